"""The corpus pipeline: five operators in a row over the documents.

Each stage takes (spark, docs, sf_dir) and returns a frame. ``run`` writes what a
stage returns as Parquet in the shared folder and hands the written rows to the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gradus.llm.base import DOCUMENT_COLUMNS, prepare, table
from gradus.llm.decontaminate import drop_contaminated
from gradus.llm.exact import drop_exact
from gradus.llm.langid import drop_unidentified, train_language_model
from gradus.llm.mixing import sample_mixed
from gradus.llm.simhash import drop_near
from gradus.session import drop_path, materialise_at, written_copies

# Language models, chunk recipes and fingerprints have no counterpart in SQL.
ORACLE_SQL = None


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents in one of the languages that the corpus itself labels.

    Null, empty and letterless texts go; ids may be null or repeated, as each row is judged alone.
    """
    prepare(spark)
    return drop_unidentified(docs, train_language_model(docs)).select(*DOCUMENT_COLUMNS)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the first of equal texts.

    Null texts are empty and equal. Rows that repeat id and text stay or go together, another text of
    the same id stays, and of equal texts without any id all stay.
    """
    prepare(spark)
    return drop_exact(docs).select(*DOCUMENT_COLUMNS)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the first of each group of near duplicates.

    Texts without words are one group. Rows that share the smallest id of a group all stay, and so does a
    group without ids.
    """
    prepare(spark)
    return drop_near(docs).select(*DOCUMENT_COLUMNS)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold benchmark passages.

    Texts without words stay; each row is judged alone.
    """
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark")).select(*DOCUMENT_COLUMNS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Samples documents to the target weights; adds the weight of a sampled document.

    Rows with a null source or language are a cell of their own; rows that repeat an id are drawn alike.
    """
    prepare(spark)
    return sample_mixed(docs).select(*DOCUMENT_COLUMNS, "sample_weight")


STAGES = [
    ("language", language),
    ("exact", exact),
    ("near", near),
    ("decontaminate", decontaminate),
    ("mix", mix),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, from the documents table on.

    Once the result of a stage is written, the copies that it read and made are deleted.
    """
    before = set(written_copies(spark))
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs, path = materialise_at(stage(spark, docs, sf_dir))
        for copy in set(written_copies(spark)) - before - {path}:
            drop_path(spark, copy)
    return docs
