"""What the corpus operators share: tables, folds, batches, written copies."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gradus.session import broadcast_if_small, configure, materialise

# Rows per Arrow batch. Texts may be long, so a batch holds few of them.
BATCH_ROWS = 512

# One row in so many (by the checksum of its id) is held out of every training.
FOLDS = 5

DOCUMENT_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def prepare(spark: SparkSession) -> SparkSession:
    """Runtime settings of the operators, with small Arrow batches."""
    configure(spark).conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{folder}/{name}.parquet")


def fold(doc_id: Column) -> Column:
    """Remainder of the checksum of the id as text; null for a null id."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(FOLDS))


def held_out(doc_id: Column) -> Column:
    """True for the rows that no training may read labels of; false for a null id."""
    return F.coalesce(fold(doc_id) == 0, F.lit(False))


def trainable(doc_id: Column) -> Column:
    """True for the rows whose labels a training may read; a null id is not among them."""
    return F.coalesce(fold(doc_id) != 0, F.lit(False))


def draw(*key: Column) -> Column:
    """A number in [0, 1) that depends on the key alone."""
    return F.pmod(F.xxhash64(*key), F.lit(1 << 40)) / F.lit(float(1 << 40))


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]], schema: str | StructType):
    """Apply a function to each Arrow batch of the frame."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                yield from fn(batch)

    return df.mapInArrow(run, schema)


def word_pieces(data: bytes, size: int = 1 << 22) -> Iterator[list[bytes]]:
    """The words between plain spaces, some megabytes of a text at a time."""
    start = 0
    while start < len(data):
        end = data.find(b" ", start + size)
        end = len(data) if end < 0 else end
        yield data[start:end].split()
        start = end


def text_mark(text: str = "text") -> Column:
    """A hash of the text, which tells rows of one id apart; a null text is empty."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def columns_of(df: DataFrame) -> list[Column]:
    """All columns, whatever characters their names have."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in df.columns]


def unused_name(df: DataFrame, stem: str) -> str:
    """A column name that the frame does not have."""
    taken = {c.lower() for c in df.columns}
    while stem.lower() in taken:
        stem += "_"
    return stem


def without_rows(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """The rows whose id and text are not listed in ``gone`` (doc_id, mark); ids may be null or repeated."""
    names = unused_name(docs, "_gone_id"), unused_name(docs, "_gone_mark")
    listed = gone.select(F.col("doc_id").alias(names[0]), F.col("mark").alias(names[1])).distinct()
    same = F.col("doc_id").eqNullSafe(F.col(names[0])) & (text_mark() == F.col(names[1]))
    return docs.join(broadcast_if_small(materialise(listed)), same, "left_anti")


def keep_matching(df: DataFrame, keys: DataFrame, on: str, how: str = "left_semi") -> DataFrame:
    """Rows with (``left_semi``) or without (``left_anti``) a partner in a list of keys.

    The list is broadcast if a count proves it small; otherwise the join shuffles.
    """
    return df.join(broadcast_if_small(keys), on, how)


__all__ = [
    "BATCH_ROWS", "DOCUMENT_COLUMNS", "broadcast_if_small", "columns_of", "draw", "fold", "held_out", "keep_matching",
    "map_batches", "materialise", "prepare", "table", "text_mark", "trainable", "unused_name", "without_rows",
    "word_pieces",
]
