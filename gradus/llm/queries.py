"""Registered queries of the corpus operators, with SQL where it can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gradus.llm import sql
from gradus.llm import chat, html, licenses, lines, pii, toxicity
from gradus.llm.base import held_out, table
from gradus.llm.decontaminate import contamination
from gradus.llm.exact import exact_groups
from gradus.llm.langid import predict_language, train_language_model
from gradus.llm.mixing import mix
from gradus.llm.search import ranked
from gradus.llm.simhash import near_groups
from gradus.llm.whitening import whiten


def op1_html(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages")
    return html.main_text(pages, html.train_page_model(pages))


def op2_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return near_groups(table(spark, folder, "documents"))


def op3_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    found = toxicity.predict_toxicity(docs, toxicity.train_toxicity(docs, table(spark, folder, "labels")))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op4_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mix(table(spark, folder, "documents"))


def op5_chat(spark: SparkSession, folder: str) -> DataFrame:
    return chat.read_back(chat.format_turns(chat.with_probe(table(spark, folder, "conversations"))))


def op6_lines(spark: SparkSession, folder: str) -> DataFrame:
    return lines.drop_repeated_lines(table(spark, folder, "documents")).select(
        "doc_id", "n_chars", "n_chunks", "n_removed", F.sha2("text", 256).alias("text_sha256")
    )


def op6_passages(spark: SparkSession, folder: str) -> DataFrame:
    return lines.drop_repeated_passages(table(spark, folder, "documents")).select(
        "doc_id", "n_chars", "n_units", "n_removed", F.sha2("text", 256).alias("text_sha256")
    )


def op7_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    found = predict_language(docs.select("doc_id", "text"), train_language_model(docs))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op8_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return pii.personal_data(docs, pii.train_skip_chain(docs))


def op9_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark")).select(
        "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"
    )


def op10_exact(spark: SparkSession, folder: str) -> DataFrame:
    return exact_groups(table(spark, folder, "documents"))


def op11_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whiten(table(spark, folder, "embeddings"))


def op12_licenses(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.find_licences(table(spark, folder, "documents"))


def op13_search(spark: SparkSession, folder: str) -> DataFrame:
    return ranked(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_html, op2_simhash, op3_toxicity, op4_mixing, op5_chat, op6_lines, op7_language, op8_personal_data,
        op9_decontamination, op10_exact, op6_passages, op11_whitening, op12_licenses, op13_search,
    )
}
SQL = {
    "op4_mixing": sql.MIXING,
    "op5_chat": sql.CHAT,
    "op6_lines": sql.LINES,
    "op9_decontamination": sql.DECONTAMINATION,
    "op10_exact": sql.EXACT,
    "op12_licenses": sql.LICENCES,
    "op13_search": sql.SEARCH,
}
