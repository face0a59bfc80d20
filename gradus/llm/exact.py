"""Exact duplicates by recipes of content-defined chunks.

A text is cut where a hash of the last eight bytes says so, so equal stretches of
different texts give equal chunks. The ordered chunk hashes of a text are its
recipe. Texts can only be equal if their recipes are, so only recipes are
compared over the whole corpus; bytes of a chunk move only for texts that share
their recipe with another one, once for each task that holds them.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradus.llm.base import keep_matching, map_batches, materialise, text_mark, without_rows

# Runs of white space that are not one plain space already.
SPACE_RUN = re.compile(rb"[\t-\r][\t-\r ]*| [\t-\r ]+")

WINDOW = 8
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
CUT_BITS = 10  # a cut in 1024 positions on average
LEAST, MOST = 256, 8192
HASH_BITS = 64


def normalise(text: str | None) -> bytes:
    """UTF-8 bytes with every run of white space made one space; null is empty."""
    return SPACE_RUN.sub(b" ", (text or "").encode())


def cuts(data: bytes) -> list[int]:
    """Ends of the chunks of a text; they depend on the bytes around them alone."""
    n = len(data)
    if n <= LEAST:
        return [n] if n else []
    found = []
    for start in range(0, n - WINDOW + 1, 1 << 20):  # in slices, so that long texts need little memory
        size = min(1 << 20, n - WINDOW + 1 - start)
        seen = np.ndarray((size,), "<u8", data, start, (1,))
        found.append(np.flatnonzero((seen * MULTIPLIER) >> np.uint64(64 - CUT_BITS) == 0) + start + WINDOW)
    ends, last = [], 0
    for at in (*np.concatenate(found).tolist(), n):
        while at - last > MOST:
            last += MOST
            ends.append(last)
        if at - last >= LEAST or (at == n and at > last):
            ends.append(at)
            last = at
    return ends


def chunks(data: bytes, hash_bits: int = HASH_BITS) -> list[tuple[int, bytes]]:
    """The chunks of a text with their hashes (signed, of so many bits), in order."""
    out, last = [], 0
    for end in cuts(data):
        piece = data[last:end]
        number = xxhash.xxh3_64_intdigest(piece) >> (64 - hash_bits)
        out.append((number - (1 << 64) if number >= 1 << 63 else number, piece))
        last = end
    return out


def _recipes(docs: DataFrame, hash_bits: int) -> DataFrame:
    def run(batch):
        sha, size, recipe = [], [], []
        for text in batch.column("text").to_pylist():
            data = normalise(text)
            sha.append(hashlib.sha256(data).hexdigest())
            size.append(len(data))
            recipe.append([number for number, _ in chunks(data, hash_bits)])
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                batch.column("mark"),
                pa.array(sha),
                pa.array(size, pa.int64()),
                pa.array(recipe, pa.list_(pa.int64())),
            ],
            ["doc_id", "mark", "text_sha256", "n_bytes", "recipe"],
        )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_batches(
        docs.select("doc_id", "text", text_mark().alias("mark")),
        run,
        f"doc_id {kind}, mark long, text_sha256 string, n_bytes long, recipe array<bigint>",
    )


def _pieces(docs: DataFrame, hash_bits: int) -> DataFrame:
    """Each chunk with its bytes, a repeated one once for each batch."""

    def run(batch):
        seen = {piece for text in batch.column("text").to_pylist() for piece in chunks(normalise(text), hash_bits)}
        names, pieces = zip(*seen) if seen else ((), ())
        yield pa.RecordBatch.from_arrays(
            [pa.array(names, pa.int64()), pa.array(pieces, pa.binary())], ["chunk", "bytes"]
        )

    return map_batches(docs.select("text"), run, "chunk long, bytes binary")


def _variants(docs: DataFrame, collided: DataFrame, hash_bits: int) -> DataFrame:
    """Recipe with hash and bytes of the chunks whose hash stands for different bytes."""
    names = [row[0] for row in collided.collect()]

    def run(batch):
        wanted, ids, whole, marks = set(names), [], [], []
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
            data = normalise(text)
            own = chunks(data, hash_bits)
            if any(number in wanted for number, _ in own):
                ids.append(doc_id)
                whole.append(hashlib.sha256(data).hexdigest())
                parts = [piece if number in wanted else b"" for number, piece in own]
                marks.append(hashlib.sha256(b"".join(len(p).to_bytes(8, "big") + p for p in parts)).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, batch.column("doc_id").type), pa.array(whole, pa.string()), pa.array(marks, pa.string())],
            ["doc_id", "text_sha256", "variant"],
        )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_batches(docs.select("doc_id", "text"), run, f"doc_id {kind}, text_sha256 string, variant string")


def exact_groups(docs: DataFrame, hash_bits: int = HASH_BITS) -> DataFrame:
    """The group of equal texts of every document.

    Texts are equal when they agree after each run of white space (space, tab to
    carriage return) became one space. Returns one row per input row: doc_id,
    keep_id (smallest doc_id of the group), group_size, kept, text_sha256 (of the
    normalised text).

    Nulls and edges: a null text is empty, and empty texts are equal. Rows that
    repeat a doc_id with the same text stay or go together. A row with a null
    doc_id counts in its group, but is never kept in place of one with an id; in a
    group without ids keep_id is null and the rows are kept. Further columns, also ones
    named like the result's, are not read. An empty table gives no rows.

    ``hash_bits`` shortens the chunk hashes, for tests of the byte comparison.
    """
    return _groups(docs, hash_bits).drop("mark")


def _groups(docs: DataFrame, hash_bits: int) -> DataFrame:
    """The rows of ``exact_groups`` with the marks of their texts."""
    recipes = materialise(_recipes(docs, hash_bits))
    repeated = materialise(
        recipes.groupBy("n_bytes", "recipe").agg(F.min("doc_id").alias("low"), F.count("*").alias("n")).where("n > 1")
    )
    keys = ["n_bytes", "recipe"]
    suspects = materialise(
        recipes.where("n_bytes > 0")
        .join(repeated.select(*keys), keys, "left_semi")
        .select("doc_id")
        .where("doc_id IS NOT NULL")
        .distinct()
    )
    # Every hash that stands for one string of bytes is verified; the others are told apart by their bytes.
    texts = keep_matching(docs.select("doc_id", "text"), suspects, "doc_id")
    nameless = docs.select("doc_id", "text").where("doc_id IS NULL")
    suspected = texts.unionByName(nameless)
    collided = materialise(
        _pieces(suspected, hash_bits)
        .groupBy("chunk")
        .agg(F.min("bytes").alias("low"), F.max("bytes").alias("high"))
        .where("low <> high")
        .select("chunk")
    )
    if collided.isEmpty():
        groups, same = repeated, keys
        named = recipes
    else:
        variants = materialise(_variants(suspected, collided, hash_bits))
        told = variants.distinct()
        of_row = recipes["doc_id"].eqNullSafe(told["doc_id"]) & (recipes["text_sha256"] == told["text_sha256"])
        named = recipes.join(told, of_row, "left").select(
            recipes["*"], F.coalesce("variant", F.lit("")).alias("variant")
        )
        same = [*keys, "variant"]
        groups = named.groupBy(*same).agg(F.min("doc_id").alias("low"), F.count("*").alias("n")).where("n > 1")
    found = named.join(groups, same, "left")
    return found.select(
        "doc_id",
        "mark",
        F.when(F.col("n").isNull(), F.col("doc_id")).otherwise(F.col("low")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        (F.col("n").isNull() | F.col("doc_id").eqNullSafe(F.col("low"))).alias("kept"),
        "text_sha256",
    )


def drop_exact(docs: DataFrame, hash_bits: int = HASH_BITS) -> DataFrame:
    """The documents without the copies of an earlier text; all columns stay.

    Nulls and edges: as ``exact_groups``; the verdict is that of the row. So another text of a repeated
    doc_id stays, rows that repeat id and text go or stay together, and a row without an id goes
    where a row with an id has its text.
    """
    return without_rows(docs, _groups(docs, hash_bits).where("NOT kept").select("doc_id", "mark"))
