"""Near duplicates by SimHash, found in a grid of segment bit counts.

A fingerprint is embedded as the bit counts of its 32 two-bit segments. Flipping one
bit moves one count by one, so the Manhattan distance of two embeddings is at most
the Hamming distance of the fingerprints. Fingerprints within three bits are within
distance one in one of the two halves of the embedding: a range join of radius one on
a grid with unit cells over each half finds them all, and the bits are then compared.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradus.llm.base import (
    broadcast_if_small, keep_matching, map_batches, materialise, text_mark, without_rows, word_pieces,
)

# Lower-cases A-Z and makes tab to carriage return spaces.
FOLD = bytes(b + 32 if 65 <= b <= 90 else 32 if 9 <= b <= 13 else b for b in range(256))

SHINGLE = 3
SEED = 42
MOST_BITS = 3

# Segments of a half of the fingerprint; each has two bits, so its count takes two bits.
SEGMENTS = 16

# A cell with more fingerprints than this is searched in blocks of at most about BLOCK.
CROWD = 32
BLOCK = 2048


def fingerprint(text: str | None) -> int:
    """SimHash of the word shingles of a text; zero without words."""
    votes, total, carry = np.zeros(64, np.int64), 0, []
    for words in word_pieces((text or "").encode().translate(FOLD)):
        words = carry + words
        if len(words) >= SHINGLE:
            grams = zip(*(words[k:] for k in range(SHINGLE)))
            hashes = np.fromiter((xxhash.xxh64_intdigest(b" ".join(g), SEED) for g in grams), np.uint64)
            for k in range(0, hashes.size, 1 << 16):
                some = hashes[k : k + (1 << 16)]
                votes += np.unpackbits(some.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
            total += hashes.size
        carry = words[-(SHINGLE - 1) :] if len(words) >= SHINGLE else words
    if not total and carry:
        return xxhash.xxh64_intdigest(b" ".join(carry), SEED)
    return int(np.packbits(votes * 2 > total, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, mark of the text and fingerprint (as a signed number) of every row."""

    def run(batch):
        found = np.array([fingerprint(t) for t in batch.column("text").to_pylist()], np.uint64)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("mark"), pa.array(found.view(np.int64))], ["doc_id", "mark", "fp"]
        )

    kind = docs.schema["doc_id"].dataType.simpleString()
    marked = docs.select("doc_id", "text", text_mark().alias("mark"))
    return map_batches(marked, run, f"doc_id {kind}, mark long, fp long")


def _counts(half: Column) -> Column:
    """Bit counts of the two-bit segments of 32 bits, two bits each."""
    return half - F.shiftright(half, 1).bitwiseAND(F.lit(0x55555555).cast("long"))


def cells(prints: DataFrame) -> DataFrame:
    """Grid cells: the own cell of a fingerprint in each half, and the cells one step up.

    Of two cells at distance one, one is a step up from the other, so steps down are not needed.
    """
    low = _counts(F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF)))
    high = _counts(F.shiftrightunsigned("fp", 32))
    own = F.array(low, high + F.lit(1 << 32))
    placed = prints.select("fp", F.explode(own).alias("home"))
    steps = F.array(
        *(
            F.when(F.shiftright("home", 2 * k).bitwiseAND(F.lit(3)) < 2, F.col("home") + F.lit(1 << (2 * k)))
            for k in range(SEGMENTS)
        )
    )
    every = F.concat(F.array("home"), F.filter(steps, lambda x: x.isNotNull()))
    return placed.select("fp", "home", F.explode(every).alias("cell"))


def _search_blocks(members: DataFrame, block: int) -> DataFrame:
    """Links inside crowded cells, as spanning trees of pairs of blocks."""
    sizes = members.groupBy("cell").agg(F.ceil(F.count("*") / block).cast("long").alias("blocks"))
    placed = members.join(broadcast_if_small(sizes), "cell")
    own = F.pmod(F.xxhash64("fp"), F.col("blocks"))
    placed = placed.select("cell", "fp", own.alias("own"), F.explode(F.expr("sequence(0L, blocks - 1)")).alias("k"))
    pairs = placed.select("cell", "fp", F.least("own", "k").alias("a"), F.greatest("own", "k").alias("b"))

    def search(group: pd.DataFrame) -> pd.DataFrame:
        left = np.unique(group["fp"].to_numpy()).view(np.uint64)
        links = []
        while left.size:
            reached, left = [left[0]], left[1:]
            while reached and left.size:
                at = reached.pop()
                near = np.bitwise_count(left ^ at) <= MOST_BITS
                links += [(at, x) for x in left[near]]
                reached += list(left[near])
                left = left[~near]
        found = np.array(links, np.uint64).reshape(-1, 2).view(np.int64)
        return pd.DataFrame({"a": found[:, 0], "b": found[:, 1]})

    return pairs.groupBy("cell", "a", "b").applyInPandas(search, "a long, b long")


def links(prints: DataFrame, crowd: int = CROWD, block: int = BLOCK) -> DataFrame:
    """Pairs (a, b) of different fingerprints within three bits.

    Complete in cells with at most ``crowd`` fingerprints; of larger cells only
    enough pairs to connect what is connected.
    """
    found = cells(prints)
    homes = found.where("cell = home").select("cell", "fp")
    full = materialise(homes.groupBy("cell").count().where(F.col("count") > crowd).select("cell"))
    near = F.bit_count(F.col("fp").bitwiseXOR(F.col("other"))) <= MOST_BITS
    pairs = keep_matching(homes, full, "cell", "left_anti").withColumnRenamed("fp", "other")
    sparse = found.join(pairs, "cell").where(near & ((F.col("cell") != F.col("home")) | (F.col("fp") < F.col("other"))))
    sparse = sparse.select(F.least("fp", "other").alias("a"), F.greatest("fp", "other").alias("b"))
    if full.isEmpty():
        return sparse.distinct()
    crowded = keep_matching(found.select("cell", "fp"), full, "cell")
    dense = _search_blocks(crowded, block).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    return sparse.unionByName(dense).distinct()


def components(edges: DataFrame) -> DataFrame:
    """Connected components of (a, b) with a < b: node and root (smallest node), by alternating stars.

    Each round every node hands its larger, then its smaller neighbours to the
    smallest one it knows. Rounds end when the edges stay the same; then every
    node points to its root. A few rounds suffice, each from a written copy.
    """

    def checksum(df: DataFrame):
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    edges = materialise(edges.select("a", "b").distinct())
    before = checksum(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        larger = both.join(least, "a").where("b > a").select(F.col("m").alias("a"), "b").where("a <> b").distinct()
        larger = materialise(larger)
        least = larger.groupBy("b").agg(F.min("a").alias("m"))
        joined = larger.join(least, "b")
        smaller = joined.where("a <> m").select(F.col("m").alias("a"), F.col("a").alias("b"))
        edges = materialise(smaller.unionByName(joined.select(F.col("m").alias("a"), "b")).distinct())
        now = checksum(edges)
        if now == before:
            return edges.select(F.col("b").alias("node"), F.col("a").alias("root"))
        before = now


def near_groups(docs: DataFrame, crowd: int = CROWD, block: int = BLOCK) -> DataFrame:
    """Fingerprint and component of every document.

    Returns one row per input row: doc_id, fingerprint (16 hex digits) and
    component_id, the smallest doc_id that is reachable over links of at most three
    differing bits.

    Nulls and edges: null and empty texts have fingerprint zero, which links like any
    other. A null doc_id gets the component of its links; component_id is null if no
    document of the component has an id. Rows that repeat a doc_id are each
    returned. Further columns, also ones named like the result's, are not read.
    An empty table gives no rows.
    """
    return _near_rows(docs, crowd, block).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def _near_rows(docs: DataFrame, crowd: int = CROWD, block: int = BLOCK) -> DataFrame:
    """doc_id, mark, fp and component_id of every row."""
    rows = materialise(fingerprints(docs))
    prints = materialise(rows.groupBy("fp").agg(F.min("doc_id").alias("low")))
    stars = components(links(prints.select("fp"), crowd, block))
    rooted = prints.join(stars, prints["fp"] == stars["node"], "left").select(
        "fp", "low", F.coalesce("root", "fp").alias("root"), F.col("root").isNotNull().alias("linked")
    )
    # Most fingerprints are their own component; only the others look for their smallest document.
    roots = stars.select("root").distinct().withColumnRenamed("root", "r")
    rooted = rooted.join(broadcast_if_small(roots), F.col("root") == F.col("r"), "left")
    shared = materialise(rooted.where("r IS NOT NULL").select("fp", "low", "root"))
    lowest = shared.groupBy("root").agg(F.min("low").alias("component_id"))
    known = shared.join(lowest, "root").select("fp", "component_id").unionByName(
        rooted.where("r IS NULL").select("fp", F.col("low").alias("component_id"))
    )
    return rows.join(materialise(known), "fp").select("doc_id", "mark", "fp", "component_id")


def drop_near(docs: DataFrame) -> DataFrame:
    """One document of each component, the one with the smallest id; all columns stay.

    Nulls and edges: as ``near_groups``; the verdict is that of the row. So another text of a repeated
    doc_id stays unless it is in the component of a smaller id, rows that share the smallest id
    all stay, a row without an id goes where its component has one, and stays otherwise.
    """
    gone = _near_rows(docs).where("component_id IS NOT NULL AND NOT doc_id <=> component_id")
    return without_rows(docs, gone.select("doc_id", "mark"))
