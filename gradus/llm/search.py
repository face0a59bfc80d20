"""Ranked search of many queries at once, over term sets that they share.

A document is read once: its terms that any query has, with their counts. A score is
a sum over terms, so what several queries have in common is summed up once for each
document. Terms that the same queries have (as often) form one set; queries are ordered
lists of such sets, most shared first, and equal beginnings are one node of a graph, as
in a tree of frequent patterns. Scores run along that graph, level by level.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gradus.llm.base import broadcast_if_small, map_batches, materialise
from gradus.llm.decontaminate import words
from gradus.operators.gram import sum_of_parts

BEST = 10

# Query bytes that are planned and broadcast together. More are searched part by part.
PART_BYTES = 1_000_000

# Numbers held for the documents that are scored side by side.
HELD = 1 << 21


@dataclass(frozen=True)
class Level:
    """Nodes that are sums of earlier ones: their children (one node after the other), factors and starts."""

    children: np.ndarray
    factors: np.ndarray
    starts: np.ndarray


class SharedPlan:
    """The query-sharing graph: terms first, then term sets, beginnings and at last the queries."""

    def __init__(self, texts: list[str | None]):
        counts = [Counter(w for part in words(t) for w in part) for t in texts]
        postings: dict[bytes, list[tuple[int, int]]] = defaultdict(list)
        for item, own in enumerate(counts):
            for term, times in own.items():
                postings[term].append((item, times))
        self.terms = {term: k for k, term in enumerate(sorted(postings))}

        # Terms with equal postings form a set.
        sets: dict[tuple, list[int]] = defaultdict(list)
        for term, number in self.terms.items():
            sets[tuple(postings[term])].append(number)
        order = sorted(sets, key=lambda p: (-len(p), p, sets[p]))

        self.size = len(self.terms)
        self.levels: list[Level] = []
        of_set = {}
        bundles = [p for p in order if len(sets[p]) > 1]
        for p in order:
            of_set[p] = sets[p][0]
        of_set |= dict(zip(bundles, self._add([[(t, 1) for t in sets[p]] for p in bundles])))

        lists: list[list[tuple[int, int]]] = [[] for _ in texts]
        for p in order:
            for item, times in p:
                lists[item].append((of_set[p], times))

        # Beginnings that two queries share are nodes; what follows belongs to the query alone.
        at, rest = [-1] * len(texts), list(range(len(texts)))
        depth = 0
        while rest:
            groups: dict[tuple, list[int]] = defaultdict(list)
            for item in rest:
                if depth < len(lists[item]):
                    groups[(at[item], lists[item][depth])].append(item)
            shared = {key: who for key, who in groups.items() if len(who) > 1}
            made = self._add([([(key[0], 1)] if key[0] >= 0 else []) + [key[1]] for key in shared])
            for node, who in zip(made, shared.values()):
                for item in who:
                    at[item] = node
            rest = [item for who in shared.values() for item in who]
            depth += 1
            for item in rest:
                lists[item][depth - 1] = (-1, 0)  # inside of the shared node
        tails = [[(n, f) for n, f in lists[i] if n >= 0] for i in range(len(texts))]
        self.queries = [i for i in range(len(texts)) if tails[i] or at[i] >= 0]
        whole = [([(at[i], 1)] if at[i] >= 0 else []) + tails[i] for i in self.queries]
        self.first = self.size
        self._add(whole)

    def _add(self, nodes: list[list[tuple[int, int]]]) -> list[int]:
        """Adds a level of nodes and returns their numbers."""
        if not nodes:
            return []
        flat = [pair for node in nodes for pair in node]
        starts = np.cumsum([0, *(len(n) for n in nodes[:-1])])
        self.levels.append(Level(np.array([c for c, _ in flat]), np.array([f for _, f in flat], np.int64), starts))
        made = list(range(self.size, self.size + len(nodes)))
        self.size += len(nodes)
        return made

    def additions(self) -> int:
        """Sums for each document, to be compared with one for each term of each query."""
        return sum(len(level.children) for level in self.levels)

    def scores(self, held: np.ndarray) -> np.ndarray:
        """Scores (queries by documents) from accumulators whose first rows are those of the terms."""
        at = len(self.terms)
        for level in self.levels:
            parts = held[level.children]
            if (level.factors != 1).any():
                parts *= level.factors[:, None]
            np.add.reduceat(parts, level.starts, axis=0, out=held[at : at + len(level.starts)])
            at += len(level.starts)
        return held[self.first :]


def _postings(docs: DataFrame, plan: SharedPlan) -> DataFrame:
    """doc_id, number of words, and the plan's terms that the document has, with their counts."""
    shared = docs.sparkSession.sparkContext.broadcast(plan.terms)

    def run(batch):
        get, sizes, terms, times, starts = shared.value.get, [], [], [], [0]
        for text in batch.column("text").to_pylist():
            n, own = 0, Counter()
            for part in words(text):
                n += len(part)
                for word, c in Counter(part).items():
                    number = get(word)
                    if number is not None:
                        own[number] += c
            sizes.append(n)
            terms += own.keys()
            times += own.values()
            starts.append(len(terms))
        offsets = pa.array(starts, pa.int32())
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array(sizes, pa.int64()),
                pa.ListArray.from_arrays(offsets, pa.array(terms, pa.int32())),
                pa.ListArray.from_arrays(offsets, pa.array(times, pa.int64())),
            ],
            ["doc_id", "n", "terms", "times"],
        )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_batches(docs.select("doc_id", "text"), run, f"doc_id {kind}, n long, terms array<int>, times array<bigint>")


def _document_counts(postings: DataFrame, size: int) -> np.ndarray:
    """How many documents hold each term."""

    def part(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        total = np.zeros(size)
        for batch in batches:
            total += np.bincount(batch.column(0).flatten().to_numpy(), minlength=size)
        return total

    return sum_of_parts(postings.select("terms"), part, size).astype(np.int64)


def term_weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def length_norm(n: int, documents: int, length: int) -> int:
    return 100 - 75 + (75 * n * documents) // length


class _Best:
    """The best documents of every query so far; equal scores by id, ids before none."""

    def __init__(self, queries: int, best: int):
        self.best = best
        self.rows: list[list[tuple]] = [[] for _ in range(queries)]
        self.least = np.ones(queries, np.int64)

    def add(self, scores: np.ndarray, ids: list) -> None:
        hit = scores >= self.least[:, None]
        for q in np.flatnonzero(hit.any(axis=1)).tolist():
            some = np.flatnonzero(hit[q])
            rows = self.rows[q] + [(-s, ids[d] is None, ids[d]) for s, d in zip(scores[q, some].tolist(), some.tolist())]
            self.rows[q] = sorted(rows, key=lambda r: r if not r[1] else (*r[:2], 0))[: self.best]
            if len(self.rows[q]) == self.best:
                self.least[q] = -self.rows[q][-1][0]


def _search(postings: DataFrame, plan: SharedPlan, numbers: list[int], best: int) -> DataFrame:
    """Per task the best documents of each query: item (its number), doc_id, score."""
    documents, length = postings.where("n > 0").agg(F.count("*"), F.sum("n")).first()
    kind = postings.schema["doc_id"].dataType.simpleString()
    schema = f"item long, doc_id {kind}, score long"
    if not documents or not plan.queries:
        return postings.sparkSession.createDataFrame([], schema)
    held_by = _document_counts(postings, len(plan.terms)).tolist()
    weights = np.array([term_weight(documents, c) for c in held_by], np.int64)
    shared = postings.sparkSession.sparkContext.broadcast((plan, weights))
    names = [numbers[q] for q in plan.queries]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan, weights = shared.value
        found, block, id_type = _Best(len(names), best), max(1, HELD // plan.size), None
        for batch in batches:
            id_type = batch.schema.field("doc_id").type
            for start in range(0, batch.num_rows, block):
                some = batch.slice(start, block)
                sizes = some.column("n").to_pylist()
                norms = np.array([length_norm(n, documents, length) for n in sizes], np.int64)
                lists = some.column("terms")
                doc = np.repeat(np.arange(len(sizes)), lists.value_lengths().to_numpy())
                terms = lists.flatten().to_numpy()
                times = some.column("times").flatten().to_numpy()
                held = np.zeros((plan.size, len(sizes)), np.int64)
                held[terms, doc] = weights[terms] * ((1_000_000_000 * times) // (1000 * times + 8 * norms[doc]))
                found.add(plan.scores(held), some.column("doc_id").to_pylist())
        rows = [(name, r[2], -r[0]) for name, own in zip(names, found.rows) for r in own]
        if rows:
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([r[0] for r in rows], pa.int64()),
                    pa.array([r[1] for r in rows], id_type),
                    pa.array([r[2] for r in rows], pa.int64()),
                ],
                ["item", "doc_id", "score"],
            )

    return postings.mapInArrow(run, schema)


def ranked(docs: DataFrame, queries: DataFrame, best: int = BEST, part_bytes: int = PART_BYTES) -> DataFrame:
    """The ``best`` documents for every query, by the summed weights of its terms.

    Returns item_id, rank (from 1), doc_id and score (above 0); equal scores by doc_id.

    Queries are planned together, ``part_bytes`` of text (and one query) at a time; each part
    reads the documents once. Tasks keep the best rows of each query only, and those are
    reduced by groups of tasks first.

    Nulls and edges: null and empty texts have no terms, so such a query returns nothing and such
    a document is never found nor counted. Rows that repeat item_id and text are one query; other
    texts of one item_id, and rows with a null one, are queries of their own. Repeated documents
    are ranked each; a null doc_id comes after the others of its score. Further columns, also
    ones named like the result's, are not read. Empty tables give no rows.
    """
    wanted = queries.select("item_id", "text").where("text IS NOT NULL").distinct()
    size = wanted.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-size // part_bytes))
    # Numbers of the queries, in a written copy.
    wanted = materialise(
        wanted.select(
            "item_id", "text", F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)).alias("part"),
            F.monotonically_increasing_id().alias("item"),
        )
    )
    found = None
    for k in range(parts):
        items = wanted.where(F.col("part") == k).select("item", "text").orderBy("item").collect()
        plan = SharedPlan([r["text"] for r in items])
        more = _search(materialise(_postings(docs, plan)), plan, [r["item"] for r in items], best)
        found = more if found is None else found.unionByName(more)
    groups = max(1, math.isqrt(docs.rdd.getNumPartitions()))
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    # Of each group of tasks the best, then the best of those.
    grouped = found.withColumn("group", F.pmod(F.spark_partition_id(), F.lit(groups)))
    some = grouped.withColumn("rank", F.row_number().over(Window.partitionBy("item", "group").orderBy(*order)))
    some = some.where(F.col("rank") <= best)
    last = some.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order)))
    names = broadcast_if_small(wanted.select("item", "item_id"))
    return last.where(F.col("rank") <= best).join(names, "item").select("item_id", "rank", "doc_id", "score")


__all__ = ["SharedPlan", "length_norm", "ranked", "term_weight"]
