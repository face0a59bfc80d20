"""Toxicity by weak supervision.

Lexicons of words and word beginnings are drawn from labelled training rows; they and
some patterns are voters. A generative model with a tree of correlated voters estimates
how accurate each voter (the given label is one) is and yields posterior labels, on
which a linear classifier over the lexicon entries is trained.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradus.llm.base import draw, map_batches, materialise, trainable

WORD = re.compile(r"[^\W\d_]+")
BEGINNINGS = (3, 4, 5, 6)

# Labelled rows that a training reads, at most about so many, and the entries it keeps.
TRAINING_ROWS = 16_000
ENTRIES = 3000
LEAST_ROWS = 4

# Standard errors by which the shares of toxic and other rows with an entry differ at least.
LEAST_Z = 4.0

# Lexicons by kind of entry (words, and beginnings by length), each cut into ranks.
LEXICON = 40
LEXICONS = 4

PATTERNS = {
    "shouting": re.compile(r"!!"),
    "marks": re.compile(r"[%#*$&]{3}"),
    "capitals": re.compile(r"\b[A-Z]{4,}\b"),
    "bars": re.compile(r" \| "),
    "figures": re.compile(r"[0-9]{3}"),
    "licence": re.compile(r"[Ll]icense"),
    "repeats": re.compile(r"\b(\w+) \1 \1\b"),
}

# Words that are remembered with their entries by a task.
MEMORY = 400_000

# Characters read at once.
SLICE = 1 << 20


def entries(word: str) -> list[str]:
    return [word, *(word[:k] + "-" for k in BEGINNINGS if len(word) >= k)]


def word_set(text: str | None) -> set[str]:
    """Distinct lower-cased words of a whole text."""
    text, found, at = text or "", set(), 0
    while at < len(text):
        end = text.find(" ", at + SLICE)
        end = len(text) if end < 0 else end
        found.update(WORD.findall(text[at:end].lower()))
        at = end
    return found


def patterns(text: str | None) -> list[int]:
    return [int(p.search(text or "") is not None) for p in PATTERNS.values()]


class Lookup:
    """The known entries of words, remembered word by word."""

    def __init__(self, numbers: dict[str, int]):
        self.numbers = numbers
        self.seen: dict[str, tuple[int, ...]] = {}

    def __call__(self, text: str | None) -> set[int]:
        if len(self.seen) > MEMORY:
            self.seen.clear()
        found, seen, get = set(), self.seen, self.numbers.get
        for word in word_set(text):
            own = seen.get(word)
            if own is None:
                own = seen[word] = tuple(k for e in entries(word) if (k := get(e)) is not None)
            found.update(own)
        return found


@dataclass
class ToxicityModel:
    """Weights of entries, then of patterns, and the constant."""

    numbers: dict[str, int]
    weights: np.ndarray
    bias: float

    def score(self, active: set[int], marks: list[int]) -> float:
        n = len(self.numbers)
        total = math.fsum([self.bias, *(self.weights[k] for k in active), *(self.weights[n + k] for k, x in enumerate(marks) if x)])
        return 1 / (1 + math.exp(-total)) if total > -700 else 0.0


def label_model(votes: np.ndarray, given: np.ndarray, rounds: int = 25) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """Posterior of class 1 for each row, from votes and the given label as one more voter.

    ``votes`` (row, voter) is 0 or 1. Each voter depends on the class and on one other
    voter, its parent in a tree of the largest mutual information given the class
    (so voters that say the same count once). Returns the posterior, the chance of a
    vote by (class, parent's vote, voter), and the parents; the root's is -1.
    """
    rows, n = votes.shape
    x = votes.astype(float)
    parents = [-1] * n
    belief = np.where(given > 0, 0.98, 0.02)
    for turn in range(2):
        # a tree by mutual information under the posterior, first from the labels, then once more from the model
        info = np.zeros((n, n))
        for weight in (belief, 1 - belief):
            mass = weight.sum() + 1e-9
            one = (weight @ x + 0.5) / (mass + 1)
            both = ((x * weight[:, None]).T @ x + 0.25) / (mass + 1)
            part = np.zeros((n, n))
            for joint, a, b in (
                (both, one[:, None], one[None, :]),
                (one[:, None] - both, one[:, None], 1 - one[None, :]),
                (one[None, :] - both, 1 - one[:, None], one[None, :]),
                (1 - one[:, None] - one[None, :] + both, 1 - one[:, None], 1 - one[None, :]),
            ):
                joint = np.maximum(joint, 1e-9)
                part += joint * np.log(joint / np.maximum(a * b, 1e-12))
            info += mass / rows * part
        parents, inside = [-1] * n, {0}
        while len(inside) < n:
            _, k, parent = max((info[i, j], -j, i) for i in inside for j in range(n) if j not in inside)
            parents[-k] = parent
            inside.add(-k)
        above = np.where(np.array(parents) < 0, 0, np.array(parents))
        up = np.where(np.array(parents) < 0, 0.0, x[:, above])
        for _ in range(rounds):
            share = belief.mean()
            log_odds = np.full(rows, np.log(share + 1e-9) - np.log(1 - share + 1e-9))
            chance = np.zeros((2, 2, n))
            for label, weight in ((1, belief), (0, 1 - belief)):
                sign = 1 if label else -1
                for value in (0, 1):
                    of = (up == value) * weight[:, None]
                    # a vote is likelier than not to be right: one row's worth of prior belief
                    chance[label, value] = ((of * x).sum(0) + 0.05) / (of.sum(0) + 1.0)
                p = np.where(up == 1, chance[label, 1], chance[label, 0])
                log_odds += sign * np.log(np.where(x == 1, p, 1 - p)).sum(1)
                hit = (weight @ given + 0.05) / (weight.sum() + 1.0)
                hit = min(hit, 0.005) if not label else max(hit, 0.97)
                log_odds += sign * np.log(np.where(given == 1, hit, 1 - hit))
            belief = 1 / (1 + np.exp(-np.clip(log_odds, -30, 30)))
    return belief, chance, parents


def fit_linear(rows: np.ndarray, columns: np.ndarray, n: int, width: int, target: np.ndarray, rounds: int = 300,
               ridge: float = 0.3) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels over 0/1 features, given by (row, column) pairs."""
    weights, bias = np.zeros(width), float(np.log((target.mean() + 1e-6) / (1 - target.mean() + 1e-6)))
    squares, bias_squares = np.full(width, 1e-3), 1e-3
    for _ in range(rounds):
        z = np.bincount(rows, weights[columns], n) + bias
        miss = target - 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        slope = np.bincount(columns, miss[rows], width) - ridge * weights
        squares += slope**2
        weights += 0.5 * slope / np.sqrt(squares)
        bias_squares += miss.sum() ** 2
        bias += 0.5 * miss.sum() / np.sqrt(bias_squares)
    return weights, bias


def train_toxicity(
    docs: DataFrame, labels: DataFrame, usable: Column | None = None, rows: int = TRAINING_ROWS
) -> ToxicityModel:
    """Lexicons, label model and classifier from about ``rows`` labelled documents, chosen by a hash of the id.

    Reads labels only of rows for which ``usable`` holds (default: outside the held-out
    fold). Without labelled rows, or with one class only, the model scores all texts alike.
    """
    usable = trainable(F.col("doc_id")) if usable is None else usable
    known = labels.select("doc_id", "toxic").where(usable & F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull())
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    total = known.count()
    chosen = known.where(draw(F.lit(3), F.col("doc_id")) * F.lit(float(total or 1)) < F.lit(float(rows)))
    # the labels are bounded by ``rows``, so they may be broadcast
    # and the rows that have them are written once, as three steps read them
    sample = materialise(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id"))

    def count(batches):
        found: dict[str, list[int]] = {}
        for batch in batches:
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
                for e in {e for w in word_set(text) for e in entries(w)}:
                    found.setdefault(e, [0, 0])[toxic] += 1
            if len(found) > MEMORY:
                yield counted(found)
                found = {}
        yield counted(found)

    def counted(found) -> pa.RecordBatch:
        values = list(found.values())
        return pa.RecordBatch.from_arrays(
            [pa.array(list(found), pa.string()), *(pa.array([v[k] for v in values], pa.int64()) for k in (0, 1))],
            ["entry", "clean", "toxic"],
        )

    sums = sample.select("text", F.col("toxic").cast("int").alias("toxic")).mapInArrow(
        count, "entry string, clean long, toxic long"
    ).groupBy("entry").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    sizes = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    bad, good = sizes.get(1, 0), sizes.get(0, 0)
    if not bad or not good:
        return ToxicityModel({}, np.zeros(len(PATTERNS)), 20.0 if bad else -20.0)
    share = (F.col("clean") + F.col("toxic")) / F.lit(float(bad + good))
    spread = F.sqrt(share * (1 - share) * F.lit(1 / bad + 1 / good)) + 1e-6
    best = (
        sums.where(F.col("clean") + F.col("toxic") >= LEAST_ROWS)
        .withColumn("z", (F.col("toxic") / F.lit(float(bad)) - F.col("clean") / F.lit(float(good))) / spread)
        .where(F.abs("z") >= LEAST_Z)
        .orderBy(F.abs("z").desc(), "entry")
        .limit(ENTRIES)
        .collect()
    )
    numbers = {r["entry"]: k for k, r in enumerate(best)}

    def encode(batch):
        lookup, active, marks = Lookup(numbers), [], []
        for text in batch.column("text").to_pylist():
            active.append(sorted(lookup(text)))
            marks.append(patterns(text))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array(active, pa.list_(pa.int32())),
                pa.array(marks, pa.list_(pa.int32())),
                batch.column("toxic"),
            ],
            ["doc_id", "active", "marks", "toxic"],
        )

    coded = map_batches(
        sample.select("doc_id", "text", F.col("toxic").cast("int").alias("toxic")),
        encode,
        f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, active array<int>, marks array<int>, toxic int",
    ).toPandas().sort_values("doc_id")
    given = coded["toxic"].to_numpy(float)
    n, width = len(coded), len(numbers) + len(PATTERNS)
    active = [np.asarray(a, np.int64) for a in coded["active"]]
    marks = np.array([list(m) for m in coded["marks"]]).reshape(n, len(PATTERNS))
    rows_of = np.repeat(np.arange(n), [a.size for a in active])
    columns = np.concatenate(active) if rows_of.size else np.zeros(0, np.int64)

    # Voters: lexicons of entries that are frequent in one class, by kind and rank, and the patterns.
    votes = []
    for sign in (1, -1):
        for kind in (0, *BEGINNINGS):
            own = [k for k, r in enumerate(best) if r["z"] * sign > 0 and _kind(r["entry"]) == kind]
            for k in range(LEXICONS):
                member = np.zeros(len(numbers))
                member[own[k * LEXICON : (k + 1) * LEXICON]] = 1
                if member.any():
                    votes.append(np.bincount(rows_of, member[columns], n) > 0)
    votes += list(marks.T > 0)
    belief, _, _ = label_model(np.array(votes).T, given)

    spots = [np.flatnonzero(m) + len(numbers) for m in marks]
    rows_all = np.concatenate([rows_of, np.repeat(np.arange(n), [s.size for s in spots])])
    columns_all = np.concatenate([columns, *spots]).astype(np.int64)
    weights, bias = fit_linear(rows_all, columns_all, n, width, belief)
    return ToxicityModel(numbers, weights, bias)


def _kind(entry: str) -> int:
    return len(entry) - 1 if entry[-1] == "-" else 0


def predict_toxicity(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """Score (0 to 1) and prediction (score of 0.5 or more) of every whole text.

    Returns one row per input row: doc_id, score, predicted. Nulls and edges: null
    and empty texts get the score of a text without words; rows that repeat each get
    their answer. Further columns, also ones named like the result's, are not
    read. An empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model.numbers, model.weights, model.bias))

    def run(batches) -> Iterator[pa.RecordBatch]:
        own = ToxicityModel(*shared.value)
        own.weights = own.weights.tolist()
        lookup = Lookup(own.numbers)
        for batch in batches:
            scores = [own.score(lookup(t), patterns(t)) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores, pa.float64())], ["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    found = docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double")
    return found.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
