"""Personal data: base patterns, and a skip-chain conditional random field that adds to them.

The nodes of a document are its tokens with a digit or an at sign; all other tokens are
known to be outside. Neighbouring nodes share chain potentials. Nodes with the same or
similar digits, however far apart, share skip potentials, so that a number that is
personal data in one place is so in another, where the base patterns miss it. Labels
come from loopy message passing over the whole document.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradus.llm.base import draw, map_batches

KINDS = ("email", "ip", "card", "phone")

# The base patterns. Possessive forms match the same and never look back.
LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
EMAIL = re.compile(r"[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

NODE = re.compile(r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+")
EDGE_MARKS = "\"'.,;:!?()[]{}<>%#*$&|="
DIGIT = re.compile(r"[0-9]")

# Documents with nodes that a training reads, at most so many.
TRAINING_DOCUMENTS = 1500

# Characters around its nodes that a training reads of a document at most.
TRAINING_CHARACTERS = 20_000

# A node joins a kind beyond the base patterns from this probability on.
SURE = 0.9

ROUNDS = 12
LABELS = 1 + len(KINDS)


def luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    even = sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return (odd + even) % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and LOCAL.match(text, start - 1):
            start -= 1
        found = EMAIL.match(text, start) if start < at else None
        if found:
            yield found.span()
            done = found.end()
        at = text.find("@", max(at + 1, done))


def base_spans(text: str | None) -> list[tuple[str, int, int]]:
    """Spans (kind, start, end) of the base patterns, by start, then kind."""
    text = text or ""
    found = [("email", *s) for s in _emails(text)] if "@" in text else []
    if DIGIT.search(text):
        for m in IP.finditer(text):
            if all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255 for part in m.group().split(".")):
                found.append(("ip", *m.span()))
        for m in CARD.finditer(text):
            digits = m.group().replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                found.append(("card", *m.span()))
        if "+" in text:
            for m in PHONE.finditer(text):
                if 10 <= len(DIGIT.findall(m.group())) <= 15:
                    found.append(("phone", *m.span()))
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def nodes(text: str | None) -> list[tuple[int, int]]:
    """Ranges of the tokens with a digit or an at sign, without marks around them."""
    found = []
    for m in NODE.finditer(text or ""):
        token = m.group()
        left = len(token) - len(token.lstrip(EDGE_MARKS.replace("(", "")))
        right = len(token.rstrip(EDGE_MARKS.replace(")", "")))
        if left < right:
            found.append((m.start() + left, m.start() + right))
    return found


def shape(token: str) -> str:
    """The token with runs of letters and digits as ``a`` and ``9``."""
    return re.sub(r"[^\W\d_]+", "a", re.sub(r"[0-9]+", "9", token))[:24]


def features(text: str, places: list[tuple[int, int]]) -> Iterator[list[str]]:
    """Form of each node and of its direct neighbours."""
    shapes = [shape(text[a:b]) for a, b in places]
    for k, (a, b) in enumerate(places):
        token = text[a:b]
        digits = DIGIT.findall(token)
        own = [f"form {shapes[k]}", f"digits {min(len(digits), 24)}", f"form {shapes[k]} {min(len(digits), 24)}"]
        own.append("at sign" if "@" in token else "no at sign")
        own.append(f"dots {min(token.count('.'), 4)}")
        if 14 <= len(digits) <= 19:
            own.append(f"check digit {luhn(''.join(digits))}")
        if len(token) > 28:
            own.append("long")
        near = [places[k - 1][1] if k else -9, places[k + 1][0] if k + 1 < len(places) else 1 << 60]
        own.append(f"before {shapes[k - 1]}" if a - near[0] <= 2 else "before other")
        own.append(f"after {shapes[k + 1]}" if near[1] - b <= 2 else "after other")
        before = text[max(0, a - 3) : a].strip()
        own.append(f"mark {before[-1]}" if before and not before[-1].isalnum() else "no mark")
        yield own


def edges(text: str, places: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
    """Pairs of nodes with their type: 0 for direct neighbours, 1 for the same or similar digits.

    Similar nodes are linked one to the next, so a number that occurs often has few edges.
    """
    found = [(k, k + 1, 0) for k in range(len(places) - 1) if places[k + 1][0] - places[k][1] <= 2]
    last: dict[tuple, int] = {}
    for k, (a, b) in enumerate(places):
        token = text[a:b].lower()
        digits = "".join(DIGIT.findall(token))
        keys = {("token", token)} if len(token) >= 4 else set()
        if len(digits) >= 7:
            keys |= {("end", digits[-7:]), ("begin", digits[:7])}
        linked = set()
        for key in keys:
            if key in last and last[key] not in linked and (last[key], k, 0) != (k - 1, k, 0):
                linked.add(last[key])
                found.append((last[key], k, 1))
            last[key] = k
    return found


def labels_of(places: list[tuple[int, int]], spans: list[tuple[str, int, int]]) -> list[int]:
    """Label of each node: the kind of a base span that it overlaps, or 0."""
    out, k = [], 0
    for a, b in places:
        while k < len(spans) and spans[k][2] <= a:
            k += 1
        own = [s for s in spans[k : k + len(KINDS)] if s[1] < b and a < s[2]]
        out.append(1 + KINDS.index(own[0][0]) if own else 0)
    return out


@dataclass
class SkipChain:
    """Weights of (feature, label), and potentials of chain and skip edges by their two labels."""

    numbers: dict[str, int]
    weights: np.ndarray
    pairs: np.ndarray

    def emissions(self, rows: Iterator[list[str]], n: int) -> np.ndarray:
        out = np.zeros((n, LABELS))
        for k, own in enumerate(rows):
            known = [n for f in own if (n := self.numbers.get(f)) is not None]
            if known:
                out[k] = self.weights[known].sum(0)
        return out

    def beliefs(self, emit: np.ndarray, links: list[tuple[int, int, int]]) -> np.ndarray:
        """Marginal of each node by loopy belief propagation, damped, in log space."""
        if not links:
            out = np.exp(emit - emit.max(1, keepdims=True))
            return out / out.sum(1, keepdims=True)
        a, b, kind = np.array(links).T
        source, target = np.concatenate([a, b]), np.concatenate([b, a])
        table = np.concatenate([self.pairs[kind], self.pairs[kind].transpose(0, 2, 1)])
        m = len(a)
        reverse = np.concatenate([np.arange(m, 2 * m), np.arange(m)])
        messages = np.zeros((2 * m, LABELS))
        for _ in range(ROUNDS):
            inbox = emit.copy()
            np.add.at(inbox, target, messages)
            out = np.logaddexp.reduce((inbox[source] - messages[reverse])[:, :, None] + table, axis=1)
            out -= out.max(1, keepdims=True)
            if np.abs(out - messages).max() < 1e-4:
                break
            messages = 0.5 * messages + 0.5 * out
        inbox = emit.copy()
        np.add.at(inbox, target, messages)
        out = np.exp(inbox - inbox.max(1, keepdims=True))
        return out / out.sum(1, keepdims=True)


def fit(texts: list[tuple[str, list[tuple[str, int, int]]]], rounds: int = 150, ridge: float = 0.05) -> SkipChain:
    """Train by pseudo-likelihood: each node's label given its features and its neighbours' labels."""
    numbers: dict[str, int] = {}
    rows, columns, gold, links, n = [], [], [], [], 0
    for text, spans in texts:
        places = nodes(text)
        for own in features(text, places):
            columns += [numbers.setdefault(f, len(numbers)) for f in own]
            rows += [len(gold)] * len(own)
            gold.append(0)
        gold[n:] = labels_of(places, spans)
        links += [(n + a, n + b, kind) for a, b, kind in edges(text, places)]
        n += len(places)
    weights, pairs = np.zeros((len(numbers), LABELS)), np.zeros((2, LABELS, LABELS))
    if not n:
        return SkipChain(numbers, weights, pairs)
    rows, columns, gold = np.array(rows), np.array(columns), np.array(gold)
    truth = np.eye(LABELS)[gold]
    # around[k, node, label]: neighbours of the node by edge type and label
    around = np.zeros((2, n, LABELS))
    for a, b, kind in links:
        around[kind, a, gold[b]] += 1
        around[kind, b, gold[a]] += 1
    squares, pair_squares = np.full(weights.shape, 1e-3), np.full(pairs.shape, 1e-3)
    for _ in range(rounds):
        score = np.zeros((n, LABELS))
        for label in range(LABELS):
            score[:, label] = np.bincount(rows, weights[columns, label], n)
        score += around[0] @ pairs[0] + around[1] @ pairs[1]
        score -= score.max(1, keepdims=True)
        p = np.exp(score)
        miss = truth - p / p.sum(1, keepdims=True)
        slope = np.zeros_like(weights)
        for label in range(LABELS):
            slope[:, label] = np.bincount(columns, miss[rows, label], len(numbers))
        slope -= ridge * weights
        pair_slope = np.stack([around[k].T @ miss for k in (0, 1)])
        pair_slope = pair_slope + pair_slope.transpose(0, 2, 1) - ridge * pairs
        squares += slope**2
        pair_squares += pair_slope**2
        weights += 0.3 * slope / np.sqrt(squares)
        pairs += 0.3 * pair_slope / np.sqrt(pair_squares)
    return SkipChain(numbers, weights, pairs)


def without_marks(text: str, spans: list[tuple[str, int, int]]) -> tuple[str, list[tuple[str, int, int]]]:
    """The text with its phone numbers a second time, at the end and without plus and country code.

    Teaches the field that a number without its plus is the same number elsewhere.
    """
    for kind, a, b in [s for s in spans if s[0] == "phone"]:
        local = re.sub(r"^\+[0-9]+[ .-]*", "", text[a:b])
        text, spans = f"{text} {local}", [*spans, (kind, len(text) + 1, len(text) + 1 + len(local))]
    return text, spans


def train_skip_chain(docs: DataFrame, documents: int = TRAINING_DOCUMENTS) -> SkipChain:
    """A field trained on documents that the base patterns label.

    Reads at most ``documents`` documents with a digit or an at sign, those with the least hash of
    the id; of each the windows around its nodes, as many as ``TRAINING_CHARACTERS`` hold. The base
    spans are the labels.
    """
    signed = docs.select("doc_id", "text").where(F.col("text").rlike("[0-9@]"))
    total = signed.count()
    # Twice as many are looked at, so that the least hashes are among them.
    probe = signed.withColumn("place", draw(F.lit(5), F.col("doc_id"))).where(
        F.col("place") * F.lit(float(total)) < F.lit(float(2 * documents))
    )

    def run(batch):
        out, order = [], []
        for t, place in zip(batch.column("text").to_pylist(), batch.column("place").to_pylist()):
            places = nodes(t)
            if not places:
                continue
            pieces, at = [], 0
            for a, b in places:
                pieces.append(t[max(at, a - 40) : b + 40])
                at = b + 40
            out.append("\n".join(pieces)[:TRAINING_CHARACTERS])
            order.append(place)
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.string()), pa.array(order, pa.float64())], ["text", "place"])

    found = map_batches(probe.select("text", "place"), run, "text string, place double")
    texts = sorted(r["text"] for r in found.orderBy("place", "text").limit(documents).collect())
    return fit([without_marks(t, base_spans(t)) for t in texts])


def added_spans(text: str, base: list[tuple[str, int, int]], model: SkipChain) -> list[tuple[str, int, int]]:
    """Nodes that the field takes for personal data and no base span touches; direct neighbours of a kind are one span."""
    places = nodes(text)
    if not places:
        return []
    belief = model.beliefs(model.emissions(features(text, places), len(places)), edges(text, places))
    label, sure = belief.argmax(1), belief.max(1)
    covered = labels_of(places, base)
    found: list[list] = []
    last = None
    # Nodes and base spans both ascend. Spans of different kinds may overlap, so the furthest end so far counts.
    passed, reach = 0, 0
    for k, (a, b) in enumerate(places):
        while passed < len(base) and base[passed][1] < b:
            reach = max(reach, base[passed][2])
            passed += 1
        if label[k] and sure[k] >= SURE and not covered[k] and a >= reach:
            kind = KINDS[label[k] - 1]
            if found and last == k - 1 and found[-1][0] == kind and a - found[-1][2] <= 2:
                found[-1][2] = b
            else:
                found.append([kind, a, b])
            last = k
    return [tuple(s) for s in found]


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for kind, a, b in spans)


def personal_data(docs: DataFrame, model: SkipChain) -> DataFrame:
    """Personal data in every whole text.

    Returns one row per input row: doc_id, the number of base spans by kind, the digest
    of the base spans, and all spans, as kind:start:end by start, then kind, in code points.

    Nulls and edges: null and empty texts have no spans; rows that repeat each get their
    answer. Further columns, also ones named like the result's, are not read. An empty
    table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model.numbers, model.weights, model.pairs))

    def run(batches):
        own = SkipChain(*shared.value)
        for batch in batches:
            counts, digests, every = [[] for _ in KINDS], [], []
            for text in batch.column("text").to_pylist():
                base = base_spans(text)
                more = added_spans(text, base, own) if text and (base or DIGIT.search(text) or "@" in text) else []
                for k, kind in enumerate(KINDS):
                    counts[k].append(sum(s[0] == kind for s in base))
                digests.append(hashlib.sha256(joined(base).encode()).hexdigest())
                every.append(joined(sorted([*base, *more], key=lambda s: (s[1], KINDS.index(s[0]), s[2]))))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in counts), pa.array(digests), pa.array(every)],
                ["doc_id", *(f"n_{kind}" for kind in KINDS), "base_sha256", "spans"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, {', '.join(f'n_{k} long' for k in KINDS)}, base_sha256 string, spans string"
    )
