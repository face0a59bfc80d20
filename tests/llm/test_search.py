"""Ranked search against plain sums, the query-sharing graph, and the edges."""

import math
import random
import re
from collections import Counter

import numpy as np

from gradus.llm import base, search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return ["".join(c.lower() if "A" <= c <= "Z" else c for c in w) for w in TERM.findall(text or "")]


def plain(docs, items, best=10):
    own = [(i, Counter(terms(t))) for i, t in docs]
    own = [(i, c) for i, c in own if c]
    n_docs, length = len(own), sum(c.total() for _, c in own)
    held = Counter(w for _, c in own for w in c)
    out = []
    for item, text in items:
        scores = []
        for i, c in own:
            m = 100 - 75 + (75 * c.total() * n_docs) // length
            total = 0
            for w in terms(text):
                if c[w]:
                    weight = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * held[w] + 1)))
                    total += weight * ((1_000_000_000 * c[w]) // (1000 * c[w] + 8 * m))
            if total > 0:
                scores.append((-total, i is None, i or 0, i))
        out += [(item, rank, i, -s) for rank, (s, _, _, i) in enumerate(sorted(scores)[:best], 1)]
    return sorted(out, key=str)


def rows(df):
    return sorted(map(tuple, df.select("item_id", "rank", "doc_id", "score").collect()), key=str)


def test_against_plain_sums(spark):
    pick = random.Random(4)
    names = [f"w{k}" for k in range(40)] + ["Été", "ÄÖ", "x1"]
    texts = [" ".join(pick.choices(names, k=pick.randrange(0, 60))) for _ in range(150)]
    docs = [(k, t) for k, t in enumerate(texts)] + [(None, texts[3]), (3, texts[3]), (900, None), (901, "—, .")]
    common = " ".join(names[:9])
    items = [(k, common + " " + " ".join(pick.choices(names, k=k))) for k in range(12)]
    items += [(20, "w1, w1 W1-w2"), (21, None), (22, "nobody has it"), (23, ""), (None, "w7 w8"), (24, "w1, w1 W1-w2")]
    frame = spark.createDataFrame([(i, t, 1, 2, "s") for i, t in docs], "doc_id long, text string, score long, item long, item_id string")
    queries = spark.createDataFrame([(i, t, "q") for i, t in items], "item_id long, text string, doc_id string")
    base.prepare(spark)
    want = plain(docs, items)
    assert rows(search.ranked(frame.repartition(7), queries)) == want
    assert rows(search.ranked(frame.repartition(3), queries.unionByName(queries), part_bytes=150)) == want
    assert search.ranked(frame.limit(0), queries).count() == 0 and search.ranked(frame, queries.limit(0)).count() == 0
    # A query that stands twice under other texts is two queries.
    twice = spark.createDataFrame([(1, "w1"), (1, "w2")], "item_id long, text string")
    assert search.ranked(frame, twice).count() == 20


def test_shared_sums_are_taken_once():
    lists = ["a b c d e f", "a b c d e g", "a b c d h h", "x", "x", "a"]
    plan = search.SharedPlan(lists)
    assert plan.additions() < sum(len(t.split()) for t in lists)
    values = np.arange(1, len(plan.terms) + 1, dtype=np.int64) ** 3
    held = np.zeros((plan.size, 1), np.int64)
    held[: len(plan.terms), 0] = values
    want = [sum(int(values[plan.terms[w.encode()]]) for w in t.split()) for t in lists]
    assert plan.scores(held)[:, 0].tolist() == want and plan.queries == list(range(6))


def test_random_graphs():
    pick = random.Random(5)
    for _ in range(60):
        names = [f"t{k}" for k in range(pick.randrange(1, 12))]
        lists = [" ".join(pick.choices(names, k=pick.randrange(0, 9))) for _ in range(pick.randrange(0, 9))]
        plan = search.SharedPlan(lists)
        if not plan.queries:
            continue
        held = np.zeros((plan.size, 3), np.int64)
        values = np.array([[pick.randrange(100) for _ in range(3)] for _ in plan.terms], np.int64)
        held[: len(plan.terms)] = values
        want = [sum(values[plan.terms[w.encode()]] for w in lists[q].split()).tolist() for q in plan.queries]
        assert plan.scores(held).tolist() == want
