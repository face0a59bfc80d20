"""Repeated passages inside of long lines, made and judged without the operator's own cut."""

import random

from gradus.llm import lines
from gradus.llm.base import prepare


def test_passages_in_other_surroundings(spark):
    prepare(spark)
    draw = random.Random(6)
    number = iter(range(10**6))

    def words(n):
        return [f"{draw.choice('abcdefgh')}{next(number)}{draw.choice('xyz')}" for _ in range(n)]

    passages = [words(n) for n in range(51, 81)]
    before, after = {}, {}
    for k, passage in enumerate(passages):
        before[k] = (words(40), passage, words(30))
        after[k + 1000] = (words(draw.randint(0, 60)), passage, words(draw.randint(0, 60)))
    rows = [(i, " ".join([*a, *p, *b])) for i, (a, p, b) in {**before, **after}.items()]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = {r["doc_id"]: r["text"] for r in lines.drop_repeated_passages(docs).collect()}
    assert len(found) == len(rows)
    texts = dict(rows)
    assert all(found[i] == texts[i] for i in before)
    lost = 0
    for i, (a, p, b) in after.items():
        left = found[i].split()
        inside = set(p)
        assert [w for w in left if w not in inside] == [*a, *b]
        gone = len(p) - sum(w in inside for w in left)
        assert gone > 0
        lost += gone
    assert lost >= 0.7 * sum(map(len, passages))


def test_repeats_within_a_text(spark):
    prepare(spark)
    once = " ".join(f"w{k * k % 101}" for k in range(60))
    docs = spark.createDataFrame([(1, f"{once} {once}"), (2, None), (3, "")], "doc_id long, text string")
    found = {r["doc_id"]: r for r in lines.drop_repeated_passages(docs).collect()}
    assert found[1]["text"].startswith(once[:-10]) and found[1]["n_removed"] > 0
    assert found[2]["text"] == found[3]["text"] == "" and found[2]["n_removed"] == 0


def test_one_word_over_and_over(spark):
    prepare(spark)
    rows = [(k, " ".join([f"a{k}", f"b{k}", *["ja"] * 60, f"c{k}", f"d{k}"])) for k in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: r["text"].split() for r in lines.drop_repeated_passages(docs).collect()}
    for k in range(1, 3):
        assert [w for w in found[k] if w != "ja"] == [f"a{k}", f"b{k}", f"c{k}", f"d{k}"]
        assert found[k].count("ja") < 10
    assert "ja" in found[0]
