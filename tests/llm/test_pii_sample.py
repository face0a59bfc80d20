"""The training documents of the field come from the whole table, whatever its order."""

from gradus.llm import pii
from gradus.llm.base import prepare


def test_sample_reaches_all_sources(spark, monkeypatch):
    prepare(spark)
    seen = []
    monkeypatch.setattr(pii, "fit", lambda samples: seen.extend(t for t, _ in samples))
    rows = [(k, f"source{'ab'[k >= 1000]} {k} x") for k in range(2000)]
    for docs in (spark.createDataFrame(rows, "doc_id long, text string").coalesce(4), spark.createDataFrame(rows[::-1], "doc_id long, text string").coalesce(1)):
        pii.train_skip_chain(docs, documents=100)
    assert len(seen) == 200 and sorted(seen[:100]) == sorted(seen[100:])
    assert 30 <= sum("sourceb" in t for t in seen[:100]) <= 70
