"""The stages of the pipeline on rows that repeat ids, lack ids, and have clashing or dotted column names."""

import pytest

import corpus_pipeline as pipeline
from gradus.llm import base
from gradus.llm.decontaminate import contamination, drop_contaminated, offsets
from gradus.llm.exact import drop_exact
from gradus.llm.langid import drop_unidentified, train_language_model
from gradus.llm.mixing import sample_mixed
from gradus.llm.simhash import drop_near

SF = "/root/testdata/sf0.001"

SAME = "The same words stand here and there in two rows of a small table."
OTHER = "Another text of the id that is repeated, which nobody else has written down."
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, mark long, `a.b` string, `language found` string, "
    "_gone_id long, `row` string, sample_weight double"
)


def frame(spark, rows):
    data = [(i, t, "en", "s", len(t or ""), 7, "dot", "as it was", 3, "r", 0.5) for i, t in rows]
    return spark.createDataFrame(data, SCHEMA).repartition(3)


def pairs(df):
    return sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=str)


ROWS = [(1, SAME), (5, SAME), (5, OTHER), (5, OTHER), (None, SAME), (None, "Nobody else has this text, and it has no id."), (7, None), (8, "")]
LEFT = sorted([(1, SAME), (5, OTHER), (5, OTHER), (None, ROWS[5][1]), (7, None)], key=str)


@pytest.mark.parametrize("drop", [drop_exact, drop_near])
def test_another_text_of_an_id_stays(spark, drop):
    docs = frame(spark, ROWS)
    left = drop(docs)
    assert left.columns == docs.columns and pairs(left) == LEFT
    assert {r["language found"] for r in left.collect()} == {"as it was"}


def test_contaminated_rows_go_alone(spark):
    docs = frame(spark, [(1, SAME), (5, SAME), (5, OTHER), (None, SAME), (None, OTHER), (7, None)])
    items = spark.createDataFrame([(1, "same words stand here and there in two rows")], "item_id long, text string")
    assert pairs(drop_contaminated(docs, items)) == sorted([(5, OTHER), (None, OTHER), (7, None)], key=str)


def test_language_keeps_columns(spark):
    known = base.table(spark, SF, "documents").select("doc_id", "text", "lang")
    text = next(r["text"] for r in known.where("lang = 'en' AND length(text) > 300").limit(1).collect())
    docs = frame(spark, [(1, text), (1, text), (None, text), (2, None), (3, "  "), (3, text + " more")])
    left = drop_unidentified(docs, train_language_model(known))
    assert left.columns == docs.columns
    assert pairs(left) == sorted([(1, text), (1, text), (None, text), (3, text + " more")], key=str)
    assert {(r["language found"], r["a.b"]) for r in left.collect()} == {("as it was", "dot")}


def test_mixing_takes_dotted_names(spark):
    docs = frame(spark, ROWS)
    left = sample_mixed(docs)
    assert left.columns == [c for c in docs.columns if c != "sample_weight"] + ["sample_weight"]
    assert {r["a.b"] for r in left.collect()} == {"dot"}


def test_whole_stages(spark):
    """Each stage on the table beside a repeated id with two texts, rows without an id, and repeated rows."""
    docs = base.table(spark, SF, "documents")
    english = [r["text"] for r in docs.where("lang = 'en' AND length(text) > 400").orderBy("doc_id").limit(3).collect()]
    own = [(5_000_001, english[0] + " first"), (5_000_001, english[1][::-1]), (5_000_001, english[0] + " first"), (None, english[2]), (5_000_002, None)]
    more = spark.createDataFrame([(i, t, "en", "web", len(t or "")) for i, t in own], docs.schema)
    before = docs.unionByName(more)
    for name, stage in pipeline.STAGES:
        after = base.materialise(stage(spark, before, SF))
        assert after.columns[:5] == base.DOCUMENT_COLUMNS, name
        assert after.count() <= before.count()
        empty = stage(spark, before.limit(0), SF)
        assert empty.count() == 0, name
        before = after


def test_offsets_in_the_original_text(spark):
    text = "Ünd — Eins, zwei! DREI... vier fünf. Sechs\nsieben acht 九 zehn Ende"
    docs = spark.createDataFrame([(1, text), (2, "eins zwei drei vier"), (3, None)], "doc_id long, text string")
    items = spark.createDataFrame([(1, "eins zwei DREI"), (2, "fünf sechs"), (3, "zehn ende"), (4, "九 zehn")], "item_id long, text string")
    for size in (1_000_000, 5):
        found = {r["doc_id"]: r for r in contamination(docs, items, automaton_bytes=size).collect()}
        ranges = found[1]["offsets"]
        assert [text[a:b] for a, b in zip(ranges[::2], ranges[1::2])] == ["Eins, zwei! DREI", "fünf. Sechs", "九 zehn Ende"]
        assert found[2]["offsets"] == [0, 14] and found[3]["offsets"] == []
    assert offsets(None, []) == [] and offsets("a b", [0, 2]) == [(0, 3)]
