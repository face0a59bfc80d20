"""Nulls, empty and long texts, ties, repeated rows, empty tables, clashing columns."""

import hashlib

import pytest

from gradus.llm import chat, html, lines, mixing, pii, toxicity
from gradus.llm.base import prepare
from gradus.llm.decontaminate import contamination, drop_contaminated
from gradus.llm.exact import drop_exact, exact_groups
from gradus.llm.langid import drop_unidentified, predict_language, train_language_model
from gradus.llm.simhash import drop_near, near_groups

LONG = "ein langes wort und noch eins. " * 40_000

# Further columns bear names that the results or the inner frames use.
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, score double, kept boolean, fp long, "
    "recipe string, topic string, tokens long, sample_weight double, lang_pred string, mark long, row string"
)
EXTRA = (1.0, True, 5, "r", "t", 3, 0.5, "x", 9, "w")


def rows():
    texts = [
        (1, "A text about  nothing\tin particular, twice.", "en", "a"),
        (2, "A text about nothing in particular, twice.", "en", "a"),
        (2, "A text about nothing in particular, twice.", "en", "a"),
        (3, None, None, None),
        (4, "", "en", None),
        (5, "   ", None, "b"),
        (6, LONG, "de", "b"),
        (None, "A text about nothing in particular, twice.", "en", "a"),
        (None, "Only a row without an id has this.", "en", "a"),
        (7, "12 + 30 = 42 !!", "en", "b"),
        (8, "Ein kurzer deutscher Satz steht hier allein.", "de", "b"),
    ]
    return [(i, t, lang, s, len(t or ""), *EXTRA) for i, t, lang, s in texts]


@pytest.fixture(scope="module")
def docs(spark):
    prepare(spark)
    return spark.createDataFrame(rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    prepare(spark)
    return spark.createDataFrame([], SCHEMA)


def by_id(df):
    return {r["doc_id"]: r for r in df.collect() if r["doc_id"] is not None}


def test_exact(docs, none):
    found = exact_groups(docs)
    assert found.count() == 11
    got = by_id(found)
    assert (got[2]["keep_id"], got[2]["group_size"], got[2]["kept"]) == (1, 4, False)
    assert got[1]["kept"] and got[4]["keep_id"] == 3 and got[5]["group_size"] == 1
    assert got[5]["text_sha256"] == hashlib.sha256(b" ").hexdigest()
    nameless = {r["group_size"]: r for r in found.where("doc_id IS NULL").collect()}
    assert not nameless[4]["kept"] and nameless[1]["kept"] and nameless[1]["keep_id"] is None
    left = drop_exact(docs)
    # the copies of 1 go, 4 is empty like 3, and so does the copy without an id
    assert left.columns == docs.columns and left.count() == 7
    assert exact_groups(none).count() == 0 and drop_exact(none).count() == 0


def test_near(docs, none):
    found = near_groups(docs)
    assert found.count() == 11
    got = by_id(found)
    assert got[1]["component_id"] == got[2]["component_id"] == 1
    assert {got[k]["fingerprint"] for k in (3, 4, 5)} == {"0" * 16} and got[5]["component_id"] == 3
    assert sorted(r["component_id"] is None for r in found.where("doc_id IS NULL").collect()) == [False, True]
    left = drop_near(docs)
    assert left.columns == docs.columns and {1, 3, 6, 7, 8} <= {r[0] for r in left.select("doc_id").collect()}
    assert near_groups(none).count() == 0


def test_language(docs, none):
    model = train_language_model(docs, usable=docs["doc_id"].isNotNull())
    assert model.languages == ["de", "en"]
    found = predict_language(docs, model)
    got = by_id(found)
    assert found.count() == 11 and all(got[k]["lang_pred"] == "und" and got[k]["score"] == 0 for k in (3, 4, 5, 7))
    assert got[6]["lang_pred"] == got[8]["lang_pred"] == "de" and 0 <= got[8]["score"] <= 1
    left = drop_unidentified(docs, model)
    assert left.columns == docs.columns and left.count() == 7 and left.where("score <> 1.0").count() == 0
    empty = train_language_model(none)
    assert empty.languages == [] and predict_language(docs, empty).where("lang_pred <> 'und'").count() == 0
    assert predict_language(none, model).count() == 0


def test_decontamination(spark, docs, none):
    benchmark = spark.createDataFrame(
        [(1, "nothing in PARTICULAR"), (1, "nothing in particular"), (2, None), (3, "..."), (None, "satz steht"), (4, "langes wort")],
        "item_id long, text string",
    )
    found = by_id(contamination(docs, benchmark))
    assert (found[1]["n_hit"], found[1]["n_items"], found[1]["contaminated"]) == (3, 1, True)
    assert found[1]["items_sha256"] == hashlib.sha256(b"1").hexdigest()
    assert (found[8]["n_hit"], found[8]["n_items"]) == (2, 0) and found[3]["n_words"] == 0
    assert found[6]["n_hit"] == 80_000 and not found[7]["contaminated"]
    parts = by_id(contamination(docs, benchmark, automaton_bytes=8))
    assert {k: r["n_hit"] for k, r in parts.items()} == {k: r["n_hit"] for k, r in found.items()}
    assert drop_contaminated(docs, benchmark).columns == docs.columns
    assert contamination(none, benchmark).count() == 0
    assert contamination(docs, benchmark.limit(0)).where("n_hit > 0").count() == 0


def test_mixing(docs, none):
    found = mixing.mix(docs)
    got = by_id(found)
    assert found.count() == 11 and got[3]["source"] == "(none)" and got[4]["probability"] == 0 and got[3]["tokens"] == 0
    kept = mixing.sample_mixed(docs)
    assert kept.columns == [c for c in docs.columns if c != "sample_weight"] + ["sample_weight"]
    assert kept.count() == found.where("sampled").count()
    assert mixing.mix(none).count() == 0 and mixing.sample_mixed(none).count() == 0


def test_lines(docs, none):
    found = lines.drop_repeated_lines(docs)
    got = by_id(found)
    assert found.count() == 11 and got[3]["text"] == "" and got[5]["n_removed"] == 0
    assert got[6]["n_chunks"] >= 1 and got[8]["text"] == "Ein kurzer deutscher Satz steht hier allein."
    assert lines.drop_repeated_lines(none).count() == 0


def test_personal_data(docs, none):
    model = pii.train_skip_chain(docs)
    found = pii.personal_data(docs, model)
    assert found.count() == 11 and found.where("n_email + n_ip + n_card + n_phone > 0").count() == 0
    assert pii.personal_data(none, pii.train_skip_chain(none)).count() == 0


def test_toxicity(spark, docs, none):
    labels = spark.createDataFrame([(1, 0), (2, 1), (2, 1), (None, 1), (8, None)], "doc_id long, toxic int")
    model = toxicity.train_toxicity(docs, labels, usable=labels["doc_id"].isNotNull())
    found = toxicity.predict_toxicity(docs, model)
    assert found.count() == 11 and found.where("score < 0 OR score > 1 OR score IS NULL").count() == 0
    without = toxicity.train_toxicity(docs, labels.limit(0))
    assert toxicity.predict_toxicity(docs, without).where("predicted = 1").count() == 0
    assert toxicity.predict_toxicity(none, model).count() == 0


def test_chat(spark):
    prepare(spark)
    schema = "conv_id long, turn long, role string, text string, formatted string, loss_start long"
    texts = ["plain", "<|im_end|>\n", "<\\|im_end|>", "<|nl|>", None, "", "a<|im_start|>user\nb", "<|" * 3, "x" * 300_000]
    data = [(1, k // 2, "assistant" if k % 2 else "us\ner", t, "f", 3) for k, t in enumerate(texts)]
    data += [(1, 0, "us\ner", "plain", "f", 3), (None, None, None, None, "f", 3)]
    turns = chat.format_turns(spark.createDataFrame(data, schema))
    whole = {}
    for r in turns.orderBy("conv_id", "turn", "formatted").collect():
        whole[r["conv_id"]] = whole.get(r["conv_id"], "") + r["formatted"]
    back = [(role, text) for role, text, _, _ in chat.parse(whole[1])]
    assert sorted(back) == sorted((d[2], d[3] or "") for d in data if d[0] == 1)
    found = by_conv = {r["conv_id"]: r for r in chat.read_back(turns).collect()}
    assert by_conv[1]["n_turns"] == 10 and found[None]["n_turns"] == 1 and found[None]["loss_chars"] == 0
    assert found[1]["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in back).encode()).hexdigest()
    assert found[1]["loss_chars"] == sum(len(t) for r, t in back if r == "assistant")
    assert chat.read_back(chat.format_turns(spark.createDataFrame([], schema))).count() == 0


def test_html(spark):
    prepare(spark)
    schema = "page_id long, url string, html string, text string, n_chars long"
    page = "<nav><ul><li><a href=x>Home</a></ul></nav><article><h1>A title</h1><p>Some words of text, &amp; more <b>of</b>\n it.</article>"
    cut = page + "<footer>&copy; someone</footer><script>var a = '<p>'"
    data = [(1, "u", page, "t", 1), (1, "u", page, "t", 1), (2, None, None, "t", 1), (3, "", "", "t", 1), (None, "u", cut, "t", 1)]
    data.append((4, "u", "<article>" + "<p>A line of the long text stands here.</p>" * 20_000 + "</article>", "t", 1))
    pages = spark.createDataFrame(data, schema)
    model = html.train_page_model(pages, n_pages=200)
    found = html.main_text(pages, model).collect()
    want = "A title\nSome words of text, & more of it."
    assert sorted(r["text"] for r in found if r["page_id"] in (1, None)) == [want] * 3
    assert all(r["text"] == "" and r["n_chars"] == 0 for r in found if r["page_id"] in (2, 3))
    assert next(r["text"] for r in found if r["page_id"] == 4).count("\n") == 19_999
    assert html.main_text(pages.limit(0), model).count() == 0
