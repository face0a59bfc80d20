"""Texts in no labelled language, and of stray letters, leave the language stage; labelled rows stay."""

from gradus.llm import base
from gradus.llm.langid import drop_unidentified, has_letter, predict_language, train_language_model

STRANGE = [
    "Съешь же ещё этих мягких французских булок, да выпей чаю",
    "我们今天去公园散步，天气很好，大家都很高兴。",
    "asdkjfh qwelkjrh zxcmvn qpwoeiruty lkjhasdf mnbvzx wqxz kjhg",
]


def test_strange_texts_are_rejected(spark):
    docs = base.table(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "text", "lang")
    model = train_language_model(docs)
    strange = spark.createDataFrame([(-k - 1, t, None) for k, t in enumerate(STRANGE)], docs.schema)
    kept = {r["doc_id"] for r in drop_unidentified(docs.unionByName(strange), model).collect()}
    assert not any(i < 0 for i in kept)
    assert kept == {r["doc_id"] for r in docs.collect() if has_letter(r["text"])}
    assert predict_language(strange, model).where("score > 0.5").count() == len(STRANGE)
