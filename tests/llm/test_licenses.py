"""Licence notices: base places, labels of whole notices, edges."""

from gradus.llm import base, licenses

MIT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    'documentation files (the "Software"), to deal in the Software without restriction'
)


def found(spark, texts):
    schema = "doc_id long, text string, labels string, score string, hits string, n_words string"
    docs = spark.createDataFrame([(i, t, "l", "s", "h", "n") for i, t in texts], schema).repartition(3)
    base.prepare(spark)
    out = licenses.find_licences(docs)
    assert out.count() == len(texts)
    return {r["doc_id"]: r for r in out.collect()}


def test_base_places(spark):
    got = found(spark, [
        (1, "GNU General-Public\nLICENSE mit license MIT Licensee. Apache License; cc by cc_by"),
        (2, None), (3, ""), (4, "mit licence"), (5, "general public license"),
        (6, "CC BY " * 5000 + "cc"),
        (None, "the MIT License"), (7, "word"), (7, "mit license"), (8, "mit Kind license"), (9, "İ mit license"),
    ])
    one = got[1]
    assert (one["n_base"], one["first_word"], one["last_word"]) == (5, 0, 12)
    assert one["base_labels"] == "apache,cc-by,gpl,mit" and one["n_words"] == 14
    for k in (2, 3, 4, 5, 8):
        assert (got[k]["n_base"], got[k]["first_word"], got[k]["last_word"], got[k]["base_labels"]) == (0, None, None, "")
        assert got[k]["score"] == 0.0
    assert (got[6]["n_base"], got[6]["first_word"], got[6]["last_word"], got[6]["n_words"]) == (5000, 0, 9998, 10001)
    assert got[None]["first_word"] == 1 and got[9]["first_word"] == 1 and got[None]["score"] == 1.0


def test_whole_notices(spark):
    loose = MIT.replace("associated documentation files", "the files that come with it")
    got = found(spark, [
        (1, "x " * 50 + MIT), (2, MIT.replace("free of charge", "for a fee")), (3, loose),
        (4, "Redistribution and use in source and binary forms, with or without modification, are permitted"),
        (5, "Licensed under the Apache License, Version 2.0"), (6, "Licensed under CC BY-NC 4.0"),
        (7, "GNU General Public License, version 3"), (8, "GNU Lesser General Public License"),
    ])
    assert [got[k]["labels"] for k in range(1, 9)] == [
        "mit-notice", "", "mit-notice", "bsd", "apache,apache-2.0", "cc-by,cc-by-nc", "gpl,gpl-3", "lgpl",
    ]
    assert got[1]["score"] == 1.0 and 0 < got[3]["score"] < 1 and 0 < got[4]["score"] < 1
    assert [got[k]["base_labels"] for k in (1, 4, 5)] == ["", "", "apache"]


def test_order_of_lookups_does_not_change_places(spark):
    """Other rows change the rarity of words, so other words are looked up first."""
    text = "a gnu general public license b mit 3 mit license apache mit apache license cc cc by"
    for other in ("gnu general", "license license public mit", "cc", "apache by"):
        got = found(spark, [(1, text), (2, other), (3, other)])[1]
        assert (got["n_base"], got["first_word"], got["last_word"]) == (4, 1, 15)


def test_empty_table(spark):
    base.prepare(spark)
    assert licenses.find_licences(spark.createDataFrame([], "doc_id long, text string")).count() == 0
