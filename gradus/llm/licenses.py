"""Licence notices, found by a positional index of their rare words, in SQL functions only.

A text is read once: the places of all words that any notice has. Over the corpus these
words get an inverse document frequency. Each notice is looked up by its rarest words: a
place of such a word, less the word's place in the notice, is a place where the notice may
begin, and the rare words must agree on it. There the other mandatory words are verified,
from rare to common; the rest of the notice only counts for the score.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradus.llm.base import materialise

# Phrases and their labels. Fixed values.
BASE = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)

# Words of notices that are too common to be looked up; they only take up their place.
COMMON = frozenset("a and any are for in is it of on or that the this to under with you".split())

# What stands between words.
GAP = r"[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"


@dataclass(frozen=True)
class Notice:
    """Words of a notice by their places, and the places that must be right."""

    label: str
    words: tuple[tuple[str, int], ...]
    mandatory: tuple[tuple[str, int], ...]
    base: bool = False


def notice(label: str, text: str, *phrases: str, base: bool = False) -> Notice:
    """A notice whose key phrases, all words if none is given, must stand at their places."""
    own = text.split()
    places = set()
    for phrase in phrases or (text,):
        part = phrase.split()
        starts = [k for k in range(len(own) - len(part) + 1) if own[k : k + len(part)] == part]
        if not starts:
            raise ValueError(f"{phrase!r} is not in the notice {label}")
        places.update(range(starts[0], starts[0] + len(part)))
    skip = () if base else COMMON
    words = tuple((w, k) for k, w in enumerate(own) if w not in skip)
    return Notice(label, words, tuple((w, k) for w, k in words if k in places), base)


# Notices with labels of their own. The first phrase-less ones must stand word by word, but for common words.
NOTICES = (
    *(notice(label, phrase, base=True) for phrase, label in BASE),
    notice("gpl-2", "gnu general public license version 2"),
    notice("gpl-3", "gnu general public license version 3"),
    notice("lgpl", "gnu lesser general public license"),
    notice("agpl", "gnu affero general public license"),
    notice("apache-2.0", "apache license version 2 0"),
    notice("cc-by-nc", "cc by nc"),
    notice("cc-by-sa", "cc by sa"),
    notice("cc-by-nd", "cc by nd"),
    notice(
        "mit-notice",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files the software to deal in the software without restriction",
        "permission is hereby granted free of charge", "person obtaining a copy of this software",
    ),
    notice(
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted provided that "
        "the following conditions are met",
        "redistribution and use in source and binary forms",
    ),
    notice(
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
        "granted provided that the above copyright notice",
        "permission to use copy modify", "distribute this software for any purpose",
    ),
    notice(
        "mpl-2.0",
        "this source code form is subject to the terms of the mozilla public license v 2 0",
        "source code form is subject", "mozilla public license v 2",
    ),
    notice(
        "unlicense",
        "this is free and unencumbered software released into the public domain",
        "free and unencumbered software",
    ),
    notice(
        "cc0",
        "has waived all copyright and related or neighboring rights to this work",
        "waived all copyright and related or neighboring rights",
    ),
)


def vocabulary(notices: tuple[Notice, ...] = NOTICES) -> list[str]:
    return sorted({w for n in notices for w, _ in n.words})


def licence_words(docs: DataFrame, names: list[str]) -> DataFrame:
    """doc_id, number of words, and the licence words: their numbers in ``names`` and places in the text.

    Of letters only A-Z are lower-cased; a word that other letters turn into a licence word is none.
    """
    listed = ", ".join(f"'{w}'" for w in names)
    numbers = f"map({', '.join(f"'{w}', {k}" for k, w in enumerate(names))})"
    hit = f"lower(get(ws, i)) IN ({listed}) AND octet_length(get(ws, i)) = octet_length(lower(get(ws, i)))"
    # A text that begins or ends with a gap has an empty part there.
    first, last = "if(get(ws, 0) = '', 1, 0)", "if(size(ws) > 1 AND get(ws, size(ws) - 1) = '', 1, 0)"
    found = (
        f"transform(filter(sequence(0, size(ws) - 1), i -> {hit}), "
        f"i -> struct({numbers}[lower(get(ws, i))] AS w, i - {first} AS i))"
    )
    # One binding of the parts, so that the text is cut once.
    cut = f"split(coalesce(text, ''), '{GAP}', -1)"
    n_words = f"cast(size(ws) - {first} - {last} AS bigint)"
    both = f"element_at(transform(array({cut}), ws -> struct({n_words} AS n_words, {found} AS hits)), 1)"
    return docs.select("doc_id", F.expr(both).alias("_r")).select("doc_id", "_r.n_words", "_r.hits")


def inverse_frequencies(rows: DataFrame, names: list[str]) -> list[float]:
    """ln((documents + 1) / (documents with the word + 1)) of every licence word, over all documents."""
    each = rows.select(F.explode(F.array_distinct("hits.w")).alias("w"))
    held = {r["w"]: r["count"] for r in each.groupBy("w").count().collect()}
    total = rows.count()
    return [math.log((total + 1) / (held.get(k, 0) + 1)) for k in range(len(names))]


def _plan(notices: tuple[Notice, ...], names: list[str], weights: list[float]) -> str:
    """SQL for the notices: mandatory words, the rarest first, then the others with their weights."""
    number = {w: k for k, w in enumerate(names)}
    rows = []
    for one in notices:
        by_rarity = sorted(one.words, key=lambda p: (-weights[number[p[0]]], p[1]))
        must = [f"struct({number[w]} AS w, {k} AS o)" for w, k in by_rarity if (w, k) in one.mandatory]
        more = [
            f"struct({number[w]} AS w, {k} AS o, {weights[number[w]]!r}D AS weight)"
            for w, k in by_rarity
            if (w, k) not in one.mandatory
        ]
        total = sum(weights[number[w]] for w, _ in one.words)
        sure = sum(weights[number[w]] for w, _ in one.mandatory)
        listed = f"array({', '.join(more)})" if more else "cast(array() AS array<struct<w: int, o: int, weight: double>>)"
        rows.append(
            f"struct('{one.label}' AS label, {str(one.base).lower()} AS base, array({', '.join(must)}) AS must, "
            f"{listed} AS more, {sure!r}D AS sure, {total!r}D AS total)"
        )
    return f"array({', '.join(rows)})"


# Places of each licence word that the text has.
_PLACES = (
    "map_from_entries(transform(array_distinct(hits.w), "
    "w -> struct(w, transform(filter(hits, h -> h.w = w), h -> h.i))))"
)

_NONE = "cast(array() AS array<int>)"


def _starts(word: str) -> str:
    """SQL for the places where a notice may begin that has the word."""
    return f"transform(coalesce(places[{word}.w], {_NONE}), i -> i - {word}.o)"


# The rarest words of a notice agree on its places; if they agree on none, no other word is looked up.
_AGREED = (
    f"aggregate(slice(t.must, 2, size(t.must)), filter({_starts('t.must[0]')}, i -> i >= 0), "
    f"(found, p) -> if(size(found) = 0, found, array_intersect(found, {_starts('p')})))"
)


_FOUND = "array<struct<label: string, base: boolean, n: int, low: int, high: int, share: double>>"


def find_licences(docs: DataFrame, notices: tuple[Notice, ...] = NOTICES) -> DataFrame:
    """Places of licence phrases in every document, and the licences they stand for.

    Returns one row per input row: doc_id, n_words, n_base (places of the base phrases),
    first_word and last_word (their smallest and largest start), base_labels, labels (those of
    all notices found) and score: of the notice that is found most completely, the share of
    its words, weighted by inverse document frequency, that stand at their places.

    Nulls and edges: a null text is empty; a text without a notice has no places, empty labels,
    null first and last words and score 0. Every place counts, also repeated and overlapping
    ones. Rows that repeat a doc_id are each returned, and a null doc_id stays null. Further
    columns, also ones named like the result's, are not read. An empty table gives no rows.
    """
    names = vocabulary(notices)
    rows = materialise(licence_words(docs, names))
    plan = _plan(notices, names, inverse_frequencies(rows, names))
    share = (
        "if(t.total = 0 OR size(t.more) = 0, 1D, (t.sure + aggregate(t.more, 0D, "
        f"(sum, p) -> sum + if(arrays_overlap(at, {_starts('p')}), p.weight, 0D))) / t.total)"
    )
    # Places of words and of notices are bound once each.
    each = (
        f"transform(filter(transform({plan}, t -> struct(t, {_AGREED} AS at)), f -> size(f.at) > 0), "
        f"f -> element_at(transform(array(f.t), t -> element_at(transform(array(f.at), at -> struct(t.label AS label, "
        f"t.base AS base, size(at) AS n, array_min(at) AS low, array_max(at) AS high, {share} AS share)), 1)), 1))"
    )
    found = f"if(size(hits) = 0, NULL, element_at(transform(array({_PLACES}), places -> {each}), 1))"
    known = rows.withColumn("found", F.coalesce(F.expr(found), F.array().cast(_FOUND)))
    known = known.withColumn("based", F.filter("found", lambda f: f["base"]))

    def labels(column: str) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(F.col(f"{column}.label"))), ",")

    return known.select(
        "doc_id",
        "n_words",
        F.aggregate("based", F.lit(0).cast("long"), lambda n, f: n + f["n"]).alias("n_base"),
        F.array_min("based.low").cast("long").alias("first_word"),
        F.array_max("based.high").cast("long").alias("last_word"),
        labels("based").alias("base_labels"),
        labels("found").alias("labels"),
        F.round(F.coalesce(F.array_max("found.share"), F.lit(0.0)), 9).alias("score"),
    )


__all__ = ["BASE", "NOTICES", "Notice", "find_licences", "inverse_frequencies", "licence_words", "notice", "vocabulary"]
