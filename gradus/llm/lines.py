"""Removal of repeated passages by content-defined chunks of lines, in SQL functions only.

A text is cut into lines (at line feeds and ends of sentences, so that passages inside
of long lines count too). A rolling hash over the hashes of two lines is a local minimum
at about every third line; chunks end there. Whether a line ends a chunk depends on the
lines around it alone, so a passage is cut alike wherever it stands, and every chunk
but a text's last one has at least two lines.

Passages without such ends, and those of few lines, are found by a finer cut: units of about
five words end at local minima of a word hash, and a chunk of ``UNITS`` units starts at every one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradus.llm.base import materialise

LINE_END = r"(?<=\\n)|(?<=[.!?] )"

# Lines of a chunk that is looked for.
LEAST_LINES = 2

# Units of a chunk in the finer cut. A passage of 50 words has about eight whole ones.
UNITS = 5

_WORDS_SQL = r"split(coalesce(text, ''), '(?<=\\s)(?=\\S)')"

_TRIMMED = "trim(TRAILING ' \\n' FROM {})"


_LINES_SQL = f"filter(split(coalesce(text, ''), '{LINE_END}'), x -> x <> '')"


def _lines() -> Column:
    """The lines of a text with what separates them; joined they are the text."""
    return F.expr(_LINES_SQL)


def _body(lines: str, first: str, last: str) -> str:
    """SQL for the bytes of the lines between two places, without white space at the end."""
    return _TRIMMED.format(f"array_join(slice({lines}, {first} + 1, {last} - {first} + 1), '')")


def _with_ends(docs: DataFrame) -> DataFrame:
    """Adds the places of the last lines of the chunks."""
    hashed = "cast(conv(substr(md5({}), 1, 7), 16, 10) AS BIGINT)".format(_TRIMMED.format("x"))
    return (
        docs.withColumn("lines", _lines())
        .withColumn("hashes", F.expr(f"transform(lines, x -> {hashed})"))
        .withColumn("rolling", F.expr("transform(hashes, (x, i) -> (x * 31 + if(i > 0, hashes[i - 1], 7)) % 2147483647)"))
        .withColumn(
            "ends",
            F.expr(
                "filter(transform(rolling, (x, i) -> if(i = size(rolling) - 1 OR (i > 0 AND x < rolling[i - 1] "
                "AND x <= rolling[i + 1]), i, -1)), x -> x >= 0)"
            ),
        )
    )


def _first(ends: str, k: str) -> str:
    return f"if({k} = 0, 0, get({ends}, {k} - 1) + 1)"


def _marked(docs: DataFrame) -> DataFrame:
    """Ids and texts with a hash of the text, which tells rows of one id apart."""
    return docs.select("doc_id", "text").withColumn("mark", F.xxhash64(F.coalesce("text", F.lit(""))))


def _joined(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
    """Join on the document, whose id may be null."""
    other = right.withColumnsRenamed({"doc_id": "_id", "mark": "_mark"})
    same = (F.col("mark") == F.col("_mark")) & F.col("doc_id").eqNullSafe(F.col("_id"))
    return left.join(other, same, how).drop("_id", "_mark")


def _gone(found: DataFrame, pieces: DataFrame) -> DataFrame:
    """The chunks of ``found`` (doc_id, mark, k, chunk) that stand earlier; ``pieces`` has their bytes as ``body``."""
    one = F.struct("doc_id", "mark", "k")
    verified = materialise(
        pieces.groupBy("chunk")
        .agg(F.min("body").alias("low"), F.max("body").alias("high"), F.min(one).alias("first"))
        .select("chunk", "first", (F.col("low") == F.col("high")).alias("same"))
    )
    gone = found.join(verified.where("same"), "chunk").where(~one.eqNullSafe(F.col("first")))
    gone = gone.select("doc_id", "mark", "k")
    unlike = verified.where("NOT same").select("chunk")
    if not unlike.isEmpty():
        # Chunks of one hash and several contents are told apart by their bytes.
        apart = materialise(pieces.join(unlike, "chunk", "left_semi"))
        first = apart.groupBy("chunk", "body").agg(F.min(one).alias("first"))
        apart = apart.join(first, ["chunk", "body"]).where(~one.eqNullSafe(F.col("first")))
        gone = gone.unionByName(apart.select("doc_id", "mark", "k").distinct())
    return gone


def repeated_chunks(docs: DataFrame) -> DataFrame:
    """For every document (doc_id, mark) the number of its chunks, and the ranges of lines that stay.

    ``kept`` has the first line and the number of lines of each chunk that stays, in order, and
    is null where all stay; ``n_removed`` counts the chunks that stand earlier in the corpus.
    """
    chunk = f"xxhash64({_body('lines', _first('ends', 'k'), 'e')})"
    layout = materialise(
        _with_ends(_marked(docs))
        .select("doc_id", "mark", "ends", F.expr(f"transform(ends, (e, k) -> {chunk})").alias("chunks"))
    )
    places = layout.select("doc_id", "mark", "ends", F.posexplode("chunks").alias("k", "chunk")).select(
        "doc_id", "mark", "k", "chunk", F.expr(f"ends[k] - {_first('ends', 'k')} + 1").alias("n")
    )
    places = places.where(F.col("n") >= LEAST_LINES).drop("n")
    often = materialise(places.groupBy("chunk").count().where("count > 1").select("chunk"))
    found = materialise(places.join(often, "chunk").distinct())

    # The bytes of the chunks that occur more than once, from the texts that have them.
    suspects = found.groupBy("doc_id", "mark").agg(F.collect_list("k").alias("ks"))
    suspects = materialise(_joined(suspects, layout.distinct(), "inner"))
    texts = _joined(_marked(docs), suspects, "inner").withColumn("lines", _lines())
    pieces = texts.select("doc_id", "mark", "lines", "ends", "chunks", F.explode("ks").alias("k")).select(
        "doc_id", "mark", "k", F.expr("chunks[k]").alias("chunk"),
        F.expr(_body("lines", _first("ends", "k"), "ends[k]")).alias("body"),
    )
    gone = _gone(found, pieces)
    removals = gone.groupBy("doc_id", "mark").agg(F.collect_set("k").alias("ks"))
    ranges = (
        "transform(array_except(sequence(0, size(ends) - 1), ks), "
        f"k -> struct({_first('ends', 'k')} + 1 AS at, get(ends, k) - {_first('ends', 'k')} + 1 AS n))"
    )
    return materialise(
        _joined(layout.select("doc_id", "mark", "ends").distinct(), removals, "left").select(
            "doc_id",
            "mark",
            F.size("ends").cast("long").alias("n_chunks"),
            F.coalesce(F.size("ks"), F.lit(0)).cast("long").alias("n_removed"),
            F.when(F.col("ks").isNotNull(), F.expr(ranges)).alias("kept"),
        )
    )


def drop_repeated_lines(docs: DataFrame) -> DataFrame:
    """Texts without the multi-line chunks that occur before, in the order of doc_id and place.

    Returns one row per input row: doc_id, text (cleaned), n_chars, n_chunks and n_removed.

    Nulls and edges: a null text is empty; texts without two lines lose nothing. A null
    doc_id comes before all others. Rows that repeat doc_id and text are one document,
    so they keep the same chunks. Further columns, also ones named like the result's,
    are not read. An empty table gives no rows.
    """
    found = _joined(_marked(docs), repeated_chunks(docs), "inner")
    # One binding of the lines, so that the text is cut once and not for each range.
    cleaned = (
        f"element_at(transform(array({_LINES_SQL}), lines -> "
        "array_join(flatten(transform(kept, r -> slice(lines, r.at, r.n))), '')), 1)"
    )
    whole = F.when(F.col("kept").isNull(), F.coalesce("text", F.lit(""))).otherwise(F.expr(cleaned))
    return found.select("doc_id", whole.alias("text"), "n_chunks", "n_removed").select(
        "doc_id", "text", F.length("text").cast("long").alias("n_chars"), "n_chunks", "n_removed"
    )


def _with_units(docs: DataFrame) -> DataFrame:
    """Adds the words, their hashes and the places of the last words of the units."""
    least = "x < get(hashes, i - 1) AND x <= get(hashes, i + 1) AND x < get(hashes, i - 2) AND x <= get(hashes, i + 2)"
    # One word over and over has no minimum; each of its repeats ends a unit.
    least += " OR x = get(hashes, i - 1) AND x = get(hashes, i + 1)"
    return (
        docs.withColumn("words", F.expr(_WORDS_SQL))
        .withColumn("hashes", F.expr(r"transform(words, x -> xxhash64(trim(TRAILING ' \\n\\t\\r' FROM x)))"))
        .withColumn(
            "ends",
            F.expr(f"filter(transform(hashes, (x, i) -> if(i = size(hashes) - 1 OR ({least}), i, -1)), x -> x >= 0)"),
        )
    )


def repeated_units(docs: DataFrame) -> DataFrame:
    """For every document (doc_id, mark) the number of its units, and the ranges of words that stay.

    ``kept`` has the first word and the number of words of each unit that stays, in order, and is
    null where all stay; ``n_removed`` counts the units in chunks that stand earlier in the corpus.
    """
    size = f"get(ends, k + {UNITS - 1}) - {_first('ends', 'k')} + 1"
    chunks = (
        f"if(size(ends) < {UNITS}, cast(array() AS array<bigint>), transform(sequence(0, size(ends) - {UNITS}), "
        f"k -> xxhash64(slice(hashes, {_first('ends', 'k')} + 1, {size}))))"
    )
    layout = materialise(_with_units(_marked(docs)).select("doc_id", "mark", "ends", F.expr(chunks).alias("chunks")))
    places = layout.select("doc_id", "mark", F.posexplode("chunks").alias("k", "chunk"))
    often = materialise(places.groupBy("chunk").count().where("count > 1").select("chunk"))
    found = materialise(places.join(often, "chunk").distinct())

    # The words of the chunks that occur more than once, from the texts that have them.
    suspects = found.groupBy("doc_id", "mark").agg(F.collect_list("k").alias("ks"))
    suspects = materialise(_joined(suspects, layout.distinct(), "inner"))
    body = (
        f"array_join(transform(slice(words, {_first('ends', 'k')} + 1, {size}), "
        r"x -> trim(TRAILING ' \\n\\t\\r' FROM x)), ' ')"
    )
    # One binding of the words, and only the words of a chunk in the row of a chunk.
    each = f"transform(ks, k -> struct(k, get(chunks, k) AS chunk, {body} AS body))"
    each = f"element_at(transform(array({_WORDS_SQL}), words -> {each}), 1)"
    pieces = _joined(_marked(docs), suspects, "inner").select("doc_id", "mark", F.expr(f"inline({each})"))
    removals = _gone(found, pieces).groupBy("doc_id", "mark").agg(F.collect_set("k").alias("ks"))
    removals = removals.select(
        "doc_id", "mark", F.expr(f"array_distinct(flatten(transform(ks, k -> sequence(k, k + {UNITS - 1}))))").alias("ks")
    )
    ranges = (
        "transform(array_except(sequence(0, size(ends) - 1), ks), "
        f"k -> struct({_first('ends', 'k')} + 1 AS at, get(ends, k) - {_first('ends', 'k')} + 1 AS n))"
    )
    return materialise(
        _joined(layout.select("doc_id", "mark", "ends").distinct(), removals, "left").select(
            "doc_id",
            "mark",
            F.size("ends").cast("long").alias("n_units"),
            F.coalesce(F.size("ks"), F.lit(0)).cast("long").alias("n_removed"),
            F.when(F.col("ks").isNotNull(), F.expr(ranges)).alias("kept"),
        )
    )


def drop_repeated_passages(docs: DataFrame) -> DataFrame:
    """Texts without the passages that occur before, in the order of doc_id and place, wherever they stand in a line.

    A unit goes if a chunk of ``UNITS`` units around it has the words of an earlier chunk; white
    space between words does not count. Each unit that goes stands, with the same words, at an
    earlier place that stays. The first and last words of a passage may be left.
    Returns one row per input row: doc_id, text (cleaned), n_chars, n_units and n_removed.

    Nulls and edges: as ``drop_repeated_lines``; texts without ``UNITS`` units lose nothing.
    """
    found = _joined(_marked(docs), repeated_units(docs), "inner")
    cleaned = (
        f"element_at(transform(array({_WORDS_SQL}), words -> "
        "array_join(flatten(transform(kept, r -> slice(words, r.at, r.n))), '')), 1)"
    )
    whole = F.when(F.col("kept").isNull(), F.coalesce("text", F.lit(""))).otherwise(F.expr(cleaned))
    return found.select("doc_id", whole.alias("text"), "n_units", "n_removed").select(
        "doc_id", "text", F.length("text").cast("long").alias("n_chars"), "n_units", "n_removed"
    )
