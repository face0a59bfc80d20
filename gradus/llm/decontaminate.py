"""Benchmark passages in documents, found by one Aho-Corasick automaton.

Texts are read as words. Every window of 13 item words (a shorter item is one
window) is a pattern over word numbers; the automaton reads each document once and
gives the positions of all windows, which map to offsets in the original text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradus.llm.base import map_batches, materialise, text_mark, without_rows, word_pieces

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

# Lower-cases A-Z; every other byte below 128 that is no digit or letter becomes a space.
FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)

WINDOW = 13

# A document is contaminated when one word in so many is hit.
SHARE = 20

# Item bytes of one automaton. A larger benchmark is cut into several that are read one after the other.
AUTOMATON_BYTES = 1_000_000


def words(text: str | None) -> Iterator[list[bytes]]:
    """The words of a text, some megabytes at a time."""
    return word_pieces((text or "").encode().translate(FOLD))


class Automaton:
    """Windows of items as patterns of word numbers."""

    def __init__(self, items: list[tuple], window: int = WINDOW):
        self.names = sorted({str(i) for i, _ in items if i is not None})
        place = {name: k for k, name in enumerate(self.names)}
        self.numbers: dict[bytes, int] = {}
        owners: dict[tuple, set[int]] = {}
        for item_id, text in items:
            own = [self.numbers.setdefault(w, len(self.numbers) + 1) for part in words(text) for w in part]
            for k in range(max(1, len(own) - window + 1)) if own else ():
                owners.setdefault(tuple(own[k : k + window]), set()).update(
                    [place[str(item_id)]] if item_id is not None else []
                )
        self.machine = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        for key, who in owners.items():
            self.machine.add_word(key, (len(key), tuple(who)))
        self.empty = not owners
        self.reach = max(map(len, owners), default=1) - 1
        if owners:
            self.machine.make_automaton()

    def hits(self, text: str | None) -> tuple[int, list[tuple[int, int]], list[str]]:
        """Number of words, merged ranges of hit words (end exclusive), names of the items."""
        get, spans, who, n, carry = self.numbers.get, [], set(), 0, []
        for part in words(text):
            # The words before a piece that a window may begin with are read again.
            own = carry + [get(w, 0) for w in part]
            before = n - len(carry)
            n += len(part)
            if self.empty:
                continue
            for end, (length, owners) in self.machine.iter(tuple(own)):
                who.update(owners)
                stop = before + end + 1
                start = stop - length
                while spans and spans[-1][1] >= start:
                    first, last = spans.pop()
                    start, stop = min(start, first), max(stop, last)
                spans.append((start, stop))
            carry = own[max(0, len(own) - self.reach) :]
        return n, spans, [self.names[k] for k in sorted(who)]


def _scan(docs: DataFrame, items: list[tuple], window: int) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(items)

    def run(batches):
        automaton = Automaton(shared.value, window)
        for batch in batches:
            n_words, spans, places, who = [], [], [], []
            for text in batch.column("text").to_pylist():
                n, found, names = automaton.hits(text)
                n_words.append(n)
                spans.append([x for span in found for x in span])
                places.append([x for place in offsets(text, spans[-1]) for x in place])
                who.append(names)
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in batch.schema.names if c != "text"),
                    pa.array(n_words, pa.int64()),
                    pa.array(spans, pa.list_(pa.int64())),
                    pa.array(places, pa.list_(pa.int64())),
                    pa.array(who, pa.list_(pa.string())),
                ],
                [*(c for c in batch.schema.names if c != "text"), "n_words", "spans", "offsets", "items"],
            )

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name != "text")
    return docs.mapInArrow(run, f"{kept}, n_words long, spans array<bigint>, offsets array<bigint>, items array<string>")


def _merge(found: DataFrame) -> DataFrame:
    """Joins what several automata found in the same row."""

    def run(batch):
        spans, places, who = [], [], []
        parts = zip(*(batch.column(c).to_pylist() for c in ("parts", "ranges", "names")))
        for words_hit, ranges, names in parts:
            # Words before their offsets, so that ranges that meet in words are joined in the text too.
            ordered = sorted(
                (p[k], p[k + 1], r[k], r[k + 1]) for p, r in zip(words_hit, ranges) for k in range(0, len(p), 2)
            )
            merged: list[list[int]] = []
            for start, end, low, high in ordered:
                if merged and merged[-1][1] >= start:
                    merged[-1][1], merged[-1][3] = max(merged[-1][1], end), max(merged[-1][3], high)
                else:
                    merged.append([start, end, low, high])
            spans.append([x for m in merged for x in m[:2]])
            places.append([x for m in merged for x in m[2:]])
            who.append(sorted({x for n in names for x in n}))
        lists = (pa.array(x, pa.list_(pa.int64())) for x in (spans, places))
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in same), *lists, pa.array(who, pa.list_(pa.string()))],
            [*same, "spans", "offsets", "items"],
        )

    same = ["doc_id", "mark", "n_words"]
    # Lists of one automaton stay side by side.
    together = found.groupBy("row", *same).agg(F.collect_list(F.struct("spans", "offsets", "items")).alias("parts"))
    together = together.select(
        *same, F.col("parts.spans").alias("parts"), F.col("parts.offsets").alias("ranges"), F.col("parts.items").alias("names")
    )
    kind = found.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, mark long, n_words long, spans array<bigint>, offsets array<bigint>, items array<string>"
    return map_batches(together, run, schema)


def contamination(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, automaton_bytes: int = AUTOMATON_BYTES
) -> DataFrame:
    """Words of each document that lie in an occurrence of a benchmark window.

    Returns one row per input row: doc_id, n_words, spans (starts and ends of the
    hit word ranges, one after the other), offsets (the same ranges in code points of
    the original text), items (names of the items whose windows occur, sorted as
    text), n_hit, n_items, items_sha256 and contaminated.

    The benchmark is broadcast in parts of at most ``automaton_bytes`` (and one
    item) each, and every part is one automaton; one part is the usual case.

    Nulls and edges: null and empty texts have no words and are never contaminated;
    items without words match nothing; items that repeat an id count once; a null
    item_id hits words but has no name. Rows that repeat a doc_id each get their
    answer. Further columns, also ones named like the result's, are not read.
    Empty tables give no rows or no hits.
    """
    return _contamination(docs, benchmark, window, automaton_bytes).drop("mark")


def _contamination(docs: DataFrame, benchmark: DataFrame, window: int, automaton_bytes: int) -> DataFrame:
    """The rows of ``contamination`` with the marks of their texts."""
    docs = docs.select("doc_id", "text", text_mark().alias("mark"))
    wanted = benchmark.select("item_id", "text").where("text IS NOT NULL")
    size = wanted.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-size // automaton_bytes))
    if parts == 1:
        found = _scan(docs, [tuple(r) for r in wanted.distinct().collect()], window)
    else:
        # Rows get a number in a written copy, so that what each part finds can be put together.
        docs = materialise(docs.withColumn("row", F.monotonically_increasing_id()))
        of_part = wanted.distinct().withColumn("part", F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)))
        of_part = materialise(of_part)
        found = None
        for k in range(parts):
            items = [tuple(r) for r in of_part.where(F.col("part") == k).select("item_id", "text").collect()]
            more = _scan(docs, items, window)
            found = more if found is None else found.unionByName(more)
        found = _merge(found)
    ends = F.aggregate("spans", F.lit(0).cast("long"), lambda total, x: x - total)
    names = F.array_join("items", ",")
    return found.select(
        "doc_id",
        "mark",
        "n_words",
        "spans",
        "offsets",
        "items",
        ends.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(names, 256).alias("items_sha256"),
        ((ends > 0) & (SHARE * ends >= F.col("n_words"))).alias("contaminated"),
    )


def offsets(text: str | None, spans: list[int]) -> list[tuple[int, int]]:
    """Code point ranges in the original text of ranges of words, which ascend."""
    found: list[int] = []
    if not spans:
        return []
    data = (text or "").encode()
    wanted = [spans[k] if k % 2 == 0 else spans[k] - 1 for k in range(len(spans))]
    byte = points = 0
    for number, m in enumerate(WORD.finditer(data.translate(FOLD))):
        while len(found) < len(wanted) and wanted[len(found)] == number:
            at = m.start() if len(found) % 2 == 0 else m.end()
            points += len(data[byte:at].decode())
            byte = at
            found.append(points)
        if len(found) == len(wanted):
            break
    return list(zip(found[::2], found[1::2]))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that are not contaminated; all columns stay.

    Nulls and edges: as ``contamination``; the verdict is that of the row, so ids may be null or repeated.
    """
    found = _contamination(docs, benchmark, WINDOW, AUTOMATON_BYTES)
    return without_rows(docs, found.where("contaminated").select("doc_id", "mark"))
