"""Queries of the corpus operators against SQL, brute force and held-out rows."""

import re
import sys
import zlib
from pathlib import Path

import numpy as np
import pytest
import xxhash
from oracle import compare, connect

from gradus.llm import base, exact, html, pii, simhash, toxicity
from gradus.llm.queries import QUERIES, SQL

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.fixture(scope="module")
def texts(spark, sf):
    return {r["doc_id"]: r["text"] for r in base.table(spark, sf, "documents").select("doc_id", "text").collect()}


@pytest.mark.parametrize("name", list(SQL))
def test_against_sql(spark, con, sf, name):
    assert compare(con, QUERIES[name](spark, sf), SQL[name]) is None


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    grams = [" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def plain_components(prints):
    """Smallest id reachable over links of at most three bits, by flooding."""
    ids = sorted(prints)
    values = np.array([prints[i] for i in ids], np.uint64)
    root = {}
    for k, i in enumerate(ids):
        if i in root:
            continue
        stack = [k]
        while stack:
            at = stack.pop()
            if ids[at] in root:
                continue
            root[ids[at]] = i
            stack += np.flatnonzero(np.bitwise_count(values ^ values[at]) <= 3).tolist()
    return root


def test_simhash_against_brute_force(spark, sf, texts):
    got = {r["doc_id"]: r for r in QUERIES["op2_simhash"](spark, sf).collect()}
    prints = {i: plain_fingerprint(t) for i, t in texts.items()}
    assert {i: r["fingerprint"] for i, r in got.items()} == {i: f"{p:016x}" for i, p in prints.items()}
    assert {i: r["component_id"] for i, r in got.items()} == plain_components(prints)


@pytest.mark.parametrize("crowd, block", [(32, 2048), (1, 8)])
def test_links_in_crowded_cells(spark, crowd, block):
    """Chains and clouds of close fingerprints; small limits send them through the block search."""
    pick = np.random.default_rng(5)
    seeds = pick.integers(0, 1 << 63, 6, dtype=np.uint64)
    values = {int(s) for s in seeds} | {int(x) for x in pick.integers(0, 1 << 63, 200, dtype=np.uint64)}
    for s in seeds:
        at = int(s)
        for _ in range(60):
            at ^= sum(1 << int(b) for b in pick.choice(64, pick.integers(1, 5), replace=False))
            values.add(at)
    prints = dict(enumerate(sorted(values)))
    frame = spark.createDataFrame([(v - (1 << 64) if v >> 63 else v,) for v in prints.values()], "fp long")
    stars = simhash.components(simhash.links(frame, crowd, block)).collect()
    numbers = {v: k for k, v in prints.items()}
    got = dict(zip(prints, prints))
    for r in stars:
        got[numbers[r["node"] % (1 << 64)]] = numbers[r["root"] % (1 << 64)]
    groups, want = {}, {}
    for k, v in plain_components(prints).items():
        want.setdefault(v, set()).add(k)
    for k, v in got.items():
        groups.setdefault(v, set()).add(k)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values()))


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(300)], "a long, b long")
    assert {r["root"] for r in simhash.components(edges).collect()} == {0}


def test_exact_tells_colliding_chunks_apart(spark, sf):
    """Hashes of three bits collide, so only the bytes can tell texts apart."""
    docs = base.table(spark, sf, "documents")
    want = sorted(map(tuple, exact.exact_groups(docs).collect()))
    assert sorted(map(tuple, exact.exact_groups(docs, hash_bits=3).collect())) == want


def test_chunks_do_not_shift():
    text = " ".join(f"word{k * k % 9973}" for k in range(20_000)).encode()
    one, two = dict(exact.chunks(text)), dict(exact.chunks(b"something else in front " + text))
    assert b"".join(p for _, p in exact.chunks(text)) == text
    assert len(one.keys() & two.keys()) > 0.9 * len(one)


def test_language_on_held_out_rows(spark, sf):
    docs = base.table(spark, sf, "documents")
    found = QUERIES["op7_language"](spark, sf).join(docs.select("doc_id", "lang"), "doc_id").collect()
    for r in found:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and 0 <= r["score"] <= 1
    kept = [r for r in found if r["held_out"]]
    assert sum(r["lang"] == r["lang_pred"] for r in kept) >= 0.97 * len(kept)


def test_toxicity_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.1"
    labels = base.table(spark, folder, "labels").select("doc_id", "toxic")
    kept = QUERIES["op3_toxicity"](spark, folder).join(labels, "doc_id").where("held_out").collect()
    caught = [r["predicted"] for r in kept if r["toxic"] == 1]
    clean = [r["predicted"] for r in kept if r["toxic"] == 0]
    assert sum(caught) >= 0.8 * len(caught) and sum(clean) <= 0.02 * len(clean)


def test_label_model_discounts_voters_that_say_the_same():
    pick = np.random.default_rng(1)
    truth = pick.random(4000) < 0.2
    good = [np.where(pick.random(4000) < 0.9, truth, ~truth) for _ in range(2)]
    noise = pick.random(4000) < 0.5
    belief, _, parents = toxicity.label_model(np.array([*good, noise, noise, noise]).T, truth.astype(float))
    assert ((belief > 0.5) == truth).mean() > 0.95 and {parents[3], parents[4]} <= {2, 3, 4}


def test_base_patterns_against_plain_expressions(texts):
    pick = np.random.default_rng(2)
    made = ["".join(pick.choice(list("0123456789..@@-+ () aA%é\n"), 40)) for _ in range(4000)]
    email, ip = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"
    card, phone = r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"
    for text in [*texts.values(), *made]:
        want = [("email", *m.span()) for m in re.finditer(email, text)]
        want += [("ip", *m.span()) for m in re.finditer(ip, text) if all(int(x) <= 255 for x in m.group().split("."))]
        for m in re.finditer(card, text):
            digits = re.sub(r"\D", "", m.group())
            if 14 <= len(digits) <= 19 and pii.luhn(digits):
                want.append(("card", *m.span()))
        want += [("phone", *m.span()) for m in re.finditer(phone, text) if 10 <= len(re.sub(r"\D", "", m.group())) <= 15]
        assert pii.base_spans(text) == sorted(want, key=lambda s: (s[1], pii.KINDS.index(s[0])))


def test_check_digit():
    assert pii.luhn("4539578763621486") and not pii.luhn("4539578763621487")


def test_skip_links_find_a_number_without_its_plus():
    texts = [f"Call +1 (4{k}5) 555-1{k}3{k} or mail bob.{k}@mail{k}.example.com at 10.2.{k}.4, item {k} of 12." for k in range(10)] * 5
    model = pii.fit([pii.without_marks(t, pii.base_spans(t)) for t in texts])
    text = "Call +1 (415) 555-1234 now. Much later (415) 555-1234 answers. Version 3.0 of 2024."
    base_found = pii.base_spans(text)
    assert [text[a:b] for _, a, b in pii.added_spans(text, base_found, model)] == ["(415) 555-1234"]


def test_pages_on_held_out_layouts(spark, sf):
    pages = base.table(spark, sf, "pages")
    model = html.train_page_model(pages)
    lines = ["Some words of a line, and some more of them.", "Short one.", "Another line that says a little more than the first did."]
    wrong = total = 0
    for seed in range(50_000, 50_150):
        _, found, labels = html.labelled_page(html.Layout(seed, lines).page())
        wrong += sum(a != b for a, b in zip(model.decode(found), labels))
        total += len(labels)
    assert wrong <= 0.02 * total
    for r in pages.collect():
        inside = r["html"].split("<article>")[1].split("</article>")[0]
        assert html.extract(r["html"], model) == "\n".join(b.text for b in html.blocks(inside))


def test_raked_weights_meet_their_targets(spark, sf):
    from gradus.llm import mixing

    rows = base.table(spark, sf, "documents").select("doc_id", *mixing._places())
    cells = rows.groupBy("source", "lang", "topic").agg({"tokens": "sum"}).withColumnRenamed("sum(tokens)", "tokens")
    target = mixing.tempered_targets(cells, "lang", 0.7)
    fitted = mixing.rake(cells, {"lang": target})
    got = {r["lang"]: r["w"] for r in fitted.groupBy("lang").agg({"weight": "sum"}).withColumnRenamed("sum(weight)", "w").collect()}
    for r in target.collect():
        assert got[r["lang"]] == pytest.approx(r["target"], abs=1e-9)


def test_pipeline(spark, sf, texts):
    """Each stage against what brute force leaves of the stage before."""
    import corpus_pipeline as pipeline

    docs = base.table(spark, sf, "documents")
    left = {}
    for name, stage in pipeline.STAGES:
        docs = base.materialise(stage(spark, docs, sf))
        left[name] = {r["doc_id"] for r in docs.select("doc_id").collect()}
    assert [n for n, _ in pipeline.STAGES] == ["language", "exact", "near", "decontaminate", "mix"]
    first = {}
    for i in sorted(left["language"]):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", texts[i]), i)
    assert left["exact"] == set(first.values())
    prints = {i: plain_fingerprint(texts[i]) for i in left["exact"]}
    assert left["near"] == {i for i, root in plain_components(prints).items() if i == root}
    bad = {r["doc_id"] for r in QUERIES["op9_decontamination"](spark, sf).where("contaminated").collect()}
    assert left["decontaminate"] == left["near"] - bad
    assert left["mix"] <= left["decontaminate"] and docs.columns == [*base.DOCUMENT_COLUMNS, "sample_weight"]
