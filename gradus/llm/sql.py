"""SQL that checks the corpus operators, for an embedded database with the same tables."""

from __future__ import annotations

from gradus.llm.licenses import NOTICES
from gradus.llm.mixing import DIGITS, DIMENSIONS, MARKS, NONE, POWERS, SEED, SWEEPS

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

EXACT = r"""
WITH n AS (
    SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body FROM documents
)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = min(doc_id) OVER w AS kept, sha256(body) AS text_sha256
FROM n WINDOW w AS (PARTITION BY body)
"""

_WORDS = rf"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

DECONTAMINATION = rf"""
WITH items AS (
    SELECT item_id, w, least(len(w), 13) AS size FROM (SELECT item_id, {_WORDS} AS w FROM benchmark) WHERE len(w) > 0
), patterns AS (
    SELECT DISTINCT item_id, size, array_to_string(w[k:k + size - 1], ' ') AS gram
    FROM (SELECT *, unnest(generate_series(1, len(w) - size + 1)) AS k FROM items)
), docs AS (
    SELECT doc_id, {_WORDS} AS w FROM documents
), sizes AS (SELECT DISTINCT size FROM patterns),
found AS (
    SELECT doc_id, k, p.size, item_id
    FROM (SELECT doc_id, k, size, array_to_string(w[k:k + size - 1], ' ') AS gram
          FROM (SELECT doc_id, w, size, unnest(generate_series(1, len(w) - size + 1)) AS k FROM docs, sizes
                WHERE len(w) >= size)) d
    JOIN patterns p ON p.gram = d.gram AND p.size = d.size
), hits AS (
    SELECT doc_id, count(DISTINCT x) AS n_hit
    FROM (SELECT doc_id, unnest(generate_series(k, k + size - 1)) AS x FROM found) GROUP BY doc_id
), names AS (
    SELECT doc_id, count(DISTINCT item_id) AS n_items,
           string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS names
    FROM found GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(names, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM docs LEFT JOIN hits USING (doc_id) LEFT JOIN names USING (doc_id)
"""


CHAT = r"""
WITH all_turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
    UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'
), sized AS (
    SELECT *, 12 + length(role) + 1 + length(text) + 10 + 1
           + CASE WHEN regexp_matches(text, '<\|im_(start|end)\|>|<\\+\|')
                  THEN len(regexp_extract_all(text, '<\\*\|')) ELSE 0 END AS formatted
    FROM all_turns
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(formatted)::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id
"""

LINES = r"""
WITH cut AS (
    SELECT doc_id, coalesce(text, '') AS text,
           string_split(replace(replace(replace(replace(coalesce(text, ''),
               chr(10), chr(10) || chr(1)), '. ', '. ' || chr(1)), '! ', '! ' || chr(1)), '? ', '? ' || chr(1)), chr(1)) AS parts
    FROM documents
), units AS (
    SELECT * FROM (SELECT doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS i FROM cut) WHERE line <> ''
), hashed AS (
    SELECT *, ('0x' || substr(md5(rtrim(line, ' ' || chr(10))), 1, 7))::UBIGINT::BIGINT AS h FROM units
), rolled AS (
    SELECT *, (h * 31 + coalesce(lag(h) OVER w, 7)) % 2147483647 AS r FROM hashed WINDOW w AS (PARTITION BY doc_id ORDER BY i)
), ended AS (
    SELECT *, CASE WHEN lead(r) OVER w IS NULL OR (lag(r) OVER w IS NOT NULL AND r < lag(r) OVER w AND r <= lead(r) OVER w)
                   THEN 1 ELSE 0 END AS stop
    FROM rolled WINDOW w AS (PARTITION BY doc_id ORDER BY i)
), placed AS (
    SELECT *, sum(stop) OVER (PARTITION BY doc_id ORDER BY i) - stop AS k FROM ended
), chunks AS (
    SELECT doc_id, k, count(*) AS n, string_agg(line, '' ORDER BY i) AS whole FROM placed GROUP BY doc_id, k
), ranked AS (
    SELECT *, n >= 2 AND row_number() OVER (PARTITION BY n >= 2, rtrim(whole, ' ' || chr(10)) ORDER BY doc_id, k) > 1 AS gone
    FROM chunks
), joined AS (
    SELECT doc_id, count(*) AS n_chunks, count(*) FILTER (gone) AS n_removed,
           coalesce(string_agg(whole, '' ORDER BY k) FILTER (NOT gone), '') AS kept
    FROM ranked GROUP BY doc_id
)
SELECT doc_id, length(coalesce(kept, ''))::BIGINT AS n_chars, coalesce(n_chunks, 0)::BIGINT AS n_chunks,
       coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS text_sha256
FROM cut LEFT JOIN joined USING (doc_id)
"""


def _share(characters: str) -> str:
    return f"(length(text) - length(translate(text, '{characters}', '')))"


def _mixing() -> str:
    parts = [
        f"""WITH rows AS MATERIALIZED (
    SELECT doc_id, coalesce(source, '{NONE}') AS source, coalesce(lang, '{NONE}') AS lang,
           CASE WHEN coalesce(length(text), 0) < 400 THEN 'brief' WHEN {_share("|")} * 50 >= length(text) THEN 'list'
                WHEN {_share(MARKS)} * 20 >= length(text) THEN 'marked'
                WHEN {_share(DIGITS)} * 100 >= length(text) THEN 'figures' ELSE 'prose' END AS topic,
           CASE WHEN coalesce(length(text), 0) = 0 THEN 0
                ELSE length(text) - length(regexp_replace(text, '[ \\t\\n\\r]', '', 'g')) + 1 END::BIGINT AS tokens
    FROM documents
), cells AS MATERIALIZED (SELECT source, lang, topic, sum(tokens)::BIGINT AS tokens FROM rows GROUP BY ALL HAVING sum(tokens) > 0)"""
    ]
    for name in DIMENSIONS:
        raised = f"pow(sum(tokens)::DOUBLE, {POWERS[name]})"
        parts.append(
            f"t_{name} AS MATERIALIZED (SELECT {name}, {raised} / sum({raised}) OVER () AS target FROM cells GROUP BY {name})"
        )
    parts.append("w0 AS MATERIALIZED (SELECT *, tokens::DOUBLE / sum(tokens) OVER () AS weight FROM cells)")
    step = 0
    for _ in range(SWEEPS):
        for name in DIMENSIONS:
            parts.append(
                f"w{step + 1} AS MATERIALIZED (SELECT source, lang, topic, tokens, "
                f"weight * target / sum(weight) OVER (PARTITION BY w{step}.{name}) AS weight "
                f"FROM w{step} JOIN t_{name} USING ({name}))"
            )
            step += 1
    parts.append(
        f"fitted AS (SELECT source, lang, topic, weight / sum(weight) OVER () AS weight, "
        f"round(weight / sum(weight) OVER () * sum(tokens) OVER () / tokens, 9) AS wanted FROM w{step})"
    )
    draw = f"('0x' || substr(md5('{SEED}:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::UBIGINT / 4294967296.0::DOUBLE"
    return (
        ",\n".join(parts)
        + f"""
SELECT doc_id, source, lang, topic, tokens, round(coalesce(weight, 0), 9) AS cell_weight,
       coalesce(least(wanted, 1.0), 0.0) AS probability, coalesce(greatest(wanted, 1.0), 0.0) AS sample_weight,
       {draw} < coalesce(least(wanted, 1.0), 0.0) AS sampled
FROM rows LEFT JOIN fitted USING (source, lang, topic)
"""
    )


MIXING = _mixing()


SEARCH = rf"""
WITH docs AS MATERIALIZED (SELECT rid, doc_id, {_WORDS} AS w FROM (SELECT row_number() OVER () AS rid, doc_id, text FROM documents)),
sizes AS (SELECT rid, doc_id, len(w)::BIGINT AS n FROM docs WHERE len(w) > 0),
corpus AS (SELECT count(*)::BIGINT AS N_docs, sum(n)::BIGINT AS L FROM sizes),
wanted AS (SELECT item_id, term, count(*)::BIGINT AS times
           FROM (SELECT item_id, unnest({_WORDS}) AS term FROM (SELECT DISTINCT item_id, text FROM benchmark)) GROUP BY ALL),
counts AS (SELECT rid, term, count(*)::BIGINT AS tf
           FROM (SELECT rid, unnest(w) AS term FROM docs) SEMI JOIN wanted USING (term) GROUP BY ALL),
weights AS (SELECT term, floor(1000 * ln((2 * any_value(N_docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
            FROM counts, corpus GROUP BY term),
parts AS (SELECT rid, doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + ((75 * n * N_docs) // L)))) AS part
          FROM counts JOIN sizes USING (rid) JOIN weights USING (term), corpus),
scores AS (SELECT item_id, rid, doc_id, sum(times * part)::BIGINT AS score FROM wanted JOIN parts USING (term) GROUP BY ALL),
placed AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id, rid)::INTEGER AS rank FROM scores WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM placed WHERE rank <= 10
"""


def _licences() -> str:
    notices = [(k, n.label, n.base, w, at, (w, at) in n.mandatory) for k, n in enumerate(NOTICES) for w, at in n.words]
    listed = ", ".join(f"({k}, '{label}', {base}, '{w}', {at}, {must})" for k, label, base, w, at, must in notices)
    return rf"""
WITH notices AS (SELECT * FROM (VALUES {listed}) t(k, label, base, word, off, must)),
docs AS MATERIALIZED (SELECT rid, doc_id, {_WORDS} AS w FROM (SELECT row_number() OVER () AS rid, doc_id, text FROM documents)),
places AS MATERIALIZED (
    SELECT rid, word, i - 1 AS i FROM (SELECT rid, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM docs)
    WHERE word IN (SELECT word FROM notices)
), weights AS (
    SELECT word, ln(((SELECT count(*) FROM docs) + 1)::DOUBLE / (count(DISTINCT rid) + 1)) AS weight
    FROM (SELECT DISTINCT word FROM notices) LEFT JOIN places USING (word) GROUP BY word
), found AS (
    SELECT rid, k, any_value(label) AS label, any_value(base) AS base, i - off AS start
    FROM places JOIN notices USING (word) WHERE i >= off AND must
    GROUP BY rid, k, i - off HAVING count(*) = (SELECT count(*) FROM notices m WHERE m.k = notices.k AND must)
), shares AS (
    SELECT f.rid, f.k, sum(weight) / (SELECT sum(weight) FROM notices m JOIN weights USING (word) WHERE m.k = f.k) AS share
    FROM (SELECT DISTINCT found.rid, found.k, n.word, n.off
          FROM found JOIN notices n USING (k) JOIN places p ON p.rid = found.rid AND p.word = n.word AND p.i = found.start + n.off) f
    JOIN weights USING (word) GROUP BY f.rid, f.k
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word,
       last_word::BIGINT AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       round(coalesce(score, 0), 9) AS score
FROM docs LEFT JOIN (
    SELECT rid, count(*) FILTER (base) AS n_base, min(start) FILTER (base) AS first_word, max(start) FILTER (base) AS last_word,
           string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base) AS base_labels,
           string_agg(DISTINCT label, ',' ORDER BY label) AS labels
    FROM found GROUP BY rid) USING (rid)
LEFT JOIN (SELECT rid, max(share) AS score FROM shares GROUP BY rid) USING (rid)
"""


LICENCES = _licences()
