"""SQL twins of the queries, for DuckDB."""

from __future__ import annotations

from newsignal.llm import host_rules, mixing

WORD = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SPACES = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

OP2 = """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
  doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))"""


def raking() -> str:
    """The rounds of the raking, one query per dimension."""
    dims, parts, last = mixing.DIMS, [], "cells"
    parts.append(
        "totals AS MATERIALIZED (SELECT "
        + ", ".join(f"(SELECT sum(m) FROM (SELECT pow(sum(n_tokens), {mixing.POWER}) AS m FROM cells GROUP BY {d})) AS {d}_total" for d in dims)
        + ")"
    )
    parts.append(
        "r0 AS MATERIALIZED (SELECT c.*, n_tokens::DOUBLE AS weight, "
        + ", ".join(f"pow(sum(n_tokens) OVER (PARTITION BY {d}), {mixing.POWER}) / {d}_total AS {d}_share" for d in dims)
        + " FROM cells c, totals)"
    )
    last = "r0"
    for i in range(mixing.ROUNDS * len(dims)):
        d = dims[i % len(dims)]
        parts.append(
            f"r{i + 1} AS MATERIALIZED (SELECT * REPLACE (weight * {d}_share / sum(weight) OVER (PARTITION BY {d}) "
            f"AS weight) FROM {last})"
        )
        last = f"r{i + 1}"
    parts.append(f"rates AS (SELECT {', '.join(dims)}, weight / n_tokens AS rate FROM {last})")
    return ",\n".join(parts)


OP3 = f"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, coalesce(source, '') AS source, coalesce(lang, '') AS lang,
    len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS n_tokens FROM documents),
rows AS MATERIALIZED (
  SELECT doc_id, source, lang, n_tokens,
    CASE WHEN 2 * length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) > n_tokens THEN 'marked'
      WHEN n_tokens < 100 THEN 'brief' WHEN n_tokens >= 1000 THEN 'long' ELSE 'prose' END AS topic
  FROM d),
cells AS MATERIALIZED (
  SELECT source, lang, topic, sum(n_tokens)::BIGINT AS n_tokens FROM rows GROUP BY ALL HAVING sum(n_tokens) > 0),
{raking()},
scaled AS (
  SELECT source, lang, topic, round(rate / (SELECT max(rate) FROM rates), 9) AS probability FROM rates),
out AS (
  SELECT doc_id, source, lang, topic, n_tokens,
    CASE WHEN n_tokens = 0 THEN 1.0 ELSE coalesce(probability, 0.0) END AS probability
  FROM rows LEFT JOIN scaled USING (source, lang, topic))
SELECT *, ('0x' || substr(md5('{mixing.SEED}:' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT / 4503599627370496.0
  < probability AS kept FROM out"""

def run_of(n: int) -> str:
    """The words from the current one on, n of them, as one text."""
    frame = f"OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND {n - 1} FOLLOWING)"
    return f"CASE WHEN count(*) {frame} = {n} THEN md5_number(string_agg(x, ' ') {frame}) END"


OP4 = f"""
WITH RECURSIVE d AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'), '{WORD}') AS w
  FROM documents),
t AS (SELECT doc_id, unnest(w) AS x, generate_subscripts(w, 1) AS i FROM d),
s AS MATERIALIZED (
  SELECT DISTINCT doc_id, g FROM (SELECT doc_id, {run_of(3)} AS g FROM t) WHERE g IS NOT NULL
  UNION ALL SELECT doc_id, md5_number(array_to_string(w, ' ')) FROM d WHERE len(w) BETWEEN 1 AND 2),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS (
  SELECT p.doc_id AS a, q.doc_id AS b, count(*) AS shared FROM s p JOIN s q USING (g)
  WHERE p.doc_id <> q.doc_id GROUP BY ALL),
links AS MATERIALIZED (
  SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
  WHERE 100 * shared >= 90 * (x.n + y.n - shared)),
reach AS (
  SELECT doc_id AS node, doc_id AS seen FROM d
  UNION SELECT node, b FROM reach JOIN links ON seen = a),
least AS (SELECT node, min(seen) AS component_id FROM reach GROUP BY node)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, coalesce(n_links, 0) AS n_links
FROM d JOIN least ON node = doc_id LEFT JOIN n USING (doc_id)
LEFT JOIN (SELECT a AS doc_id, count(*) AS n_links FROM links GROUP BY a) USING (doc_id)"""

OP6 = """
WITH d AS MATERIALIZED (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS MATERIALIZED (
  SELECT doc_id, i, count(*) OVER (PARTITION BY g) > 1 AS again FROM (
    SELECT doc_id, i, md5_number(substr(h, 2 * i - 1, 400)) AS g
    FROM (SELECT doc_id, h, unnest(generate_series(1, length(h) // 2 - 199)) AS i FROM d))),
b AS (
  SELECT doc_id, unnest(l) AS x, generate_subscripts(l, 1) AS i
  FROM (SELECT doc_id, regexp_extract_all(h, '..') AS l FROM d)),
c AS (
  SELECT doc_id, i, x,
    coalesce(bool_or(again) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 199 PRECEDING AND CURRENT ROW), false) AS gone
  FROM b LEFT JOIN w USING (doc_id, i)),
e AS (SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY i), false) AS begins FROM c),
g AS (
  SELECT doc_id, count(*) AS n_bytes, count(*) FILTER (gone) AS n_removed, count(*) FILTER (begins) AS n_spans,
    coalesce(string_agg(x, '' ORDER BY i) FILTER (NOT gone), '') AS kept
  FROM e GROUP BY doc_id)
SELECT doc_id, coalesce(n_bytes, 0) AS n_bytes, coalesce(n_removed, 0) AS n_removed,
  coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(kept, ''))) AS kept_sha256
FROM d LEFT JOIN g USING (doc_id)"""

R = host_rules
LOW, HIGH = R.PRIOR_RANGE


def shrunk(rule: str) -> str:
    weight = (
        f"CASE WHEN {rule}_var > 0 THEN least(greatest({rule}_mean * (1 - {rule}_mean) / {rule}_var - 1, {LOW}), {HIGH}) "
        f"ELSE {HIGH} END"
    )
    return f"({rule}_fails + ({weight}) * {rule}_mean) / (n_docs + ({weight}))"


OP7 = f"""
WITH d AS MATERIALIZED (
  SELECT doc_id, source, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '{WORD}') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{WORD}')) AS l
  FROM documents),
t AS (SELECT doc_id, unnest(w) AS x, generate_subscripts(w, 1) AS i FROM d),
windows AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n
  FROM (SELECT doc_id, i, {run_of(R.WINDOW)} AS g FROM t) WHERE g IS NOT NULL),
repeats AS (
  SELECT doc_id, count(DISTINCT i + j) AS n_repeat_words FROM windows, range({R.WINDOW}) r(j)
  WHERE n > 1 GROUP BY doc_id),
m AS MATERIALIZED (
  SELECT doc_id, source, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols, len(l) AS n_wordy,
    len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM d LEFT JOIN repeats USING (doc_id)),
f AS MATERIALIZED (
  SELECT *, n_words < {R.MIN_WORDS} AS short, 100 * n_repeat_words > {R.MAX_REPEATED_PERCENT} * n_words AS repeated,
    100 * n_symbols > {R.MAX_SYMBOL_PERCENT} * word_chars AS symbols,
    100 * n_dup_lines > {R.MAX_DUP_LINE_PERCENT} * n_wordy AS dup_lines FROM m),
h AS MATERIALIZED (
  SELECT source, count(*) AS n_docs, {', '.join(f'count(*) FILTER ({r}) AS {r}_fails' for r in R.RULES)}
  FROM f GROUP BY source),
p AS (SELECT {', '.join(f'avg({r}_fails / n_docs) AS {r}_mean, var_pop({r}_fails / n_docs) AS {r}_var' for r in R.RULES)} FROM h),
v AS (SELECT source, greatest({', '.join(shrunk(r) for r in R.RULES)}) <= 0.5 AS host_kept FROM h, p)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  short OR repeated AS base_failed, NOT (short OR repeated) AND host_kept AS kept
FROM f JOIN v ON f.source IS NOT DISTINCT FROM v.source"""

OP8 = f"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS MATERIALIZED (
  SELECT doc_id, i, lines[i] AS line, translate(trim(lines[i], {SPACES}), '{UPPER}', '{UPPER.lower()}') AS key
  FROM (SELECT doc_id, lines, unnest(generate_series(1, len(lines))) AS i FROM d)),
often AS (SELECT key FROM l WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10),
m AS (SELECT l.*, o.key IS NOT NULL AS gone FROM l LEFT JOIN often o ON l.key = o.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id"""

OP10 = f"""
WITH d AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') AS w FROM documents),
t AS MATERIALIZED (SELECT doc_id, unnest(w) AS x, generate_subscripts(w, 1) AS i FROM d),
windows AS (
  SELECT doc_id, i, row_number() OVER (PARTITION BY g ORDER BY doc_id, i) > 1 AS later
  FROM (SELECT doc_id, i, {run_of(20)} AS g FROM t) WHERE g IS NOT NULL),
c AS (
  SELECT doc_id, i, x,
    coalesce(bool_or(later) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 19 PRECEDING AND CURRENT ROW), false) AS gone
  FROM t LEFT JOIN windows USING (doc_id, i)),
g AS (
  SELECT doc_id, count(*) FILTER (gone) AS n_removed, string_agg(x, ' ' ORDER BY i) FILTER (NOT gone) AS kept
  FROM c GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN g USING (doc_id)"""

OP12 = f"""
WITH t AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
    translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
p AS MATERIALIZED (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM t),
one AS MATERIALIZED (SELECT lang, x, count(*) AS a FROM (SELECT lang, unnest(w) AS x FROM p) GROUP BY ALL),
total AS (SELECT lang, sum(a)::BIGINT AS n FROM one GROUP BY lang),
two AS MATERIALIZED (
  SELECT lang, x, y, count(*) AS a FROM (SELECT lang, unnest(w[:-2]) AS x, unnest(w[2:]) AS y FROM p)
  WHERE x IS NOT NULL AND y IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
three AS MATERIALIZED (
  SELECT lang, x, y, z, count(*) AS a
  FROM (SELECT lang, unnest(w[:-3]) AS x, unnest(w[2:-2]) AS y, unnest(w[3:]) AS z FROM p)
  WHERE x IS NOT NULL AND y IS NOT NULL AND z IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
longer AS (
  SELECT lang, x, y, max(a) AS most FROM (
    SELECT lang, x, y, a FROM three UNION ALL SELECT lang, y, z, a FROM three) GROUP BY ALL),
cuts AS (
  SELECT t.lang, concat_ws(' ', t.x, t.y) AS phrase, t.a, 1 AS k, l.a AS l, r.a AS r
  FROM two t JOIN one l ON l.lang = t.lang AND l.x = t.x JOIN one r ON r.lang = t.lang AND r.x = t.y
  LEFT JOIN longer m ON m.lang = t.lang AND m.x = t.x AND m.y = t.y WHERE coalesce(100 * most < 50 * t.a, true)
  UNION ALL
  SELECT t.lang, concat_ws(' ', t.x, t.y, t.z), t.a, 1, l.a, r.a
  FROM three t JOIN one l ON l.lang = t.lang AND l.x = t.x
  JOIN two r ON r.lang = t.lang AND r.x = t.y AND r.y = t.z
  UNION ALL
  SELECT t.lang, concat_ws(' ', t.x, t.y, t.z), t.a, 2, l.a, r.a
  FROM three t JOIN two l ON l.lang = t.lang AND l.x = t.x AND l.y = t.y
  JOIN one r ON r.lang = t.lang AND r.x = t.z),
scored AS (SELECT *, ((1000000::HUGEINT * a * a) // (l::HUGEINT * r))::BIGINT AS score FROM cuts),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
  phrase, a, l, r, n, score FROM lowest JOIN total USING (lang) QUALIFY rank <= 2000"""

ORACLES = {
    "op2_exact_dedup": OP2, "op3_mix_sources": OP3, "op4_jaccard_join": OP4, "op6_suffix_dedup": OP6,
    "op7_host_rules": OP7, "op8_line_dedup": OP8, "op10_phrase_dedup": OP10,
    "op12_phrases": OP12,
}
