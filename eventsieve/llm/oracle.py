"""DuckDB SQL of the registered queries that SQL can express."""

from __future__ import annotations

from math import ceil

from .licenses import CONTAINMENT, GAP, PHRASES, TEMPLATES, window_words
from .mixing import MAX_REPEATS, SHARE, WEIGHTS
from .secrets import BASE, BREAK, ENCRYPTION, END, HEADER, INLINE_CHARS, LINE, LINE_CHARS, LINE_STOP, RULES, SIGNS
from .signatures import TOP

SPACE = r"[\x20\x09-\x0D]"


def _secret_spans() -> str:
    """One list of spans per rule: gaps and matches alternate, so their lengths give the places."""
    out = []
    for i, r in enumerate(RULES):
        if r.kind == "pem":
            out.append("coalesce(keys, [])")
            continue
        p = "'" + r.pattern.replace("'", "''") + "'"
        out.append(f"""(SELECT list_filter(list_transform(range(1, len(m) + 1), lambda i: {{
            'start': list_sum(list_transform(gap[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0),
            'ord': {i},
            'stop': list_sum(list_transform(gap[1:i], lambda x: length(x))) + list_sum(list_transform(m[1:i], lambda x: length(x))),
            'fine': length(g[i]) >= {r.least}, 'kind': '{r.kind}'}}), lambda s: s.fine)
          FROM (SELECT regexp_extract_all(t, {p}) AS m, regexp_extract_all(t, {p}, {r.group}) AS g, string_split_regex(t, {p}) AS gap))""")
    return "list_sort(list_concat(" + ", ".join(out) + "))"


def _joined(spans: str) -> str:
    return f"coalesce(array_to_string(list_transform({spans}, lambda s: concat(s.kind, ':', s.start::BIGINT, ':', s.stop::BIGINT)), ','), '')"


UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _words(text: str) -> str:
    return f"list_filter(string_split_regex({text}, '{GAP}'), lambda w: w <> '')"


def _phrase_places(phrase: str) -> str:
    same = " AND ".join(f"ws[i + {k}] = '{w}'" for k, w in enumerate(phrase.split(), 1))
    return f"list_filter(range(0, len(ws)), lambda i: {same})"


def _template_met(template: str) -> tuple[str, str]:
    """Whether a block meets a template, and the best containment among blocks that do."""
    own = sorted(set(template.split()))
    held = f"coalesce(list_max(list_transform(blocks, lambda b: len(list_intersect({own}, b)))), 0)"
    met = f"{held} >= {ceil(CONTAINMENT * len(own) - 1e-9)}"
    return met, f"CASE WHEN {met} THEN {held}::DOUBLE / {len(own)} ELSE 0 END"


def _blocks(ws: str) -> str:
    """Windows over a list of words, each half a window after the one before."""
    window = window_words(TEMPLATES)
    half = window // 2
    return f"list_transform(range(0, greatest(len({ws}) - {half + 1}, 0) + 1, {half}), lambda s: {ws}[s + 1:s + {window}])"


OP2 = f"""
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}') AS t FROM documents),
v AS (SELECT doc_id, {_words("t")} AS ws, list_transform(string_split(t, chr(10)), lambda l: {_words("l")}) AS ls FROM d),
w AS (SELECT doc_id, ws, {_blocks("ws")} || flatten(list_transform(ls, lambda l: {_blocks("l")})) AS blocks FROM v),
p AS (SELECT doc_id, len(ws) AS n_words, {", ".join(f"{_phrase_places(p)} AS p{i}" for i, p in enumerate(PHRASES))},
  {", ".join(f"{_template_met(t)[0]} AS t{i}, {_template_met(t)[1]} AS s{i}" for i, (t, _) in enumerate(TEMPLATES))} FROM w),
b AS (SELECT *, {" || ".join(f"p{i}" for i in range(len(PHRASES)))} AS places,
  list_filter([{", ".join(f"CASE WHEN len(p{i}) > 0 THEN '{b}' END" for i, b in enumerate(PHRASES.values()))}], lambda x: x IS NOT NULL) AS base,
  list_filter([{", ".join(f"CASE WHEN t{i} THEN '{b}' END" for i, (_, b) in enumerate(TEMPLATES))}], lambda x: x IS NOT NULL) AS met FROM p)
SELECT doc_id, n_words::BIGINT AS n_words, len(places)::BIGINT AS n_base, list_min(places)::BIGINT AS first_word, list_max(places)::BIGINT AS last_word,
  coalesce(array_to_string(list_sort(list_distinct(base)), ','), '') AS base_labels,
  coalesce(array_to_string(list_sort(list_distinct(base || met)), ','), '') AS labels,
  CASE WHEN len(places) > 0 THEN 1.0::DOUBLE ELSE greatest({", ".join(f"s{i}" for i in range(len(TEMPLATES)))})::DOUBLE END AS score
FROM b
"""

def _q(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


SHORT = f"regexp_matches(x, '[A-Za-z]') AND length(x) < {LINE_CHARS}"
OP4 = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
h AS (SELECT r, regexp_extract_all(t, {_q(HEADER)}) AS hs, string_split_regex(t, {_q(HEADER)}) AS segs FROM d WHERE regexp_matches(t, {_q(HEADER)})),
p AS (SELECT r, hs, segs, unnest(range(1, len(hs) + 1)) AS i FROM h),
s AS (SELECT r, list_sum(list_transform(segs[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(hs[1:i - 1], lambda x: length(x))), 0) AS start,
    length(hs[i]) AS size, regexp_replace(segs[i + 1], {_q(BREAK)}, chr(10) || chr(10), 'g') AS t FROM p),
s1 AS (SELECT *, length(regexp_extract(t, {_q(ENCRYPTION)}, 0)) AS k1 FROM s),
s2 AS (SELECT *, k1 + length(regexp_extract(substr(t, k1 + 1), {_q(ENCRYPTION)}, 0)) AS k FROM s1),
s3 AS (SELECT *, substr(t, k + 1) AS rest FROM s2),
s4 AS (SELECT *, string_split_regex(rest, {_q(END)})[1] AS inside, regexp_extract_all(rest, {_q(LINE)}) AS runs, string_split_regex(rest || chr(10), {_q(LINE)}) AS gaps FROM s3),
s5 AS (SELECT *, regexp_extract_all(inside, {_q(LINE)}) AS words, array_to_string(list_transform(range(1, len(runs) + 1), lambda i: CASE
    WHEN regexp_matches(gaps[i], {_q(f"[^{SIGNS}]")}) THEN '0'
    WHEN length(runs[i]) >= {LINE_CHARS} AND (regexp_matches(gaps[i], '[\r\n]') OR length(runs[i]) >= {INLINE_CHARS}) THEN '2'
    WHEN length(runs[i]) >= {LINE_CHARS} THEN '0'
    WHEN NOT regexp_matches(runs[i], '[A-Za-z]') THEN '1'
    WHEN regexp_matches(gaps[i], '[\r\n]') AND regexp_matches(gaps[i + 1], {_q(LINE_STOP)}) THEN '3' ELSE '0' END), '') AS kinds FROM s4),
s6 AS (SELECT *, length(regexp_extract(kinds, '^[12]*')) AS run, length(regexp_extract(kinds, '^[12]*2')) AS held FROM s5),
s7 AS (SELECT *, CASE WHEN held > 0 AND substr(kinds, run + 1, 1) = '3' THEN run + 1 ELSE held END AS n FROM s6),
s8 AS (SELECT *, CASE WHEN regexp_matches(rest, {_q(END)}) AND NOT regexp_matches(inside, '[^\x00-\x7F]')
      AND len(list_filter(words[1:len(words) - 1], lambda x: {SHORT})) <= len(list_filter(words, lambda x: length(x) >= {LINE_CHARS}))
    THEN length(inside) + length(regexp_extract(rest, {_q(END)}, 0))
    ELSE coalesce(list_sum(list_transform(gaps[1:n], lambda x: length(x))) + list_sum(list_transform(runs[1:n], lambda x: length(x))), 0) END AS n_key FROM s7),
k AS (SELECT r, list({{'start': start, 'ord': {len(RULES) - 1}, 'stop': start + size + CASE WHEN n_key > 0 THEN k + n_key ELSE 0 END, 'fine': true, 'kind': 'pem'}}) AS keys
  FROM s8 GROUP BY r),
f AS (SELECT doc_id, {_secret_spans()} AS found FROM d LEFT JOIN k USING (r))
SELECT doc_id, {", ".join(f"len(list_filter(found, lambda x: x.kind = '{k}'))::BIGINT AS n_{k}" for k in BASE)},
  sha256({_joined(f"list_filter(found, lambda x: x.ord < {len(BASE)})")}) AS base_sha256, {_joined("found")} AS spans
FROM f
"""

OP10 = rf"""
WITH d AS (
  SELECT doc_id, source, CASE WHEN text IS NULL THEN 0 ELSE len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) END::BIGINT AS size,
    ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':' || coalesce(text, '')), 1, 15))::BIGINT AS h
  FROM documents),
p AS (SELECT source, sum(size)::BIGINT AS source_size, [{", ".join(map(str, WEIGHTS))}][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(WEIGHTS)} + 1] AS w
  FROM d GROUP BY source),
l AS (SELECT *, ({SHARE}::DOUBLE * (sum(source_size) OVER ())::DOUBLE - (coalesce(sum({MAX_REPEATS} * source_size) OVER (
      ORDER BY ({MAX_REPEATS} * source_size)::DOUBLE / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE)
    / (sum(w) OVER (ORDER BY ({MAX_REPEATS} * source_size)::DOUBLE / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS level FROM p),
t AS (SELECT source, source_size, least(({MAX_REPEATS} * source_size)::DOUBLE, (max(level) OVER ()) * w) AS target FROM l),
r AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS copies FROM t),
c AS (SELECT d.*, r.source_size, r.target, r.copies, r.target - r.copies * r.source_size AS rest,
    sum(size) OVER (PARTITION BY d.source ORDER BY h) AS upto, sum(size) OVER (PARTITION BY d.source, h) AS tied
  FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source)
SELECT doc_id, source, size, source_size, target, (size * (copies
  + CASE WHEN upto <= rest OR (upto - tied <= rest AND upto - rest < rest - (upto - tied)) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM c
"""

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

OP13 = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, translate(text, '{UPPER}', '{UPPER.lower()}') AS t FROM documents),
b AS (SELECT row_number() OVER () AS q, item_id, translate(text, '{UPPER}', '{UPPER.lower()}') AS t FROM benchmark),
dt AS (SELECT r, doc_id, unnest(regexp_extract_all(t, '{TERM}')) AS term FROM d),
tf AS (SELECT r, doc_id, term, count(*) AS tf FROM dt GROUP BY ALL),
n AS (SELECT r, sum(tf)::BIGINT AS n FROM tf GROUP BY r),
c AS (SELECT count(*) AS docs, sum(n)::BIGINT AS l FROM n),
m AS (SELECT r, 75 + (25 * n * docs) // l AS m FROM n, c),
w AS (SELECT term, floor(1000 * ln((2 * any_value(docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM tf, c GROUP BY term),
bt AS (SELECT q, item_id, term, count(*) AS times FROM (SELECT q, item_id, unnest(regexp_extract_all(t, '{TERM}')) AS term FROM b) GROUP BY ALL),
s AS (SELECT q, item_id, r, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
  FROM bt JOIN w USING (term) JOIN tf USING (term) JOIN m USING (r) GROUP BY ALL)
SELECT item_id, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST, r)::INTEGER AS rank, doc_id, score
FROM s WHERE score > 0 QUALIFY rank <= {TOP}
"""

ORACLE_SQL: dict[str, str] = {
    "op2_license_scans": OP2,
    "op4_secret_scans": OP4,
    "op10_source_mix": OP10,
    "op13_ranked_search": OP13,
}
