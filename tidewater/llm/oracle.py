"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

from tidewater.llm import chat, grid_join, license_scan, mixing, near_dup, phrases, prefix_trie, quality, repeats, secret_scan

WORD = r"[^\x20\x09-\x0D]+"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


OP1 = rf"""
WITH d AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '{WORD}')), 0) AS BIGINT) AS size,
         md5('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS key
  FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS rank
  FROM d GROUP BY source),
w AS (SELECT *, [{", ".join(map(str, mixing.WEIGHTS))}][(rank - 1) % {len(mixing.WEIGHTS)} + 1] AS weight, {mixing.MAX_EPOCHS} * source_size AS cap FROM s),
r AS (
  SELECT *, CAST(sum(source_size) OVER () - coalesce(sum(cap) OVER o, 0) AS BIGINT) AS room,
         CAST(sum(weight) OVER () - coalesce(sum(weight) OVER o, 0) AS BIGINT) AS left_weight
  FROM w WINDOW o AS (ORDER BY cap / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
f AS (SELECT * FROM r WHERE cap * left_weight > weight * room ORDER BY cap / weight, rank LIMIT 1),
t AS (
  SELECT r.source, r.source_size,
         CASE WHEN r.cap * r.left_weight <= r.weight * r.room THEN CAST(r.cap AS DOUBLE)
              ELSE CAST((SELECT room FROM f) AS DOUBLE) * r.weight / (SELECT left_weight FROM f) END AS target
  FROM r),
p AS (
  SELECT d.*, t.source_size, t.target, CAST(floor(t.target) AS BIGINT) AS budget,
         CAST(sum(size) OVER (PARTITION BY d.source ORDER BY key, doc_id, size ROWS UNBOUNDED PRECEDING) - size AS BIGINT) AS start
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
e AS (SELECT *, CASE WHEN source_size > 0 THEN budget // source_size ELSE 0 END AS epochs FROM p)
SELECT doc_id, source, size, source_size, target,
       CAST(epochs * size + greatest(0, least(size, budget - epochs * source_size - start)) AS BIGINT) AS taken
FROM e
"""

OP4 = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}') AS w
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {near_dup.SHINGLE} THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - {near_dup.SHINGLE} + 2), lambda i: array_to_string(w[i : i + {near_dup.SHINGLE} - 1], ' ')) END) AS x
  FROM d),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (
  SELECT a, b FROM c JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
  WHERE 100 * k >= {near_dup.PERCENT} * (na.n + nb.n - k)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM d
  UNION
  SELECT r.doc_id, e.b FROM reach r JOIN e ON e.a = r.other),
m AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, m.component_id, d.doc_id = m.component_id AS kept
FROM d JOIN m ON m.doc_id = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id
"""


OP2 = rf"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{chat.END}{chat.START}assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '{chat.END}{chat.START}assistant ok'),
e AS (
  SELECT *, regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g') AS body,
         regexp_replace(replace(replace(role, '%', '%25'), chr(10), '%0A'), '<(\\*)\|', '<\\\1|', 'g') AS head
  FROM c),
g AS (
  SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS LAST, role, text) AS told,
         coalesce(string_agg(text, '' ORDER BY turn NULLS LAST, role, text) FILTER (WHERE role = '{chat.ASSISTANT}'), '') AS loss,
         CAST(sum({len(chat.START) + len(chat.END) + 2} + len(head) + len(body)) AS BIGINT) AS formatted_chars,
         string_agg(role, ',' ORDER BY turn NULLS LAST, role, text) AS roles,
         bool_and(role IN ('system', 'user', 'assistant')) AS plain
  FROM e GROUP BY conv_id)
SELECT conv_id, CASE WHEN roles = 'user,assistant' THEN 'prompt' WHEN roles = 'system,user,assistant' THEN 'instruction-system'
                     WHEN plain THEN 'sharegpt' ELSE 'messages' END AS layout,
       n_turns, sha256(told) AS turns_sha256, CAST(len(loss) AS BIGINT) AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars
FROM g
"""


def _op7() -> str:
    """Anchors by corpus frequency, votes by relative position, phrases in place."""
    quoted = ", ".join
    words = quoted(f"({k}, {i}, {_quoted(w)})" for k, t in enumerate(license_scan.TEMPLATES) for i, w in enumerate(t.words))
    labels = quoted(f"({k}, {_quoted(t.label)}, {len(t.words)})" for k, t in enumerate(license_scan.TEMPLATES))
    phrases = quoted(f"({k}, {q}, {i})" for k, t in enumerate(license_scan.TEMPLATES) for q, p in enumerate(t.places) for i in p)
    base = " UNION ALL ".join(
        f"SELECT a.rid, a.i AS start, '{label}' AS label FROM {', '.join(f'h {x}' for x in 'abc'[: len(p)])} WHERE "
        + " AND ".join(f"{x}.w = '{w}'" for x, w in zip("abc", p, strict=False))
        + "".join(f" AND {x}.rid = a.rid AND {x}.i = a.i + {k}" for k, x in enumerate("bc"[: len(p) - 1], start=1))
        for label, p in license_scan.BASE.items()
    )
    return rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{license_scan.WORD}') AS ws
  FROM documents),
p(t, j, w) AS (VALUES {words}),
l(t, label, n) AS (VALUES {labels}),
f(t, q, j) AS (VALUES {phrases}),
u AS (SELECT rid, unnest(ws) AS w, unnest(range(len(ws))) AS i FROM d),
h AS (SELECT * FROM u WHERE w IN (SELECT w FROM p) OR w IN ({quoted(f"'{w}'" for v in license_scan.BASE.values() for w in v)})),
n AS (SELECT w, count(DISTINCT rid) AS n FROM h GROUP BY w),
v AS (SELECT t, w, n, row_number() OVER (PARTITION BY t ORDER BY n, w) AS k FROM (SELECT DISTINCT t, w FROM p) JOIN n USING (w)),
a AS (
  SELECT p.* FROM p JOIN v ON v.t = p.t AND v.w = p.w
  WHERE k <= {license_scan.ANCHORS} OR n <= {license_scan.RARE_SHARE} * (SELECT count(*) FROM d)),
s AS (
  SELECT h.rid, a.t, h.i - a.j AS pos FROM h JOIN a ON a.w = h.w GROUP BY ALL HAVING count(*) >= {license_scan.VOTES}),
m AS (SELECT s.rid, s.t, s.pos, p.j FROM s JOIN p ON p.t = s.t JOIN h ON h.rid = s.rid AND h.i = s.pos + p.j AND h.w = p.w),
fn AS (SELECT t, q, count(*) AS n FROM f GROUP BY t, q),
hit AS (SELECT m.rid, m.t, m.pos, f.q, count(*) AS k FROM m JOIN f ON f.t = m.t AND f.j = m.j GROUP BY ALL),
ok AS (SELECT DISTINCT hit.rid, hit.t, hit.pos FROM hit JOIN fn ON fn.t = hit.t AND fn.q = hit.q AND fn.n = hit.k),
sc AS (SELECT m.rid, m.t, m.pos, count(*) / any_value(l.n) AS score FROM m JOIN ok USING (rid, t, pos) JOIN l ON l.t = m.t GROUP BY ALL),
b AS ({base}),
bb AS (
  SELECT rid, count(*) AS n_base, min(start) AS first_word, max(start) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels
  FROM b GROUP BY rid),
al AS (
  SELECT rid, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
  FROM (SELECT rid, label FROM b UNION SELECT rid, label FROM sc JOIN l USING (t)) GROUP BY rid),
sx AS (SELECT rid, max(score) AS score FROM sc GROUP BY rid)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0) AS score
FROM d LEFT JOIN bb USING (rid) LEFT JOIN al USING (rid) LEFT JOIN sx USING (rid)
"""


OP10 = f"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS rid, vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
u AS (
  SELECT * FROM d WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(v) > 0
    AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(v, lambda x: x <> 0)) > 0),
l AS (
  SELECT a.rid, a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.label = b.label AND a.rid <> b.rid AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= {grid_join.THRESHOLD}),
n AS (SELECT rid, count(*) AS n_links FROM l GROUP BY rid),
reach(vec_id, other) AS (
  SELECT vec_id, vec_id FROM d
  UNION
  SELECT r.vec_id, l.b FROM reach r JOIN l ON l.a = r.other),
m AS (SELECT vec_id, min(other) AS component_id FROM reach GROUP BY vec_id)
SELECT d.vec_id, coalesce(n_links, 0) AS n_links, component_id, d.vec_id = component_id AS kept
FROM d JOIN m ON m.vec_id = d.vec_id LEFT JOIN n ON n.rid = d.rid
"""


def _op6() -> str:
    """Spans by cumulative lengths of the gaps and matches of each rule."""
    parts = []
    for rank, r in enumerate(secret_scan.RULES):
        p = _quoted(r.regex)
        parts.append(
            f"SELECT rid, {rank} AS rank, '{r.kind}' AS kind, {r.least} AS least, string_split_regex(text, {p}) AS g, "
            f"regexp_extract_all(text, {p}) AS m, regexp_extract_all(text, {p}, {r.group}) AS v FROM d WHERE regexp_matches(text, {p})"
        )
    base = [r.kind for r in secret_scan.RULES if r.base]
    counts = ", ".join(f"count(*) FILTER (WHERE kind = '{k}') AS n_{k}" for k in base)
    listed = "string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank)"
    in_base = ", ".join(f"'{k}'" for k in base)
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
x AS ({" UNION ALL ".join(parts)}),
y AS (SELECT rid, rank, kind, least, unnest(range(1, len(m) + 1)) AS i, g, m, v FROM x),
z AS (
  SELECT rid, rank, kind, len(v[i]) AS size, least,
         CAST(list_sum(list_transform(g[1:i], lambda q: len(q))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda q: len(q))), 0) AS BIGINT) AS start,
         len(m[i]) AS n
  FROM y),
s AS (SELECT rid, rank, kind, start, start + n AS stop FROM z WHERE size >= least),
a AS (
  SELECT rid, {counts}, {listed} FILTER (WHERE kind IN ({in_base})) AS base, {listed} AS spans
  FROM s GROUP BY rid)
SELECT d.doc_id, {", ".join(f"coalesce(n_{k}, 0) AS n_{k}" for k in base)},
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN a ON a.rid = d.rid
"""


def _op9() -> str:
    low_high = []
    for r in quality.RULES:
        if r.low is not None:
            low_high.append(f"{r.metric} >= {r.low}")
        if r.high is not None:
            low_high.append(f"{r.metric} <= {r.high}")
    stop = ", ".join(f"'{w}'" for w in sorted(set(quality.STOP_WORDS)))
    ratio = "CASE WHEN {1} > 0 THEN {0} / {1} ELSE 0 END AS {2}".format
    return rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
t AS (SELECT rid, regexp_extract_all(text, '{WORD}') AS w, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM d),
k AS (SELECT rid, w, unnest(range(1, len(w) - 1)) AS i FROM t),
g AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, w[i], w[i + 1], w[i + 2]) AS n FROM k),
q AS (SELECT rid, count(DISTINCT p) AS n_repeat_words FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS p FROM g WHERE n > 1) GROUP BY rid),
c AS (
  SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words,
         CAST(len(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
         CAST(len(regexp_replace(text, '{quality.NOT_SYMBOLS}', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words, CAST(len(l) AS BIGINT) AS n_lines,
         CAST(len(regexp_replace(text, '{quality.NOT_SHOUTS}', '', 'g')) AS BIGINT) AS n_shouts,
         CAST(len(list_filter(w, lambda x: lower(x) IN ({stop}))) AS BIGINT) AS n_stop_words
  FROM d JOIN t USING (rid) LEFT JOIN q USING (rid)),
m AS (
  SELECT *, {ratio("word_chars", "n_words", "mean_word_length")}, {ratio("n_symbols", "n_words", "symbol_ratio")},
         {ratio("n_shouts", "n_words", "shout_ratio")}, {ratio("n_stop_words", "n_words", "stop_word_ratio")},
         {ratio("n_dup_lines", "n_lines", "dup_line_ratio")},
         n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > {quality.MAX_REPEAT_PERCENT} * n_words AS base_failed
  FROM c)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_shouts, n_stop_words, base_failed,
       NOT base_failed AND {" AND ".join(low_high)} AS kept
FROM m
"""


OP11 = rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, coalesce(lang, '{phrases.UNKNOWN}') AS lang,
         string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?
-
]') AS ps
  FROM documents),
p AS (SELECT lang, unnest(list_transform(ps, lambda x: regexp_extract_all(x, '[^ 	]+'))) AS w FROM d),
g AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM p),
s AS (SELECT lang, w[i : i + {phrases.DEPTH - 1}] AS t FROM g),
c AS (SELECT lang, t, unnest(range(1, len(t) + 1)) AS k FROM s),
f AS (SELECT lang, t[1 : k] AS ws, CAST(count(*) AS HUGEINT) AS f FROM c GROUP BY ALL),
n AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM p GROUP BY lang),
a AS (SELECT * FROM f WHERE len(ws) > 1 AND f >= {phrases.LEAST}),
i AS (SELECT lang, ws, f, unnest(range(1, len(ws) + 1)) AS b FROM a WHERE len(ws) > 2),
j AS (SELECT lang, ws, f, b, unnest(range(b + 1, len(ws) + 1)) AS e FROM i),
m AS (SELECT lang, ws[b : e] AS ws, max(f) AS most FROM j WHERE e - b + 1 < len(ws) GROUP BY ALL),
u AS (SELECT a.* FROM a LEFT JOIN m ON m.lang = a.lang AND m.ws = a.ws WHERE NOT coalesce(100 * most >= {phrases.COVERED} * f, false)),
x AS (SELECT lang, ws, f, unnest(range(1, len(ws))) AS k FROM u),
y AS (
  SELECT x.lang, x.ws, x.f, x.k, l.f AS l, r.f AS r, 2000000 * x.f // (l.f + r.f) AS score
  FROM x JOIN f l ON l.lang = x.lang AND l.ws = x.ws[1 : k] JOIN f r ON r.lang = x.lang AND r.ws = x.ws[k + 1 :]),
z AS (SELECT * FROM y QUALIFY row_number() OVER (PARTITION BY lang, ws ORDER BY score, k) = 1)
SELECT z.lang, row_number() OVER (PARTITION BY z.lang ORDER BY score DESC, f DESC, array_to_string(ws, ' ')) AS rank,
       array_to_string(ws, ' ') AS phrase, CAST(f AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, n.n, CAST(score AS BIGINT) AS score
FROM z JOIN n ON n.lang = z.lang QUALIFY rank <= {phrases.TOP}
"""

OP12 = f"""
WITH t AS (SELECT row_number() OVER (ORDER BY doc_id NULLS LAST) AS rid, doc_id, encode(coalesce(text, '')) AS b FROM documents),
w AS (SELECT rid, b, unnest(range(1, octet_length(b) - {repeats.LENGTH} + 2)) AS s FROM t),
r AS (
  SELECT rid, s, row_number() OVER (PARTITION BY b[s : s + {repeats.LENGTH - 1}] ORDER BY rid, s) > 1 AS again FROM w),
g AS (
  SELECT rid, s, coalesce(s > lag(s) OVER (PARTITION BY rid ORDER BY s) + {repeats.LENGTH}, true) AS new FROM r WHERE again),
n AS (SELECT rid, s, sum(CAST(new AS INTEGER)) OVER (PARTITION BY rid ORDER BY s) AS k FROM g),
x AS (SELECT rid, k, min(s) AS a, max(s) + {repeats.LENGTH} AS e FROM n GROUP BY rid, k),
k AS (
  SELECT t.rid, t.b, coalesce(list(x.a ORDER BY x.a) FILTER (WHERE x.a IS NOT NULL), []) AS a, coalesce(list(x.e ORDER BY x.a) FILTER (WHERE x.a IS NOT NULL), []) AS e, t.doc_id
  FROM t LEFT JOIN x ON x.rid = t.rid GROUP BY t.rid, t.b, t.doc_id)
SELECT doc_id, octet_length(b) AS n_bytes, CAST(coalesce(list_sum(list_transform(range(1, len(a) + 1), lambda i: e[i] - a[i])), 0) AS BIGINT) AS n_removed,
       len(a) AS n_spans,
       sha256(unhex(array_to_string(list_transform(range(1, len(a) + 2),
         lambda i: hex(b[coalesce(e[i - 1], 1) : coalesce(a[i], octet_length(b) + 1) - 1])), ''))) AS kept_sha256
FROM k
"""

# The checksum of a decimal number, bit by bit.
CRC32 = """xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: CAST(ord(c) AS BIGINT))),
  lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0],
    lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)), 4294967295)"""

OP13 = f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text,
         sha256(len(coalesce(role, '')) || ':' || coalesce(role, '') || ':' || coalesce(text, '')) AS u
  FROM conversations WHERE conv_id IS NOT NULL),
c AS (
  SELECT conv_id, list({{'u': u, 'n': len(text)}} ORDER BY turn NULLS FIRST, u) AS ts, {CRC32} % {prefix_trie.HEADS} AS h
  FROM t GROUP BY conv_id),
r AS (
  SELECT c.conv_id, list_concat(coalesce(b.ts[1 : c.h], []), c.ts[c.h + 1 :]) AS ts
  FROM c LEFT JOIN c b ON b.conv_id = c.conv_id - c.conv_id % {prefix_trie.GROUP}),
p AS (SELECT conv_id, ts, unnest(range(len(ts) + 1)) AS d FROM r),
n AS (
  SELECT list_transform(ts[1 : d], lambda x: x.u) AS node, CASE WHEN d > 0 THEN list_transform(ts[1 : d - 1], lambda x: x.u) END AS parent,
         d AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, coalesce(max(ts[d].n), 0) AS n,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE len(ts) = d), '')) AS ends_sha256
  FROM p GROUP BY ALL),
k AS (SELECT parent, count(*) AS n_children FROM n WHERE parent IS NOT NULL GROUP BY parent),
m AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN k ON k.parent = n.node),
up AS (SELECT node, unnest(range(depth + 1)) AS d, n_convs, n, n_children FROM m),
s AS (
  SELECT node[1 : d] AS node, CAST(count(*) FILTER (WHERE n_children = 0) AS BIGINT) AS n_leaves, CAST(sum((n_convs - 1) * n) AS BIGINT) AS saved_tokens
  FROM up GROUP BY ALL)
SELECT m.conv_id, m.depth, q.conv_id AS parent_conv_id, m.n_convs, m.n_children, s.n_leaves, s.saved_tokens, m.ends_sha256
FROM m JOIN s ON s.node = m.node LEFT JOIN m q ON q.node = m.parent
"""


ORACLE: dict[str, str] = {
    "op1_mix_sources": OP1,
    "op2_chat_format": OP2,
    "op4_minhash_near_dups": OP4,
    "op6_secret_scan": _op6(),
    "op7_license_scan": _op7(),
    "op9_quality_rules": _op9(),
    "op10_grid_join": OP10,
    "op11_phrase_mining": OP11,
    "op12_remove_repeats": OP12,
    "op13_prefix_trie": OP13,
}
