"""DuckDB SQL of the registered queries that SQL can express."""
from __future__ import annotations

from metroscope.llm import epsilon_grid, licenses, redirects, resampling, thresholds
from metroscope.llm.common import ALNUM_WORD, LOWER_ASCII, SPACE_WORD, UPPER_ASCII

_LOWER = f"'{UPPER_ASCII}', '{LOWER_ASCII}'"

# --- op2: recursion over link edges ----------------------------------------------------
_RULES = ", ".join(f"('{r.verdict}', '{r.text}', '{r.host}', '{r.path}')" for r in redirects.RULES)


def _plain(url: str) -> str:
    host = f"translate(regexp_extract({url}, '(?s)^.*?://([^/?#]*)', 1), {_LOWER})"
    path = f"regexp_extract({url}, '(?s)^.*?://[^/?#]*([^?#]*)', 1)"
    query = f"regexp_extract({url}, '(?s)^[^?#]*\\?([^#]*)', 1)"
    kept = (f"list_sort(list_filter(string_split({query}, '&'), lambda q: q <> '' "
            f"AND NOT regexp_matches(q, '^{redirects.TRACKING}(?:=|$)')))")
    return (f"CASE WHEN contains({url}, '://') THEN regexp_replace({host}, '^(?:www|m)\\.', '') || "
            f"regexp_replace(regexp_replace({path}, '/index\\.(?:html?|php)$', '/'), '/+$', '') || "
            f"CASE WHEN len({kept}) > 0 THEN '?' || array_to_string({kept}, '&') ELSE '' END END")


_REF = "(?i)&(?:amp|lt|gt|quot|apos|#x[0-9a-f]{1,6}|#[0-9]{1,7});"
_CODE = ("(CASE WHEN regexp_matches(r, '^&#[xX]') THEN CAST('0x' || regexp_extract(r, '[xX]([^;]+)', 1) AS BIGINT) "
         "ELSE TRY_CAST(regexp_extract(r, '&#([0-9]+)', 1) AS BIGINT) END)")
_CHAR = ("CASE lower(r) WHEN '&amp;' THEN '&' WHEN '&lt;' THEN '<' WHEN '&gt;' THEN '>' WHEN '&quot;' THEN '\"' WHEN '&apos;' THEN chr(39) "
         f"ELSE CASE WHEN {_CODE} BETWEEN 1 AND 55295 OR {_CODE} BETWEEN 57344 AND 1114111 THEN chr(CAST({_CODE} AS INTEGER)) ELSE r END END")
_HREF = "(?i)\\bhref\\s*=\\s*(?:[\"'']([^\"''>]+)|([^\"''>\\s]+))"

OP2 = f"""
WITH RECURSIVE rules(verdict, text, host, path) AS (VALUES {_RULES}),
p AS (SELECT page_id, url, coalesce(html, '') AS html,
        coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), {_LOWER}), '') AS host,
        coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path, {_plain('url')} AS node FROM pages),
best AS (SELECT p.*,
        (SELECT r.text FROM rules r WHERE (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)
         ORDER BY length(r.text) DESC, r.text LIMIT 1) AS rule FROM p),
tags AS (SELECT node, url, path, unnest(list_concat(
        list_transform(list_filter(regexp_extract_all(html, '(?is)<link\\b[^>]*>'),
                       lambda t: regexp_matches(t, '(?i)\\brel\\s*=\\s*["'']?canonical\\b')),
                       lambda t: regexp_extract(t, '{_HREF}', 1) || regexp_extract(t, '{_HREF}', 2)),
        list_transform(list_filter(regexp_extract_all(html, '(?is)<meta\\b[^>]*>'),
                       lambda t: regexp_matches(t, '(?i)http-equiv\\s*=\\s*["'']?refresh\\b')),
                       lambda t: regexp_extract(t, '(?i)url\\s*=\\s*["'']?([^"''> ]+)', 1)))) AS raw FROM best WHERE node IS NOT NULL),
pieces AS (SELECT *, regexp_split_to_array(raw, '{_REF}') AS texts, list_transform(regexp_extract_all(raw, '{_REF}'), lambda r: {_CHAR}) AS refs FROM tags),
decoded AS (SELECT node, regexp_extract(url, '(?s)^(.*?://[^/?#]*)', 1) AS origin, path AS page_path, regexp_extract(path, '(?s)^(.*)/', 1) || '/' AS folder,
        regexp_replace(array_to_string(list_transform(range(1, len(texts) + 1), lambda i: texts[i] || coalesce(refs[i], '')), ''),
                       '^[\\x00-\\x20]+|[\\x00-\\x20]+$', '', 'g') AS t FROM pieces),
parts AS (SELECT *, CASE WHEN starts_with(t, '/') THEN '' ELSE folder END || regexp_extract(t, '(?s)^([^?#]*)', 1) AS way,
        regexp_extract(t, '(?s)^[^?#]*(.*)$', 1) AS rest FROM decoded),
walked AS (SELECT *, CASE WHEN regexp_matches(way, '/\\.\\.?(?:/|$)') THEN array_to_string(list_reduce(
        list_concat([CAST([] AS VARCHAR[])], list_transform(string_split(way, '/'), lambda x: [x])),
        lambda done, x: CASE WHEN x[1] = '.' THEN done WHEN x[1] = '..' THEN done[1:greatest(len(done) - 1, 1)] ELSE list_concat(done, x) END), '/')
        ELSE way END AS steps FROM parts),
targets AS (SELECT node, CASE WHEN t = '' THEN NULL WHEN regexp_matches(t, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN t WHEN starts_with(t, '//') THEN 'http:' || t
        WHEN regexp_matches(t, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN NULL WHEN regexp_matches(t, '^[?#]') THEN origin || page_path || t
        ELSE origin || steps || rest END AS target FROM walked),
links AS (SELECT DISTINCT node AS a, {_plain('target')} AS b,
        translate(regexp_extract(target, '(?s)^.*?://([^/?#]*)', 1), {_LOWER}) AS host, regexp_extract(target, '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
        FROM targets WHERE contains(target, '://')),
ruled AS (SELECT DISTINCT b AS node, (SELECT r.verdict FROM rules r WHERE (l.host = r.host OR ends_with(l.host, '.' || r.host)) AND starts_with(l.path, r.path)
         ORDER BY length(r.text) DESC, r.text LIMIT 1) AS verdict FROM links l),
edges AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach(node, other) AS (SELECT DISTINCT node, node FROM best WHERE node IS NOT NULL
        UNION SELECT r.node, e.b FROM reach r JOIN edges e ON r.other = e.a),
decided AS (SELECT b.node, r.verdict FROM best b JOIN rules r ON b.rule = r.text
        UNION ALL SELECT node, verdict FROM ruled WHERE verdict IS NOT NULL),
grouped AS (SELECT reach.node, bool_or(d.verdict = 'allow') AS a, bool_or(d.verdict = 'block') AS b
        FROM reach JOIN decided d ON d.node = reach.other GROUP BY reach.node)
SELECT best.page_id, best.host, best.path, best.rule,
       coalesce((SELECT verdict FROM rules r WHERE r.text = best.rule),
                CASE WHEN g.a THEN 'allow' WHEN g.b THEN 'block' ELSE 'allow' END) AS verdict
FROM best LEFT JOIN grouped g ON g.node = best.node
"""

# --- op3: counts in value bins, the first wide gap beyond the quartiles --------------------
_RATES = ("repeat_rate", "symbol_rate", "dup_line_rate", "mean_word")
_LIN, _LOG = thresholds.LINEAR, thresholds.LOG


def _low(b: str) -> str:
    return f"(CASE WHEN {b} <= 1 THEN 0.0 WHEN {b} <= {_LIN} THEN ({b} - 1) / {_LIN} ELSE exp(({b} - {_LIN + 1}) / {_LOG}) END)"


def _high(b: str) -> str:
    return f"(CASE WHEN {b} <= 0 THEN 0.0 WHEN {b} <= {_LIN} THEN {b} / {_LIN} ELSE exp(({b} - {_LIN}) / {_LOG}) END)"


_BINS = " UNION ALL ".join(
    f"SELECT lang, source, '{r}' AS rate, n_words, CAST(CASE WHEN {r} <= 0 THEN 0 WHEN {r} < 1 THEN floor({r} * {_LIN}) + 1 "
    f"ELSE {_LIN + 1} + floor(ln({r}) * {_LOG}) END AS INTEGER) AS bin FROM ok" for r in _RATES)
_NAMES = [f"{r}_max" for r in thresholds.ABOVE] + [f"{r}_min" for r in thresholds.BELOW]


def _limits(keys: str) -> str:
    """Thresholds per ``keys`` from the bins merged to that level."""
    by = f"{keys}, rate" if keys else "rate"
    quantiles = ", ".join(f"min(CASE WHEN upto * 100 >= total * {p} THEN bin END) OVER g AS q{p}" for p in (25, 50, 75))
    middle = f"(({_low('q50')} + {_high('q50')}) / 2)"
    room = lambda far: f"(greatest({far}, 0.0) + one_word) * {thresholds.GAP}"
    above = f"bin >= q75 AND {_low('nxt')} - {_high('bin')} >= {room(_high('bin') + ' - ' + middle)}"
    below = f"bin <= q25 AND {_low('bin')} - {_high('bef')} >= {room(middle + ' - ' + _low('bin'))}"
    columns = ", ".join([f"min(CASE WHEN rate = '{r}' AND {above} THEN ({_high('bin')} + {_low('nxt')}) / 2 END) AS {r}_max" for r in thresholds.ABOVE]
                        + [f"max(CASE WHEN rate = '{r}' AND {below} THEN ({_low('bin')} + {_high('bef')}) / 2 END) AS {r}_min" for r in thresholds.BELOW])
    return f"""SELECT {keys + ',' if keys else ''} max(total) AS docs, {columns} FROM (SELECT *, {quantiles} FROM (
  SELECT *, sum(n) OVER (g ORDER BY bin ROWS UNBOUNDED PRECEDING) AS upto, sum(n) OVER g AS total, sum(n) OVER g / sum(words) OVER g AS one_word,
   lead(bin) OVER (g ORDER BY bin) AS nxt, lag(bin) OVER (g ORDER BY bin) AS bef
  FROM (SELECT {by}, bin, count(*) AS n, sum(n_words) AS words FROM bins GROUP BY {by}, bin) WINDOW g AS (PARTITION BY {by}))
 WINDOW g AS (PARTITION BY {by})) {'GROUP BY ' + keys if keys else ''}"""


_PICKED = ", ".join(f"CASE WHEN g.docs >= {thresholds.MIN_GROUP} THEN g.{c} WHEN l.docs >= {thresholds.MIN_GROUP} THEN l.{c} "
                    f"ELSE o.{c} END AS {c}" for c in _NAMES)
_INSIDE = " AND ".join([f"coalesce({r} <= {r}_max, true)" for r in thresholds.ABOVE] + [f"coalesce({r} >= {r}_min, true)" for r in thresholds.BELOW])

OP3 = f"""
WITH d AS (SELECT doc_id, lang, source, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{SPACE_WORD}') AS w FROM documents),
grams AS (SELECT doc_id, unnest(range(0, len(w) - 2)) AS p, w FROM d WHERE len(w) >= 3),
keyed AS (SELECT doc_id, p, struct_pack(a := w[p + 1], b := w[p + 2], c := w[p + 3]) AS g FROM grams),
often AS (SELECT doc_id, p FROM keyed QUALIFY count(*) OVER (PARTITION BY doc_id, g) >= 2),
rep AS (SELECT doc_id, count(DISTINCT x) AS n FROM (SELECT doc_id, unnest(range(p, p + 3)) AS x FROM often) GROUP BY doc_id),
m AS (SELECT d.doc_id, d.lang, d.source, CAST(len(w) AS BIGINT) AS n_words,
        CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
        CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
        CAST(len(list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '{SPACE_WORD}')))
             - len(list_distinct(list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '{SPACE_WORD}')))) AS BIGINT) AS n_dup_lines,
        CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words FROM d LEFT JOIN rep ON rep.doc_id = d.doc_id),
r AS (SELECT *, n_words < {thresholds.MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words AS base_failed,
        CASE WHEN n_words > 0 THEN n_repeat_words / n_words ELSE 0 END AS repeat_rate,
        CASE WHEN n_words > 0 THEN n_symbols / n_words ELSE 0 END AS symbol_rate,
        CASE WHEN n_words > 0 THEN n_dup_lines / n_words ELSE 0 END AS dup_line_rate,
        CASE WHEN n_words > 0 THEN word_chars / n_words ELSE 0 END AS mean_word FROM m),
ok AS (SELECT * FROM r WHERE NOT base_failed),
bins AS ({_BINS}),
g AS ({_limits('lang, source')}),
l AS ({_limits('lang')}),
o AS ({_limits('')}),
lim AS (SELECT g.lang, g.source, {_PICKED} FROM g JOIN l ON l.lang IS NOT DISTINCT FROM g.lang CROSS JOIN o)
SELECT r.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND {_INSIDE} AS kept
FROM r LEFT JOIN lim ON lim.lang IS NOT DISTINCT FROM r.lang AND lim.source IS NOT DISTINCT FROM r.source
"""

# --- op5: all windows of all texts -----------------------------------------------------
_WORDS = f"regexp_extract_all(translate(coalesce(text, ''), {_LOWER}), '{ALNUM_WORD}')"

OP5 = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
i AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
iw AS (SELECT item_id, w, least(13, len(w)) AS n, unnest(range(0, len(w) - least(13, len(w)) + 1)) AS p FROM i WHERE len(w) > 0),
windows AS (SELECT DISTINCT item_id, n, array_to_string(w[p + 1:p + n], ' ') AS t FROM iw),
sizes AS (SELECT DISTINCT n FROM windows),
dp AS (SELECT doc_id, w, n, unnest(range(0, len(w) - n + 1)) AS p FROM d, sizes WHERE len(w) >= n),
hit AS (SELECT dp.doc_id, dp.p, dp.n, item_id FROM dp JOIN windows x ON x.n = dp.n AND x.t = array_to_string(dp.w[p + 1:p + dp.n], ' ')),
words AS (SELECT doc_id, count(DISTINCT x) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + n)) AS x FROM hit) GROUP BY doc_id),
items AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
        FROM hit GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN words ON words.doc_id = d.doc_id LEFT JOIN items ON items.doc_id = d.doc_id
"""

# --- op6: phrases by word place, templates by diagonal ------------------------------------
_TEMPLATES = ", ".join(f"({i}, '{label}', '{text}')" for i, (label, text) in enumerate(licenses.TEMPLATES))
_PHRASES = " UNION ALL ".join(
    f"SELECT doc_id, p, '{label}' AS label FROM places WHERE w[p + 1:p + {len(ph.split())}] = {ph.split()!r}"
    for ph, label in licenses.PHRASES.items())

OP6 = f"""
WITH tmpl(id, label, text) AS (VALUES {_TEMPLATES}),
tw AS (SELECT id, label, {_WORDS} AS w FROM tmpl),
tp AS (SELECT id, label, w, len(w) AS n, unnest(range(0, len(w) - 2)) AS t FROM tw),
tg AS (SELECT id, label, n, t, w[t + 1] AS a, w[t + 2] AS b, w[t + 3] AS c FROM tp),
d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
places AS (SELECT doc_id, w, unnest(range(0, len(w))) AS p FROM d WHERE len(w) > 0),
hit AS (SELECT doc_id, id, label, n, p, t FROM places JOIN tg ON w[p + 1] = a AND w[p + 2] = b AND w[p + 3] = c),
diagonal AS (SELECT doc_id, id, label, n, p - t AS dg, min(p) AS lo, max(p) + 3 AS hi FROM hit GROUP BY doc_id, id, label, n, p - t),
marked AS (SELECT *, CASE WHEN abs(dg - lag(dg) OVER o) <= {licenses.MAX_SHIFT}
        AND lo - max(hi) OVER (PARTITION BY doc_id, id ORDER BY lo, dg ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) <= {licenses.MAX_GAP}
        THEN 0 ELSE 1 END AS apart FROM diagonal WINDOW o AS (PARTITION BY doc_id, id ORDER BY lo, dg)),
runs AS (SELECT *, sum(apart) OVER (PARTITION BY doc_id, id ORDER BY lo, dg) AS run FROM marked),
covered AS (SELECT r.doc_id, r.label, r.n, r.id, r.run, count(DISTINCT h.x) / r.n AS share
        FROM runs r JOIN (SELECT doc_id, id, p - t AS dg, unnest([t, t + 1, t + 2]) AS x FROM hit) h
          ON h.doc_id = r.doc_id AND h.id = r.id AND h.dg = r.dg
        GROUP BY r.doc_id, r.label, r.n, r.id, r.run),
best AS (SELECT doc_id, max(least(share, 1.0)) AS score, list(label) FILTER (share >= {licenses.COVERAGE}) AS found FROM covered GROUP BY doc_id),
phrases AS ({_PHRASES}),
base AS (SELECT doc_id, count(*) AS n, min(p) AS lo, max(p) AS hi, list(label) AS labels FROM phrases GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(base.n, 0) AS BIGINT) AS n_base, CAST(lo AS BIGINT) AS first_word,
       CAST(hi AS BIGINT) AS last_word, array_to_string(list_sort(list_distinct(coalesce(base.labels, []))), ',') AS base_labels,
       array_to_string(list_sort(list_distinct(list_concat(coalesce(base.labels, []), coalesce(found, [])))), ',') AS labels,
       CAST(coalesce(score, 0.0) AS DOUBLE) AS score
FROM d LEFT JOIN base ON base.doc_id = d.doc_id LEFT JOIN best ON best.doc_id = d.doc_id
"""

# --- op8: the read-back output equals the input; lengths follow from the template ----------
_CONTROL = r"(\\|\[/INST\]|\[/ROLE\]|\[INST\]|\[ROLE\]|</s>|<s>)"


def _escaped(c: str) -> str:
    return f"length(regexp_replace({c}, '{_CONTROL}', '\\\\\\1', 'g'))"


OP8 = f"""
WITH c AS (SELECT conv_id, turn, role, text FROM conversations
        UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text, role AS r, text AS x FROM c)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, r NULLS FIRST, x NULLS FIRST)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, r NULLS FIRST, x NULLS FIRST) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum({_escaped('text')} + CASE WHEN role = 'user' THEN 18 WHEN role = 'assistant' THEN 7
                ELSE 20 + {_escaped('role')} END) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id
"""

# --- op11: crc32 by its own table, once per distinct word --------------------------------
_CRC_STEP = "CASE WHEN c % 2 = 1 THEN xor(3988292384, c // 2) ELSE c // 2 END"

OP11 = f"""
WITH one AS (SELECT i, list_reduce(list_concat([i], [0, 0, 0, 0, 0, 0, 0, 0]), lambda c, k: {_CRC_STEP}) AS v FROM range(256) r(i)),
crc AS (SELECT list(v ORDER BY i) AS t FROM one),
d AS (SELECT row_number() OVER () AS row, doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT {_WORDS} AS w FROM benchmark),
dw AS (SELECT row, word, count(*) AS n FROM (SELECT row, unnest(w) AS word FROM d) GROUP BY row, word),
bw AS (SELECT word, count(*) AS n FROM (SELECT unnest(w) AS word FROM b) GROUP BY word),
words AS (SELECT word, hex(word) AS x FROM (SELECT word FROM dw UNION SELECT word FROM bw)),
bytes AS (SELECT word, list_transform(range(1, length(x), 2), lambda i:
        CAST(16 * (instr('0123456789ABCDEF', substr(x, i, 1)) - 1) + instr('0123456789ABCDEF', substr(x, i + 1, 1)) - 1 AS BIGINT)) AS l FROM words),
bucket AS (SELECT word, xor(list_reduce(list_concat([4294967295], l), lambda c, y: xor(c // 256, t[xor(c, y) % 256 + 1])), 4294967295)
        % {resampling.BUCKETS} AS k FROM bytes, crc),
s AS (SELECT k, sum(n) AS n FROM dw JOIN bucket USING (word) GROUP BY k),
t AS (SELECT k, sum(n) AS n FROM bw JOIN bucket USING (word) GROUP BY k),
gain AS (SELECT s.k, CAST(floor(1000 * ln((CAST(coalesce(t.n, 0) AS DOUBLE) + 1) * ((SELECT CAST(sum(n) AS DOUBLE) FROM s) + {resampling.BUCKETS})
        / ((CAST(s.n AS DOUBLE) + 1) * (coalesce((SELECT CAST(sum(n) AS DOUBLE) FROM t), 0) + {resampling.BUCKETS})))) AS BIGINT) AS g
        FROM s LEFT JOIN t ON s.k = t.k),
weights AS (SELECT row, CAST(sum(dw.n * g) AS BIGINT) AS weight FROM dw JOIN bucket USING (word) JOIN gain USING (k) GROUP BY row),
h AS (SELECT row, doc_id, CAST(len(w) AS BIGINT) AS n_features, CAST(coalesce(weight, 0) AS BIGINT) AS weight,
        list_reduce(list_concat([0], list_transform(range(1, 9), lambda i: CAST(instr('0123456789abcdef',
        substr(sha256('{resampling.SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')), i, 1)) - 1 AS BIGINT))), lambda a, y: 16 * a + y) AS h
        FROM d LEFT JOIN weights USING (row)),
scored AS (SELECT *, weight + CAST(floor(-1000 * ln(-ln((CAST(h AS DOUBLE) + 0.5) / CAST(4294967296 AS DOUBLE)))) AS BIGINT) AS score FROM h),
placed AS (SELECT row, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST, weight DESC, n_features) AS place FROM scored
        WHERE n_features >= {resampling.MIN_WORDS})
SELECT doc_id, n_features, weight, score,
       CASE WHEN place <= {resampling.PERCENT} * (SELECT count(*) FROM placed) // 100 THEN place END AS rank
FROM scored LEFT JOIN placed USING (row)
"""

# --- op12: all pairs ---------------------------------------------------------------------
OP12 = f"""
WITH RECURSIVE e AS (SELECT row_number() OVER () AS row, vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
good AS (SELECT * FROM e WHERE v IS NOT NULL AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        AND len(list_filter(v, lambda x: x <> 0)) > 0),
dim AS (SELECT len(v) AS n FROM good GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1),
u AS (SELECT row, vec_id, v, sqrt(list_sum(list_transform(v, lambda x: x * x))) AS norm FROM good WHERE len(v) = (SELECT n FROM dim)),
links AS (SELECT a.row AS a, b.row AS b FROM u a JOIN u b ON a.row <> b.row
        WHERE list_dot_product(a.v, b.v) / (a.norm * b.norm) >= {epsilon_grid.MIN_COSINE}),
reach(row, other) AS (SELECT row, row FROM e UNION SELECT r.row, l.b FROM reach r JOIN links l ON r.other = l.a),
comp AS (SELECT reach.row, min(o.vec_id) AS component_id FROM reach JOIN e o ON o.row = reach.other GROUP BY reach.row),
n AS (SELECT a AS row, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_links, component_id, e.vec_id IS NOT DISTINCT FROM component_id AS kept
FROM e JOIN comp USING (row) LEFT JOIN n USING (row)
"""

ORACLE: dict[str, str] = {
    "op2_redirects": OP2,
    "op3_adaptive_rules": OP3,
    "op5_winnowing": OP5,
    "op6_licenses": OP6,
    "op8_chat_template": OP8,
    "op11_resampling": OP11,
    "op12_epsilon_grid": OP12,
}
