"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from rankloom.llm.common import LOWER, SPACE, UPPER
from rankloom.llm.decontaminate import WINDOW
from rankloom.llm.jaccard import N, PERCENT
from rankloom.llm.quality import ALPHA, DELTA, GRID, MAX_REPEAT_PERCENT, MIN_WORDS, SYMBOLS
from rankloom.llm.substrings import LENGTH
from rankloom.llm.trie import GROUP, HEADS
from rankloom.llm.urls import CONFIDENCE, LEAST_PAGES, RULES, SUPPORT

_TEXT = "coalesce(text, '')"
_LOWER = f"translate({_TEXT}, '{UPPER}', '{LOWER}')"

SUBSTRINGS = f"""
WITH t AS (SELECT doc_id, strlen({_TEXT}) AS n, hex(encode({_TEXT})) AS h FROM documents),
w AS (SELECT doc_id, s, md5(substr(h, 2 * s + 1, {2 * LENGTH})) AS k
      FROM (SELECT doc_id, h, unnest(range(0, n - {LENGTH - 1})) AS s FROM t)),
f AS (SELECT doc_id, s, min({{'d': doc_id, 's': s}}) OVER (PARTITION BY k) AS first FROM w),
c AS (SELECT doc_id, s, s - lag(s) OVER (PARTITION BY doc_id ORDER BY s) AS gap
      FROM f WHERE first != {{'d': doc_id, 's': s}}),
i AS (SELECT doc_id, s, sum(CASE WHEN gap <= {LENGTH} THEN 0 ELSE 1 END)
             OVER (PARTITION BY doc_id ORDER BY s) AS island FROM c),
r AS (SELECT doc_id, island, min(s) AS a, max(s) + {LENGTH} AS b FROM i GROUP BY ALL),
g AS (SELECT doc_id, a, b, lag(b, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS before FROM r),
k AS (SELECT doc_id, sum(b - a) AS gone, count(*) AS spans, max(b) AS last,
             string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS kept
      FROM g JOIN t USING (doc_id) GROUP BY doc_id)
SELECT doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(coalesce(gone, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(spans, 0) AS BIGINT) AS n_spans,
       sha256(unhex(coalesce(kept, '') || substr(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM t LEFT JOIN k USING (doc_id)"""

JACCARD = f"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^{SPACE}]+') AS ws
                     FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(
        CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < {N} THEN [array_to_string(ws, ' ')]
             ELSE [array_to_string(ws[i:i + {N - 1}], ' ') for i in range(1, len(ws) - {N - 2})]
        END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c
      FROM s x JOIN s y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
      WHERE 100 * c >= {PERCENT} * (x.n + y.n - c)),
l AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
r AS (SELECT doc_id, doc_id AS c FROM documents
      UNION SELECT l.b, r.c FROM r JOIN l ON r.doc_id = l.a)
SELECT r.doc_id, CAST(coalesce(any_value(n.n), 0) AS BIGINT) AS n_shingles,
       min(c) AS component_id
FROM r LEFT JOIN n ON n.doc_id = r.doc_id GROUP BY r.doc_id"""

_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
DECONTAMINATION = f"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '{_WORD}') AS ws FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all({_LOWER}, '{_WORD}') AS ws
      FROM benchmark),
p AS (SELECT DISTINCT item, size, array_to_string(ws[i:i + size - 1], ' ') AS g
      FROM (SELECT item, ws, least(len(ws), {WINDOW}) AS size,
                   unnest(range(1, greatest(len(ws) - {WINDOW} + 1, 1) + 1)) AS i
            FROM b WHERE len(ws) > 0)),
z AS (SELECT DISTINCT size FROM p),
x AS (SELECT doc_id, i, size, array_to_string(ws[i:i + size - 1], ' ') AS g
      FROM (SELECT doc_id, ws, size, unnest(range(1, len(ws) - size + 2)) AS i FROM d, z)),
h AS (SELECT x.doc_id, x.i, x.size, p.item FROM x JOIN p ON x.g = p.g AND x.size = p.size),
c AS (SELECT doc_id, count(DISTINCT pos) AS n_hit
      FROM (SELECT doc_id, unnest(range(i, i + size)) AS pos FROM h) GROUP BY doc_id),
m AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
      FROM (SELECT DISTINCT doc_id, item FROM h) GROUP BY doc_id)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c USING (doc_id) LEFT JOIN m USING (doc_id)"""

_TESTS = [(rule, k, c) for rule, cs in GRID.items() for k, c in enumerate(cs)]
_TAIL = (f"CASE WHEN r < n * {ALPHA} THEN list_sum([exp(lgamma(n + 1) - lgamma(k + 1)"
         f" - lgamma(n - k + 1) + k * ln({ALPHA}) + (n - k) * ln(1 - {ALPHA}))"
         f" for k in range(0, r + 1)]) ELSE 1 END")
QUALITY = f"""
WITH w AS (SELECT doc_id, lang, {_TEXT} AS text,
                  regexp_extract_all({_TEXT}, '[^{SPACE}]+') AS ws,
                  list_filter(string_split({_TEXT}, chr(10)),
                              lambda x: regexp_matches(x, '[^{SPACE}]')) AS ls FROM documents),
g AS (SELECT doc_id, i, array_to_string(ws[i:i + 4], ' ') AS g
      FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 3)) AS i FROM w)),
v AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM g),
q AS (SELECT doc_id, count(DISTINCT pos) AS n
      FROM (SELECT doc_id, unnest(range(i, i + 5)) AS pos FROM v WHERE c > 1) GROUP BY doc_id),
b AS (SELECT doc_id, lang, CAST(len(ws) AS BIGINT) AS n_words,
             CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
             CAST(length(text) - length(regexp_replace(text, '[{SYMBOLS}]', '', 'g')) AS BIGINT)
               AS n_symbols,
             CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
             CAST(coalesce(q.n, 0) AS BIGINT) AS n_repeat_words, len(ls) AS n_lines
      FROM w LEFT JOIN q USING (doc_id)),
f AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words
               AS base_failed,
             n_symbols / greatest(word_chars, 1) AS symbol_share,
             n_dup_lines / greatest(n_lines, 1) AS dup_line_share,
             n_repeat_words / greatest(n_words, 1) AS repeat_share,
             word_chars / greatest(n_words, 1) AS word_length,
             1.0 / greatest(n_words, 1) AS shortness FROM b),
good AS (SELECT f.* FROM f JOIN labels USING (doc_id)
         WHERE NOT base_failed AND quality = 1 AND coalesce(toxic, 0) = 0),
t AS (SELECT * FROM (VALUES {', '.join(f"('{r}', {k}, {c})" for r, k, c in _TESTS)})
      AS t(rule, k, cut)),
o AS (SELECT lang, rule, k, cut, count(*) AS n, count(*) FILTER (CASE rule
        {' '.join(f"WHEN '{r}' THEN {r}" for r in GRID)} END > cut) AS r
      FROM good, t GROUP BY ALL),
s AS (SELECT count(DISTINCT coalesce(lang, '')) AS strata FROM good),
u AS (SELECT lang, rule, arg_min(cut, k) AS cut FROM o, s
      WHERE {_TAIL} <= {DELTA} / (greatest(strata, 1) * {len(_TESTS)}) GROUP BY ALL),
x AS (SELECT DISTINCT doc_id FROM f JOIN u ON f.lang IS NOT DISTINCT FROM u.lang
      WHERE CASE rule {' '.join(f"WHEN '{r}' THEN {r}" for r in GRID)} END > cut)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND x.doc_id IS NULL AS kept
FROM f LEFT JOIN x USING (doc_id)"""

def _lower(text: str) -> str:
    return f"translate({text}, '{UPPER}', '{LOWER}')"


def _listed(column: int) -> str:
    longest = sorted(RULES, key=lambda r: (len(r[0] + r[1]), r), reverse=True)
    return "CASE " + " ".join(
        f"WHEN (host = '{h}' OR host LIKE '%.{h}') AND starts_with(path, '{p}') THEN '{(h + p, v)[column]}'"
        for h, p, v in longest) + " END"


# Every set of tokens of every labelled page is counted; only small tables allow that.
URLS = f"""
WITH r AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3)
                           ELSE '' END AS rest FROM pages),
u AS (SELECT page_id, {_lower("regexp_extract(rest, '^([^/?#]*)', 1)")} AS host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path,
             regexp_extract(rest, '^[^?#]*[?]([^#]*)', 1) AS query FROM r),
p AS (SELECT page_id, host, path, {_listed(0)} AS rule, {_listed(1)} AS listed,
             list_sort(list_distinct(
               [{_lower("'h:' || x")} FOR x IN string_split(host, '.') IF x != '']
               || [{_lower("'p:' || x")} FOR x IN regexp_split_to_array(path, '[/.]') IF x != '']
               || [{_lower("'q:' || string_split(x, '=')[1]")} FOR x IN string_split(query, '&')
                   IF string_split(x, '=')[1] != ''])) AS ts FROM u),
b AS (SELECT doc_id, max(CASE WHEN quality = 0 OR coalesce(toxic, 0) = 1 THEN 1 ELSE 0 END) AS bad
      FROM labels WHERE quality IN (0, 1) OR toxic = 1 GROUP BY doc_id),
t AS (SELECT ts, bad FROM p JOIN b ON page_id = doc_id),
n AS (SELECT greatest({LEAST_PAGES}, ceil({SUPPORT} * count(*))) AS least FROM t),
z AS (SELECT list_filter(ts, lambda x, i: (m >> (i - 1)) & 1 = 1) AS body, bad
      FROM (SELECT ts, bad, unnest(range(1, CAST(1 AS BIGINT) << len(ts))) AS m FROM t)),
c AS (SELECT body, count(*) AS n, sum(bad) AS block FROM z GROUP BY body),
k AS (SELECT body, CAST(s AS BIGINT) AS support, s / n AS confidence, block
      FROM (SELECT body, n, block AS s, true AS block FROM c
            UNION ALL SELECT body, n, n - block, false FROM c), n
      WHERE s >= least AND s / n >= {CONFIDENCE}),
m AS (SELECT page_id, max({{'confidence': confidence, 'support': support, 'block': block}}) AS best
      FROM p JOIN k ON list_has_all(ts, body) WHERE rule IS NULL GROUP BY page_id)
SELECT p.page_id, host, path, rule, best.confidence AS confidence,
       coalesce(best.support, 0) AS support,
       coalesce(listed, CASE WHEN best.block THEN 'block' ELSE 'allow' END) AS verdict
FROM p LEFT JOIN m ON p.page_id = m.page_id"""

# CRC-32 of the decimal id: eight shifts for each of its characters.
_CRC = ("xor(list_reduce([4294967295::BIGINT] || [ascii(x)::BIGINT FOR x IN "
        "string_split(CAST(conv_id AS VARCHAR), '')], lambda crc, x: list_reduce("
        "[xor(crc, x)] || [0::BIGINT FOR i IN range(8)], lambda y, i: "
        "CASE WHEN y & 1 = 1 THEN xor(y >> 1, 3988292384) ELSE y >> 1 END)), 4294967295)")
TRIE = f"""
WITH o AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (
             PARTITION BY conv_id ORDER BY turn NULLS FIRST) - 1 AS p
           FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, conv_id - conv_id % {GROUP} AS base, {_CRC} % {HEADS} AS h
      FROM (SELECT DISTINCT conv_id FROM o)),
r AS (SELECT c.conv_id, 0 AS part, o.p, o.role, o.text FROM c JOIN o ON o.conv_id = base AND o.p < h
      UNION ALL SELECT c.conv_id, 1, o.p, o.role, o.text FROM c JOIN o USING (conv_id) WHERE o.p >= h),
t AS (SELECT conv_id, text, row_number() OVER w AS d,
             md5(string_agg(length(role) || ':' || role || length(text) || ':' || text, '') OVER w) AS k
      FROM r WINDOW w AS (PARTITION BY conv_id ORDER BY part, p ROWS UNBOUNDED PRECEDING)),
a AS (SELECT conv_id, d, k, coalesce(lag(k) OVER (PARTITION BY conv_id ORDER BY d), '') AS parent,
             len(regexp_extract_all(text, '[^{SPACE}]+')) AS words FROM t
      UNION ALL SELECT conv_id, 0, '', NULL, 0 FROM c),
l AS (SELECT conv_id, max(d) AS d FROM a GROUP BY conv_id),
n AS (SELECT d, k, min(conv_id) AS owner, count(*) AS n, any_value(parent) AS parent,
             any_value(words) AS words FROM a GROUP BY d, k),
e AS (SELECT d, k, string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) AS ids
      FROM a JOIN l USING (conv_id, d) GROUP BY d, k),
x AS (SELECT d, parent AS k, count(*) AS children FROM (SELECT d - 1 AS d, parent FROM n WHERE d > 0)
      GROUP BY ALL),
s AS (SELECT up.d, up.k, sum((n.n - 1) * n.words) AS saved,
             count(*) FILTER (x.children IS NULL) AS leaves
      FROM n JOIN a low ON low.conv_id = n.owner AND low.d <= n.d JOIN n up ON up.d = low.d AND up.k = low.k
      LEFT JOIN x ON x.d = n.d AND x.k = n.k GROUP BY up.d, up.k)
SELECT n.owner AS conv_id, CAST(n.d AS BIGINT) AS depth, p.owner AS parent_conv_id, n.n AS n_convs,
       coalesce(x.children, 0) AS n_children, leaves AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens,
       sha256(coalesce(ids, '')) AS ends_sha256
FROM n JOIN s ON s.d = n.d AND s.k = n.k LEFT JOIN n p ON p.d = n.d - 1 AND p.k = n.parent
LEFT JOIN e ON e.d = n.d AND e.k = n.k LEFT JOIN x ON x.d = n.d AND x.k = n.k"""

ORACLE: dict[str, str] = {
    "op1_substring_dedup": SUBSTRINGS,
    "op2_jaccard_join": JACCARD,
    "op6_decontamination": DECONTAMINATION,
    "op8_quality": QUALITY,
    "op13_url_filters": URLS,
    "op12_prefix_trie": TRIE,
}
