"""The registered queries of this subpackage, and SQL with the same results where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from metforge.llm import (
    chat_format, clustering, decontaminate, hard_negatives, jaccard_join, line_dedup, minhash_join, mixing, quality_model, quality_rules, secrets, suffix_dedup, token_counts,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        quality_model.op1_quality_model, line_dedup.op2_line_dedup, secrets.op3_secret_scan, token_counts.op4_token_counts,
        jaccard_join.op5_jaccard_join, decontaminate.op6_decontaminate, quality_rules.op7_quality_rules,
        suffix_dedup.op8_suffix_dedup, mixing.op9_mixing, chat_format.op10_chat_format,
        minhash_join.op11_minhash_join, hard_negatives.op12_hard_negatives, clustering.op13_centroid_clustering,
    )
}

_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

def _jaccard(size: int, percent: int) -> str:
    """Components of the documents whose sets of ``size``-word shingles are similar by ``percent``."""
    return f"""
WITH RECURSIVE d AS (SELECT doc_id, {_WORDS.format(_LOWER.format("COALESCE(text, '')"))} AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + {size - 1}], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - {size - 2})) AS i FROM d WHERE len(w) >= {size})
  UNION ALL SELECT doc_id, array_to_string(w, ' ') FROM d WHERE len(w) BETWEEN 1 AND {size - 1}
),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
e AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM s AS a JOIN s AS b ON a.g = b.g AND a.doc_id <> b.doc_id
  JOIN n AS na ON na.doc_id = a.doc_id JOIN n AS nb ON nb.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, na.n, nb.n HAVING 100 * count(*) >= {percent} * (na.n + nb.n - count(*))
),
r AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT r.a, e.b FROM r JOIN e ON e.a = r.b),
c AS (SELECT a, min(b) AS component_id FROM r GROUP BY a)
SELECT d.doc_id, COALESCE(n.n, 0) AS n_shingles, c.component_id
FROM d JOIN c ON c.a = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id
"""


_MINHASH = f"SELECT *, doc_id = component_id AS kept FROM ({_jaccard(4, 80)})"

_PARTS = r"regexp_extract_all({}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_DECONTAMINATION = f"""
WITH d AS (SELECT doc_id, {_PARTS.format(_LOWER.format("COALESCE(text, '')"))} AS w FROM documents),
b AS (SELECT item_id, {_PARTS.format(_LOWER.format("COALESCE(text, '')"))} AS w FROM benchmark WHERE item_id IS NOT NULL),
p AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS size, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS g
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM b WHERE len(w) > 0)
),
z AS (SELECT DISTINCT size FROM p),
x AS (
  SELECT doc_id, size, i, array_to_string(w[i:i + size - 1], ' ') AS g
  FROM (SELECT doc_id, w, z.size, unnest(range(1, len(w) - z.size + 2)) AS i FROM d JOIN z ON len(d.w) >= z.size)
),
h AS (SELECT x.doc_id, x.i, x.size, p.item_id FROM x JOIN p ON p.size = x.size AND p.g = x.g),
c AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS k FROM h) GROUP BY doc_id),
t AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM h) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, COALESCE(c.n_hit, 0) AS n_hit, COALESCE(t.n_items, 0) AS n_items,
  sha256(COALESCE(t.items, '')) AS items_sha256, COALESCE(c.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c ON c.doc_id = d.doc_id LEFT JOIN t ON t.doc_id = d.doc_id
"""


def _rules(name: str) -> str:
    top, bottom, slack = quality_rules.RATIOS[name]
    return f"SELECT doc_id, lang, source, '{name}' AS m, {slack} AS slack, CAST({top} AS DOUBLE) / {bottom} AS x FROM c WHERE n_words > 0"


def _group(keys: str) -> str:
    by = f"{keys}, m" if keys else "m"
    return f"""
  SELECT {by}, any_value(rows) AS rows, any_value(v50 + {quality_rules.SPREAD} * least(v75 - v50, {quality_rules.SKEW} * (v50 - v25)) + slack) AS fence FROM (
    SELECT *, CASE WHEN b25 <= -10000 THEN 0.0 ELSE 2 * pow({quality_rules.BASE}, b25) / (1 + {quality_rules.BASE}) END AS v25,
      CASE WHEN b50 <= -10000 THEN 0.0 ELSE 2 * pow({quality_rules.BASE}, b50) / (1 + {quality_rules.BASE}) END AS v50,
      CASE WHEN b75 <= -10000 THEN 0.0 ELSE 2 * pow({quality_rules.BASE}, b75) / (1 + {quality_rules.BASE}) END AS v75
    FROM (
      SELECT {by}, slack, any_value(rows) AS rows, min(bin) FILTER (upto >= rows * 0.25) AS b25, min(bin) FILTER (upto >= rows * 0.5) AS b50, min(bin) FILTER (upto >= rows * 0.75) AS b75
      FROM (
        SELECT *, sum(n) OVER (PARTITION BY {by} ORDER BY bin) AS upto, sum(n) OVER (PARTITION BY {by}) AS rows
        FROM (SELECT {by}, bin, slack, count(*) AS n FROM k GROUP BY {by}, bin, slack)
      ) GROUP BY {by}, slack
    )
  ) GROUP BY {by}"""


QUALITY_COUNTS = f"""
d AS (SELECT row_number() OVER () AS r, doc_id, lang, source, COALESCE(text, '') AS t, {_WORDS.format("COALESCE(text, '')")} AS w FROM documents),
l AS (
  SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT r, unnest(string_split(t, chr(10))) AS line FROM d) WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY r
),
q AS (
  SELECT r, i, count(*) OVER (PARTITION BY r, g) AS times
  FROM (SELECT r, i, array_to_string(w[i:i + 7], ' ') AS g FROM (SELECT r, w, unnest(range(1, len(w) - 6)) AS i FROM d WHERE len(w) >= 9))
),
u AS (SELECT r, count(DISTINCT k) AS n_repeat_words FROM (SELECT r, unnest(range(i, i + 8)) AS k FROM q WHERE times > 1) GROUP BY r),
c AS (
  SELECT d.r, doc_id, lang, source, len(w) AS n_words, CAST(COALESCE(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
    length(t) - length(translate(t, '#*$%&|<>', '')) AS n_symbols, length(t) - length(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', '')) AS n_capitals,
    COALESCE(n_dup_lines, 0) AS n_dup_lines, COALESCE(n_lines, 0) AS n_lines, COALESCE(n_repeat_words, 0) AS n_repeat_words,
    len(list_filter(range(2, len(w) + 1), lambda i: w[i] = w[i - 1])) AS n_echo_words
  FROM d LEFT JOIN l ON l.r = d.r LEFT JOIN u ON u.r = d.r
)"""

_QUALITY = f"""
WITH {QUALITY_COUNTS},
x AS ({" UNION ALL ".join(_rules(k).replace("SELECT doc_id", "SELECT r") for k in quality_rules.RATIOS)}),
k AS (SELECT *, CASE WHEN x <= 0 THEN -10000 ELSE CAST(ceil(ln(x) / ln({quality_rules.BASE})) AS INTEGER) END AS bin FROM x),
own AS ({_group("lang, source")}),
bylang AS ({_group("lang")}),
every AS ({_group("")}),
v AS (
  SELECT k.r, bool_or(k.x > CASE WHEN own.rows >= {quality_rules.MIN_GROUP} THEN own.fence
    WHEN bylang.rows >= {quality_rules.MIN_GROUP} THEN bylang.fence ELSE every.fence END) AS beyond
  FROM k JOIN own ON own.lang IS NOT DISTINCT FROM k.lang AND own.source IS NOT DISTINCT FROM k.source AND own.m = k.m
  JOIN bylang ON bylang.lang IS NOT DISTINCT FROM k.lang AND bylang.m = k.m JOIN every ON every.m = k.m GROUP BY k.r
)
SELECT c.doc_id, c.n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  c.n_words < 20 OR 100 * n_repeat_words > 30 * c.n_words AS base_failed,
  NOT (c.n_words < 20 OR 100 * n_repeat_words > 30 * c.n_words) AND NOT COALESCE(beyond, false) AS kept
FROM c LEFT JOIN v ON v.r = c.r
"""

_SUFFIX = """
WITH d AS (SELECT doc_id, hex(encode(COALESCE(text, ''))) AS h FROM documents),
w AS (SELECT doc_id, i, substr(h, 2 * i - 1, 200) AS s FROM (SELECT doc_id, h, unnest(range(1, length(h) // 2 - 98)) AS i FROM d WHERE length(h) >= 200)),
r AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) AS k FROM w) WHERE k > 1
),
g AS (SELECT doc_id, i, COALESCE(lag(i) OVER (PARTITION BY doc_id ORDER BY i), -100) AS p FROM r),
a AS (
  SELECT doc_id, CAST(sum(least(100, i - p)) AS BIGINT) AS n_removed, count(*) FILTER (p < 0 OR i - p > 100) AS n_spans, max(i) + 100 AS last FROM g GROUP BY doc_id
),
k AS (
  SELECT g.doc_id, string_agg(substr(h, 2 * (CASE WHEN p < 0 THEN 1 ELSE p + 100 END) - 1, 2 * (i - CASE WHEN p < 0 THEN 1 ELSE p + 100 END)), '' ORDER BY i) AS part
  FROM g JOIN d ON d.doc_id = g.doc_id WHERE i > CASE WHEN p < 0 THEN 1 ELSE p + 100 END GROUP BY g.doc_id
)
SELECT d.doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, COALESCE(n_removed, 0) AS n_removed, COALESCE(n_spans, 0) AS n_spans,
  sha256(unhex(CASE WHEN a.doc_id IS NULL THEN h ELSE COALESCE(part, '') || substr(h, 2 * last - 1) END)) AS kept_sha256
FROM d LEFT JOIN a ON a.doc_id = d.doc_id LEFT JOIN k ON k.doc_id = d.doc_id
"""

ORACLES: dict[str, str] = {
    "op2_line_dedup": line_dedup.SQL,
    "op3_secret_scan": secrets.SQL,
    "op5_jaccard_join": _jaccard(5, 75),
    "op6_decontaminate": _DECONTAMINATION,
    "op7_quality_rules": _QUALITY,
    "op8_suffix_dedup": _SUFFIX,
    "op9_mixing": mixing.SQL,
    "op10_chat_format": chat_format.SQL,
    "op11_minhash_join": _MINHASH,
    "op12_hard_negatives": hard_negatives.SQL,
    "op13_centroid_clustering": clustering.SQL,
}
