"""Secret scan with the ownership of each candidate value counted over the whole corpus.

Patterns give the base spans.  Longer opaque runs (``opaque``) are candidates as well.  Every
candidate's hash is aggregated by distinct repositories and owners: a value that several owners
have, or that lies in many repositories, is a copied example; one that few hold in few places is
owner-specific and looks live.  Opaque runs become spans
only if they are owner-specific; base spans always stay, and are counted by class.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from metforge.llm.common import table
from metforge.operators.skew import lookup_join
from metforge.session import stored

# The patterns and least lengths of the base kinds, in their order.
KINDS = {
    "assign": (r"""((?i)password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2),
    # a run that is too short cannot hold a shorter match that passes, so the least length is in the pattern
    "access": ("AKIA[A-Z0-9]{16,}", 0),
    "hex": ("[0-9a-f]{24,}", 0),
    "opaque": ("[A-Za-z0-9+/_-]{20,}", 0),
}
ASSIGN_LENGTH = 6
EXAMPLE_OWNERS = 3  # a value that so many owners have is a copied example
EXAMPLE_REPOSITORIES = 10  # and so is one in so many repositories, whoever owns them


def _candidates(rows: DataFrame) -> DataFrame:
    """``doc_id, version, repository, owner, kind, start, end, value`` of every match; code points, end exclusive."""
    text = F.col("text")
    parts = []
    for order, (kind, (pattern, group)) in enumerate(KINDS.items()):
        found = F.arrays_zip(
            F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("whole"),
            F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("value"),
            F.transform(F.split(text, pattern, -1), F.length).alias("gap"),
        )
        at = rows.where(text.rlike(pattern)).select(
            "doc_id", "version", "repository", "owner", F.lit(order).alias("kind_order"), F.lit(kind).alias("kind"), F.posexplode(found).alias("i", "m")
        )
        parts.append(at.where("m.whole IS NOT NULL").select("*", F.col("m.whole").alias("whole"), F.col("m.value").alias("value"), F.col("m.gap").alias("gap")).drop("m"))
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    # the text before a match is all gaps so far and all matches before; repeated rows have the same gaps
    by = W.partitionBy("doc_id", "version", "copy", "kind").orderBy("i")
    end = F.sum(F.col("gap") + F.length("whole")).over(by)
    copy = F.row_number().over(W.partitionBy("doc_id", "version", "kind", "i").orderBy("repository", "owner"))
    every = every.withColumn("copy", copy).withColumn("end", end.cast("bigint")).withColumn("start", F.col("end") - F.length("whole"))
    passes = F.when(F.col("kind") == "assign", F.length("value") >= ASSIGN_LENGTH).when(
        F.col("kind") == "opaque", F.col("value").rlike("[0-9]") & F.col("value").rlike("[a-z]") & F.col("value").rlike("[A-Z]")
    ).otherwise(F.lit(True))
    return every.where(passes).drop("whole", "gap", "i")


def ownership(candidates: DataFrame) -> DataFrame:
    """``hash, repositories, owners, example``: how far each value is spread."""
    # combined on the map side first, so a value that is everywhere is one row per task and owner
    pairs = candidates.select("hash", "repository", "owner").distinct()
    return pairs.groupBy("hash").agg(
        F.countDistinct("repository").alias("repositories"), F.countDistinct("owner").alias("owners")
    ).withColumn("example", (F.col("owners") >= EXAMPLE_OWNERS) | (F.col("repositories") >= EXAMPLE_REPOSITORIES))


def _text_of(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def secret_spans(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", repository: str = "doc_id", owner: str = "source") -> DataFrame:
    """One row per input row: ``doc_id``, and ``spans``, an array of ``start, kind_order, kind, end, base,
    example, repositories, owners``.

    ``repository`` and ``owner`` name the columns counted; null ones count for nothing.  A null or
    empty text has no spans.  Rows that repeat an id and text get the same spans.  Kinds that start at
    one place (a tie) are in their fixed order.  An empty table gives no rows; columns that are not
    named are not looked at, so their names may clash.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(body).alias("version"), F.col(repository).alias("repository"), F.col(owner).alias("owner"), body.alias("text"))
    found = stored(_candidates(rows).withColumn("hash", F.sha2("value", 256)).drop("value"), "secret-candidates")
    known = stored(ownership(found), "secret-owners")
    rated = lookup_join(found.where("copy = 1").drop("repository", "owner"), known, "hash")
    base = F.col("kind") != "opaque"
    around = W.partitionBy("doc_id", "version").orderBy("start", "kind_order")
    earlier = F.max(F.when(base, F.col("end"))).over(around.rowsBetween(W.unboundedPreceding, -1))
    later = F.min(F.when(base, F.col("start"))).over(around.rowsBetween(1, W.unboundedFollowing))
    apart = F.coalesce(earlier <= F.col("start"), F.lit(True)) & F.coalesce(later >= F.col("end"), F.lit(True))
    spans = rated.withColumn("apart", apart).where(base | (F.col("apart") & ~F.col("example")))
    entry = F.struct("start", "kind_order", "kind", "end", base.alias("base"), "example", "repositories", "owners")
    made = spans.groupBy(F.col("doc_id").alias("id"), F.col("version").alias("ver")).agg(F.array_sort(F.collect_list(entry)).alias("spans"))
    keys = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(body).alias("version"))
    out = keys.join(made, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("version") == F.col("ver")), "left")
    empty = F.array().cast(made.schema["spans"].dataType)
    return out.select("doc_id", F.coalesce("spans", empty).alias("spans"))


def _is_kind(kind: str) -> Callable[[Column], Column]:
    return lambda s: s["kind"] == kind


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = secret_spans(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["base"])
    count = lambda test: F.size(F.filter("spans", test)).cast("bigint")
    return rows.select(
        "doc_id", *[count(_is_kind(k)).alias(f"n_{k}") for k in ("assign", "access", "hex", "opaque")],
        F.sha2(_text_of(base), 256).alias("base_sha256"), _text_of(F.col("spans")).alias("spans"),
        count(lambda s: ~s["example"]).alias("n_live"), count(lambda s: s["example"]).alias("n_example"),
        *[F.coalesce(F.array_max(F.col(f"spans.{c}")), F.lit(0).cast("bigint")).alias(f"max_{c}") for c in ("repositories", "owners")],
    )


_RE2 = {
    "assign": r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)""",
    "access": "AKIA[A-Z0-9]{16,}", "hex": "[0-9a-f]{24,}", "opaque": "[A-Za-z0-9+/_-]{20,}",
}


def _sql() -> str:
    kinds = " UNION ALL ".join(
        f"""SELECT doc_id, source, {k} AS ko, '{kind}' AS kind, regexp_extract_all(t, '{p}', 0) AS w,
        regexp_extract_all(t, '{p}', {KINDS[kind][1]}) AS v, regexp_split_to_array(t, '{p}') AS g FROM d"""
        for k, (kind, p) in enumerate(_RE2.items())
    )
    return f"""
WITH d AS (SELECT doc_id, source, COALESCE(text, '') AS t FROM documents),
k AS ({kinds}),
x AS (SELECT doc_id, source, ko, kind, unnest(w) AS w, unnest(v) AS v, unnest(g[1:len(w)]) AS g, unnest(range(1, len(w) + 1)) AS i FROM k WHERE len(w) > 0),
y AS (
  SELECT *, CAST(sum(length(g) + length(w)) OVER (PARTITION BY doc_id, kind ORDER BY i) AS BIGINT) AS e FROM x
),
c AS (
  SELECT doc_id, source, ko, kind, v, e - length(w) AS s, e FROM y
  WHERE CASE kind WHEN 'assign' THEN length(v) >= {ASSIGN_LENGTH}
    WHEN 'opaque' THEN regexp_matches(v, '[0-9]') AND regexp_matches(v, '[a-z]') AND regexp_matches(v, '[A-Z]') ELSE true END
),
o AS (
  SELECT *, owners >= {EXAMPLE_OWNERS} OR repositories >= {EXAMPLE_REPOSITORIES} AS example
  FROM (SELECT v, count(DISTINCT source) AS owners, count(DISTINCT doc_id) AS repositories FROM c GROUP BY v)
),
z AS (
  SELECT c.*, o.example, o.owners, o.repositories, kind <> 'opaque' OR (NOT example AND NOT EXISTS (
    SELECT 1 FROM c AS b WHERE b.doc_id = c.doc_id AND b.kind <> 'opaque' AND b.s < c.e AND c.s < b.e)) AS stays
  FROM c JOIN o ON o.v = c.v
),
a AS (
  SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
    count(*) FILTER (kind = 'hex') AS n_hex, count(*) FILTER (kind = 'opaque') AS n_opaque,
    string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, ko) FILTER (kind <> 'opaque') AS base,
    string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, ko) AS spans,
    count(*) FILTER (NOT example) AS n_live, count(*) FILTER (example) AS n_example,
    max(repositories) AS max_repositories, max(owners) AS max_owners
  FROM z WHERE stays GROUP BY doc_id
)
SELECT d.doc_id, COALESCE(n_assign, 0) AS n_assign, COALESCE(n_access, 0) AS n_access, COALESCE(n_hex, 0) AS n_hex,
  COALESCE(n_opaque, 0) AS n_opaque, sha256(COALESCE(base, '')) AS base_sha256, COALESCE(spans, '') AS spans,
  COALESCE(n_live, 0) AS n_live, COALESCE(n_example, 0) AS n_example,
  COALESCE(max_repositories, 0) AS max_repositories, COALESCE(max_owners, 0) AS max_owners
FROM d LEFT JOIN a ON a.doc_id = d.doc_id
"""


SQL = _sql()
