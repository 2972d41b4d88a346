"""Mixing sources to target weights: certain whole copies, then Pareto order sampling.

Targets of the sources are shared by weight and capped at a multiple of each source's size, the
excess being shared again until none is above.  Inside a source a document of length class ``k``
is wanted ``e`` times, ``e`` in proportion to the class's weight and at most the cap: it gets
``floor(e)`` copies for certain, and the fraction is its inclusion probability ``p``.  Documents
are ranked by ``(u / (1 - u)) / (p / (1 - p))`` with a hash of the id as ``u``, and the first
ones are taken up to the words that are left.  The place where a source's ranking is cut is
found by counting words in bins of the rank, then in bins of the bin that holds the cut, then
document by document: no ranking of a whole source is ever in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from metforge.llm.common import fresh, table
from metforge.operators.ordering import global_row_number
from metforge.operators.skew import lookup_join
from metforge.session import stored

WORD = "[^\\x20\\x09-\\x0D]+"
WEIGHTS = (5, 2, 1)  # of the sources in order, repeating
CAP = 3  # copies of a document or source at most
BINS = 4096
SEED = "mix-1"


def sized(docs: DataFrame, doc_id: str, text: str, source: str, carry: bool = False) -> DataFrame:
    """``doc_id, source, size, class, u``: what the choice depends on; ``carry``: the row itself as ``packed``, too."""
    size = F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("bigint")
    digest = F.md5(F.concat(F.lit(f"{SEED}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit("")))).substr(1, 13)
    u = (F.conv(digest, 16, 10).cast("bigint").cast("double") + 0.5) / F.lit(float(1 << 52))
    packed = [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("packed")] if carry else []
    rows = docs.select(*packed, F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), size.alias("size"), u.alias("u"))
    return rows.withColumn("class", _class(F.col("size")))


def _class(size: Column) -> Column:
    """Number of binary digits of the size."""
    return F.length(F.bin(size)).cast("int")


def _class_weight(k: Column) -> Column:
    """Longer documents are preferred a little."""
    return (k + 8).cast("bigint")


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """``source, source_size, target`` from ``source, source_size``; the shares add up to all words."""
    placed = global_row_number(sources.withColumn("none", F.col("source").isNull()), ["none", "source"], "place")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.pmod(F.col("place") - 1, F.lit(len(weights))) + 1).cast("int"))
    placed = stored(placed.select("source", "source_size", weight.cast("bigint").alias("weight")), "mix-sources")
    size, w = F.col("source_size"), F.col("weight")
    total = placed.agg(F.sum(size)).first()[0] or 0
    rest, share = total, placed.agg(F.sum(w)).first()[0] or 1
    while True:  # a source once above its cap stays there, as the share of the others only rises
        above = F.lit(rest) * w > size * cap * F.lit(share)
        left = placed.agg(F.sum(F.when(above, size * cap)).alias("full"), F.sum(F.when(~above, w)).alias("open")).first()
        after = (total - (left["full"] or 0), left["open"] or 0)
        if after == (rest, share) or not after[1]:
            break
        rest, share = after
    target = F.when(above, (size * cap).cast("double")).otherwise((F.lit(rest) * w).cast("double") / F.lit(share))
    return placed.select("source", "source_size", target.alias("target"))


def _rates(sizes: DataFrame, goals: DataFrame, cap: int) -> DataFrame:
    """``mark, class, copies, p``: certain copies and inclusion probability per source and length class."""
    per = sizes.groupBy("mark", "class").agg(F.sum("size").alias("words")).where("words > 0").withColumn("g", _class_weight(F.col("class")))
    per = per.join(goals.select("mark", "target"), "mark")
    # classes reach the cap in the order of their weight: with the first j at the cap the others get rate * g
    down = W.partitionBy("mark").orderBy(F.desc("g"))
    above = F.coalesce(F.sum("words").over(down.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    below = F.sum(F.col("g") * F.col("words")).over(down.rowsBetween(0, W.unboundedFollowing))
    per = per.withColumn("rate", (F.col("target") - cap * above) / below)
    first_open = F.max(F.when(F.col("rate") * F.col("g") <= cap, F.struct("g", "rate"))).over(W.partitionBy("mark"))
    per = per.withColumn("open", first_open)
    e = F.when(F.col("open").isNull() | (F.col("g") > F.col("open.g")), F.lit(float(cap))).otherwise(F.col("open.rate") * F.col("g"))
    e = F.least(F.greatest(e, F.lit(0.0)), F.lit(float(cap)))
    return per.select("mark", "class", "words", e.alias("e")).select(
        "mark", "class", "words", F.floor("e").cast("bigint").alias("copies"), (F.col("e") - F.floor("e")).alias("p")
    )


def _score(u: Column, p: Column) -> Column:
    """The Pareto rank, as q / (1 + q) between 0 and 1."""
    a, b = u * (1 - p), p * (1 - u)
    return a / (a + b)


def _boundary(rows: DataFrame, bin_: Column, left: Column) -> DataFrame:
    """``mark, bin, before``: the bin in which the words reach ``left``, and the words before it."""
    counts = rows.groupBy("mark", bin_.alias("bin"), left.alias("left")).agg(F.sum("size").alias("words"))
    upto = F.sum("words").over(W.partitionBy("mark").orderBy("bin"))
    first = F.min(F.when(F.col("upto") >= F.col("left"), F.struct("bin", (F.col("upto") - F.col("words")).alias("before"), "left")))
    last = F.max(F.struct("bin", (F.col("upto") - F.col("words")).alias("before"), "left"))
    return counts.withColumn("upto", upto).groupBy("mark").agg(F.coalesce(first, last).alias("b")).select("mark", "b.*")


def _mark(source: Column) -> Column:
    return F.concat(F.when(source.isNull(), "n").otherwise("v"), F.coalesce(source, F.lit("")))


def plan(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> tuple[DataFrame, DataFrame]:
    """Targets by source, and ``(mark, class, copies, p, cut)``: what a document gets follows from its row here."""
    sizes = sizes.withColumn("mark", _mark(F.col("source")))
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    goals = stored(targets(sources, weights, cap).withColumn("mark", _mark(F.col("source"))), "mix-targets")
    rates = stored(_rates(sizes, goals, cap), "mix-rates")
    left = goals.join(rates.groupBy("mark").agg(F.sum(F.col("copies") * F.col("words")).alias("certain")), "mark").select(
        "mark", (F.col("target") - F.col("certain")).alias("left")
    )
    drawn = lookup_join(lookup_join(sizes, rates.drop("words").where("p > 0"), ["mark", "class"]), left, "mark")
    drawn = drawn.where("size > 0").withColumn("score", _score(F.col("u"), F.col("p")))
    coarse, exact = F.floor(F.col("score") * BINS), F.col("score") * BINS * BINS
    fine = F.floor(exact) - coarse * BINS
    one = stored(_boundary(drawn, coarse, F.col("left")), "mix-coarse")
    inside = lookup_join(drawn.drop("left").withColumn("bin", coarse), one, ["mark", "bin"]).withColumn("left2", F.col("left") - F.col("before"))
    two = stored(_boundary(inside.drop("bin", "left", "before"), fine, F.col("left2")), "mix-fine")
    near = lookup_join(inside.drop("left", "before", "left2", "bin").withColumn("bin", fine), two, ["mark", "bin"])
    by = W.partitionBy("mark").orderBy("score", "doc_id", "size")
    upto = F.sum("size").over(by) + F.col("before")
    place = F.struct("score", "doc_id", "size")
    # the document around the cut is taken if more than half of it lies before
    last = near.withColumn("upto", upto).groupBy("mark").agg(
        F.max(F.when(2 * F.col("upto") - F.col("size") <= 2 * F.col("left"), place)).alias("cut"), F.min(place).alias("first")
    )
    cut = stored(last.select("mark", "cut", "first"), "mix-cuts")
    return goals, rates.join(cut, "mark", "left")


def _decided(rows: DataFrame) -> Column:
    """Copies of a document, from ``copies, p, cut, first, score`` and its own values."""
    place = F.struct("score", "doc_id", "size")
    taken = F.when(F.col("cut").isNotNull(), place <= F.col("cut")).otherwise(F.coalesce(place < F.col("first"), F.lit(False)))
    return F.when(F.col("size") > 0, F.coalesce(F.col("copies"), F.lit(0)) + F.when((F.col("p") > 0) & taken, 1).otherwise(0)).otherwise(0)


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """One row per input row: ``doc_id, size, source_size, target, copies, taken``.

    A null or empty text has size 0 and is not taken.  Null sources are one source, the last in
    order.  Rows that repeat an id share its random number; of one size they are taken together.  An empty
    table gives no rows.  The same input gives the same mix on every run.
    """
    sizes = stored(sized(docs, doc_id, text, source), "mix-sizes")
    goals, rules = plan(sizes, weights, cap)
    rows = lookup_join(sizes.withColumn("mark", _mark(F.col("source"))), goals.drop("source"), "mark", "left")
    rows = lookup_join(rows, rules.drop("words"), ["mark", "class"], "left").withColumn("score", _score(F.col("u"), F.col("p")))
    rows = rows.withColumn("copies", _decided(rows).cast("bigint"))
    return rows.select("doc_id", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def mixed_docs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", copies: str = "copies", weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """The documents taken, with all their columns and the number of ``copies``.

    The choice is a rule by source and length, so texts are not shuffled to apply it.
    """
    sizes = stored(sized(docs, doc_id, text, source), "mix-sizes")
    _, rules = plan(sizes, weights, cap)
    name = fresh(docs, copies)
    rows = sized(docs, doc_id, text, source, carry=True).withColumn("mark", _mark(F.col("source")))
    rows = lookup_join(rows, rules.drop("words"), ["mark", "class"], "left").withColumn("score", _score(F.col("u"), F.col("p")))
    rows = rows.withColumn("made", _decided(rows).cast("bigint")).where("made > 0")
    return rows.select(*[F.col(f"packed.`{c}`").alias(c) for c in docs.columns], F.col("made").alias(name))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


SQL = r"""
WITH s AS (
  SELECT doc_id, source, len(regexp_extract_all(COALESCE(text, ''), '[^\x20\x09-\x0D]+')) AS size,
    (CAST(CAST('0x' || substr(md5('mix-1:' || COALESCE(CAST(doc_id AS VARCHAR), '')), 1, 13) AS BIGINT) AS DOUBLE) + 0.5) / 4503599627370496.0 AS u
  FROM documents
),
src AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS ss,
    CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w
  FROM s GROUP BY source
),
o AS (
  SELECT *, (SELECT CAST(sum(size) AS BIGINT) FROM s)
      - CAST(COALESCE(sum(3 * ss) OVER (ORDER BY 3.0 * ss / w, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS rest,
    CAST(sum(w) OVER (ORDER BY 3.0 * ss / w, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS BIGINT) AS share,
    row_number() OVER (ORDER BY 3.0 * ss / w, source) AS k
  FROM src
),
f AS (SELECT rest, share FROM o WHERE rest * w <= 3 * ss * share ORDER BY k LIMIT 1),
t AS (
  SELECT source, ss, CASE WHEN f.rest * w > ss * 3 * f.share THEN CAST(ss * 3 AS DOUBLE) ELSE CAST(f.rest * w AS DOUBLE) / f.share END AS target
  FROM src CROSS JOIN f
),
per AS (
  SELECT s.source, len(bin(size)) AS class, CAST(sum(size) AS BIGINT) AS words, len(bin(size)) + 8 AS g, any_value(target) AS target
  FROM s JOIN t ON t.source IS NOT DISTINCT FROM s.source WHERE size > 0 GROUP BY s.source, len(bin(size))
),
rate AS (
  SELECT *, (target - CAST(3 * COALESCE(sum(words) OVER (PARTITION BY source ORDER BY g DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE))
    / CAST(sum(g * words) OVER (PARTITION BY source ORDER BY g DESC ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS rate
  FROM per
),
op AS (
  SELECT *, max(CASE WHEN rate * g <= 3 THEN g END) OVER (PARTITION BY source) AS open_g FROM rate
),
e AS (
  SELECT *, CASE WHEN open_g IS NULL OR g > open_g THEN 3.0::DOUBLE
    ELSE least(greatest(max(CASE WHEN g = open_g THEN rate END) OVER (PARTITION BY source) * g, 0.0), 3.0) END AS e
  FROM op
),
c AS (SELECT source, class, words, CAST(floor(e) AS BIGINT) AS copies, e - floor(e) AS p FROM e),
l AS (
  SELECT c.source, any_value(target) - CAST(sum(copies * words) AS BIGINT) AS left_words
  FROM c JOIN t ON t.source IS NOT DISTINCT FROM c.source GROUP BY c.source
),
d AS (
  SELECT s.doc_id, s.source, s.size, t.ss, t.target, c.copies, c.p, l.left_words,
    (u * (1 - p)) / (u * (1 - p) + p * (1 - u)) AS score
  FROM s JOIN t ON t.source IS NOT DISTINCT FROM s.source
  LEFT JOIN c ON c.source IS NOT DISTINCT FROM s.source AND c.class = len(bin(s.size)) AND s.size > 0
  LEFT JOIN l ON l.source IS NOT DISTINCT FROM s.source
),
r AS (
  SELECT *, CASE WHEN p > 0 THEN sum(CASE WHEN p > 0 THEN size ELSE 0 END) OVER (PARTITION BY source ORDER BY CASE WHEN p > 0 THEN score END NULLS LAST, doc_id, size) END AS upto
  FROM d
)
SELECT doc_id, size, ss AS source_size, target,
  CAST(CASE WHEN size > 0 THEN size * (copies + CASE WHEN p > 0 AND 2 * upto - size <= 2 * left_words THEN 1 ELSE 0 END) ELSE 0 END AS BIGINT) AS taken
FROM r
"""
