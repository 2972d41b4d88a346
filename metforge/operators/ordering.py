"""Positions in a total order, without sending a whole group to one task.

The shared primitive is :func:`range_sorted`: the rows are range-partitioned by the
full sort key and stored, after which each row has a partition number and a place in it.  Everything that crosses partitions is then settled on a summary with
one row per (group, partition).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from metforge.functions import temporal
from metforge.operators.skew import lookup_join
from metforge.session import materialize, stored

PART, PLACE = "_part", "_place"


def range_sorted(df: DataFrame, order_by: Sequence[str]) -> DataFrame:
    """Rows in total order, with ``_part`` and ``_place`` columns that no longer change."""
    tagged = (
        df.repartitionByRange(*order_by)
        .sortWithinPartitions(*order_by)
        .withColumn("_mid", F.monotonically_increasing_id())
    )
    low = F.lit((1 << 33) - 1)
    return stored(tagged, "sorted").withColumn(PART, F.shiftright("_mid", 33).cast("int")).withColumn(
        PLACE, F.col("_mid").bitwiseAND(low)
    ).drop("_mid")


def global_row_number(df: DataFrame, order_by: Sequence[str], name: str) -> DataFrame:
    """1-based position in the total order of ``order_by`` (add a unique column to break ties)."""
    rows = range_sorted(df, order_by)
    per_part = rows.groupBy(PART).agg(F.count(F.lit(1)).alias("_n"))
    # one row per partition
    earlier = W.orderBy(PART).rowsBetween(W.unboundedPreceding, -1)
    starts = per_part.select(PART, F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"))
    return (
        rows.join(F.broadcast(starts), PART)
        .withColumn(name, F.col("_start") + F.col(PLACE) + 1)
        .drop(PART, PLACE, "_start")
    )


def group_row_number(df: DataFrame, keys: Sequence[str], order_by: Sequence[str], name: str) -> DataFrame:
    """1-based position within ``keys``: the global position less the start of the group."""
    rows = global_row_number(df, [*keys, *order_by], name)
    starts = rows.groupBy(*keys).agg(F.min(name).alias("_first"))
    return lookup_join(rows, starts, keys).withColumn(name, F.col(name) - F.col("_first") + 1).drop("_first")


OCTAVE = 128  # bins between a number and its double
OFFSET = 1100 * OCTAVE  # beyond the number of the least positive double
FINE = 4096  # bins of a refinement
AT_ONCE = 65536  # different values of one bin that are put in order by one task


def value_bin(v: Column) -> Column:
    """Number of a logarithmic bin; never falls when the value grows.  NaN comes last, as in Spark's order."""
    d = v.cast("double")
    size = F.floor(F.log2(F.abs(d)) * F.lit(float(OCTAVE))) + F.lit(OFFSET)
    size = F.when(F.abs(d) == float("inf"), F.lit(4 * OFFSET).cast("bigint")).otherwise(size)
    return F.when(F.isnan(d), F.lit(8 * OFFSET).cast("bigint")).when(d == 0, F.lit(0).cast("bigint")).when(d > 0, size).otherwise(-size)


def order_statistics(
    df: DataFrame, group: Sequence[str], value: str, positions: Callable[[Column], dict[str, Column]], mean: str | None = None
) -> DataFrame:
    """Values at given 0-based positions of each group's sorted values, exactly.

    ``positions`` maps the group's count to ``{output column: position}``.  Result: ``group columns, n, output columns``, and
    the mean under the name ``mean`` if given.

    Two scans at any size: the first counts the values of each group by logarithmic bin, the second takes the bins
    that hold a wanted position, equal values combined.  Bins of more than ``AT_ONCE`` different values are cut
    into ``FINE`` parts of their own range, again and again, before a task puts one in order.  All counts are combined on the map side.
    """
    keys = list(group) or ["_all"]
    df = df if group else df.withColumn("_all", F.lit(0))
    names = list(positions(F.lit(1)))
    clean = df.where(F.col(value).isNotNull()).select(*keys, F.col(value).alias("_v"))
    bins = stored(clean.withColumn("_bin", value_bin(F.col("_v"))).groupBy(*keys, "_bin").agg(F.count(F.lit(1)).alias("_n"), F.sum("_v").alias("_sum")), "value-bins")
    means = [(F.sum("_sum") / F.sum("_n")).alias(mean)] if mean else []
    totals = bins.groupBy(*keys).agg(F.sum("_n").alias("n"), *means)
    at = [F.struct(F.lit(k).alias("_name"), c.cast("bigint").alias("_pos")) for k, c in positions(F.col("n")).items()]
    wanted = totals.select(*keys, F.inline(F.array(*at)))
    held = stored(_holding(bins.drop("_sum"), keys, [], wanted), "wanted-bins")  # one row per group and position

    near = lookup_join(clean.withColumn("_bin", value_bin(F.col("_v"))), held.select(*keys, "_bin").distinct(), [*keys, "_bin"])
    near = stored(near.groupBy(*keys, "_bin", "_v").agg(F.count(F.lit(1)).alias("_n")), "wanted-values")
    near, held = _refined(near, keys, held)
    through = W.partitionBy(*keys, "_bin").orderBy("_v").rowsBetween(W.unboundedPreceding, 0)
    ranked = near.withColumn("_through", F.sum("_n").over(through))
    hit = (F.col("_pos") < F.col("_through")) & (F.col("_pos") >= F.col("_through") - F.col("_n"))
    found = lookup_join(ranked, held, [*keys, "_bin"]).where(hit)
    out = found.groupBy(*keys).agg(*[F.max(F.when(F.col("_name") == k, F.col("_v"))).alias(k) for k in names])
    out = totals.join(out, keys, "left")
    return out if group else out.drop("_all")


def _holding(bins: DataFrame, keys: Sequence[str], inside: Sequence[str], wanted: DataFrame) -> DataFrame:
    """``wanted`` with the ``_bin`` that holds each position, and the position counted inside it.

    ``bins`` is ``keys, inside, _bin, _n``; there are at most a few hundred thousand bins of a group, and a row for each.
    """
    by = [*keys, *inside]
    upto = F.sum("_n").over(W.partitionBy(*by).orderBy("_bin").rowsBetween(W.unboundedPreceding, 0))
    placed = bins.withColumn("_upto", upto)
    inner = lookup_join(placed, wanted, by, unique=True)
    local = F.col("_pos") - (F.col("_upto") - F.col("_n"))
    return inner.where((local >= 0) & (F.col("_pos") < F.col("_upto"))).select(*by, "_bin", "_name", local.alias("_pos"))


def _refined(near: DataFrame, keys: Sequence[str], held: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The same with the bins of too many values cut finer.  Each round divides a bin's range by ``FINE``."""
    while True:
        by = [*keys, "_bin"]
        shape = near.groupBy(*by).agg(F.count(F.lit(1)).alias("_values"), F.min("_v").cast("double").alias("_low"), F.max("_v").cast("double").alias("_high"))
        # a bin whose ends are equal as doubles cannot be cut; it holds few whole numbers beyond 2**53
        wide = shape.where((F.col("_values") > AT_ONCE) & (F.col("_high") > F.col("_low"))).select(*by, "_low", "_high")
        if wide.isEmpty():
            return near, held
        wide = stored(wide, "wide-bins")
        share = (F.col("_v").cast("double") / 2 - F.col("_low") / 2) / (F.col("_high") / 2 - F.col("_low") / 2)  # halves, as the range may not be a double
        cut = lookup_join(near, wide, by).withColumn("_fine", F.least(F.floor(share * FINE), F.lit(FINE - 1)).cast("bigint")).drop("_low", "_high")
        bins = cut.groupBy(*by, "_fine").agg(F.sum("_n").alias("_n")).withColumnRenamed("_bin", "_old").withColumnRenamed("_fine", "_bin")
        finer = _holding(bins, keys, ["_old"], lookup_join(held, wide.select(*by), by, "left_semi").withColumnRenamed("_bin", "_old"))
        # bins are numbered anew, so that old and new ones are told apart
        name = lambda old, new: F.xxhash64(old, new)
        finer = stored(finer.select(*keys, name(F.col("_old"), F.col("_bin")).alias("_bin"), "_name", "_pos"), "finer-positions")
        rows = cut.withColumn("_bin", name(F.col("_bin"), F.col("_fine"))).drop("_fine")
        rows = lookup_join(rows, finer.select(*by).distinct(), by)
        kept = lookup_join(near, wide.select(*by), by, "left_anti")
        near = stored(kept.unionByName(rows.select(*kept.columns)), "finer-values")
        held = stored(lookup_join(held, wide.select(*by), by, "left_anti").unionByName(finer.select(*held.columns)), "finer-held")


def quantiles(df: DataFrame, group: Sequence[str], value: str, probabilities: dict[str, float], mean: str | None = None) -> DataFrame:
    """Exact quantiles with linear interpolation between neighbours, and the mean if it is given a name."""
    def at(n: Column) -> dict[str, Column]:
        out = {}
        for name, p in probabilities.items():
            pos = F.lit(p) * (n - 1)
            out[f"_{name}_lo"], out[f"_{name}_hi"] = F.floor(pos), F.ceil(pos)
        return out

    stats = order_statistics(df, group, value, at, mean)
    cols = [F.col(mean)] if mean else []
    for name, p in probabilities.items():
        lo, hi, pos = F.col(f"_{name}_lo"), F.col(f"_{name}_hi"), F.lit(p) * (F.col("n") - 1)
        cols.append((lo + (hi - lo) * (pos - F.floor(pos))).alias(name))
    return stats.select(*group, "n", *cols)


def next_in_time(df: DataFrame, keys: Sequence[str], time: str, name: str, bucket_hours: int = 24) -> DataFrame:
    """Each row's following timestamp within ``keys`` (which, with ``time``, must be unique).

    The window is per (keys, time bucket), so a long series is spread over its buckets;
    the last row of a bucket takes the head of the next one that has rows.
    """
    bucket = temporal.floor_to(temporal.micros(F.col(time)), bucket_hours * temporal.HOUR_US)
    rows = df.withColumn("_bucket", bucket)
    heads = rows.groupBy(*keys, "_bucket").agg(F.min(time).alias("_head"))
    following = F.lead("_head").over(W.partitionBy(*keys).orderBy("_bucket"))
    heads = heads.select(*keys, "_bucket", following.alias("_next_head"))
    inside = F.lead(time).over(W.partitionBy(*keys, "_bucket").orderBy(time))
    return (
        rows.withColumn("_inside", inside)
        .join(heads, [*keys, "_bucket"], "left")
        .withColumn(name, F.coalesce("_inside", "_next_head"))
        .drop("_bucket", "_inside", "_next_head")
    )


def nearest_values(points: DataFrame, axes: dict[str, DataFrame], names: dict[str, str]) -> DataFrame:
    """``points`` with, per coordinate column, the closest value of its axis (a one-column table).

    Ties go to the larger axis value.  Coordinates and axis values are merged in one
    sorted order; the neighbours on either side come from the partition itself or from
    the partition summary, so no pairs are formed and crowded coordinates do no harm.
    """
    parts = []
    for column, axis in axes.items():
        wanted = points.select(F.col(column).cast("double").alias("_c")).where(F.col("_c").isNotNull()).distinct()
        marks = axis.select(F.col(axis.columns[0]).cast("double").alias("_c")).distinct()
        for table, value in ((wanted, F.lit(None).cast("double")), (marks, F.col("_c"))):
            parts.append(table.select(F.lit(column).alias("_name"), "_c", value.alias("_axis")))
    merged = reduce(DataFrame.unionByName, parts)
    rows = range_sorted(merged, ["_name", "_c"])
    # frames that end at the current row, in either direction: those that begin there are computed anew for each row
    in_part = W.partitionBy(PART, "_name")
    across = W.partitionBy("_name")
    upto, before = (W.unboundedPreceding, W.currentRow), (W.unboundedPreceding, -1)
    # one row per axis and partition
    edges = rows.groupBy("_name", PART).agg(F.min("_axis").alias("_lo"), F.max("_axis").alias("_hi")).select(
        "_name",
        PART,
        F.max("_hi").over(across.orderBy(PART).rowsBetween(*before)).alias("_hi_before"),
        F.min("_lo").over(across.orderBy(F.desc(PART)).rowsBetween(*before)).alias("_lo_after"),
    )
    # range frames put equal coordinates in one peer group, so an exact hit is its own neighbour
    below = F.max("_axis").over(in_part.orderBy("_c").rangeBetween(*upto))
    above = F.min("_axis").over(in_part.orderBy(F.desc("_c")).rangeBetween(*upto))
    snapped = (
        rows.withColumn("_below", below)
        .withColumn("_above", above)
        .where(F.col("_axis").isNull())
        .join(F.broadcast(edges), ["_name", PART])
        .withColumn("_below", F.coalesce("_below", "_hi_before"))
        .withColumn("_above", F.coalesce("_above", "_lo_after"))
    )
    closer_below = (F.col("_c") - F.col("_below")) < (F.col("_above") - F.col("_c"))
    choice = (
        F.when(F.col("_above").isNull(), F.col("_below"))
        .when(F.col("_below").isNull(), F.col("_above"))
        .when(closer_below, F.col("_below"))
        .otherwise(F.col("_above"))
    )
    mapping = materialize(snapped.select("_name", F.col("_c").alias("_coordinate"), choice.alias("_nearest")))
    out = points
    for column in axes:
        side = mapping.where(F.col("_name") == column).select("_coordinate", F.col("_nearest").alias(names[column]))
        keyed = out.withColumn("_coordinate", F.col(column).cast("double"))
        out = lookup_join(keyed, side, "_coordinate", "left").drop("_coordinate")
    return out
