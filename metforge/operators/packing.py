"""Packing parameters, packed tables and dense placement."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metforge import dims
from metforge.functions import codec, physics
from metforge.operators.ordering import global_row_number, group_row_number
from metforge.operators.skew import lookup_join
from metforge.session import materialize, stored


def packing_params(df: DataFrame, by: Sequence[str], value: str = "value", target: str = "int16") -> DataFrame:
    """``add_offset`` and ``scale_factor`` from the data range of each group."""
    clean = physics.nan_to_null(F.col(value))
    spans = df.groupBy(*by).agg(F.min(clean).alias("low"), F.max(clean).alias("high"))
    return _with_params(spans, target)


def wide_params(df: DataFrame, by: Sequence[str], variables: Sequence[str], time: str, target: str = "int16") -> DataFrame:
    """One row per group: ``first`` stamp and, per variable, a struct ``(add_offset, scale_factor)``.

    All variables and the time origin come out of one pass over the wide rows.
    """
    spans = [f(physics.nan_to_null(F.col(v))).alias(f"_{n}_{v}") for v in variables for n, f in (("lo", F.min), ("hi", F.max))]
    grouped = df.groupBy(*by).agg(F.min(time).alias("first"), *spans)
    pair = lambda lo, hi: F.struct(
        codec.add_offset(lo, hi, target).alias("add_offset"), codec.scale_factor(lo, hi, target).alias("scale_factor")
    )
    return grouped.select(*by, "first", *[pair(F.col(f"_lo_{v}"), F.col(f"_hi_{v}")).alias(f"_p_{v}") for v in variables])


def pack_wide(df: DataFrame, params: DataFrame, by: Sequence[str], variables: Sequence[str], target: str = "int16") -> DataFrame:
    """Every variable replaced by its packed integers; ``first`` is added.  One join serves all variables."""
    packed = {v: codec.pack(F.col(v), F.col(f"_p_{v}.add_offset"), F.col(f"_p_{v}.scale_factor"), target) for v in variables}
    return lookup_join(df, params, by).withColumns(packed).drop(*[f"_p_{v}" for v in variables])


def long_params(params: DataFrame, by: Sequence[str], variables: Sequence[str]) -> DataFrame:
    """``(by, first, variable, add_offset, scale_factor)`` from :func:`wide_params`."""
    rows = F.array(*[F.struct(F.lit(v).alias("variable"), F.col(f"_p_{v}").alias("p")) for v in variables])
    return params.select(*by, "first", F.explode(rows).alias("_r")).select(*by, "first", "_r.variable", "_r.p.*")


def preset_params(df: DataFrame, variable: str = "variable", target: str = "int16") -> DataFrame:
    """The same from the fixed range of each variable present in ``df``."""
    ranges = _with_params(dims.packing_ranges(df.sparkSession), target).withColumnRenamed("variable", variable)
    return ranges.join(df.select(variable).distinct(), variable, "left_semi")


def _with_params(spans: DataFrame, target: str) -> DataFrame:
    low, high = F.col("low"), F.col("high")
    return spans.withColumn("add_offset", codec.add_offset(low, high, target)).withColumn(
        "scale_factor", codec.scale_factor(low, high, target)
    )


def pack_table(
    df: DataFrame, by: Sequence[str], value: str = "value", params: DataFrame | None = None, target: str = "int16"
) -> DataFrame:
    """Add ``packed`` with its ``add_offset`` and ``scale_factor``; parameters come from the data unless given."""
    if params is None:
        params = materialize(packing_params(df, by, value, target))
    side = params.select(*by, "add_offset", "scale_factor")
    return lookup_join(df, side, by, "left").withColumn(
        "packed", codec.pack(F.col(value), F.col("add_offset"), F.col("scale_factor"), target)
    )


def unpack_table(df: DataFrame, value: str = "value", target: str = "int16") -> DataFrame:
    return df.withColumn(value, codec.unpack(F.col("packed"), F.col("add_offset"), F.col("scale_factor"), target))


def with_attributes(df: DataFrame, variable: str = "variable") -> DataFrame:
    """Units, description and source name of each variable (12 fixed rows, broadcast)."""
    table = dims.variables(df.sparkSession).withColumnRenamed("variable", variable)
    return df.join(F.broadcast(table), variable, "left")


def dense_index(df: DataFrame, time: str = "time", site: str = "gid", lat: str = "LATIXY", lon: str = "LONGXY") -> DataFrame:
    """Add 0-based ``t_idx`` (rank of the stamp) and ``n_idx`` (rank of the site by lat, lon, id)."""
    times = global_row_number(df.select(time).distinct(), [time], "t_idx")
    places = global_row_number(df.select(site, lat, lon).distinct(), [lat, lon, site], "n_idx")
    times = times.withColumn("t_idx", F.col("t_idx") - 1)
    places = places.select(site, (F.col("n_idx") - 1).alias("n_idx"))
    return lookup_join(lookup_join(df, times, time), places, site)


def dense_axes(
    df: DataFrame, places: DataFrame, group: str, time: str = "time", site: str = "gid", lat: str = "lat", lon: str = "lon"
) -> tuple[DataFrame, DataFrame]:
    """``(group, time, t_idx)`` and ``(group, site, n_idx)``: the stamps and sites of each group, 0-based, sites by lat, lon, id."""
    times = group_row_number(df.select(group, time).distinct(), [group], [time], "t_idx")
    at = places.select(F.col(site).cast("string").alias(site), lat, lon)
    located = lookup_join(df.select(group, site).distinct(), at, site, "left")
    sites = group_row_number(located, [group], [lat, lon, site], "n_idx")
    return (
        stored(times.select(group, time, (F.col("t_idx") - 1).alias("t_idx")), "grid-times"),
        stored(sites.select(group, site, (F.col("n_idx") - 1).alias("n_idx")), "grid-sites"),
    )


def dense_cells(
    df: DataFrame, places: DataFrame, group: str, time: str = "time", site: str = "gid", lat: str = "lat", lon: str = "lon"
) -> DataFrame:
    """Every stamp of a group at every site of that group, with 0-based ``t_idx`` and ``n_idx``.

    ``df`` has unique (group, site, time); the columns of a cell without a row are null.  The axes
    are joined on the group, so the pairs formed are the cells of the result and no others.
    """
    times, sites = dense_axes(df, places, group, time, site, lat, lon)
    return lookup_join(times, sites, group).join(df, [group, site, time], "left")


def gathered_cells(df: DataFrame, times: DataFrame, sites: DataFrame, group: str, time: str = "time", site: str = "gid") -> DataFrame:
    """The rows of ``df`` at their places on the axes of :func:`dense_axes`; cells without a row are not formed."""
    return lookup_join(lookup_join(df, times, [group, time]), sites, [group, site])


def dense_coverage(df: DataFrame, time: str = "time", site: str = "gid") -> DataFrame:
    """One row: does every site have a row at every stamp?"""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct(time).alias("n_times"),
        F.count_distinct(site).alias("n_sites"),
    ).withColumn("complete", F.col("n_rows") == F.col("n_times") * F.col("n_sites"))
