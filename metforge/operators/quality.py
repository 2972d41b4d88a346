"""Statistics, plausibility checks and comparison of sources.

All of them work on long tables ``(variable, value, ...)`` and reduce on the map side
to a few rows per variable.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metforge import dims
from metforge.functions import physics
from metforge.operators.ordering import quantiles
from metforge.operators.skew import lookup_join

MAGNITUDE_LIMIT = 0.5
OUTSIDE_LIMIT = 0.1


def variable_stats(df: DataFrame, variable: str = "variable", value: str = "value") -> DataFrame:
    """Mean and the 1st and 99th percentile (exact, linear between neighbours) as mean, min, max."""
    clean = df.select(variable, physics.nan_to_null(F.col(value)).alias("_value"))
    return quantiles(clean, [variable], "_value", {"min": 0.01, "max": 0.99}, mean="mean").drop("n")


def range_report(
    df: DataFrame, stats: DataFrame | None = None, variable: str = "variable", value: str = "value"
) -> DataFrame:
    """Per variable: mean, min, max, and the three concerns about them.

    ``stats`` is ``(variable, ref_mean, ref_min, ref_max)`` and defaults to the built-in
    reference; variables without statistics are listed with ``has_stats = false`` and
    still checked against the hard limits.
    """
    spark = df.sparkSession
    stats = dims.reference_stats(spark) if stats is None else stats
    clean = df.select(F.col(variable).alias("variable"), physics.nan_to_null(F.col(value)).alias("_v"))
    limits = F.broadcast(dims.hard_limits(spark))  # 6 fixed rows
    outside = (F.col("_v") > F.col("ref_max")) | (F.col("_v") < F.col("ref_min"))
    summary = (
        lookup_join(clean, stats, "variable", "left")
        .groupBy("variable", "ref_mean")
        .agg(
            F.avg("_v").alias("mean"),
            F.min("_v").alias("min"),
            F.max("_v").alias("max"),
            F.count_if(outside).alias("_outside"),
            F.count(F.lit(1)).alias("_rows"),
        )
        .join(limits, "variable", "left")
    )
    gap = physics.magnitude_gap(F.col("ref_mean"), F.col("mean"))
    return summary.select(
        "variable",
        "mean",
        "min",
        "max",
        F.col("ref_mean").isNotNull().alias("has_stats"),
        gap.alias("magnitude_gap"),
        # the logarithm of 0 is minus infinity: an infinite gap; of a negative mean: no statement
        F.coalesce(F.when(F.col("mean") == 0, F.col("ref_mean").isNotNull()).otherwise(F.abs(gap) > MAGNITUDE_LIMIT), F.lit(False)).alias(
            "magnitude_concern"
        ),
        F.when(F.col("ref_mean").isNotNull(), F.col("_outside") / F.col("_rows")).alias("outside_fraction"),
        ((F.col("_outside") / F.col("_rows")) > OUTSIDE_LIMIT).alias("range_concern"),
        F.coalesce((F.col("max") > F.col("hard_max")) | (F.col("min") < F.col("hard_min")), F.lit(False)).alias(
            "hard_limit_concern"
        ),
    )


def negative_report(df: DataFrame, variable: str = "variable", value: str = "value", names: Sequence[str] | None = None) -> DataFrame:
    """Number of negative values of each variable that cannot be negative."""
    names = dims.NON_NEGATIVE if names is None else names
    return df.where(F.col(variable).isin(list(names))).groupBy(variable).agg(F.count_if(F.col(value) < 0).alias("n_negative"))


def compare_sources(
    left: DataFrame, right: DataFrame, keys: Sequence[str], value: str = "value", variable: str = "variable",
    right_names: dict[str, str] | None = None,
) -> DataFrame:
    """Bias, RMS difference and correlation of two sources on their common keys.

    ``right_names`` maps names of the right source to those of the left one (for example
    ``{"UWIND": "WIND"}``).  Repeated keys are averaged first, so each key counts once.
    """
    name = F.col(variable)
    for other, own in (right_names or {}).items():
        name = F.when(F.col(variable) == other, F.lit(own)).otherwise(name)
    a = left.groupBy(variable, *keys).agg(F.avg(value).alias("_a"))
    b = right.withColumn(variable, name).groupBy(variable, *keys).agg(F.avg(value).alias("_b"))
    diff = F.col("_a") - F.col("_b")
    return (
        a.join(b, [variable, *keys])
        .groupBy(variable)
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.avg(diff).alias("bias"),
            F.sqrt(F.avg(diff * diff)).alias("rmse"),
            F.corr("_a", "_b").alias("correlation"),
        )
    )


def axis_check(
    expected: DataFrame, actual: DataFrame, keys: Sequence[str], position: str, value: str, atol: float = 1e-6, rtol: float = 1e-5
) -> DataFrame:
    """Count disagreements of two axes per key; a position present on one side only disagrees."""
    both = expected.select(*keys, position, F.col(value).alias("_e")).join(
        actual.select(*keys, position, F.col(value).alias("_a")), [*keys, position], "full_outer"
    )
    close = F.abs(F.col("_e") - F.col("_a")) <= F.lit(atol) + F.lit(rtol) * F.abs(F.col("_a"))
    return both.groupBy(*keys).agg(
        F.count("_e").alias("n_expected"),
        F.count("_a").alias("n_actual"),
        F.count_if(~F.coalesce(close, F.lit(False))).alias("n_mismatch"),
    )
