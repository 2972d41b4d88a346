"""Years, batches, axes and resampling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metforge import dims
from metforge.functions import temporal
from metforge.operators.ordering import next_in_time
from metforge.operators.skew import dealt, lookup_join
from metforge.session import materialize


def drop_leap_days(df: DataFrame, time: str, calendar: str = "noleap") -> DataFrame:
    """Remove Feb 29 for a calendar without it; other calendars pass through."""
    if temporal.keeps_leap_day(calendar):
        return df
    return df.where(~temporal.is_leap_day(F.col(time)))


def complete_years(df: DataFrame, time: str, calendar: str = "standard", by: Sequence[str] = ()) -> DataFrame:
    """First and last complete year.

    A year is complete when it has rows on Jan 1 and on Dec 31; gaps inside it are not
    looked at.  Without any complete year the first and last year present are returned.
    """
    dates = df.select(*by, temporal.naive(F.col(time)).alias("_t"))
    dates = drop_leap_days(dates, "_t", calendar)
    code = temporal.month_day(F.col("_t"))
    yearly = dates.groupBy(*by, F.year("_t").alias("_y")).agg(
        (F.bool_or(code == 101) & F.bool_or(code == 1231)).alias("_complete")
    )
    full = F.when(F.col("_complete"), F.col("_y"))
    return yearly.groupBy(*by).agg(
        F.coalesce(F.min(full), F.min("_y")).alias("start_year"),
        F.coalesce(F.max(full), F.max("_y")).alias("end_year"),
    )


def keep_years(df: DataFrame, time: str, first: int, last: int) -> DataFrame:
    return df.where(temporal.in_years(F.col(time), first, last))


def latest_time(df: DataFrame, time: str) -> DataFrame:
    return df.agg(F.max(time).alias("latest"))


def distinct_times(df: DataFrame, time: str, keys: Sequence[str] = ()) -> DataFrame:
    """Distinct stamps in order."""
    return df.select(*keys, time).distinct().orderBy(*keys, time)


def first_time_rows(df: DataFrame, time: str, start: str, end: str) -> DataFrame:
    """All rows of the earliest stamp in ``[start, end)``."""
    window = df.where(temporal.in_half_open(F.col(time), start, end))
    first = window.agg(F.min(time).alias(time))  # one row
    return window.join(F.broadcast(first), time, "left_semi")


def date_batches(intervals: DataFrame, start: str, end: str, years: int = 5, keys: Sequence[str] = ()) -> DataFrame:
    """Split each ``[start, end)`` interval of dates into batches of ``years``.

    Breaks are stepped one from the other (a Feb 29 start moves to Feb 28 and stays
    there); the last batch is cut at ``end``; an empty interval has no batches.
    """
    s, e = F.col(start).cast("date"), F.col(end).cast("date")
    # enough steps to pass the end: a calendar year never has fewer than 365 days
    steps = F.greatest(F.lit(0), F.ceil(F.datediff(e, s) / F.lit(365 * years)).cast("int"))
    breaks = F.aggregate(
        F.sequence(F.lit(1), F.greatest(steps, F.lit(1))),
        F.array(s),
        lambda acc, _: F.concat(acc, F.array(F.add_months(F.element_at(acc, -1), 12 * years))),
    )
    return (
        intervals.select(*keys, e.alias("_end"), breaks.alias("_breaks"))
        .select(*keys, "_end", "_breaks", F.posexplode(F.slice("_breaks", F.lit(1), F.size("_breaks") - 1)).alias("_i", "task_start"))
        .where(F.col("task_start") < F.col("_end"))
        .select(*keys, "task_start", F.least(F.col("_breaks")[F.col("_i") + 1], F.col("_end")).alias("task_end"))
    )


def _bin_start(df: DataFrame, keys: Sequence[str], time: str, hours: int) -> DataFrame:
    """Add ``_bin``: start of the ``hours``-wide bin, counted from midnight of the key's first day."""
    width = hours * temporal.HOUR_US
    us = temporal.micros(F.col(time))
    if 24 % hours == 0:  # every midnight is a bin edge, whatever the first day
        return df.withColumn("_bin", temporal.from_micros(temporal.floor_to(us, width)))
    names = list(keys) or ["_all"]
    df = df if keys else df.withColumn("_all", F.lit(0))
    first = materialize(df.groupBy(*names).agg(F.min(time).alias("_first")))
    origin = temporal.micros(temporal.midnight(F.col("_first")))
    out = lookup_join(df, first, names).withColumn(
        "_bin", temporal.from_micros(origin + temporal.floor_to(us - origin, width))
    )
    return out.drop("_first", "_all")


def resample_mean(
    df: DataFrame, keys: Sequence[str], time: str, values: Sequence[str], hours: int, calendar: str = "standard"
) -> DataFrame:
    """Bin means labelled with the bin start; bins with a missing mean are dropped."""
    rows = _bin_start(drop_leap_days(df, time, calendar), keys, time, hours)
    means = rows.groupBy(*keys, F.col("_bin").alias(time)).agg(*[F.avg(v).alias(v) for v in values])
    return means.na.drop(subset=list(values))


def time_axis(
    df: DataFrame, keys: Sequence[str], time: str, values: Sequence[str], hours: int = 1, calendar: str = "standard"
) -> DataFrame:
    """The stamps a data set is written at: its own, or the non-empty bins of a coarser step."""
    if hours > 1:
        return resample_mean(df, keys, time, values, hours, calendar).select(*keys, time)
    return drop_leap_days(df, time, calendar).select(*keys, time).distinct()


def unique_rows(df: DataFrame, keys: Sequence[str], time: str, values: Sequence[str], on_duplicate: str = "error") -> DataFrame:
    """One row per key and stamp.

    Duplicate stamps of one key are an error when the rows are read, or with
    ``on_duplicate="lowest"`` the row that sorts first is kept.
    """
    grouped = df.groupBy(*keys, time)
    if on_duplicate == "lowest":
        return grouped.agg(F.min(F.struct(*values)).alias("_row")).select(*keys, time, "_row.*")
    if on_duplicate != "error":
        raise ValueError("on_duplicate must be 'error' or 'lowest'")
    single = grouped.agg(F.count(F.lit(1)).alias("_n"), *[F.first(v).alias(v) for v in values])
    message = F.concat(F.lit("duplicate time "), F.col(time).cast("string"))
    checked = lambda v: F.when(F.col("_n") > 1, F.raise_error(message)).otherwise(F.col(v)).alias(v)
    return single.select(*keys, time, *[checked(v) for v in values])


def reindex(
    df: DataFrame, axis: DataFrame, keys: Sequence[str], time: str, values: Sequence[str], on_duplicate: str = "error"
) -> DataFrame:
    """Values at the stamps of ``axis``; a stamp without data has nulls."""
    if on_duplicate == "error":  # "lowest" may meet any number of rows of one stamp, and combines them before they are shuffled
        # time first: an earlier shuffle by keys and time, with its parts merged, would be taken for this one
        df, axis = dealt(df, [time, *keys]), dealt(axis, [time, *keys])
    return axis.join(unique_rows(df, keys, time, values, on_duplicate), [*keys, time], "left")


def resample_pick(
    df: DataFrame,
    keys: Sequence[str],
    time: str,
    values: Sequence[str],
    hours: int,
    calendar: str = "standard",
    on_duplicate: str = "error",
    origin: Sequence[str] | None = None,
) -> DataFrame:
    """Coarser axis from the bins, values as observed exactly at the bin starts.

    Bins are counted from the first day of each key, or of each group of the columns ``origin`` (among
    ``keys``), whose keys then share their bins.

    They are otherwise those of :func:`resample_mean`; a bin whose start was not observed has
    nulls.  Rows are dealt by bin, so that the stamps of a bin and the bin itself are settled in the same task.
    """
    binned = _bin_start(drop_leap_days(df, time, calendar), keys if origin is None else origin, time, hours)
    bins = [*keys, "_bin"]
    if on_duplicate == "error":  # as in reindex
        binned = dealt(binned, bins)
    single = unique_rows(binned, bins, time, values, on_duplicate)
    at_start = F.col(time) == F.col("_bin")
    picked = single.groupBy(*keys, F.col("_bin").alias("_start")).agg(
        *[F.max(F.when(at_start, F.col(v))).alias(v) for v in values],
        *[F.count(v).alias(f"_n_{v}") for v in values],
    )
    # a mean exists when the bin has a value
    for v in values:
        picked = picked.where(F.col(f"_n_{v}") > 0)
    return picked.select(*keys, F.col("_start").alias(time), *values)


def dtime_columns(
    time: Column, first: Column, units: str = "days", calendar: str = "standard", mode: str = "elapsed"
) -> dict[str, Column]:
    """``dtime`` (offset of ``time`` from ``first``) and its ``dtime_units`` text.

    ``elapsed`` counts real time even for data without leap days; ``calendar`` counts on
    the 365-day calendar when ``calendar`` is noleap.
    """
    if units not in temporal.UNIT_US:
        raise ValueError("units must be 'days' or 'hours'")
    if mode not in ("elapsed", "calendar"):
        raise ValueError("mode must be 'elapsed' or 'calendar'")
    shorter = mode == "calendar" and not temporal.keeps_leap_day(calendar)
    measure = temporal.elapsed_noleap if shorter else temporal.elapsed
    return {
        "dtime": measure(time, first, units),
        "dtime_units": F.concat(F.lit(f"{units} since "), temporal.stamp(first)),
    }


def with_dtime(
    df: DataFrame, keys: Sequence[str], time: str, units: str = "days", calendar: str = "standard", mode: str = "elapsed"
) -> DataFrame:
    """Add the offset from each key's first stamp; see :func:`dtime_columns`."""
    added = dtime_columns(F.col(time), F.col("_first"), units, calendar, mode)
    first = materialize(df.groupBy(*keys).agg(F.min(time).alias("_first")))
    return lookup_join(df, first, keys).withColumns(added).drop("_first")


def time_steps(axis: DataFrame, keys: Sequence[str], time: str) -> DataFrame:
    """Hours to the next stamp and the number of model steps that fit in between."""
    ahead = next_in_time(axis, keys, time, "_next")
    hours: Column = (temporal.micros(F.col("_next")) - temporal.micros(F.col(time))) / F.lit(float(temporal.HOUR_US))
    return (
        ahead.where(F.col("_next").isNotNull())
        .withColumn("step_hours", hours)
        .withColumn("model_steps", F.col("step_hours") * F.lit(3600.0 / dims.MODEL_STEP_S))
        .drop("_next")
    )
