import datetime as dt

import pandas as pd
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from metforge.functions import temporal
from metforge.operators import timeaxis
from metforge.operators.catalog import in_window


def stamps(spark, texts, gid="a"):
    return spark.createDataFrame([(gid, t) for t in texts], "gid string, t string").select("gid", temporal.naive(F.col("t")).alias("time"))


def hourly(spark, start, end, drop_leap=True):
    times = pd.date_range(start, end, freq="h")
    if drop_leap:
        times = times[~((times.month == 2) & (times.day == 29))]
    rows = [("a", t.strftime("%Y-%m-%d %H:%M"), float(i)) for i, t in enumerate(times)]
    df = spark.createDataFrame(rows, "gid string, t string, v double")
    return df.select("gid", temporal.naive(F.col("t")).alias("time"), "v")


def test_complete_years(spark):
    d = stamps(spark, ["1999-03-01", "2000-01-01", "2000-12-31", "2001-01-01", "2001-12-31", "2002-01-01"])
    assert tuple(timeaxis.complete_years(d, "time", "noleap").first()) == (2000, 2001)
    few = stamps(spark, ["1999-03-01", "2002-01-01"])
    assert tuple(timeaxis.complete_years(few, "time").first()) == (1999, 2002)


def test_axis_with_removed_leap_day(new_york):
    d = stamps(new_york, ["2000-02-28 00:00", "2000-03-01 06:00"])
    got = timeaxis.with_dtime(d, ["gid"], "time", "days", "noleap").orderBy("time").collect()
    assert [r["dtime"] for r in got] == [0.0, 2.25]
    assert got[0]["dtime_units"] == "days since 2000-02-28 00:00:00"
    short = timeaxis.with_dtime(d, ["gid"], "time", "days", "noleap", mode="calendar").orderBy("time").collect()
    assert [r["dtime"] for r in short] == [0.0, 1.25]
    with pytest.raises(ValueError):
        timeaxis.with_dtime(d, ["gid"], "time", "minutes")


def test_resample(new_york):
    d = hourly(new_york, "2000-02-28 01:00", "2000-03-01 05:00")
    mean = {r["time"]: r["v"] for r in timeaxis.resample_mean(d, ["gid"], "time", ["v"], 3, "noleap").collect()}
    assert mean[dt.datetime(2000, 2, 28)] == 0.5
    assert mean[dt.datetime(2000, 2, 28, 3)] == 3
    assert mean[dt.datetime(2000, 2, 28, 21)] == 21
    assert mean[dt.datetime(2000, 3, 1)] == 48 - 24 and mean[dt.datetime(2000, 3, 1, 3)] == 51 - 24
    assert not [t for t in mean if (t.month, t.day) == (2, 29)]
    pick = {r["time"]: r["v"] for r in timeaxis.resample_pick(d, ["gid"], "time", ["v"], 3, "noleap").collect()}
    assert pick[dt.datetime(2000, 2, 28)] is None and pick[dt.datetime(2000, 2, 28, 3)] == 2
    assert set(pick) == set(mean)


@pytest.mark.parametrize("hours", [2, 5, 7, 24, 36])
def test_resample_matches_pandas(spark, hours):
    d = hourly(spark, "2001-01-01 05:00", "2001-01-09 17:00")
    got = timeaxis.resample_mean(d, ["gid"], "time", ["v"], hours).orderBy("time").toPandas()
    want = d.toPandas().set_index("time")[["v"]].resample(f"{hours}h").mean().dropna().reset_index()
    assert list(got["time"]) == list(want["time"])
    assert list(got["v"]) == pytest.approx(list(want["v"]))


def test_reindex_gap_and_duplicate(spark):
    d = hourly(spark, "2001-01-01 00:00", "2001-01-01 03:00")
    axis = stamps(spark, ["2001-01-01 01:00", "2001-01-01 09:00"])
    got = timeaxis.reindex(d, axis, ["gid"], "time", ["v"]).orderBy("time").collect()
    assert [r["v"] for r in got] == [1.0, None]
    twice = d.unionByName(d.withColumn("v", F.col("v") + 1))
    with pytest.raises(PySparkException, match="duplicate time"):
        timeaxis.reindex(twice, axis, ["gid"], "time", ["v"]).collect()
    kept = timeaxis.unique_rows(twice, ["gid"], "time", ["v"], "lowest").orderBy("time").collect()
    assert [r["v"] for r in kept] == [0.0, 1.0, 2.0, 3.0]


@pytest.mark.parametrize("step", ["pick", "reindex"])
def test_stamps_stay_dealt(spark, step):
    """Few bytes of many stamps are not merged into one task after the shuffle, whatever was shuffled before."""
    d = hourly(spark, "2001-01-01 00:00", "2001-04-01 00:00").groupBy("gid", "time").agg(F.max("v").alias("v"))
    if step == "pick":
        out = timeaxis.resample_pick(d, ["gid"], "time", ["v"], 3)
    else:
        out = timeaxis.reindex(d, d.select("gid", (F.col("time") + F.expr("INTERVAL '30' MINUTE")).alias("time")).distinct(), ["gid"], "time", ["v"])
    parts = [r["count"] for r in out.groupBy(F.spark_partition_id().alias("part")).count().collect()]
    assert len(parts) > 1 and max(parts) < sum(parts) / 2


def batches(spark, start, end, years):
    d = spark.createDataFrame([(start, end)], "s string, e string")
    return [tuple(str(v) for v in r) for r in timeaxis.date_batches(d, "s", "e", years).orderBy("task_start").collect()]


def test_batches(spark):
    assert batches(spark, "2018-01-01", "2024-06-30", 2) == [
        ("2018-01-01", "2020-01-01"), ("2020-01-01", "2022-01-01"), ("2022-01-01", "2024-01-01"), ("2024-01-01", "2024-06-30"),
    ]
    assert batches(spark, "2024-01-01", "2024-01-01", 5) == []
    assert batches(spark, "2025-01-01", "2024-01-01", 5) == []
    assert [b[0] for b in batches(spark, "2016-02-29", "2021-01-01", 1)] == [
        "2016-02-29", "2017-02-28", "2018-02-28", "2019-02-28", "2020-02-28",
    ]


@pytest.mark.parametrize("years", [1, 3, 10])
def test_batches_tile_the_interval(spark, years):
    got = batches(spark, "1950-03-07", "2025-11-30", years)
    assert got[0][0] == "1950-03-07" and got[-1][1] == "2025-11-30"
    assert all(a[1] == b[0] and a[0] < a[1] for a, b in zip(got, got[1:]))


def test_micros_round_trip_before_1970(new_york):
    d = stamps(new_york, ["1949-12-31 23:59:59.500001", "1970-01-01", "2024-03-10 02:30:00"])
    us = temporal.micros(F.col("time"))
    got = d.select(us.alias("us"), (temporal.from_micros(us) == F.col("time")).alias("same"), temporal.floor_to(us, 3600_000_000).alias("f")).collect()
    assert all(r["same"] for r in got)
    assert all(r["f"] <= r["us"] < r["f"] + 3600_000_000 for r in got)


def test_day_windows(spark):
    d = stamps(spark, ["2000-01-01", "2000-01-31 23:59", "2000-02-01"])
    assert d.where(temporal.in_days(F.col("time"), "2000-01-01", "2000-01-31")).count() == 2
    assert d.where(temporal.in_half_open(F.col("time"), "2000-01-01", "2000-01-31")).count() == 1


def test_calendar_window(spark):
    rows = [("360_day", 2000, 1, 30, 0), ("360_day", 2000, 1, 30, 60), ("360_day", 2000, 2, 1, 0), ("noleap", 2000, 1, 31, 0), ("noleap", 2000, 1, 31, 1), ("360_day", 1999, 2, 30, 0)]
    d = spark.createDataFrame(rows, "calendar string, year int, month int, day int, second int")
    kept = {tuple(r) for r in in_window(d, "1999-02-28", "2000-01-31").collect()}
    assert kept == {rows[0], rows[3], rows[5]}


def test_decode_offsets(new_york):
    rows = [("standard", 59.25), ("noleap", 59.25), ("360_day", 59.25), ("noleap", 365.0), ("360_day", 360.0)]
    d = new_york.createDataFrame(rows, "calendar string, o double")
    f = temporal.decode_offset(F.col("o"), F.lit("days since 2000-01-01 00:00:00"), F.col("calendar"))
    iso = temporal.civil_iso(*[f[c] for c in ("year", "month", "day", "second")])
    assert [r[0] for r in d.select(iso).collect()] == [
        "2000-02-29 06:00:00", "2000-03-01 06:00:00", "2000-02-30 06:00:00", "2001-01-01 00:00:00", "2001-01-01 00:00:00",
    ]
    hours = temporal.decode_offset(F.lit(30.5), F.lit("hours since 2000-12-31 00:00"), F.lit("standard"))
    assert tuple(new_york.range(1).select(hours.alias("h")).first()["h"]) == (2001, 1, 1, 23400)


def test_time_steps_cross_bucket_borders(spark):
    d = stamps(spark, ["2000-01-01 00:00", "2000-01-01 23:00", "2000-01-09 00:00", "2000-01-09 00:30"])
    got = timeaxis.time_steps(d, ["gid"], "time").orderBy("time").collect()
    assert [r["step_hours"] for r in got] == [23.0, 169.0, 0.5]
    assert [r["model_steps"] for r in got] == [46.0, 338.0, 1.0]
