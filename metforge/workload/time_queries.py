"""Years, windows, batches, axes, resampling, calendars."""

from __future__ import annotations

from pyspark.sql import functions as F

from metforge.functions import temporal
from metforge.operators import timeaxis
from metforge.workload import views
from metforge.workload.registry import query
from metforge.workload.views import rounded

STAMP = "strftime({c}, '%Y-%m-%d %H:%M:%S')"


def stamped(df, *columns):
    return df.withColumns({c: temporal.stamp(F.col(c)) for c in columns})


def orders(spark, sf):
    t = views.table(spark, sf, "orders")
    return t.withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp_ntz"))


def _years(table: str, t: str, by: str = "", leap: str = "") -> str:
    keys = f"{by}, " if by else ""
    return f"""WITH y AS (SELECT {keys}year({t}) AS y, bool_or(month({t}) * 100 + day({t}) = 101)
  AND bool_or(month({t}) * 100 + day({t}) = 1231) AS ok FROM {table} {leap} GROUP BY ALL)
SELECT {keys}CAST(coalesce(min(CASE WHEN ok THEN y END), min(y)) AS INTEGER) AS start_year,
 CAST(coalesce(max(CASE WHEN ok THEN y END), max(y)) AS INTEGER) AS end_year FROM y {"GROUP BY " + by if by else ""}"""


@query(_years("orders", "o_orderdate"))
def complete_years(spark, sf):
    return timeaxis.complete_years(orders(spark, sf), "o_orderdate", "noleap")


@query(_years("events", "ts"))
def complete_years_fallback(spark, sf):
    return timeaxis.complete_years(views.table(spark, sf, "events"), "ts")


@query(_years("order_axis", "time", "gid"), ("order_axis",))
def complete_years_by_site(spark, sf):
    return timeaxis.complete_years(views.order_axis(spark, sf), "time", by=["gid"])


@query(
    f"SELECT o_orderkey, {STAMP.format(c='o_orderdate')} AS o_orderdate FROM orders WHERE NOT (month(o_orderdate) = 2 AND day(o_orderdate) = 29)"
)
def drop_leap_days(spark, sf):
    return stamped(timeaxis.drop_leap_days(orders(spark, sf), "o_orderdate").select("o_orderkey", "o_orderdate"), "o_orderdate")


@query(f"SELECT o_orderkey, {STAMP.format(c='o_orderdate')} AS o_orderdate FROM orders WHERE year(o_orderdate) BETWEEN 1996 AND 1998")
def year_range(spark, sf):
    return stamped(timeaxis.keep_years(orders(spark, sf), "o_orderdate", 1996, 1998).select("o_orderkey", "o_orderdate"), "o_orderdate")


@query(
    f"SELECT event_id, {STAMP.format(c='ts')} AS ts FROM events WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-12'"
)
def half_open_window(spark, sf):
    e = views.table(spark, sf, "events")
    return stamped(e.where(temporal.in_half_open(F.col("ts"), "2024-01-05", "2024-01-12")).select("event_id", "ts"), "ts")


@query(
    f"SELECT event_id, {STAMP.format(c='ts')} AS ts FROM events WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-12'"
)
def inclusive_days(spark, sf):
    e = views.table(spark, sf, "events")
    return stamped(e.where(temporal.in_days(F.col("ts"), "2024-01-05", "2024-01-12")).select("event_id", "ts"), "ts")


@query(
    """WITH b AS (SELECT o_custkey, CAST(min(o_orderdate) AS DATE) AS s, CAST(max(o_orderdate) AS DATE) AS e FROM orders GROUP BY 1),
stepped AS (SELECT o_custkey, e, unnest(generate_series(0, 10)) AS i,
  CASE WHEN month(s) = 2 AND day(s) = 29 THEN s - INTERVAL 1 day ELSE s END AS base, s FROM b),
brk AS (SELECT o_custkey, e, CAST(CASE WHEN i = 0 THEN s ELSE base + to_years(2 * i) END AS DATE) AS task_start,
  CAST(base + to_years(2 * (i + 1)) AS DATE) AS nxt FROM stepped)
SELECT o_custkey, strftime(task_start, '%Y-%m-%d') AS task_start, strftime(least(nxt, e), '%Y-%m-%d') AS task_end FROM brk WHERE task_start < e"""
)
def date_batches(spark, sf):
    spans = orders(spark, sf).groupBy("o_custkey").agg(F.min("o_orderdate").alias("s"), F.max("o_orderdate").alias("e"))
    out = timeaxis.date_batches(spans, "s", "e", 2, keys=["o_custkey"])
    return out.select("o_custkey", F.col("task_start").cast("string").alias("task_start"), F.col("task_end").cast("string").alias("task_end"))


@query(f"SELECT {STAMP.format(c='max(ts)')} AS latest FROM events")
def latest_time(spark, sf):
    return stamped(timeaxis.latest_time(views.table(spark, sf, "events"), "ts"), "latest")


@query(
    f"SELECT gid, {STAMP.format(c='time')} AS time, row_number() OVER (ORDER BY gid, time) - 1 AS place FROM (SELECT DISTINCT gid, time FROM station)", ("station",)
)
def distinct_times(spark, sf):
    """The place of each stamp is read off the order in which the rows come."""
    return stamped(views.placed(timeaxis.distinct_times(views.station(spark, sf), "time", ["gid"]), ["gid", "time"]).select("gid", "time", "place"), "time")


@query(
    """SELECT o_orderkey FROM orders WHERE o_orderdate = (SELECT min(o_orderdate) FROM orders
 WHERE o_orderdate >= TIMESTAMP '1997-03-01' AND o_orderdate < TIMESTAMP '1998-01-01')"""
)
def first_time_rows(spark, sf):
    return timeaxis.first_time_rows(orders(spark, sf), "o_orderdate", "1997-03-01", "1998-01-01").select("o_orderkey")


def _axis_sql(divisor: str, unit: str, table: str) -> str:
    return f"""WITH t AS (SELECT gid, time, min(time) OVER (PARTITION BY gid) AS t0 FROM {table})
SELECT gid, {STAMP.format(c='time')} AS time, round(date_diff('microsecond', t0, time) / {divisor}, 6) AS dtime,
 '{unit} since ' || {STAMP.format(c='t0')} AS dtime_units FROM t"""


def _axis(df):
    return df.select("gid", temporal.stamp(F.col("time")).alias("time"), rounded("dtime").alias("dtime"), "dtime_units")


@query(_axis_sql("86400000000e0", "days", "series"), ("series",))
def time_axis_days(spark, sf):
    return _axis(timeaxis.with_dtime(views.series(spark, sf), ["gid"], "time", "days"))


@query(_axis_sql("3600000000e0", "hours", "series"), ("series",))
def time_axis_hours(spark, sf):
    return _axis(timeaxis.with_dtime(views.series(spark, sf), ["gid"], "time", "hours"))


NOLEAP = """year({c}) * 365 + dayofyear({c}) - 1 - CASE WHEN month({c}) > 2 AND ((year({c}) % 4 = 0 AND year({c}) % 100 <> 0)
 OR year({c}) % 400 = 0) THEN 1 ELSE 0 END"""


@query(
    f"""WITH a AS (SELECT gid, time FROM order_axis WHERE NOT (month(time) = 2 AND day(time) = 29)),
t AS (SELECT gid, time, min(time) OVER (PARTITION BY gid) AS t0 FROM a)
SELECT gid, {STAMP.format(c='time')} AS time, CAST(({NOLEAP.format(c='time')}) - ({NOLEAP.format(c='t0')}) AS DOUBLE) AS dtime,
 'days since ' || {STAMP.format(c='t0')} AS dtime_units FROM t""",
    ("order_axis",),
)
def time_axis_noleap(spark, sf):
    axis = timeaxis.drop_leap_days(views.order_axis(spark, sf), "time", "noleap")
    return _axis(timeaxis.with_dtime(axis, ["gid"], "time", "days", "noleap", mode="calendar"))


@query(
    f"""WITH n AS (SELECT gid, time, lead(time) OVER (PARTITION BY gid ORDER BY time) AS nxt FROM station)
SELECT gid, {STAMP.format(c='time')} AS time, date_diff('microsecond', time, nxt) / 3600000000e0 AS step_hours,
 date_diff('microsecond', time, nxt) / 3600000000e0 * 2e0 AS model_steps FROM n WHERE nxt IS NOT NULL""",
    ("station",),
)
def time_step(spark, sf):
    axis = timeaxis.time_axis(views.station(spark, sf), ["gid"], "time", [])
    return stamped(timeaxis.time_steps(axis, ["gid"], "time"), "time")


VALUES = ["TBOT", "PSRF"]


def _bins(hours: int) -> str:
    width = hours * 3600000000
    return f"""kept AS (SELECT * FROM station WHERE NOT (month(time) = 2 AND day(time) = 29)),
o AS (SELECT gid, min(CAST(CAST(time AS DATE) AS TIMESTAMP)) AS day0 FROM kept GROUP BY gid),
binned AS (SELECT kept.*, day0 + to_microseconds((date_diff('microsecond', day0, time) // {width}) * {width}) AS bin FROM kept JOIN o USING (gid))"""


def _resample_sql(hours: int) -> str:
    return f"""WITH {_bins(hours)} SELECT gid, {STAMP.format(c='bin')} AS time, round(avg(TBOT), 6) AS TBOT, round(avg(PSRF), 6) AS PSRF
 FROM binned GROUP BY gid, bin"""


def _resampled(spark, sf, hours):
    out = timeaxis.resample_mean(views.station(spark, sf), ["gid"], "time", VALUES, hours, "noleap")
    return stamped(out, "time").withColumns({c: rounded(c) for c in VALUES})


@query(_resample_sql(3), ("station",))
def resample_mean(spark, sf):
    return _resampled(spark, sf, 3)


@query(_resample_sql(7), ("station",))
def resample_mean_uneven(spark, sf):
    return _resampled(spark, sf, 7)


@query(
    f"""WITH {_bins(3)}, axis AS (SELECT DISTINCT gid, bin AS time FROM binned)
SELECT gid, {STAMP.format(c='time')} AS time, round(TBOT, 6) AS TBOT, round(PSRF, 6) AS PSRF FROM axis LEFT JOIN kept USING (gid, time)""",
    ("station",),
)
def resample_pick(spark, sf):
    out = timeaxis.resample_pick(views.station(spark, sf), ["gid"], "time", VALUES, 3, "noleap")
    return stamped(out, "time").withColumns({c: rounded(c) for c in VALUES})


@query(
    f"""WITH axis AS (SELECT g.gid, t.time FROM (SELECT DISTINCT gid FROM station) g JOIN (SELECT DISTINCT gid, CAST(CAST(time AS DATE) AS TIMESTAMP) + INTERVAL 4 hour AS time FROM station) t USING (gid))
SELECT gid, {STAMP.format(c='time')} AS time, round(TBOT, 6) AS TBOT FROM axis LEFT JOIN station USING (gid, time)""",
    ("station",),
)
def reindex_gaps(spark, sf):
    station = views.station(spark, sf)
    axis = station.select("gid", (temporal.midnight(F.col("time")) + views.day_hours(F.lit(4))).alias("time")).distinct()
    out = timeaxis.reindex(station, axis, ["gid"], "time", ["TBOT"])
    return stamped(out, "time").withColumn("TBOT", rounded("TBOT"))


@query(
    f"""WITH d AS (SELECT gid, date AS time, min({{'t': temperature_2m, 'p': surface_pressure}}) AS r FROM hourly GROUP BY 1, 2)
SELECT gid, {STAMP.format(c='time')} AS time, round(r.t, 6) AS temperature_2m, round(r.p, 6) AS surface_pressure FROM d""",
    ("hourly",),
)
def duplicate_stamps(spark, sf):
    values = ["temperature_2m", "surface_pressure"]
    rows = views.hourly(spark, sf).withColumnRenamed("date", "time")
    out = timeaxis.unique_rows(rows, ["gid"], "time", values, on_duplicate="lowest")
    return stamped(out, "time").withColumns({c: rounded(c) for c in values})


# --- model calendars --------------------------------------------------------------------

ISO = "printf('%04d-%02d-%02d %02d:%02d:%02d', year, month, day, second // 3600, (second % 3600) // 60, second % 60)"
IN_WINDOW = """(year * 10000 + month * 100 + day >= CASE WHEN calendar = '360_day' THEN 19960130 ELSE 19960131 END
 AND (year * 10000 + month * 100 + day < CASE WHEN calendar = '360_day' THEN 19981030 ELSE 19981031 END
  OR (year * 10000 + month * 100 + day = CASE WHEN calendar = '360_day' THEN 19981030 ELSE 19981031 END AND second = 0)))"""


@query(f"SELECT o_orderkey, calendar, {ISO} AS date FROM climate WHERE {IN_WINDOW}", ("climate",))
def calendar_window_360(spark, sf):
    from metforge.operators.catalog import in_window

    rows = in_window(views.climate(spark, sf), "1996-01-31", "1998-10-31")
    iso = temporal.civil_iso(F.col("year"), F.col("month"), F.col("day"), F.col("second"))
    return rows.select("o_orderkey", "calendar", iso.alias("date"))


@query(
    f"""WITH x AS (SELECT o_orderkey, o_orderdate, CASE o_orderkey % 3 WHEN 0 THEN 'standard' WHEN 1 THEN 'noleap' ELSE '360_day' END AS calendar,
  TIMESTAMP '1995-01-01' AS t0 FROM orders WHERE NOT (month(o_orderdate) = 2 AND day(o_orderdate) = 29)),
n AS (SELECT *, date_diff('day', t0, o_orderdate) AS g, ({NOLEAP.format(c='o_orderdate')}) - ({NOLEAP.format(c='t0')}) AS d365 FROM x)
SELECT o_orderkey, calendar, CASE calendar WHEN 'noleap' THEN strftime(o_orderdate, '%Y-%m-%d') || ' 06:00:00'
 WHEN 'standard' THEN strftime(t0 + to_days(CAST(d365 AS INTEGER)), '%Y-%m-%d') || ' 06:00:00'
 ELSE printf('%04d-%02d-%02d 06:00:00', 1995 + d365 // 360, (d365 % 360) // 30 + 1, d365 % 30 + 1) END AS date FROM n"""
)
def decode_offsets(spark, sf):
    t0 = temporal.day_bound("1995-01-01")
    k = F.col("o_orderkey")
    rows = timeaxis.drop_leap_days(orders(spark, sf), "o_orderdate").select(
        "o_orderkey",
        F.when(k % 3 == 0, "standard").when(k % 3 == 1, "noleap").otherwise("360_day").alias("calendar"),
        (temporal.elapsed_noleap(F.col("o_orderdate"), t0, "days") + 0.25).alias("offset"),
    )
    units = F.lit("days since 1995-01-01 00:00:00")
    decoded = rows.withColumn("f", temporal.decode_offset(F.col("offset"), units, F.col("calendar")))
    iso = temporal.civil_iso(F.col("f.year"), F.col("f.month"), F.col("f.day"), F.col("f.second"))
    return decoded.select("o_orderkey", "calendar", iso.alias("date"))
