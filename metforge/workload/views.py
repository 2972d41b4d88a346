"""The driver tables in the shapes the operators work on, for Spark and as SQL text.

The driver tables hold no weather, so each view maps columns of one table by plain
arithmetic that is the same in both engines.  ``SQL`` holds the matching sub-queries.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from metforge.functions import geometry as geo
from metforge.session import stored

SQL: dict[str, str] = {}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def rounded(c: Column | str, digits: int = 6) -> Column:
    """Rounded half away from zero, for comparison between engines; adding 0.0 turns -0.0 into 0.0."""
    c = F.col(c) if isinstance(c, str) else c
    scale = float(10**digits)
    return F.signum(c) * F.floor(F.abs(c) * scale + 0.5) / scale + F.lit(0.0)


def placed(ordered: DataFrame, by: list[str]) -> DataFrame:
    """``place``: number of changes of ``by`` before each row, in the order in which the rows come.

    Partitions of a sorted table follow one another; only their first and last rows are put together.
    """
    rows = stored(ordered.withColumn("_at", F.monotonically_increasing_id()), "ordered")
    part, key = F.shiftright("_at", 33), F.struct(*by)
    inside = W.partitionBy("_part").orderBy("_at")
    rows = rows.withColumn("_part", part).withColumn("_new", F.coalesce((F.lag(key).over(inside) != key).cast("bigint"), F.lit(0).cast("bigint")))
    rows = rows.withColumn("_own", F.sum("_new").over(inside.rowsBetween(W.unboundedPreceding, 0)))
    ends = rows.groupBy("_part").agg(F.min_by(key, "_at").alias("first"), F.max_by(key, "_at").alias("last"), F.sum("_new").alias("n"))
    across = W.orderBy("_part")  # one row per partition
    step = F.coalesce((F.lag("last").over(across) != F.col("first")).cast("bigint"), F.lit(0).cast("bigint"))
    ends = ends.withColumn("_step", step).withColumn("_before", F.sum(F.col("_step") + F.coalesce(F.lag("n").over(across), F.lit(0))).over(across.rowsBetween(W.unboundedPreceding, 0)))
    return rows.join(F.broadcast(ends.select("_part", "_before")), "_part").withColumn("place", F.col("_own") + F.col("_before"))


def day_hours(hours: Column) -> Column:
    return F.expr("INTERVAL '0 01:00:00' DAY TO SECOND") * hours


SQL["sites"] = """
SELECT CAST(s_suppkey AS VARCHAR) AS gid,
       CAST((s_suppkey * 37) % 180 - 90 AS DOUBLE) + 0.25e0 AS lat,
       CAST((s_suppkey * 73) % 360 - 180 AS DOUBLE) + 0.25e0 AS lon
FROM supplier
"""


def sites(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("s_suppkey")
    return table(spark, sf, "supplier").select(
        k.cast("string").alias("gid"),
        (((k * 37) % 180 - 90).cast("double") + 0.25).alias("lat"),
        (((k * 73) % 360 - 180).cast("double") + 0.25).alias("lon"),
    )


SQL["hourly"] = """
SELECT CAST(l_suppkey AS VARCHAR) AS gid,
       l_shipdate + to_hours(l_linenumber) AS date,
       230e0 + 1.5e0 * l_quantity AS temperature_2m,
       (230e0 + 1.5e0 * l_quantity) - 100e0 * l_discount AS dewpoint_temperature_2m,
       80000e0 + l_extendedprice / 5e0 AS surface_pressure,
       100e0 * l_tax - 4e0 AS u_component_of_wind_10m,
       100e0 * l_discount - 5e0 AS v_component_of_wind_10m,
       l_discount - 0.02e0 AS total_precipitation_hourly,
       l_extendedprice * 36e0 AS surface_solar_radiation_downwards_hourly,
       l_quantity * 36000e0 AS surface_thermal_radiation_downwards_hourly
FROM lineitem
"""


def hourly(spark: SparkSession, sf: str) -> DataFrame:
    q, price, disc, tax = (F.col(c) for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax"))
    warm = 230.0 + 1.5 * q
    return table(spark, sf, "lineitem").select(
        F.col("l_suppkey").cast("string").alias("gid"),
        (F.col("l_shipdate").cast("timestamp_ntz") + day_hours(F.col("l_linenumber"))).alias("date"),
        warm.alias("temperature_2m"),
        (warm - 100.0 * disc).alias("dewpoint_temperature_2m"),
        (80000.0 + price / 5.0).alias("surface_pressure"),
        (100.0 * tax - 4.0).alias("u_component_of_wind_10m"),
        (100.0 * disc - 5.0).alias("v_component_of_wind_10m"),
        (disc - 0.02).alias("total_precipitation_hourly"),
        (price * 36.0).alias("surface_solar_radiation_downwards_hourly"),
        (q * 36000.0).alias("surface_thermal_radiation_downwards_hourly"),
    )


# unique (gid, time): the first row of each site and hour of the hourly view, by all its values
SQL["station"] = f"""
SELECT gid, date AS time, min(temperature_2m) AS TBOT, max(surface_pressure) AS PSRF,
       min(total_precipitation_hourly) AS PRECTmms
FROM ({SQL["hourly"]}) GROUP BY gid, date
"""


def station(spark: SparkSession, sf: str) -> DataFrame:
    return hourly(spark, sf).groupBy("gid", F.col("date").alias("time")).agg(
        F.min("temperature_2m").alias("TBOT"),
        F.max("surface_pressure").alias("PSRF"),
        F.min("total_precipitation_hourly").alias("PRECTmms"),
    )


SQL["series"] = "SELECT CAST(user_id % 20 AS VARCHAR) AS gid, ts AS time, value FROM events"


def series(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select(
        (F.col("user_id") % 20).cast("string").alias("gid"), F.col("ts").cast("timestamp_ntz").alias("time"), "value"
    )


# axis of order dates: daily stamps over several years, ten sites
SQL["order_axis"] = "SELECT DISTINCT CAST(o_custkey % 10 AS VARCHAR) AS gid, o_orderdate AS time FROM orders"


def order_axis(spark: SparkSession, sf: str) -> DataFrame:
    return (
        table(spark, sf, "orders")
        .select((F.col("o_custkey") % 10).cast("string").alias("gid"), F.col("o_orderdate").cast("timestamp_ntz").alias("time"))
        .distinct()
    )


SQL["catalogue"] = """
SELECT CAST(user_id AS VARCHAR) || 'm' || CAST(event_id % 20 AS VARCHAR) AS source_id, event_type AS variable_id,
       'exp' || CAST(event_id % 3 AS VARCHAR) AS experiment_id, 'Amon' AS table_id,
       'r' || CAST(event_id % 5 AS VARCHAR) || 'i1p1f1' AS member_id,
       'store/' || CAST(event_id AS VARCHAR) AS zstore
FROM events
"""


def catalogue(spark: SparkSession, sf: str) -> DataFrame:
    e = F.col("event_id")
    return (
        table(spark, sf, "events")
        .select(
            F.concat(F.col("user_id").cast("string"), F.lit("m"), (e % 20).cast("string")).alias("source_id"),
            F.col("event_type").alias("variable_id"),
            F.concat(F.lit("exp"), (e % 3).cast("string")).alias("experiment_id"),
            F.lit("Amon").alias("table_id"),
            F.concat(F.lit("r"), (e % 5).cast("string"), F.lit("i1p1f1")).alias("member_id"),
            F.concat(F.lit("store/"), e.cast("string")).alias("zstore"),
        )
    )


SQL["model_long"] = """
SELECT CAST(l_suppkey AS VARCHAR) AS gid, u.variable, u.value FROM lineitem,
LATERAL (VALUES ('TBOT', 230e0 + 1.5e0 * l_quantity), ('PSRF', 80000e0 + l_extendedprice / 5e0),
                ('FSDS', l_extendedprice / 100e0), ('PRECTmms', (l_discount - 0.02e0) / 3.6e0),
                ('RH', l_quantity * 2.2e0), ('WIND', l_quantity * 0.1e0), ('DTBOT', 200e0 + l_quantity)) AS u(variable, value)
"""


def model_long(spark: SparkSession, sf: str) -> DataFrame:
    q, price, disc = (F.col(c) for c in ("l_quantity", "l_extendedprice", "l_discount"))
    wide = table(spark, sf, "lineitem").select(
        F.col("l_suppkey").cast("string").alias("gid"),
        (230.0 + 1.5 * q).alias("TBOT"),
        (80000.0 + price / 5.0).alias("PSRF"),
        (price / 100.0).alias("FSDS"),
        ((disc - 0.02) / 3.6).alias("PRECTmms"),
        (q * 2.2).alias("RH"),
        (q * 0.1).alias("WIND"),
        (200.0 + q).alias("DTBOT"),
    )
    return wide.unpivot(["gid"], wide.columns[1:], "variable", "value")


# lattice of 40 rows: one cell per customer
SQL["cells"] = """
SELECT c_custkey AS cell_id, CAST(c_custkey % 40 AS DOUBLE) AS lat, CAST(c_custkey // 40 AS DOUBLE) AS lon,
       c_acctbal AS value FROM customer
"""


def cells(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("c_custkey")
    return table(spark, sf, "customer").select(
        k.alias("cell_id"),
        (k % 40).cast("double").alias("lat"),
        F.floor(k / 40).cast("double").alias("lon"),
        F.col("c_acctbal").alias("value"),
    )


SQL["cell_series"] = "SELECT o_custkey AS cell_id, o_orderdate AS time, o_totalprice AS value FROM orders"


def cell_series(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(
        F.col("o_custkey").alias("cell_id"), F.col("o_orderdate").cast("timestamp_ntz").alias("time"), F.col("o_totalprice").alias("value")
    )


# polygons around centres off the lattice: even ones reach 2.5 from theirs, odd ones hold no lattice point
SQL["zones"] = """
SELECT CAST(s_suppkey AS VARCHAR) AS gid,
       (s_suppkey // 5) * 2 + CASE WHEN s_suppkey % 2 = 0 THEN 3.4e0 ELSE 3.3e0 END AS cx,
       (s_suppkey % 5) * 8 + CASE WHEN s_suppkey % 2 = 0 THEN 3.4e0 ELSE 3.3e0 END AS cy,
       CASE WHEN s_suppkey % 2 = 0 THEN 2.5e0 ELSE 0.25e0 END AS h FROM supplier
"""


def zones(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("s_suppkey")
    shift = F.when(k % 2 == 0, 3.4).otherwise(3.3)
    return table(spark, sf, "supplier").select(
        k.cast("string").alias("gid"),
        (F.floor(k / 5) * 2 + shift).alias("cx"),
        ((k % 5) * 8 + shift).alias("cy"),
        F.when(k % 2 == 0, 2.5).otherwise(0.25).alias("h"),
    )


# points on halves of the lattice step, so that many lie midway between two axis values
SQL["points"] = """
SELECT CAST(s_suppkey AS VARCHAR) AS gid, (s_suppkey % 83) / 2e0 AS py, ((s_suppkey * 7) % 91) / 2e0 AS px FROM supplier
"""


def points(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("s_suppkey")
    return table(spark, sf, "supplier").select(
        k.cast("string").alias("gid"), ((k % 83) / 2.0).alias("lat"), (((k * 7) % 91) / 2.0).alias("lon")
    )


def boxes(spark: SparkSession, sf: str) -> DataFrame:
    ring = geo.box_ring(F.col("cx"), F.col("cy"), F.col("h"))
    return zones(spark, sf).select("gid", F.lit("Polygon").alias("geom_type"), F.array(ring).alias("rings"))


def diamonds(spark: SparkSession, sf: str) -> DataFrame:
    x, y, h = F.col("cx"), F.col("cy"), F.col("h")
    ring = F.array(geo.point(x + h, y), geo.point(x, y + h), geo.point(x - h, y), geo.point(x, y - h), geo.point(x + h, y))
    return zones(spark, sf).select("gid", F.lit("Polygon").alias("geom_type"), F.array(ring).alias("rings"))


SQL["parts_dem"] = """
SELECT p_brand AS feature_id, p_partkey AS cell, p_retailprice AS elevation, p_size * 7.2e0 - 0.1e0 AS aspect FROM part
"""


def parts_dem(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select(
        F.col("p_brand").alias("feature_id"),
        F.col("p_partkey").cast("int").alias("row"),
        F.lit(0).alias("col"),
        F.col("p_partkey").cast("double").alias("x"),
        F.lit(0.0).alias("y"),
        F.col("p_retailprice").alias("elevation"),
        (F.col("p_size") * 7.2 - 0.1).alias("aspect"),
    )


SQL["lattice_dem"] = """
SELECT 'f' || CAST(c_custkey // 4000 AS VARCHAR) AS feature_id, CAST(c_custkey % 40 AS INTEGER) AS row,
       CAST(c_custkey // 40 AS INTEGER) AS col, CAST(c_custkey // 40 AS DOUBLE) AS x,
       -CAST(c_custkey % 40 AS DOUBLE) AS y, c_acctbal AS elevation FROM customer
"""


def lattice_dem(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("c_custkey")
    col = F.floor(k / 40)
    return table(spark, sf, "customer").select(
        F.concat(F.lit("f"), F.floor(k / 4000).cast("string")).alias("feature_id"),
        (k % 40).cast("int").alias("row"),
        col.cast("int").alias("col"),
        col.cast("double").alias("x"),
        (-(k % 40).cast("double")).alias("y"),
        F.col("c_acctbal").alias("elevation"),
    )


# model output on three calendars
SQL["climate"] = """
SELECT year(o_orderdate) AS year, month(o_orderdate) AS month, least(day(o_orderdate), 30) AS day,
       CAST((o_orderkey % 4) * 21600 AS INTEGER) AS second,
       CASE o_orderkey % 3 WHEN 0 THEN 'standard' WHEN 1 THEN 'noleap' ELSE '360_day' END AS calendar,
       CAST(o_custkey % 40 AS DOUBLE) AS lat, CAST(o_custkey // 40 AS DOUBLE) AS lon,
       'run/pr_MODEL' || CAST(o_custkey % 7 AS VARCHAR) || '_ssp' || CAST(o_orderkey % 3 AS VARCHAR) || '_r1.nc' AS path,
       o_orderkey, o_totalprice AS pr, o_totalprice / 1000e0 AS tas FROM orders
"""


def climate(spark: SparkSession, sf: str) -> DataFrame:
    k, c, d = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderdate")
    return table(spark, sf, "orders").select(
        F.year(d).alias("year"),
        F.month(d).alias("month"),
        F.least(F.dayofmonth(d), F.lit(30)).alias("day"),
        ((k % 4) * 21600).cast("int").alias("second"),
        F.when(k % 3 == 0, "standard").when(k % 3 == 1, "noleap").otherwise("360_day").alias("calendar"),
        (c % 40).cast("double").alias("lat"),
        F.floor(c / 40).cast("double").alias("lon"),
        F.concat(F.lit("run/pr_MODEL"), (c % 7).cast("string"), F.lit("_ssp"), (k % 3).cast("string"), F.lit("_r1.nc")).alias("path"),
        "o_orderkey",
        F.col("o_totalprice").alias("pr"),
        (F.col("o_totalprice") / 1000.0).alias("tas"),
    )


def with_views(body: str, *names: str) -> str:
    """``body`` with the named views as common table expressions."""
    ctes = ", ".join(f"{n} AS ({SQL[n].strip()})" for n in names)
    if body.lstrip().upper().startswith("WITH "):
        return f"WITH {ctes}, {body.lstrip()[5:]}"
    return f"WITH {ctes} {body.strip()}"
