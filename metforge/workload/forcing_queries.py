"""Unit conversion, humidity, zones, packing, quality."""

from __future__ import annotations

from pyspark.sql import functions as F

from metforge import dims
from metforge.functions import labels, physics, temporal
from metforge.operators import packing, projection, quality, sites, timeaxis
from metforge.plans import forcing
from metforge.workload import views
from metforge.workload.registry import query
from metforge.workload.views import rounded

BOUNDS = """
years AS (SELECT year(date) AS y, bool_or(month(date) * 100 + day(date) = 101)
                 AND bool_or(month(date) * 100 + day(date) = 1231) AS ok
          FROM hourly WHERE NOT (month(date) = 2 AND day(date) = 29) GROUP BY 1),
bounds AS (SELECT coalesce(min(CASE WHEN ok THEN y END), min(y)) AS y0,
                  coalesce(max(CASE WHEN ok THEN y END), max(y)) AS y1 FROM years)
"""
KEPT = "year(date) BETWEEN y0 AND y1 AND NOT (month(date) = 2 AND day(date) = 29)"
E_SAT = """611e0 * exp(((CASE WHEN temperature_2m >= 273.15e0 THEN 2453000e0 ELSE 2838000e0 END) / 461.52e0)
 * (1e0 / 273.15e0 - 1e0 / temperature_2m))"""
E_ACT = """611e0 * exp(((CASE WHEN temperature_2m <= 273.15e0 THEN 2453000e0 ELSE 2838000e0 END) / 461.52e0)
 * (1e0 / 273.15e0 - 1e0 / dewpoint_temperature_2m))"""
HUMID = f"""humid AS (SELECT *, {E_SAT} AS esat, {E_ACT} AS e FROM hourly),
mixed AS (SELECT *, e * 287.053e0 / (461.52e0 * (surface_pressure - e)) AS w FROM humid)"""
ZONED = """zoned AS (SELECT *, CAST((row_number() OVER (ORDER BY lat, lon, gid) - 1) % {n} + 1 AS INTEGER) AS zone,
  row_number() OVER (ORDER BY lat, lon, gid) AS site_no FROM sites)"""
READY = f"""
WITH {BOUNDS}, {HUMID}, {ZONED.format(n=4)},
ready AS (SELECT temperature_2m AS TBOT, greatest(total_precipitation_hourly / 3.6e0, 0e0) AS PRECTmms,
       greatest(w / (w + 1e0), 0e0) AS QBOT,
       greatest(surface_solar_radiation_downwards_hourly / 3600e0, 0e0) AS FSDS,
       greatest(surface_thermal_radiation_downwards_hourly / 3600e0, 0e0) AS FLDS,
       greatest(surface_pressure, 0e0) AS PSRF,
       sqrt(u_component_of_wind_10m * u_component_of_wind_10m + v_component_of_wind_10m * v_component_of_wind_10m) AS WIND,
       lon AS LONGXY, lat AS LATIXY, date AS time, gid, zone
FROM mixed JOIN zoned USING (gid), bounds WHERE {KEPT})
"""
READY_OUT = """SELECT round(TBOT, 6) AS TBOT, round(PRECTmms, 6) + 0e0 AS PRECTmms, round(QBOT, 9) AS QBOT, round(FSDS, 6) AS FSDS,
 round(FLDS, 6) AS FLDS, round(PSRF, 6) AS PSRF, round(WIND, 6) AS WIND, LONGXY, LATIXY,
 strftime(time, '%Y-%m-%d %H:%M:%S') AS time, gid, zone FROM ready"""


def presentable(df, *more):
    """Model-ready rows with rounded values and text stamps."""
    digits = {"QBOT": 9}
    values = [rounded(c, digits.get(c, 6)).alias(c) for c in dims.PROFILES["BYPASS"]]
    return df.select(*values, "LONGXY", "LATIXY", temporal.stamp(F.col("time")).alias("time"), "gid", "zone", *more)


@query(READY + READY_OUT, ("hourly", "sites"))
def forcing_ready(spark, sf):
    options = forcing.ForcingOptions(zones=4)
    return presentable(forcing.forcing_ready(views.hourly(spark, sf), views.sites(spark, sf), options))


TOWER = READY.replace("QBOT,\n", "QBOT, greatest(e / esat * 100e0, 0e0) AS RH, 10e0 AS ZBOT,\n")
DATM = [v for v in dims.PROFILES["DATM_MODE"] if v != "ZBOT"]


@query(
    f"""{TOWER} SELECT ZBOT, {", ".join(f"round({v}, 6) + 0e0 AS {v}" for v in DATM)}, LONGXY, LATIXY,
 strftime(time, '%Y-%m-%d %H:%M:%S') AS time, gid, zone FROM ready""",
    ("hourly", "sites"),
)
def forcing_datm(spark, sf):
    """The other output profile, with the height of the observations."""
    options = forcing.ForcingOptions(profile="DATM_MODE", zones=4)
    ready = forcing.forcing_ready(views.hourly(spark, sf).withColumn("ZBOT", F.lit(10.0)), views.sites(spark, sf), options)
    return ready.select("ZBOT", *[rounded(v).alias(v) for v in DATM], "LONGXY", "LATIXY", temporal.stamp(F.col("time")).alias("time"), "gid", "zone")


@query(
    READY + READY_OUT.replace(", gid, zone FROM", ", gid, zone, dense_rank() OVER (ORDER BY time, LATIXY, LONGXY) - 1 AS place FROM"), ("hourly", "sites")
)
def forcing_sorted(spark, sf):
    """The place of each row is read off the order in which the sorted rows come."""
    options = forcing.ForcingOptions(zones=4)
    ready = forcing.forcing_ready(views.hourly(spark, sf), views.sites(spark, sf), options)
    return presentable(views.placed(sites.sorted_observations(ready), ["time", "LATIXY", "LONGXY"]), "place")


@query(
    """SELECT gid, strftime(date, '%Y-%m-%d %H:%M:%S') AS date,
  round(sqrt(u_component_of_wind_10m * u_component_of_wind_10m + v_component_of_wind_10m * v_component_of_wind_10m), 6) AS speed,
  round(CASE WHEN degrees(atan2(u_component_of_wind_10m, v_component_of_wind_10m)) >= 180e0
     THEN degrees(atan2(u_component_of_wind_10m, v_component_of_wind_10m))
     ELSE degrees(atan2(u_component_of_wind_10m, v_component_of_wind_10m)) + 180e0 END, 6) + 0e0 AS direction
FROM hourly""",
    ("hourly",),
)
def wind_components(spark, sf):
    rows = forcing.convert_units(views.hourly(spark, sf))
    return rows.select(
        "gid", temporal.stamp(F.col("date")).alias("date"), rounded("wind_speed").alias("speed"), rounded("wind_direction").alias("direction")
    )


@query(
    f"""WITH {HUMID} SELECT gid, strftime(date, '%Y-%m-%d %H:%M:%S') AS date, round(e / esat * 100e0, 6) AS rh,
 round(w / (w + 1e0), 9) AS q FROM mixed""",
    ("hourly",),
)
def humidity(spark, sf):
    rows = forcing.derive_humidity(views.hourly(spark, sf))
    return rows.select(
        "gid", temporal.stamp(F.col("date")).alias("date"), rounded("relative_humidity").alias("rh"), rounded("specific_humidity", 9).alias("q")
    )


@query(
    """SELECT gid, strftime(date, '%Y-%m-%d %H:%M:%S') AS date, round(total_precipitation_hourly / 3.6e0, 9) + 0e0 AS precipitation,
 round(surface_solar_radiation_downwards_hourly / 3600e0, 6) AS shortwave,
 round(surface_thermal_radiation_downwards_hourly / 3600e0, 6) AS longwave FROM hourly""",
    ("hourly",),
)
def unit_conversion(spark, sf):
    rows = forcing.convert_units(views.hourly(spark, sf))
    return rows.select(
        "gid",
        temporal.stamp(F.col("date")).alias("date"),
        rounded("total_precipitation_hourly", 9).alias("precipitation"),
        rounded("surface_solar_radiation_downwards_hourly").alias("shortwave"),
        rounded("surface_thermal_radiation_downwards_hourly").alias("longwave"),
    )


@query(
    """SELECT gid, strftime(date, '%Y-%m-%d %H:%M:%S') AS date,
 round(CASE WHEN total_precipitation_hourly < 0 THEN 0e0 ELSE total_precipitation_hourly END, 6) + 0e0 AS precipitation,
 round(u_component_of_wind_10m, 6) + 0e0 AS u FROM hourly""",
    ("hourly",),
)
def nonneg_clip(spark, sf):
    rows = forcing.clip_nonnegative(views.hourly(spark, sf))
    return rows.select(
        "gid",
        temporal.stamp(F.col("date")).alias("date"),
        rounded("total_precipitation_hourly").alias("precipitation"),
        rounded("u_component_of_wind_10m").alias("u"),
    )


@query("SELECT gid, lat, CASE WHEN lon < 0 THEN lon + 360e0 ELSE lon END AS lon FROM sites", ("sites",))
def lon_0_360(spark, sf):
    return views.sites(spark, sf).withColumn("lon", physics.wrap_longitude(F.col("lon")))


@query(f"WITH {ZONED.format(n=3)} SELECT gid, lat, lon, zone, site_no FROM zoned", ("sites",))
def zone_round_robin(spark, sf):
    return sites.with_zones(views.sites(spark, sf), 3).select("gid", "lat", "lon", "zone", "site_no")


@query(
    f"""WITH {ZONED.format(n=12)} SELECT CASE WHEN lon < 0 THEN lon + 360e0 ELSE lon END AS lon, lat,
 lpad(CAST(zone AS VARCHAR), 2, '0') AS zone, site_no AS id FROM zoned""",
    ("sites",),
)
def zone_mapping(spark, sf):
    return sites.zone_mapping(sites.with_zones(views.sites(spark, sf), 12))


@query(
    "SELECT gid, CASE WHEN lon < 0 THEN lon + 360e0 ELSE lon END AS lon, lat, '01' AS zone, 1 AS id FROM sites", ("sites",)
)
def zone_mapping_site(spark, sf):
    return sites.zone_mapping(views.sites(spark, sf), site=True)


@query(f"WITH {ZONED.format(n=5)} SELECT DISTINCT zone FROM zoned", ("sites",))
def distinct_zones(spark, sf):
    return sites.distinct_zones(sites.with_zones(views.sites(spark, sf), 5))


@query(
    f"""WITH {BOUNDS}, {ZONED.format(n=12)} SELECT z.gid, v.variable,
 'ERA5_' || v.variable || '_' || CAST(y0 AS VARCHAR) || '-' || CAST(y1 AS VARCHAR) || '_z' || lpad(CAST(z.zone AS VARCHAR), 2, '0') AS dataset
FROM zoned z, bounds, (VALUES ('TBOT'), ('PRECTmms'), ('QBOT'), ('FSDS'), ('FLDS'), ('PSRF'), ('WIND')) AS v(variable)""",
    ("hourly", "sites"),
)
def output_names(spark, sf):
    first, last = forcing.year_bounds(views.hourly(spark, sf))
    located = sites.with_zones(views.sites(spark, sf), 12)
    named = located.select("gid", "zone", F.explode(F.array(*[F.lit(v) for v in dims.PROFILES["BYPASS"]])).alias("variable"))
    return named.select(
        "gid", "variable", labels.dataset_name(F.col("variable"), F.lit(first), F.lit(last), F.col("zone")).alias("dataset")
    )


# --- packing ----------------------------------------------------------------------------

SPANS = "spans AS (SELECT gid, variable, min(value) AS low, max(value) AS high FROM model_long GROUP BY 1, 2)"
PARAMS = f"""{SPANS}, params AS (SELECT gid, variable, low, high,
  CASE WHEN high = low THEN low ELSE low + 29491e0 * ((high - low) / 58981e0) END AS add_offset,
  CASE WHEN high = low THEN 1e0 ELSE (high - low) / 58981e0 END AS scale_factor FROM spans)"""


@query(
    f"""WITH {PARAMS} SELECT gid, variable, round(low, 9) + 0e0 AS low, round(high, 9) + 0e0 AS high,
 round(add_offset, 9) + 0e0 AS add_offset, round(scale_factor, 12) AS scale_factor FROM params""",
    ("model_long",),
)
def packing_params(spark, sf):
    p = packing.packing_params(views.model_long(spark, sf), ["gid", "variable"])
    return p.select(
        "gid",
        "variable",
        rounded("low", 9).alias("low"),
        rounded("high", 9).alias("high"),
        rounded("add_offset", 9).alias("add_offset"),
        rounded("scale_factor", 12).alias("scale_factor"),
    )


@query(
    f"""WITH {PARAMS} SELECT gid, variable, round(value, 9) + 0e0 AS value,
 CAST(round_even((value - add_offset) / scale_factor, 0) AS SMALLINT) AS packed
FROM model_long JOIN params USING (gid, variable)""",
    ("model_long",),
)
def pack_values(spark, sf):
    packed = packing.pack_table(views.model_long(spark, sf), ["gid", "variable"])
    return packed.select("gid", "variable", rounded("value", 9).alias("value"), "packed")


@query(
    f"""WITH {PARAMS}, packed AS (SELECT gid, variable, value, add_offset, scale_factor,
 CAST(round_even((value - add_offset) / scale_factor, 0) AS SMALLINT) AS packed FROM model_long JOIN params USING (gid, variable))
SELECT gid, variable, packed, round(packed * scale_factor + add_offset, 6) + 0e0 AS value,
 abs(packed * scale_factor + add_offset - value) <= scale_factor * 0.5000001e0 AS within_half_step FROM packed""",
    ("model_long",),
)
def unpack_values(spark, sf):
    packed = packing.pack_table(views.model_long(spark, sf), ["gid", "variable"]).withColumnRenamed("value", "original")
    back = packing.unpack_table(packed)
    close = F.abs(F.col("value") - F.col("original")) <= F.col("scale_factor") * 0.5000001
    return back.select("gid", "variable", "packed", rounded("value").alias("value"), close.alias("within_half_step"))


@query(
    """WITH ranges(variable, low, high) AS (VALUES ('PRECTmms', -0.04e0, 0.04e0), ('FSDS', -20e0, 2000e0), ('TBOT', 175e0, 350e0),
 ('RH', 0e0, 100e0), ('QBOT', 0e0, 0.1e0), ('FLDS', 0e0, 1000e0), ('PSRF', 20000e0, 120000e0), ('WIND', -1e0, 100e0)),
p AS (SELECT variable, (high - low) / 58981e0 AS s, low + 29491e0 * ((high - low) / 58981e0) AS o FROM ranges),
steps AS (SELECT gid, variable, value, round_even((value - o) / s, 0) AS step FROM model_long LEFT JOIN p USING (variable))
SELECT gid, variable, round(value, 9) + 0e0 AS value,
 CAST(CASE WHEN step BETWEEN -32768 AND 32767 THEN step ELSE -32767 END AS SMALLINT) AS packed FROM steps""",
    ("model_long",),
)
def pack_preset(spark, sf):
    long = views.model_long(spark, sf)
    packed = packing.pack_table(long, ["variable"], params=packing.preset_params(long))
    return packed.select("gid", "variable", rounded("value", 9).alias("value"), "packed")


@query(
    """WITH v(variable, units, description, long_name) AS (VALUES
 ('TBOT', 'K', 'temperature at the lowest atm level (TBOT)', 'temperature_2m'),
 ('PSRF', 'Pa', 'pressure at the lowest atm level (PSRF)', 'surface_pressure'),
 ('FSDS', 'W/m2', 'incident solar (FSDS)', 'surface_solar_radiation_downwards_hourly'),
 ('PRECTmms', 'mm/s', 'precipitation (PRECTmms)', 'total_precipitation_hourly'),
 ('RH', '%', 'relative humidity at the lowest atm level (RH)', 'relative_humidity'),
 ('WIND', 'm/s', 'wind magnitude at the lowest atm level (WIND)', 'wind_speed'),
 ('DTBOT', 'unsure', 'dewpoint temperature [era5 direct]', 'dewpoint_temperature_2m'))
SELECT gid, variable, units, description, long_name, n FROM
 (SELECT gid, variable, count(*) AS n FROM model_long GROUP BY 1, 2) LEFT JOIN v USING (variable)""",
    ("model_long",),
)
def variable_attributes(spark, sf):
    counts = views.model_long(spark, sf).groupBy("gid", "variable").agg(F.count(F.lit(1)).alias("n"))
    return packing.with_attributes(counts).select("gid", "variable", "units", "description", "long_name", "n")


@query(
    """SELECT gid, strftime(time, '%Y-%m-%d %H:%M:%S') AS time, dense_rank() OVER (ORDER BY time) - 1 AS t_idx,
 dense_rank() OVER (ORDER BY lat, lon, gid) - 1 AS n_idx, round(TBOT, 6) AS value FROM station JOIN sites USING (gid)""",
    ("station", "sites"),
)
def dense_index(spark, sf):
    placed = sites.attach_locations(views.station(spark, sf), views.sites(spark, sf))
    dense = packing.dense_index(placed, lat="lat", lon="lon")
    return dense.select("gid", temporal.stamp(F.col("time")).alias("time"), "t_idx", "n_idx", rounded("TBOT").alias("value"))


@query(
    """SELECT count(*) AS n_rows, count(DISTINCT time) AS n_times, count(DISTINCT gid) AS n_sites,
 count(*) = count(DISTINCT time) * count(DISTINCT gid) AS complete FROM station""",
    ("station",),
)
def dense_coverage(spark, sf):
    return packing.dense_coverage(views.station(spark, sf))


# --- quality ----------------------------------------------------------------------------


@query(
    """SELECT variable, round(avg(value), 6) AS mean, round(quantile_cont(value, 0.01), 6) + 0e0 AS min,
 round(quantile_cont(value, 0.99), 6) AS max FROM model_long GROUP BY variable""",
    ("model_long",),
)
def variable_stats(spark, sf):
    s = quality.variable_stats(views.model_long(spark, sf))
    return s.select("variable", *[rounded(c).alias(c) for c in ("mean", "min", "max")])


@query(
    """WITH ref(variable, rmean, rmin, rmax) AS (VALUES
 ('FLDS', 241.61348580062975e0, 124.493408203125e0, 363.47250366210847e0), ('FSDS', 97.75458921397247e0, -0.02685546875e0, 640.371337890625e0),
 ('PRECTmms', 6.108417376083734e-06, 0e0, 0.00012084960937500001e0), ('PSRF', 101517.92885260089e0, 99128.11279296875e0, 104250.79345703125e0),
 ('QBOT', 0.0017366085448494591e0, 0.0001058959960937439e0, 0.006910400390624995e0), ('TBOT', 265.1942151892329e0, 236.1052703857422e0, 294.68711853027344e0),
 ('WIND', 2.8788591383582154e0, 0.5445281982421832e0, 6.71185302734375e0)),
lim(variable, lmin, lmax) AS (VALUES ('TBOT', 180e0, 350e0), ('RH', 0e0, 100e0), ('WIND', 0e0, 80e0), ('PSRF', 8e4, 1.5e5), ('FSDS', 0e0, 2500e0), ('PRECTmms', 0e0, 15e0)),
s AS (SELECT variable, rmean, avg(value) AS mean, min(value) AS mn, max(value) AS mx, count(*) AS n,
  count(*) FILTER (WHERE value > rmax OR value < rmin) AS outside FROM model_long LEFT JOIN ref USING (variable) GROUP BY variable, rmean),
g AS (SELECT *, CASE WHEN mean > 0 THEN log10(rmean) - log10(mean) END AS gap FROM s)
SELECT variable, round(mean, 6) AS mean, round(mn, 6) + 0e0 AS min, round(mx, 6) AS max, rmean IS NOT NULL AS has_stats,
 round(gap, 6) AS magnitude_gap, coalesce(CASE WHEN mean = 0 THEN rmean IS NOT NULL ELSE abs(gap) > 0.5 END, false) AS magnitude_concern,
 round(CASE WHEN rmean IS NOT NULL THEN outside / n END, 6) AS outside_fraction, outside / n > 0.1 AS range_concern,
 coalesce(mx > lmax OR mn < lmin, false) AS hard_limit_concern FROM g LEFT JOIN lim USING (variable)""",
    ("model_long",),
)
def range_validation(spark, sf):
    r = quality.range_report(views.model_long(spark, sf))
    numbers = {c: rounded(c) for c in ("mean", "min", "max", "magnitude_gap", "outside_fraction")}
    return r.withColumns(numbers)


SIGNED = [b for b in dims.REQUIRED_BANDS if b in dims.NON_NEGATIVE]


@query(
    f"""SELECT variable, count(*) FILTER (WHERE value < 0) AS n_negative FROM
 (SELECT u.variable, u.value FROM hourly, LATERAL (VALUES {", ".join(f"('{b}', {b})" for b in SIGNED)}) AS u(variable, value)) GROUP BY variable""",
    ("hourly",),
)
def negative_check(spark, sf):
    bands = dims.REQUIRED_BANDS
    return quality.negative_report(projection.melt(views.hourly(spark, sf).select(*bands), [], bands))


@query(
    """WITH a AS (SELECT event_type AS variable, time_bucket(INTERVAL 1 hour, ts) AS time, avg(value) AS x FROM events GROUP BY 1, 2),
b AS (SELECT event_type AS variable, time_bucket(INTERVAL 1 hour, ts) AS time, avg(value * 1.1e0 + user_id) AS y FROM events GROUP BY 1, 2)
SELECT variable, count(*) AS n, round(avg(x - y), 6) AS bias, round(sqrt(avg((x - y) * (x - y))), 6) AS rmse, round(corr(x, y), 6) AS correlation
FROM a JOIN b USING (variable, time) GROUP BY variable"""
)
def compare_sources(spark, sf):
    hour = temporal.from_micros(temporal.floor_to(temporal.micros(F.col("ts")), temporal.HOUR_US))
    events = views.table(spark, sf, "events").withColumn("time", hour)
    other = F.when(F.col("event_type") == "view", "UVIEW").otherwise(F.col("event_type"))
    left = events.select(F.col("event_type").alias("variable"), "time", "value")
    right = events.select(other.alias("variable"), "time", (F.col("value") * 1.1 + F.col("user_id")).alias("value"))
    out = quality.compare_sources(left, right, ["time"], right_names={"UVIEW": "view"})
    return out.withColumns({c: rounded(c) for c in ("bias", "rmse", "correlation")})


@query(
    """WITH pos AS (SELECT gid, time, row_number() OVER (PARTITION BY gid ORDER BY time) AS position,
   min(time) OVER (PARTITION BY gid) AS t0 FROM order_axis),
e AS (SELECT gid, position, day(time) = 1 AS gap, date_diff('day', t0, time) AS d FROM pos)
SELECT gid, count(*) AS n_expected, count(CASE WHEN NOT gap THEN 1 END) AS n_actual,
 count(CASE WHEN gap OR NOT abs(d - d * (1 + 1e-4)) <= 1e-6 + 1e-5 * abs(d * (1 + 1e-4)) THEN 1 END) AS n_mismatch
FROM e GROUP BY gid""",
    ("order_axis",),
)
def axis_check(spark, sf):
    from metforge.operators.ordering import group_row_number

    axis = group_row_number(views.order_axis(spark, sf), ["gid"], ["time"], "position")
    expected = timeaxis.with_dtime(axis, ["gid"], "time")
    # the other axis is stretched a little and has no first days of a month
    stretched = expected.withColumn("dtime", F.col("dtime") * (1 + 1e-4)).where(F.dayofmonth("time") != 1)
    return quality.axis_check(expected, stretched, ["gid"], "position", "dtime")
