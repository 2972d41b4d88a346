"""Catalogue search, long tables, file names."""

from __future__ import annotations

from pyspark.sql import functions as F

from metforge import dims
from metforge.functions import labels
from metforge.operators import catalog, projection
from metforge.plans import climate
from metforge.workload import views
from metforge.workload.registry import query
from metforge.workload.time_queries import IN_WINDOW, ISO
from metforge.workload.views import rounded

NEEDED = ["view", "click", "error"]


@query(
    "SELECT * FROM catalogue WHERE experiment_id = 'exp1' AND variable_id IN ('view', 'click') AND member_id IN ('r0i1p1f1', 'r3i1p1f1')",
    ("catalogue",),
)
def facet_search(spark, sf):
    request = {"experiment": "exp1", "variables": ["view", "click"], "ensemble": ["r0i1p1f1", "r3i1p1f1"]}
    return catalog.facet_search(views.catalogue(spark, sf), request)


COMPLETE = "SELECT source_id FROM catalogue WHERE variable_id IN ('view', 'click', 'error') GROUP BY 1 HAVING count(DISTINCT variable_id) = 3"


@query(f"SELECT * FROM catalogue WHERE source_id IN ({COMPLETE})", ("catalogue",))
def complete_models(spark, sf):
    return catalog.complete_models(views.catalogue(spark, sf), NEEDED)


@query(
    f"""SELECT * FROM catalogue WHERE variable_id IN ('view', 'click', 'error') AND table_id = 'Amon' AND source_id IN ({COMPLETE})""",
    ("catalogue",),
)
def find_available(spark, sf):
    return catalog.find_available(views.catalogue(spark, sf), {"variables": NEEDED, "table": "Amon"})


@query(f"SELECT * FROM catalogue WHERE source_id IN (SELECT source_id FROM ({COMPLETE}) ORDER BY source_id LIMIT 5)", ("catalogue",))
def first_models(spark, sf):
    return catalog.first_models(views.catalogue(spark, sf), NEEDED, 5)


@query(
    "SELECT zstore, variable_id || '_' || source_id || '_' || experiment_id || '_' || member_id AS name FROM catalogue", ("catalogue",)
)
def catalogue_names(spark, sf):
    return views.catalogue(spark, sf).select("zstore", catalog.output_name().alias("name"))


LONG = f"""SELECT {ISO} AS date, lon, lat, u.value, u.var, split_part(split_part(path, '/', -1), '_', 2) AS model,
 split_part(split_part(path, '/', -1), '_', 3) AS ssp FROM climate, LATERAL (VALUES ('pr', pr), ('tas', tas)) AS u(var, value)"""


@query(f"SELECT date, lon, lat, round(value, 6) AS value, var, model, ssp FROM ({LONG})", ("climate",))
def long_melt(spark, sf):
    return catalog.long_table(views.climate(spark, sf), ["pr", "tas"]).withColumn("value", rounded("value"))


@query(f"SELECT date, lon, lat, round(value, 6) AS value, var, model, ssp FROM ({LONG} WHERE {IN_WINDOW})", ("climate",))
def climate_extract(spark, sf):
    out = climate.extract(views.climate(spark, sf), ["pr", "tas"], "1996-01-31", "1998-10-31")
    return out.withColumn("value", rounded("value"))


MODEL_LONG = ["TBOT", "DTBOT", "PSRF", "PRECTmms", "FSDS", "RH", "WIND"]
PIVOT = ", ".join(f"max(CASE WHEN variable = '{v}' THEN v END) AS {v}" for v in MODEL_LONG)


@query(
    f"SELECT gid, {PIVOT} FROM (SELECT gid, variable, round(min(value), 6) + 0e0 AS v FROM model_long GROUP BY 1, 2) GROUP BY gid",
    ("model_long",),
)
def variables_pivot(spark, sf):
    wide = catalog.merge_variables(views.model_long(spark, sf), ["gid"], MODEL_LONG)
    return wide.withColumns({c: rounded(c) for c in MODEL_LONG})


@query(
    """SELECT o_orderkey, 'pr_MODEL' || CAST(o_custkey % 7 AS VARCHAR) || '_ssp' || CAST(o_orderkey % 3 AS VARCHAR) || '_r1' AS stem,
 'MODEL' || CAST(o_custkey % 7 AS VARCHAR) AS model, 'ssp' || CAST(o_orderkey % 3 AS VARCHAR) AS ssp, CAST(NULL AS VARCHAR) AS absent FROM orders"""
)
def parse_file_stem(spark, sf):
    p = F.col("path")
    return views.climate(spark, sf).select(
        "o_orderkey",
        labels.file_stem(p).alias("stem"),
        labels.stem_part(p, 1).alias("model"),
        labels.stem_part(p, 2).alias("ssp"),
        labels.stem_part(p, 9).alias("absent"),
    )


@query(
    """SELECT gid, strftime(date, '%Y-%m-%d %H:%M') AS date, temperature_2m, surface_pressure FROM
 (SELECT gid, date, round(temperature_2m, 6) AS temperature_2m, round(surface_pressure, 6) AS surface_pressure FROM hourly)""",
    ("hourly",),
)
def band_selection(spark, sf):
    table = projection.band_table(views.hourly(spark, sf), "gid", "date", ["temperature_2m", "surface_pressure"])
    return table.withColumns({c: rounded(c) for c in ("temperature_2m", "surface_pressure")})


@query("SELECT DISTINCT p_type AS band_name FROM part WHERE p_type NOT IN (SELECT event_type FROM events) AND p_type IS NOT NULL")
def unknown_bands(spark, sf):
    wanted = views.table(spark, sf, "part").select(F.col("p_type").alias("band_name"))
    return projection.unknown_names(wanted, views.table(spark, sf, "events"), "band_name", "event_type")


@query(
    """SELECT 'event' AS kind, CAST(user_id AS VARCHAR) AS gid, value, NULL AS price FROM events
UNION ALL SELECT 'order', CAST(o_custkey AS VARCHAR), NULL, o_totalprice FROM orders"""
)
def concat_sources(spark, sf):
    events = views.table(spark, sf, "events").select(F.lit("event").alias("kind"), F.col("user_id").cast("string").alias("gid"), "value")
    orders = views.table(spark, sf, "orders").select(
        F.lit("order").alias("kind"), F.col("o_custkey").cast("string").alias("gid"), F.col("o_totalprice").alias("price")
    )
    return projection.concat_tables([events, orders])


@query(
    "SELECT CAST(s_suppkey AS VARCHAR) AS gid, round(s_acctbal, 6) AS balance FROM supplier"
)
def infer_id(spark, sf):
    renamed = views.table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("pid"), F.col("s_name").alias("provider_id"), F.col("s_acctbal").alias("balance")
    )
    return projection.with_gid(renamed).select("gid", rounded("balance").alias("balance"))


RENAMED = {name: source for source, name in dims.SHORT_NAMES.items() if name in dims.PROFILES["BYPASS"] and source in dims.REQUIRED_BANDS}


@query(
    f"""SELECT gid, variable, round(value, 6) + 0e0 AS value FROM (SELECT gid, u.variable, u.value FROM hourly,
 LATERAL (VALUES {", ".join(f"('{name}', {source})" for name, source in RENAMED.items())}) AS u(variable, value))""",
    ("hourly",),
)
def model_names_melt(spark, sf):
    renamed = projection.to_model_names(views.hourly(spark, sf))
    return projection.melt(renamed, ["gid"], list(RENAMED)).withColumn("value", rounded("value"))
