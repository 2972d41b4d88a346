"""Locations: zones, numbering and the join with hourly rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metforge.functions import labels, physics
from metforge.operators.ordering import global_row_number
from metforge.operators.skew import lookup_join

SITE_ORDER = ["lat", "lon", "gid"]


def attach_locations(hourly: DataFrame, locations: DataFrame) -> DataFrame:
    """Hourly rows with the coordinates and zone of their site; rows of unknown sites drop out.

    Ids are compared as text on both sides.
    """
    columns = [c for c in ("gid", "lat", "lon", "zone") if c in locations.columns]
    side = locations.withColumn("gid", F.col("gid").cast("string")).select(*columns)
    return lookup_join(hourly.withColumn("gid", F.col("gid").cast("string")), side, "gid")


def with_zones(locations: DataFrame, zones: int = 1) -> DataFrame:
    """Add ``site_no`` (1.. in lat, lon, gid order) and, unless present, round-robin ``zone``."""
    numbered = global_row_number(locations, SITE_ORDER, "site_no")
    if "zone" in locations.columns:
        return numbered
    return numbered.withColumn("zone", (F.pmod(F.col("site_no") - 1, F.lit(zones)) + 1).cast("int"))


def zone_mapping(locations: DataFrame, site: bool = False) -> DataFrame:
    """``lon`` on 0..360, ``lat``, two-digit ``zone`` and ``id``.

    For single-site data sets every site is its own mapping: id 1 in zone 01, one per ``gid``.
    """
    lon = physics.wrap_longitude(F.col("lon")).alias("lon")
    if site:
        return locations.select("gid", lon, "lat", F.lit("01").alias("zone"), F.lit(1).alias("id"))
    numbered = locations if "site_no" in locations.columns else with_zones(locations)
    return numbered.select(lon, "lat", labels.zone_code(F.col("zone")).alias("zone"), F.col("site_no").alias("id"))


def distinct_zones(locations: DataFrame) -> DataFrame:
    return locations.select("zone").distinct()


def sorted_observations(df: DataFrame) -> DataFrame:
    """Model-ready rows by time, then south to north and west to east."""
    return df.orderBy("time", "LATIXY", "LONGXY")
