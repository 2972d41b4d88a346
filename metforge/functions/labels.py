"""Identifiers and file names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def zone_code(zone: Column) -> Column:
    """Zone number padded to two digits; longer numbers stay whole."""
    text = zone.cast("int").cast("string")
    return F.when(F.length(text) < 2, F.lpad(text, 2, "0")).otherwise(text)


def dataset_name(variable: Column, first_year: Column, last_year: Column, zone: Column, prefix: str = "ERA5") -> Column:
    """``ERA5_TBOT_1980-2000_z01``."""
    years = F.concat_ws("-", first_year.cast("string"), last_year.cast("string"))
    return F.concat_ws("_", F.lit(prefix), variable, years, F.concat(F.lit("z"), zone_code(zone)))


def file_stem(path: Column) -> Column:
    """Last path segment without its extension."""
    return F.regexp_replace(F.substring_index(path, "/", -1), r"\.[^.]*$", "")


def stem_part(path: Column, index: int) -> Column:
    """``index``-th part (from 0) of a stem such as ``pr_MODEL_ssp585_r1``; null if absent."""
    return F.try_element_at(F.split(file_stem(path), "_"), F.lit(index + 1))


def cell_label(lat: Column, lon: Column) -> Column:
    """``"68.30,18.80"``."""
    return F.format_string("%.2f,%.2f", lat, lon)


def label_lat(label: Column) -> Column:
    return F.split(label, ",")[0].cast("double")


def label_lon(label: Column) -> Column:
    return F.split(label, ",")[1].cast("double")
