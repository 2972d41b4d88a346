"""Hourly reanalysis samples to model-ready and packed forcing."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metforge import dims
from metforge.functions import codec, labels, physics, temporal
from metforge.operators import packing, projection, sites, timeaxis
from metforge.operators.skew import lookup_join
from metforge.session import materialize, stored

KEYS = ["LONGXY", "LATIXY", "time", "gid", "zone"]


@dataclass(frozen=True)
class ForcingOptions:
    calendar: str = "noleap"
    dtime_units: str = "days"
    resolution_hours: int = 1
    zones: int = 1
    profile: str = "BYPASS"
    dtime_mode: str = "elapsed"
    on_duplicate: str = "error"
    fix_north: bool = False
    consistent_latent_heat: bool = False


def convert_units(df: DataFrame, options: ForcingOptions = ForcingOptions()) -> DataFrame:
    """Wind from its components, precipitation to mm/s, radiation to W/m2; absent columns are skipped."""
    u, v = "u_component_of_wind_10m", "v_component_of_wind_10m"
    new = {}
    if u in df.columns and v in df.columns:
        new["wind_speed"] = physics.wind_speed(F.col(u), F.col(v))
        new["wind_direction"] = physics.wind_direction(F.col(u), F.col(v), options.fix_north)
    conversions = {
        "total_precipitation_hourly": physics.metres_per_hour_to_mm_per_second,
        "surface_solar_radiation_downwards_hourly": physics.joules_per_hour_to_watts,
        "surface_thermal_radiation_downwards_hourly": physics.joules_per_hour_to_watts,
    }
    new |= {c: f(F.col(c)) for c, f in conversions.items() if c in df.columns}
    return df.withColumns(new) if new else df


def derive_humidity(df: DataFrame, options: ForcingOptions = ForcingOptions()) -> DataFrame:
    """Relative and specific humidity, where temperature, dewpoint and pressure are all present."""
    needed = ["temperature_2m", "dewpoint_temperature_2m", "surface_pressure"]
    if any(c not in df.columns for c in needed):
        return df
    t, d, p = (F.col(c) for c in needed)
    same = options.consistent_latent_heat
    return df.withColumns(
        {
            "relative_humidity": physics.relative_humidity(t, d, same),
            "specific_humidity": physics.specific_humidity(t, d, p, same),
        }
    )


def clip_nonnegative(df: DataFrame) -> DataFrame:
    """Zero instead of negative values for the variables that cannot be negative."""
    new = {c: physics.clip_negative(F.col(c)) for c in dims.NON_NEGATIVE if c in df.columns}
    return df.withColumns(new) if new else df


def model_ready(
    hourly: DataFrame, locations: DataFrame, first_year: int, last_year: int, options: ForcingOptions = ForcingOptions()
) -> DataFrame:
    """Model-ready rows of the given years; a stateless chain that also runs on a stream."""
    rows = timeaxis.keep_years(hourly.withColumn("date", temporal.naive(F.col("date"))), "date", first_year, last_year)
    rows = timeaxis.drop_leap_days(rows, "date", options.calendar)
    rows = sites.attach_locations(rows, locations)
    rows = clip_nonnegative(derive_humidity(convert_units(rows, options), options))
    renamed = projection.to_model_names(rows, options.profile)
    return projection.strict_select(renamed, projection.profile_variables(options.profile) + KEYS)


def year_bounds(hourly: DataFrame, options: ForcingOptions = ForcingOptions()) -> tuple[int, int]:
    """Complete years over all files and sites: two integers, so that the year filter is a literal."""
    row = timeaxis.complete_years(hourly, "date", options.calendar).first()
    return row["start_year"], row["end_year"]


def forcing_ready(hourly: DataFrame, locations: DataFrame, options: ForcingOptions = ForcingOptions()) -> DataFrame:
    """Complete years of model-ready rows."""
    zoned = locations if "zone" in locations.columns else sites.with_zones(locations, options.zones)
    return model_ready(hourly, zoned, *year_bounds(hourly, options), options)


def packed_dataset(
    ready: DataFrame, locations: DataFrame, first_year: int, last_year: int, options: ForcingOptions = ForcingOptions(),
    layout: str = "site",
) -> tuple[DataFrame, DataFrame]:
    """``(values, metadata)`` of packed data sets.

    ``site`` makes one data set per site and variable, ``grid`` one per variable and zone
    over all locations with data: every stamp of the zone's common axis at every site, placed by
    ``t_idx`` and ``n_idx`` (sites by lat, lon, id).  ``locations`` carries ``gid, lat, lon, zone``.
    Cells and stamps without data hold the fill value.  :func:`gathered_dataset` has the same grids without their fill values.
    """
    if layout not in ("site", "grid"):
        raise ValueError("layout must be 'site' or 'grid'")
    on_axis, by, params = _on_axis(ready, locations, options, layout)
    cells, place_in = on_axis, []
    if layout == "grid":
        cells, place_in = packing.dense_cells(on_axis, locations.select("gid", "lat", "lon"), "zone"), ["t_idx", "n_idx"]
    return _packed_values(cells, params, by, options, place_in), _packed_metadata(params, by, first_year, last_year, options)


def gathered_dataset(
    ready: DataFrame, locations: DataFrame, first_year: int, last_year: int, options: ForcingOptions = ForcingOptions()
) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """``(values, metadata, times, sites)``: the data sets of the ``grid`` layout, compressed by gathering.

    ``values`` has the cells that hold a value, at their ``t_idx`` and ``n_idx``; every other pair of a stamp in
    ``times`` (``zone, time, dtime, t_idx``) and a site in ``sites`` (``zone, gid, n_idx``) of a zone holds the fill value.  Nothing
    is lost, and the rows are those of the data, not stamps times sites.
    """
    on_axis, by, params = _on_axis(ready, locations, options, "grid")
    times, places = packing.dense_axes(on_axis, locations.select("gid", "lat", "lon"), "zone")
    cells = packing.gathered_cells(on_axis, times, places, "zone")
    values = _packed_values(cells, params, by, options, ["t_idx", "n_idx"]).where(F.col("packed") != codec.FILL)
    dated = lookup_join(times, params.select("zone", "first"), "zone").withColumn("dtime", _stamps(options)["dtime"])
    return values, _packed_metadata(params, by, first_year, last_year, options), dated.select("zone", "time", "dtime", "t_idx"), places


def packed_columns(
    ready: DataFrame, locations: DataFrame, first_year: int, last_year: int, options: ForcingOptions = ForcingOptions()
) -> tuple[DataFrame, DataFrame]:
    """``(values, metadata)``: the data sets of the ``site`` layout side by side.

    A row is a stamp of a site, and a data set the column of its variable; stamps, offsets and ids are not repeated for each.
    """
    on_axis, by, params = _on_axis(ready, locations, options, "site")
    return _packed_wide(on_axis, params, by, options, []), _packed_metadata(params, by, first_year, last_year, options)


def _on_axis(ready: DataFrame, locations: DataFrame, options: ForcingOptions, layout: str) -> tuple[DataFrame, list[str], DataFrame]:
    """Unique rows on the axis of the data sets, the keys of a data set, and the packing parameters by these."""
    variables = projection.profile_variables(options.profile)
    hours = options.resolution_hours
    place = locations.select(F.col("gid").cast("string").alias("gid"), F.col("zone").cast("int").alias("zone"))
    rows, keys = lookup_join(ready.drop("zone"), place, "gid"), ["gid", "zone"]
    if hours > 1:
        origin = keys if layout == "site" else ["zone"]
        on_axis = timeaxis.resample_pick(rows, keys, "time", variables, hours, options.calendar, options.on_duplicate, origin)
    else:
        on_axis = timeaxis.unique_rows(timeaxis.drop_leap_days(rows, "time", options.calendar), keys, "time", variables, options.on_duplicate)
    # the one heavy shuffle; one pass over the result gives origins and ranges, another packs
    on_axis = stored(on_axis, "on-axis")
    by = keys if layout == "site" else ["zone"]
    return on_axis, by, materialize(packing.wide_params(on_axis, by, variables, "time"))


def _stamps(options: ForcingOptions) -> dict[str, Column]:
    return timeaxis.dtime_columns(F.col("time"), F.col("first"), options.dtime_units, options.calendar, options.dtime_mode)


def _packed_wide(cells: DataFrame, params: DataFrame, by: list[str], options: ForcingOptions, place_in: list[str]) -> DataFrame:
    variables = projection.profile_variables(options.profile)
    packed = packing.pack_wide(cells, params, by, variables).withColumn("dtime", _stamps(options)["dtime"])
    return packed.select("gid", "zone", "time", "dtime", *place_in, *variables)


def _packed_values(cells: DataFrame, params: DataFrame, by: list[str], options: ForcingOptions, place_in: list[str]) -> DataFrame:
    wide = _packed_wide(cells, params, by, options, place_in)
    values = projection.melt(wide, ["gid", "zone", "time", "dtime", *place_in], projection.profile_variables(options.profile), value="packed")
    return values.select("gid", "variable", "zone", "time", "dtime", *place_in, "packed")


def _packed_metadata(params: DataFrame, by: list[str], first_year: int, last_year: int, options: ForcingOptions) -> DataFrame:
    variables = projection.profile_variables(options.profile)
    return packing.with_attributes(packing.long_params(params, by, variables)).select(
        *by,
        "variable",
        labels.dataset_name(F.col("variable"), F.lit(first_year), F.lit(last_year), F.col("zone")).alias("dataset"),
        "add_offset",
        "scale_factor",
        F.lit(codec.FILL).cast("smallint").alias("fill"),
        "units",
        "description",
        "long_name",
        F.lit("time-dependent").alias("mode"),
        F.lit(options.calendar).alias("calendar"),
        _stamps(options)["dtime_units"].alias("dtime_units"),
    )


def site_table(locations: DataFrame) -> DataFrame:
    """Per-site coordinates as stored with the data: single precision, longitude on 0..360."""
    extra = [c for c in ("method", "sampled_geometry") if c in locations.columns]
    return locations.select(
        F.col("gid").cast("string").alias("gid"),
        F.col("lat").cast("float").alias("LATIXY"),
        physics.wrap_longitude(F.col("lon")).cast("float").alias("LONGXY"),
        *extra,
    )
