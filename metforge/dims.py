"""Fixed dimension data: variables, ranges, limits, names, band catalogue."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# ---------------------------------------------------------------------------
# Fixed values.  They must equal the ones the land model and the published
# forcing data sets use, so they are stated as plain lists.
# ---------------------------------------------------------------------------

# variable, units, description, reanalysis name, climate-model name
VARIABLES = [
    ("TBOT", "K", "temperature at the lowest atm level (TBOT)", "temperature_2m", "tas"),
    ("DTBOT", "unsure", "dewpoint temperature [era5 direct]", "dewpoint_temperature_2m", "tdps"),
    ("RH", "%", "relative humidity at the lowest atm level (RH)", "relative_humidity", "hur"),
    ("WIND", "m/s", "wind magnitude at the lowest atm level (WIND)", "wind_speed", "sfcWind"),
    ("FSDS", "W/m2", "incident solar (FSDS)", "surface_solar_radiation_downwards_hourly", "rsds"),
    ("FLDS", "W/m2", "incident longwave (FLDS)", "surface_thermal_radiation_downwards_hourly", "rlds"),
    ("PSRF", "Pa", "pressure at the lowest atm level (PSRF)", "surface_pressure", "ps"),
    ("PRECTmms", "mm/s", "precipitation (PRECTmms)", "total_precipitation_hourly", "pr"),
    ("QBOT", "kg/kg", "specific humidity at the lowest atm level (QBOT)", "specific_humidity", "huss"),
    ("ZBOT", "m", "observational height (ZBOT)", None, None),
    ("UWIND", "m/s", "u component of wind velocity", "u_component_of_wind_10m", "uas"),
    ("VWIND", "m/s", "v component of wind velocity", "v_component_of_wind_10m", "vas"),
]

REQUIRED_BANDS = [
    "temperature_2m",
    "u_component_of_wind_10m",
    "v_component_of_wind_10m",
    "surface_solar_radiation_downwards_hourly",
    "surface_thermal_radiation_downwards_hourly",
    "total_precipitation_hourly",
    "surface_pressure",
    "dewpoint_temperature_2m",
]

REQUIRED_CLIMATE_VARIABLES = ["sfcWind", "rsds", "rlds", "huss", "pr", "tas", "hur", "ps"]

# output profile -> variables
PROFILES = {
    "BYPASS": ["TBOT", "PRECTmms", "QBOT", "FSDS", "FLDS", "PSRF", "WIND"],
    "DATM_MODE": ["ZBOT", "TBOT", "PRECTmms", "RH", "FSDS", "FLDS", "PSRF", "WIND"],
}

# preset packing ranges
PACKING_RANGES = [
    ("PRECTmms", -0.04, 0.04),
    ("FSDS", -20.0, 2000.0),
    ("TBOT", 175.0, 350.0),
    ("RH", 0.0, 100.0),
    ("QBOT", 0.0, 0.1),
    ("FLDS", 0.0, 1000.0),
    ("PSRF", 20000.0, 120000.0),
    ("WIND", -1.0, 100.0),
]

# hard plausibility limits
HARD_LIMITS = [
    ("TBOT", 180.0, 350.0),
    ("RH", 0.0, 100.0),
    ("WIND", 0.0, 80.0),
    ("PSRF", 8e4, 1.5e5),
    ("FSDS", 0.0, 2500.0),
    ("PRECTmms", 0.0, 15.0),
]

# reference statistics: variable, mean, 1st percentile, 99th percentile
REFERENCE_STATS = [
    ("FLDS", 241.61348580062975, 124.493408203125, 363.47250366210847),
    ("FSDS", 97.75458921397247, -0.02685546875, 640.371337890625),
    ("PRECTmms", 6.108417376083734e-06, 0.0, 0.00012084960937500001),
    ("PSRF", 101517.92885260089, 99128.11279296875, 104250.79345703125),
    ("QBOT", 0.0017366085448494591, 0.0001058959960937439, 0.006910400390624995),
    ("TBOT", 265.1942151892329, 236.1052703857422, 294.68711853027344),
    ("WIND", 2.8788591383582154, 0.5445281982421832, 6.71185302734375),
]

# names whose values cannot be negative
NON_NEGATIVE = [
    "surface_solar_radiation_downwards_hourly",
    "surface_thermal_radiation_downwards_hourly",
    "surface_thermal_radiation_upwards_hourly",
    "surface_net_solar_radiation_hourly",
    "surface_net_thermal_radiation_hourly",
    "surface_latent_heat_flux_hourly",
    "surface_sensible_heat_flux_hourly",
    "total_precipitation_hourly",
    "snowfall_hourly",
    "snowmelt_hourly",
    "runoff_hourly",
    "evaporation_hourly",
    "volumetric_soil_water_layer_1",
    "volumetric_soil_water_layer_2",
    "volumetric_soil_water_layer_3",
    "volumetric_soil_water_layer_4",
    "snow_depth",
    "skin_temperature",
    "2m_temperature",
    "10m_u_component_of_wind",
    "10m_v_component_of_wind",
    "surface_pressure",
    "relative_humidity",
    "specific_humidity",
]

# aspect classes: start, end (degrees, half open, may wrap), code
ASPECT_CLASSES = [(270.0, 90.0, "N"), (90.01, 269.99, "S")]

# hourly reanalysis bands: name, units
BAND_UNITS = [
    ("dewpoint_temperature_2m", "K"),
    ("temperature_2m", "K"),
    ("skin_temperature", "K"),
    ("soil_temperature_level_1", "K"),
    ("soil_temperature_level_2", "K"),
    ("soil_temperature_level_3", "K"),
    ("soil_temperature_level_4", "K"),
    ("lake_bottom_temperature", "K"),
    ("lake_ice_depth", "m"),
    ("lake_ice_temperature", "K"),
    ("lake_mix_layer_depth", "m"),
    ("lake_mix_layer_temperature", "K"),
    ("lake_shape_factor", None),
    ("lake_total_layer_temperature", "K"),
    ("snow_albedo", None),
    ("snow_cover", "%"),
    ("snow_density", "kg/m^3"),
    ("snow_depth", "m"),
    ("snow_depth_water_equivalent", "m of water equivalent"),
    ("snowfall", "m of water equivalent"),
    ("snowmelt", "m of water equivalent"),
    ("temperature_of_snow_layer", "K"),
    ("skin_reservoir_content", "m of water equivalent"),
    ("volumetric_soil_water_layer_1", "Volume fraction"),
    ("volumetric_soil_water_layer_2", "Volume fraction"),
    ("volumetric_soil_water_layer_3", "Volume fraction"),
    ("volumetric_soil_water_layer_4", "Volume fraction"),
    ("forecast_albedo", None),
    ("surface_latent_heat_flux", "J/m^2"),
    ("surface_net_solar_radiation", "J/m^2"),
    ("surface_net_thermal_radiation", "J/m^2"),
    ("surface_sensible_heat_flux", "J/m^2"),
    ("surface_solar_radiation_downwards", "J/m^2"),
    ("surface_thermal_radiation_downwards", "J/m^2"),
    ("evaporation_from_bare_soil", "m of water equivalent"),
    ("evaporation_from_open_water_surfaces_excluding_oceans", "m of water equivalent"),
    ("evaporation_from_the_top_of_canopy", "m of water equivalent"),
    ("evaporation_from_vegetation_transpiration", "m of water equivalent"),
    ("potential_evaporation", "m"),
    ("runoff", "m"),
    ("snow_evaporation", "m of water equivalent"),
    ("sub_surface_runoff", "m"),
    ("surface_runoff", "m"),
    ("total_evaporation", "m of water equivalent"),
    ("u_component_of_wind_10m", "m/s"),
    ("v_component_of_wind_10m", "m/s"),
    ("surface_pressure", "Pa"),
    ("total_precipitation", "m"),
    ("leaf_area_index_high_vegetation", "Area fraction"),
    ("leaf_area_index_low_vegetation", "Area fraction"),
    ("snowfall_hourly", "m of water equivalent"),
    ("snowmelt_hourly", "m of water equivalent"),
    ("surface_latent_heat_flux_hourly", "J/m^2"),
    ("surface_net_solar_radiation_hourly", "J/m^2"),
    ("surface_net_thermal_radiation_hourly", "J/m^2"),
    ("surface_sensible_heat_flux_hourly", "J/m^2"),
    ("surface_solar_radiation_downwards_hourly", "J/m^2"),
    ("surface_thermal_radiation_downwards_hourly", "J/m^2"),
    ("evaporation_from_bare_soil_hourly", "m of water equivalent"),
    ("evaporation_from_open_water_surfaces_excluding_oceans_hourly", "m of water equivalent"),
    ("evaporation_from_the_top_of_canopy_hourly", "m of water equivalent"),
    ("evaporation_from_vegetation_transpiration_hourly", "m of water equivalent"),
    ("potential_evaporation_hourly", "m"),
    ("runoff_hourly", "m"),
    ("snow_evaporation_hourly", "m of water equivalent"),
    ("sub_surface_runoff_hourly", "m"),
    ("surface_runoff_hourly", "m"),
    ("total_evaporation_hourly", "m of water equivalent"),
    ("total_precipitation_hourly", "m"),
]

NATIVE_SCALE_M = 11132  # native pixel of the hourly reanalysis
DEM_NATIVE_SCALE_M = 2
MODEL_STEP_S = 1800  # land-model time step
# ---------------------------------------------------------------------------

SHORT_NAMES = {source: name for name, _, _, source, _ in VARIABLES if source}
CLIMATE_SHORT_NAMES = {source: name for name, _, _, _, source in VARIABLES if source}
BANDS = [name for name, _ in BAND_UNITS]


def variables(spark: SparkSession) -> DataFrame:
    """``(variable, units, description, long_name)``: 12 fixed rows."""
    return spark.createDataFrame(
        [v[:4] for v in VARIABLES], "variable string, units string, description string, long_name string"
    )


def reference_stats(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        REFERENCE_STATS, "variable string, ref_mean double, ref_min double, ref_max double"
    )


def hard_limits(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(HARD_LIMITS, "variable string, hard_min double, hard_max double")


def packing_ranges(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(PACKING_RANGES, "variable string, low double, high double")


def bands(spark: SparkSession) -> DataFrame:
    """Built-in band catalogue; use :func:`metforge.sources.readers.band_catalogue` for a file."""
    return spark.createDataFrame(BAND_UNITS, "band_name string, units string")
