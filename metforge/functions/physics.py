"""Meteorological conversions as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the humidity formulas (Clausius-Clapeyron form).
E_REF = 611.0  # Pa, vapour pressure at T_REF
R_VAPOUR = 461.52  # J/kg/K
R_DRY = 287.053  # J/kg/K
L_VAPORISATION = 2453000.0  # J/kg
L_SUBLIMATION = 2838000.0  # J/kg
T_REF = 273.15  # K


def wind_speed(u: Column, v: Column) -> Column:
    return F.sqrt(u * u + v * v)


def wind_direction(u: Column, v: Column, fix_north: bool = False) -> Column:
    """Direction the wind blows from, in degrees.

    An angle of exactly 180 is reported as 180 for compatibility with existing
    data sets, and as 0 when ``u`` is a negative zero; ``fix_north`` reports the
    due-north wind as 360 instead.
    """
    angle = F.degrees(F.atan2(u, v))
    if fix_north:
        return angle + 180.0
    # atan2 here drops the sign of zero
    minus_zero = (u == 0) & (v < 0) & u.cast("string").startswith("-")
    return F.when(angle >= 180.0, F.when(minus_zero, F.lit(0.0)).otherwise(angle)).otherwise(angle + 180.0)


def metres_per_hour_to_mm_per_second(c: Column) -> Column:
    return c / 3.6


def joules_per_hour_to_watts(c: Column) -> Column:
    return c / 3600.0


def _pressure_at(t: Column, latent: Column) -> Column:
    return E_REF * F.exp((latent / R_VAPOUR) * (1.0 / T_REF - F.try_divide(F.lit(1.0), t)))


def saturation_vapour_pressure(t: Column) -> Column:
    latent = F.when(t >= T_REF, L_VAPORISATION).otherwise(L_SUBLIMATION)
    return _pressure_at(t, latent)


def vapour_pressure(t: Column, dewpoint: Column, consistent_latent_heat: bool = False) -> Column:
    """Actual vapour pressure.

    The latent heat is chosen on the air temperature, with the two phases the
    other way round than at saturation; existing data sets depend on it.
    ``consistent_latent_heat`` uses the saturation rule instead.
    """
    if consistent_latent_heat:
        latent = F.when(t >= T_REF, L_VAPORISATION).otherwise(L_SUBLIMATION)
    else:
        latent = F.when(t <= T_REF, L_VAPORISATION).otherwise(L_SUBLIMATION)
    return _pressure_at(dewpoint, latent)


def relative_humidity(t: Column, dewpoint: Column, consistent_latent_heat: bool = False) -> Column:
    """Percent."""
    e = vapour_pressure(t, dewpoint, consistent_latent_heat)
    return F.try_divide(e, saturation_vapour_pressure(t)) * 100.0


def specific_humidity(
    t: Column, dewpoint: Column, pressure: Column, consistent_latent_heat: bool = False
) -> Column:
    """kg/kg, through the mixing ratio."""
    e = vapour_pressure(t, dewpoint, consistent_latent_heat)
    ratio = F.try_divide(e * R_DRY, R_VAPOUR * (pressure - e))
    return F.try_divide(ratio, ratio + 1.0)


def clip_negative(c: Column) -> Column:
    """Negative becomes 0; null and NaN stay what they are."""
    return F.when(c < 0, F.lit(0.0)).otherwise(c)


def nan_to_null(c: Column) -> Column:
    """Missing values have one form downstream: null."""
    return F.when(~F.isnan(c), c)


def wrap_longitude(lon: Column) -> Column:
    """Longitude on 0..360."""
    return F.pmod(lon, F.lit(360.0))


def magnitude_gap(reference: Column, mean: Column) -> Column:
    """Orders of magnitude between two means; null where the logarithm does not exist."""
    return F.log10(reference) - F.log10(mean)
