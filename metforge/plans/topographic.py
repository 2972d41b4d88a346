"""Elevation model to topographic units."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from metforge import dims
from metforge.operators.terrain import (
    assign_units,
    dissolve,
    downsample,
    elevation_thresholds,
    unit_count,
    unit_metadata,
    with_aspect,
)
from metforge.session import materialize


def topounits(
    dem: DataFrame, method: str = "epercentiles", max_units: int = 11, bins: int | None = None,
    classes: Sequence[tuple[float, float, str]] | None = None, sample_every: int = 1, cell_area: float = 1.0,
) -> DataFrame:
    """Elevation-quantile units, or elevation bands crossed with aspect classes."""
    classes = list(dims.ASPECT_CLASSES if classes is None else classes)
    bins, _ = unit_count(method, bins, max_units, classes)
    used = classes if method == "elevaspect" else None
    if used is not None and "aspect" not in dem.columns:
        dem = with_aspect(dem)
    sample = dem if sample_every == 1 else downsample(dem, float(sample_every), 1.0)
    thresholds = materialize(elevation_thresholds(sample, bins))
    units = assign_units(dem, thresholds, used)
    return dissolve(units, unit_metadata(thresholds, used), cell_area)
