"""Climate-model cells: spatial subset of the chosen data sets and the long table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metforge.functions import physics
from metforge.operators import catalog, spatial


def subset(
    cells: DataFrame, point: tuple[float, float] | None = None, lat_bounds: tuple[float, float] | None = None,
    lon_bounds: tuple[float, float] | None = None, polygons: DataFrame | None = None, value: str = "value",
    cell_id: str = "cell_id", resolution: float = 1.0,
) -> DataFrame:
    """Cells at the point nearest to ``(lat, lon)``, in a box, or masked by polygons; all cells otherwise.

    Longitudes of the cells are taken as 0..360; the request may use either convention.
    """
    if point is not None:
        lat, lon = point
        at = cells.sparkSession.range(1).select(
            F.lit("point").alias("gid"), F.lit(float(lat)).alias("lat"), physics.wrap_longitude(F.lit(float(lon))).alias("lon")
        )
        return spatial.sample_points(at, cells).drop("gid")
    if lat_bounds is not None and lon_bounds is not None:
        return spatial.box_subset(cells, lat_bounds, lon_bounds, wrap=True)
    if polygons is not None:
        return spatial.polygon_mask(cells, polygons, value, cell_id, resolution=resolution, wrap=True)
    return cells


def extract(cells: DataFrame, variables: Sequence[str], first: str, last: str, path: str = "path") -> DataFrame:
    """Long table of a date window, each model in its own calendar."""
    return catalog.long_table(catalog.in_window(cells, first, last), variables, path)
