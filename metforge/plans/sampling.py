"""Raster time series to hourly rows per geometry."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metforge.functions import temporal
from metforge.functions.physics import nan_to_null
from metforge.operators import projection, spatial, timeaxis, zonal


@dataclass(frozen=True)
class SampleRequest:
    start_date: str
    end_date: str
    bands: str | Sequence[str] = "elm"
    years_per_task: int = 5
    job_name: str = "sample"
    resolution: float = 0.1
    weights: str = "centre"
    grid: tuple[float, float, float, float] | None = None
    scale: str | float = "native"
    sample_image: tuple[str, str] | None = None
    sample_band: str = "temperature_2m"


def batches(series: DataFrame, request: SampleRequest) -> list[tuple[dt.date, dt.date]]:
    """Date batches of the request, cut at the last day with data; a handful of pairs."""
    latest = timeaxis.latest_time(series, "time").select(F.to_date("latest").alias("latest"))
    bounds = latest.select(
        F.lit(request.start_date).cast("date").alias("s"), F.least(F.col("latest"), F.lit(request.end_date).cast("date")).alias("e")
    )
    rows = timeaxis.date_batches(bounds, "s", "e", request.years_per_task).orderBy("task_start").collect()
    return [(r["task_start"], r["task_end"]) for r in rows]


def valid_cells(series: DataFrame, request: SampleRequest) -> DataFrame:
    """``cell_id`` of the cells with a value at the first stamp of the sample image's window."""
    image = timeaxis.first_time_rows(series.select("cell_id", "time", request.sample_band), "time", *request.sample_image)
    return image.where(nan_to_null(F.col(request.sample_band)).isNotNull()).select("cell_id")


def sample_zonal(series: DataFrame, cells: DataFrame, geoms: DataFrame, request: SampleRequest) -> tuple[DataFrame, DataFrame]:
    """``(rows, locations)``.

    ``series`` is ``(cell_id, time, bands...)``, ``cells`` has one row per cell.  The cell
    to geometry map is made once and joined to all hours; ``batch`` names the export
    file ``<job>_<start>_<end>``.  A ``scale`` coarser than the native pixel samples block means.
    With a ``sample_image``, a window ``[start, end)`` of dates, a polygon without a cell that has a value of
    ``sample_band`` at the first stamp in it is sampled at its centroid; otherwise every cell counts.
    """
    bands = projection.resolve_bands(request.bands, None if isinstance(request.bands, str) else series.columns)
    parts = batches(series, request)
    factor, resolution, grid = zonal.coarsening(zonal.sampling_scale_m(request.scale)), request.resolution, request.grid
    image_series = series
    if factor > 1:
        if request.sample_image is not None:
            image_series, _ = zonal.coarsen(series, cells, [request.sample_band], factor, resolution)
        series, cells = zonal.coarsen(series, cells, bands, factor, resolution)
        resolution, grid = resolution * factor, None
    valid = None if request.sample_image is None else valid_cells(image_series, request)
    cell_map, effective = zonal.sampling_map(cells, geoms, resolution, request.weights, grid, valid)
    places = spatial.locations(effective)
    t = F.col("time")
    label = F.when(F.lit(False), F.lit(""))
    for start, end in parts:
        label = label.when(temporal.in_half_open(t, start, end), F.lit(f"{request.job_name}_{start}_{end}"))
    inside = temporal.in_half_open(t, parts[0][0], parts[-1][1]) if parts else F.lit(False)
    means = zonal.zonal_mean(series.where(inside), cell_map, bands)
    rows = means.select("gid", temporal.stamp(t, "minute").alias("date"), *bands, label.alias("batch"))
    return rows, places
