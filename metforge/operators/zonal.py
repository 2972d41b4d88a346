"""Zonal means of raster time series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metforge import dims
from metforge.functions import physics
from metforge.operators import spatial
from metforge.operators.skew import lookup_join
from metforge.session import materialize, stored


# the map is joined to every hour, so a larger broadcast than usual pays off
MAP_BROADCAST_BYTES = 256 * 1024 * 1024


def sampling_scale_m(requested: str | float) -> float:
    """``"native"`` or a pixel size in metres, never finer than the native one."""
    if requested == "native":
        return float(dims.NATIVE_SCALE_M)
    return float(max(requested, dims.NATIVE_SCALE_M))


def zonal_mean(
    series: DataFrame, cell_map: DataFrame, bands: Sequence[str], time: str = "time", cell_id: str = "cell_id", gid: str = "gid"
) -> DataFrame:
    """Weighted mean of each band per (gid, time); missing cells do not count.

    ``cell_map`` is ``(cell_id, gid, w)`` and does not depend on time.
    """
    side = cell_map.select(cell_id, gid, "w")
    rows = lookup_join(series.select(cell_id, time, *bands), side, cell_id, limit=MAP_BROADCAST_BYTES)
    w = F.col("w")
    means = []
    for b in bands:
        v = physics.nan_to_null(F.col(b))
        means.append(F.try_divide(F.sum(w * v), F.sum(F.when(v.isNotNull(), w))).alias(b))
    return rows.groupBy(gid, time).agg(*means)


def coarsening(scale_m: float) -> int:
    """Native pixels per side of a pixel of the given size."""
    return max(1, round(scale_m / dims.NATIVE_SCALE_M))


def coarsen(
    series: DataFrame, cells: DataFrame, bands: Sequence[str], factor: int, resolution: float, time: str = "time", cell_id: str = "cell_id"
) -> tuple[DataFrame, DataFrame]:
    """``(series, cells)`` on blocks of ``factor`` x ``factor`` cells: the mean of the cells with data."""
    width = resolution * factor
    # native cells are numbered first: a coordinate like 0.3 / 0.1 may come out a little below its number
    native = lambda c: F.floor(F.col(c) / resolution + 1e-6)
    row, col = F.floor(native("lat") / factor), F.floor(native("lon") / factor)
    block = F.concat_ws("_", row.cast("string"), col.cast("string"))
    members = cells.select(cell_id, block.alias("_block"))
    centres = cells.select(
        block.alias(cell_id), ((row + 0.5) * width).alias("lat"), ((col + 0.5) * width).alias("lon")
    ).distinct()
    rows = lookup_join(series.select(cell_id, time, *bands), members, cell_id, limit=MAP_BROADCAST_BYTES)
    means = rows.groupBy(F.col("_block").alias(cell_id), time).agg(*[F.avg(physics.nan_to_null(F.col(b))).alias(b) for b in bands])
    return means, centres


def sampling_map(
    cells: DataFrame, geoms: DataFrame, resolution: float = 1.0, weights: str = "centre",
    grid: tuple[float, float, float, float] | None = None, valid: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """``(cell_map, geometries)`` for one row per cell and one per geometry.

    Polygons take the cells whose centres they contain (weight 1) or, with
    ``weights="overlap"``, every cell by the share covered.  Points, and polygons that
    hold no cell centre, take the nearest cell.  With ``valid``, a table of the ``cell_id`` that have
    data in a sample image, only those count as held; a polygon that holds one takes all its cells.
    """
    if weights not in ("centre", "overlap"):
        raise ValueError("weights must be 'centre' or 'overlap'")
    covered = stored(spatial.cells_in_polygons(cells, geoms, resolution=resolution), "covered")
    held = covered
    if valid is not None:
        held = lookup_join(covered, stored(valid.select("cell_id").distinct(), "valid-cells"), "cell_id", "left_semi")
    effective = materialize(spatial.effective_geometries(geoms, held))
    if valid is not None:
        covered = lookup_join(covered, effective.where(F.col("geom_type") != "Point").select("gid"), "gid", "left_semi")
    if weights == "overlap":
        kept = effective.where(F.col("geom_type") != "Point").select("gid", "geom_type", "rings")
        by_area = spatial.overlap_weights(cells, kept, resolution)
    else:
        by_area = covered.withColumn("w", F.lit(1.0))
    points = effective.where(F.col("geom_type") == "Point").select(
        "gid", F.col("rings")[0][0]["y"].alias("lat"), F.col("rings")[0][0]["x"].alias("lon")
    )
    at_points = spatial.sample_points(points, cells.select("cell_id", "lat", "lon"), grid=grid).select(
        "cell_id", "gid", F.lit(1.0).alias("w")
    )
    return stored(by_area.unionByName(at_points), "cell-map"), effective
