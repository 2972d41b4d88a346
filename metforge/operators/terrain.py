"""Topographic units from a cell table ``(feature_id, row, col, x, y, elevation)``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import WindowSpec
from pyspark.sql import functions as F

from metforge import dims
from metforge.functions import geometry as geo
from metforge.operators.ordering import order_statistics
from metforge.operators.skew import lookup_join

TOP = 100000.0  # upper end of the highest elevation band
TARGET_PIXELS = 500  # cells aimed at per unit
FINEST_SAMPLE_M = 5.0


def sampling_scale(geoms: DataFrame, units: int, target: int = TARGET_PIXELS) -> DataFrame:
    """Add ``scale_m``: pixel size that gives about ``target`` pixels per unit."""
    area = geo.sphere_area(geo.edges(F.col("rings")))
    return geoms.withColumn("area_m2", area).withColumn(
        "scale_m", F.greatest(F.sqrt(F.col("area_m2") / F.lit(float(units * target))), F.lit(FINEST_SAMPLE_M))
    )


def export_scale(requested: str | float, native: bool = True) -> float:
    """Pixel size of the exported units; ``"native"`` is that of the DEM if it is the native one."""
    if requested == "native":
        return float(dims.DEM_NATIVE_SCALE_M if native else 100)
    return float(requested)


def downsample(dem: DataFrame, scale_m: float, native_m: float = float(dims.DEM_NATIVE_SCALE_M)) -> DataFrame:
    """Every k-th row and column, k being the ratio of the pixel sizes."""
    k = max(1, round(scale_m / native_m))
    if k == 1:
        return dem
    return dem.where((F.col("row") % k == 0) & (F.col("col") % k == 0))


def _lines() -> tuple[WindowSpec, WindowSpec]:
    """Windows along the rows and along the columns of a tile."""
    tile = ("feature_id", "tr", "tc")
    return W.partitionBy(*tile, "row").orderBy("col"), W.partitionBy(*tile, "col").orderBy("row")


def _tiled(cells: DataFrame, tile: int) -> DataFrame:
    """Cells by tile (``tr, tc``), each tile with a rim of one cell of its neighbours (``own`` is false)."""
    row, col, size = F.col("row"), F.col("col"), F.lit(tile)
    tr, tc = F.floor(row / size).cast("int"), F.floor(col / size).cast("int")
    at = lambda r, c, own: F.struct(r.alias("tr"), c.alias("tc"), F.lit(own).alias("own"))
    copies = F.array_compact(
        F.array(
            at(tr, tc, True),
            F.when(F.pmod(row, size) == 0, at(tr - 1, tc, False)),
            F.when(F.pmod(row, size) == tile - 1, at(tr + 1, tc, False)),
            F.when(F.pmod(col, size) == 0, at(tr, tc - 1, False)),
            F.when(F.pmod(col, size) == tile - 1, at(tr, tc + 1, False)),
        )
    )
    tiled = cells.withColumn("_tile", F.explode(copies)).select(*cells.columns, "_tile.*")
    return tiled.repartition("feature_id", "tr", "tc")


def with_aspect(dem: DataFrame, tile: int = 256) -> DataFrame:
    """Add ``aspect``: downslope direction, degrees clockwise from north.

    Cells without all four neighbours, and flat cells, have null.  The raster is cut
    into tiles that carry a one-cell rim of their neighbours, so one shuffle by tile
    serves both gradients and no task holds more than a tile of a feature.
    """
    row, col = F.col("row"), F.col("col")
    tiled = _tiled(dem, tile)
    along_row, along_col = _lines()
    e = F.col("elevation")

    def neighbour(shift: int, window, index: Column) -> Column:
        at_index = F.lag(index, -shift).over(window)
        return F.when(at_index == index + shift, F.lag(e, -shift).over(window))

    slopes = tiled.withColumn("_dx", (neighbour(1, along_row, col) - neighbour(-1, along_row, col)) / 2.0).withColumn(
        "_dy", (neighbour(-1, along_col, row) - neighbour(1, along_col, row)) / 2.0
    )
    dx, dy = F.col("_dx"), F.col("_dy")
    angle = F.pmod(F.degrees(F.atan2(-dx, -dy)), F.lit(360.0))
    return (
        slopes.where(F.col("own"))
        .withColumn("aspect", F.when((dx != 0) | (dy != 0), angle))
        .drop("tr", "tc", "own", "_dx", "_dy")
    )


def elevation_thresholds(dem: DataFrame, bins: int, floor: float = 0.0) -> DataFrame:
    """``(feature_id, thresholds)``: ``bins + 1`` band edges per feature.

    Inner edges are the sorted elevations at 0-based position ``int(p * n / 100)`` for
    p = 100/bins, 200/bins, ...; the outer ones are ``floor`` and 100000.
    """
    names = [f"_t{i}" for i in range(1, bins)]

    def positions(n: Column) -> dict[str, Column]:
        return {name: F.floor(F.lit((i + 1) * (100 / bins)) * n / 100.0) for i, name in enumerate(names)}

    if names:
        stats = order_statistics(dem, ["feature_id"], "elevation", positions)
    else:
        stats = dem.where(F.col("elevation").isNotNull()).select("feature_id").distinct()
    return stats.select(
        "feature_id", F.array(F.lit(float(floor)), *[F.col(n).cast("double") for n in names], F.lit(TOP)).alias("thresholds")
    )


def aspect_class(aspect: Column, classes: Sequence[tuple[float, float, str]]) -> Column:
    """0-based index of the first class ``[start, end)`` that holds the angle; a class may wrap north."""
    out = F.when(F.lit(False), F.lit(0))
    for i, (start, end, _) in enumerate(classes):
        above, below = aspect >= start, aspect < end
        out = out.when((above & below) if start <= end else (above | below), F.lit(i))
    return out


def _band(e: Column, thresholds: Column) -> Column:
    """0-based elevation band, null outside all of them."""
    reached = F.size(F.filter(thresholds, lambda t: t <= e))
    return F.when((reached >= 1) & (reached < F.size(thresholds)), reached - 1)


def unit_count(method: str, bins: int | None, max_units: int, classes: Sequence[tuple[float, float, str]]) -> tuple[int, int]:
    """Checked ``(elevation bins, units)``."""
    if method == "epercentiles":
        bins = max_units if bins is None else bins
        units = bins
    elif method == "elevaspect":
        if bins is None:
            raise ValueError("elevaspect needs a number of elevation bins")
        units = bins * len(classes)
        if units > max_units:
            raise ValueError(f"{units} units exceed the maximum of {max_units}")
    else:
        raise ValueError(f"unknown method {method!r}")
    return bins, units


def assign_units(dem: DataFrame, thresholds: DataFrame, classes: Sequence[tuple[float, float, str]] | None = None) -> DataFrame:
    """Add ``topounit_id`` (1.., elevation-major); cells in no unit drop out."""
    rows = lookup_join(dem, thresholds, "feature_id").withColumn("_band", _band(F.col("elevation"), F.col("thresholds")))
    if classes is None:
        unit = F.col("_band") + 1
    else:
        unit = F.col("_band") * len(classes) + aspect_class(F.col("aspect"), classes) + 1
    return rows.withColumn("topounit_id", unit.cast("int")).where(F.col("topounit_id").isNotNull()).drop("_band", "thresholds")


def unit_metadata(thresholds: DataFrame, classes: Sequence[tuple[float, float, str]] | None = None) -> DataFrame:
    """One row per feature and unit with its elevation band and aspect class."""
    t = F.col("thresholds")
    bands = thresholds.select("feature_id", t, F.explode(F.sequence(F.lit(0), F.size(t) - 2)).alias("_band")).select(
        "feature_id", "_band", t[F.col("_band")].alias("min_elev"), t[F.col("_band") + 1].alias("max_elev")
    )
    if classes is None:
        return bands.select("feature_id", (F.col("_band") + 1).alias("topounit_id"), "min_elev", "max_elev")
    table = F.array(
        *[
            F.struct(
                F.lit(i).alias("i"), F.lit(code).alias("aspect_name"), F.lit(float(s)).alias("aspect_start"), F.lit(float(e)).alias("aspect_end")
            )
            for i, (s, e, code) in enumerate(classes)
        ]
    )
    return bands.withColumn("_c", F.explode(table)).select(
        "feature_id",
        (F.col("_band") * len(classes) + F.col("_c.i") + 1).alias("topounit_id"),
        "min_elev",
        "max_elev",
        "_c.aspect_name",
        "_c.aspect_start",
        "_c.aspect_end",
    )


def dissolve(units: DataFrame, metadata: DataFrame, cell_area: float = 1.0) -> DataFrame:
    """One row per unit of each feature: members, area, mean elevation, extent and metadata.

    Units without members stay, with 0 cells.
    """
    members = units.groupBy("feature_id", "topounit_id").agg(
        F.count(F.lit(1)).alias("n_cells"),
        F.avg("elevation").alias("mean_elev"),
        *[f(c).alias(f"{n}_{c}") for c in ("x", "y") for n, f in (("min", F.min), ("max", F.max))],
    )
    return (
        metadata.join(members, ["feature_id", "topounit_id"], "left")
        .withColumn("n_cells", F.coalesce("n_cells", F.lit(0)))
        .withColumn("area", F.col("n_cells") * F.lit(cell_area))
    )


def outline_segments(units: DataFrame, tile: int = 256) -> DataFrame:
    """Boundary of each unit on the cell lattice, as straight segments that cannot be made longer.

    One shuffle by tile finds the sides whose neighbour is another unit or none; only these go on, and
    sides that follow one another on a line are one segment, from ``(row0, col0)`` to ``(row1, col1)``.
    """
    r, c = F.col("row"), F.col("col")
    tiled = _tiled(units.select("feature_id", "topounit_id", "row", "col"), tile)

    along_row, along_col = _lines()

    def same(shift: int, window: WindowSpec, index: Column) -> Column:
        near = (F.lag(index, -shift).over(window) == index + shift) & (F.lag("topounit_id", -shift).over(window) == F.col("topounit_id"))
        return F.coalesce(near, F.lit(False))

    found = tiled.withColumns(
        {"_w": same(-1, along_row, c), "_e": same(1, along_row, c), "_n": same(-1, along_col, r), "_s": same(1, along_col, r)}
    ).where(F.col("own"))
    side = lambda held, level, line, place: F.when(~F.col(held), F.struct(F.lit(level).alias("level"), line.alias("line"), place.alias("place")))
    sides = F.array_compact(F.array(side("_n", True, r, c), side("_s", True, r + 1, c), side("_w", False, c, r), side("_e", False, c + 1, r)))
    keys = ["feature_id", "topounit_id", "level", "line"]
    rows = found.select("feature_id", "topounit_id", F.inline(sides))
    run = F.col("place") - F.row_number().over(W.partitionBy(*keys).orderBy("place"))  # a line of one unit: as long as a raster is wide
    ends = rows.withColumn("_run", run).groupBy(*keys, "_run").agg(F.min("place").alias("a"), (F.max("place") + 1).alias("b"))
    pick = lambda x, y: F.when(F.col("level"), F.col(x)).otherwise(F.col(y))
    return ends.select(
        "feature_id", "topounit_id", pick("line", "a").alias("row0"), pick("a", "line").alias("col0"), pick("line", "b").alias("row1"), pick("b", "line").alias("col1")
    )
