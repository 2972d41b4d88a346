"""Spatial joins: containment, shares, intersection and nearest cells.

What polygons need is computed edge by edge in :mod:`metforge.operators.polygons`; this module knows the tables
of geometries (``gid, geom_type, rings``) and cells.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metforge.functions import geometry as geo
from metforge.functions.labels import cell_label
from metforge.operators import polygons
from metforge.operators.ordering import nearest_values
from metforge.operators.skew import lookup_join
from metforge.session import materialize

def with_shape(geoms: DataFrame, rings: str = "rings") -> DataFrame:
    """Add the bounding box."""
    out = geoms.withColumn("_b", geo.bounds(F.col(rings)))
    return out.select(*[c for c in out.columns if c != "_b"], "_b.*")


def _polygon_edges(geoms: DataFrame, gid: str) -> DataFrame:
    return polygons.edge_table(geoms.where(F.col("geom_type") != "Point"), gid)


def cells_in_polygons(
    cells: DataFrame, geoms: DataFrame, cell_id: str = "cell_id", gid: str = "gid", x: str = "lon", y: str = "lat",
    resolution: float = 1.0,
) -> DataFrame:
    """``(cell_id, gid)`` of every cell centre inside a polygon.

    ``cells`` has one row per cell; ``resolution`` is the typical distance of centres and
    only affects speed.
    """
    centres = cells.select(cell_id, F.col(x).cast("double").alias("_x"), F.col(y).cast("double").alias("_y"))
    return polygons.points_in_polygons(centres, _polygon_edges(geoms, gid), cell_id, gid, resolution)


def overlap_weights(
    cells: DataFrame, geoms: DataFrame, resolution: float, cell_id: str = "cell_id", gid: str = "gid", x: str = "lon", y: str = "lat"
) -> DataFrame:
    """``(cell_id, gid, w)``: share of each square cell that lies in the polygon, where positive."""
    return polygons.cell_shares(cells, _polygon_edges(geoms, gid), resolution, cell_id, gid, x, y)


def box_subset(
    df: DataFrame, lat_bounds: tuple[float, float], lon_bounds: tuple[float, float], lat: str = "lat", lon: str = "lon",
    wrap: bool = False,
) -> DataFrame:
    """Inclusive box.  With ``wrap`` the bounds are taken on 0..360, and a box whose west edge
    then exceeds its east edge runs across the seam."""
    west, east = lon_bounds
    x = F.col(lon)
    if wrap:
        west, east = west % 360.0, east % 360.0
    rows = df.where(F.col(lat).between(*lat_bounds))
    return rows.where(x.between(west, east) if west <= east else (x >= west) | (x <= east))


def _both_sides(geoms: DataFrame) -> DataFrame:
    """Polygons where cells of 0..360 degrees can be: as they are, and, if they reach west of Greenwich, 360 degrees on."""
    on = F.transform("rings", lambda r: F.transform(r, lambda p: F.struct((p["x"] + 360.0).alias("x"), p["y"].alias("y"))))
    west = F.array_min(F.flatten(F.transform("rings", lambda r: F.transform(r, lambda p: p["x"]))))
    copies = F.when(west < 0, F.array(F.col("rings"), on)).otherwise(F.array("rings"))
    rows = geoms.select("gid", "geom_type", F.posexplode(copies).alias("_side", "rings"))
    return rows.select(F.concat_ws("|", F.col("gid").cast("string"), "_side").alias("gid"), "geom_type", "rings")


def polygon_mask(
    cells: DataFrame, geoms: DataFrame, value: str, cell_id: str = "cell_id", lat: str = "lat", lon: str = "lon", resolution: float = 1.0,
    wrap: bool = False,
) -> DataFrame:
    """Cells in the common bounding box of the polygons; values outside all polygons become null.

    With ``wrap`` the cells have longitudes of 0..360 and the polygons may run across Greenwich,
    with negative longitudes in the west.
    """
    box = (
        with_shape(geoms)
        .agg(*[F.min(c).alias(c) for c in ("min_x", "min_y")], *[F.max(c).alias(c) for c in ("max_x", "max_y")])
        .first()
    )
    if box["min_x"] is None:
        return cells.limit(0)
    full = box["max_x"] - box["min_x"] >= 360.0
    across = (0.0, 359.999999999) if wrap and full else (box["min_x"], box["max_x"])
    boxed = box_subset(cells, (box["min_y"], box["max_y"]), across, lat, lon, wrap=wrap)
    if wrap:
        geoms = _both_sides(geoms)
    places = boxed.select(cell_id, lat, lon).distinct()
    covered = cells_in_polygons(places, geoms, cell_id, "gid", lon, lat, resolution).select(cell_id).distinct()
    flagged = lookup_join(boxed, materialize(covered.withColumn("_inside", F.lit(True))), cell_id, "left")
    return flagged.withColumn(value, F.when(F.col("_inside"), F.col(value))).drop("_inside")


def intersecting(
    left: DataFrame, right: DataFrame, gid: str = "pid", right_gid: str = "gid", resolution: float = 1.0
) -> DataFrame:
    """Rows of ``left`` (polygons) that share a point with any polygon of ``right``.

    Their boundaries meet, or else a ring of one lies wholly inside the other.
    """
    a = left.select(F.col(gid).alias("_lid"), "rings")
    b = right.select(F.col(right_gid).alias("_rid"), "rings")
    left_edges, right_edges = (materialize(polygons.edge_table(g, i)) for g, i in ((a, "_lid"), (b, "_rid")))
    met = polygons.meeting(left_edges, right_edges, "_lid", "_rid", resolution)
    within = polygons.points_in_polygons(polygons.ring_starts(a, "_lid"), right_edges, "_lid", "_rid", resolution)
    around = polygons.points_in_polygons(polygons.ring_starts(b, "_rid"), left_edges, "_rid", "_lid", resolution)
    hits = met.select("_lid").unionByName(within.select("_lid")).unionByName(around.select("_lid")).distinct()
    return lookup_join(left, materialize(hits.withColumnRenamed("_lid", gid)), gid, "left_semi")


def grid_index(c: Column, origin: float, step: float) -> Column:
    """Number of the grid line nearest to a coordinate.  Lines are compared by number: ``k * step`` is rarely exact."""
    return F.floor((c - origin) / step + 0.5)


def nearest_cells(
    points: DataFrame, cells: DataFrame, lat: str = "lat", lon: str = "lon",
    grid: tuple[float, float, float, float] | None = None,
) -> DataFrame:
    """``points`` with ``cell_lat, cell_lon``: nearest axis values, each axis on its own.

    With a regular grid ``(lat0, dlat, lon0, dlon)`` the value is computed; otherwise the
    distinct coordinates of ``cells`` form the axes.  Ties go to the larger coordinate.
    """
    if grid is not None:
        lat0, dlat, lon0, dlon = grid
        snap = lambda c, origin, step: grid_index(F.col(c), origin, step) * F.lit(step) + F.lit(origin)
        return points.withColumn("cell_lat", snap(lat, lat0, dlat)).withColumn("cell_lon", snap(lon, lon0, dlon))
    axes = {lat: cells.select(lat), lon: cells.select(lon)}
    return nearest_values(points, axes, {lat: "cell_lat", lon: "cell_lon"})


def sample_points(points: DataFrame, cells: DataFrame, gid: str = "gid", grid: tuple[float, float, float, float] | None = None) -> DataFrame:
    """Cell rows at the nearest cell of each point, with the point's id.

    Each axis is searched on its own, so the pair found need not be a cell; such a point keeps a row with
    the pair's coordinates and nulls, like a missing value of a dense array.
    """
    snapped = nearest_cells(points.select(gid, "lat", "lon"), cells, grid=grid)
    side = snapped.select(gid, F.col("cell_lat").alias("lat"), F.col("cell_lon").alias("lon"))
    keys, keyed = ["lat", "lon"], cells
    if grid is not None:
        lat0, dlat, lon0, dlon = grid
        keys = ["_row", "_col"]
        at = {"_row": grid_index(F.col("lat"), lat0, dlat), "_col": grid_index(F.col("lon"), lon0, dlon)}
        side, keyed = side.withColumns(at), cells.withColumns(at)
    side = materialize(side)
    found = lookup_join(keyed, side if grid is None else side.drop("lat", "lon"), keys).drop("_row", "_col")
    held = lookup_join(keyed.select(*keys), side.select(*keys).distinct(), keys).distinct()
    lost = lookup_join(side, materialize(held), keys, "left_anti")
    missing = [F.lit(None).cast(f.dataType).alias(f.name) for f in cells.schema.fields if f.name not in ("lat", "lon")]
    return found.unionByName(lost.select(gid, "lat", "lon", *missing))


def effective_geometries(geoms: DataFrame, covered: DataFrame, gid: str = "gid") -> DataFrame:
    """Polygons that hold no cell centre become their centroid; the others stay.

    ``covered`` is the ``(cell_id, gid)`` table of cells with valid data.
    """
    counts = covered.groupBy(gid).agg(F.count(F.lit(1)).alias("n_cells"))
    # ids are unique on both sides
    joined = geoms.join(counts, gid, "left").withColumn("n_cells", F.coalesce("n_cells", F.lit(0)))
    empty = (F.col("geom_type") != "Point") & (F.col("n_cells") == 0)
    centre = F.array(F.array(geo.centroid(geo.edges(F.col("rings")))))
    return joined.withColumn("rings", F.when(empty, centre).otherwise(F.col("rings"))).withColumn(
        "geom_type", F.when(empty, "Point").otherwise(F.col("geom_type"))
    )


METHODS = {  # fixed values: label of the sampling method by geometry type
    "Point": "sampled at provided coordinate",
    "Polygon": "sampled across provided polygon",
    "MultiPolygon": "sampled across provided multipolygon",
}


def locations(geoms: DataFrame, gid: str = "gid") -> DataFrame:
    """``(gid, lat, lon, method, sampled_geometry)``: representative point, method label and WKT."""
    kind, rings = F.col("geom_type"), F.col("rings")
    where = F.when(kind == "Point", rings[0][0]).otherwise(geo.centroid(geo.edges(rings)))
    label = F.when(F.lit(False), F.lit(""))
    for name, text in METHODS.items():
        label = label.when(kind == name, text)
    label = label.otherwise(F.raise_error(F.concat(F.lit("unsupported geometry type: "), kind)))
    return geoms.withColumn("_p", where).select(
        gid, F.col("_p.y").alias("lat"), F.col("_p.x").alias("lon"), label.alias("method"), geo.wkt(kind, rings).alias("sampled_geometry")
    )


def axis_resolution(cells: DataFrame, axis: str) -> float:
    """Distance of the two lowest coordinates of an axis."""
    low = [r[0] for r in cells.select(axis).distinct().orderBy(axis).limit(2).collect()]
    if len(low) < 2:
        raise ValueError(f"axis {axis} has a single coordinate; give the resolution")
    return abs(low[1] - low[0])


def grid_cells(
    cells: DataFrame, value: str, min_lat: float = 55.0, lat_res: float | None = None, lon_res: float | None = None
) -> DataFrame:
    """``(pid, lat, lon, ring)`` for cells with data at or north of ``min_lat``."""
    lat_res = axis_resolution(cells, "lat") if lat_res is None else lat_res
    lon_res = axis_resolution(cells, "lon") if lon_res is None else lon_res
    v = F.col(value)
    kept = cells.where((F.col("lat") >= min_lat) & v.isNotNull() & ~F.isnan(v)).select("lat", "lon").distinct()
    ring = geo.box_ring(F.col("lon"), F.col("lat"), lon_res / 2.0, lat_res / 2.0)
    return kept.select(cell_label(F.col("lat"), F.col("lon")).alias("pid"), "lat", "lon", ring.alias("ring"))
