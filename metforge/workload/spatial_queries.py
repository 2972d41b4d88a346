"""Grid cells, polygons, zonal means, terrain."""

from __future__ import annotations

from pyspark.sql import functions as F

from metforge.functions import geometry as geo
from metforge.functions import labels, temporal
from metforge.operators import spatial, terrain, zonal
from metforge.plans import climate, sampling, topographic
from metforge.workload import views
from metforge.workload.registry import query
from metforge.workload.views import rounded

IN_BOX = "abs(c.lon - z.cx) < z.h AND abs(c.lat - z.cy) < z.h"
IN_DIAMOND = "abs(c.lon - z.cx) + abs(c.lat - z.cy) < z.h"


def nearest(points: str, x: str, y: str, cells: str = "cells") -> str:
    """Nearest axis values of each point, ties to the larger; points have columns gid, x, y."""
    one = lambda axis, c: (
        f"(SELECT gid, v FROM (SELECT p.gid, a.v, row_number() OVER (PARTITION BY p.gid ORDER BY abs(a.v - p.{c}), a.v DESC) AS rn"
        f" FROM {points} p, (SELECT DISTINCT {axis} AS v FROM {cells}) a) WHERE rn = 1)"
    )
    return f"SELECT p.gid, la.v AS lat, lo.v AS lon FROM {points} p JOIN {one('lat', y)} la USING (gid) JOIN {one('lon', x)} lo USING (gid)"


@query(
    f"WITH near AS ({nearest('points', 'px', 'py')}) SELECT gid, lat AS cell_lat, lon AS cell_lon FROM near", ("cells", "points")
)
def nearest_cell(spark, sf):
    points = views.points(spark, sf)
    return spatial.nearest_cells(points, views.cells(spark, sf)).select("gid", "cell_lat", "cell_lon")


@query("SELECT gid, floor(py + 0.5e0) AS cell_lat, floor((px - 0.25e0) / 0.5e0 + 0.5e0) * 0.5e0 + 0.25e0 AS cell_lon FROM points", ("points",))
def nearest_cell_regular(spark, sf):
    points = views.points(spark, sf)
    near = spatial.nearest_cells(points, views.cells(spark, sf), grid=(0.0, 1.0, 0.25, 0.5))
    return near.select("gid", "cell_lat", "cell_lon")


@query(
    f"""WITH near AS ({nearest('points', 'px', 'py')}) SELECT n.gid, c.cell_id, n.lat, n.lon, c.value FROM near n LEFT JOIN cells c USING (lat, lon)""",
    ("cells", "points"),
)
def point_samples(spark, sf):
    points = views.points(spark, sf)
    return spatial.sample_points(points, views.cells(spark, sf)).select("gid", "cell_id", "lat", "lon", "value")


def _tenth(df):
    """The same on a grid of 0.1 degrees, whose lines no double holds exactly."""
    return df.withColumns({"lat": F.col("lat") * 0.1, "lon": F.col("lon") * 0.1})


TENTH = (0.0, 0.1, 0.0, 0.1)


@query("SELECT cell_id AS gid, CAST(lat AS BIGINT) AS line_lat, CAST(lon AS BIGINT) AS line_lon FROM cells", ("cells",))
def nearest_cell_tenth(spark, sf):
    points = _tenth(views.cells(spark, sf)).withColumnRenamed("cell_id", "gid")
    near = spatial.nearest_cells(points, points, grid=TENTH)
    line = lambda c: F.rint(F.col(c) * 10).cast("bigint")
    return near.select("gid", line("cell_lat").alias("line_lat"), line("cell_lon").alias("line_lon"))


@query("SELECT cell_id AS gid, cell_id, value FROM cells", ("cells",))
def point_samples_tenth(spark, sf):
    cells = _tenth(views.cells(spark, sf))
    points = cells.select(F.col("cell_id").alias("gid"), "lat", "lon")
    return spatial.sample_points(points, cells, grid=TENTH).select("gid", "cell_id", "value")


@query(
    """SELECT CAST(CAST(floor(lat / 2e0) AS BIGINT) AS VARCHAR) || '_' || CAST(CAST(floor(lon / 2e0) AS BIGINT) AS VARCHAR) AS cell_id,
 strftime(time, '%Y-%m-%d %H:%M') AS date, round(avg(s.value), 6) AS value FROM cell_series s JOIN cells USING (cell_id) GROUP BY ALL""",
    ("cells", "cell_series"),
)
def coarse_tenth(spark, sf):
    means, _ = zonal.coarsen(views.cell_series(spark, sf), _tenth(views.cells(spark, sf)), ["value"], 2, 0.1)
    return means.select("cell_id", temporal.stamp(F.col("time"), "minute").alias("date"), rounded("value").alias("value"))


@query(
    """SELECT cell_id, lat, x AS lon, CASE WHEN lat > 3 AND lat < 21 AND (x < 15.5e0 OR x > 329.5e0) THEN value END AS value
FROM (SELECT cell_id, lat, (lon * 10) % 360 AS x, value FROM cells) WHERE lat BETWEEN 3 AND 21 AND (x <= 15.5e0 OR x >= 329.5e0)""",
    ("cells",),
)
def polygon_subset_seam(spark, sf):
    cells = views.cells(spark, sf).withColumn("lon", (F.col("lon") * 10) % 360)
    corners = [(-30.5, 3.0), (15.5, 3.0), (15.5, 21.0), (-30.5, 21.0), (-30.5, 3.0)]
    ring = F.array(*[F.struct(F.lit(x).alias("x"), F.lit(y).alias("y")) for x, y in corners])
    across = spark.range(1).select(F.lit("a").alias("gid"), F.lit("Polygon").alias("geom_type"), F.array(ring).alias("rings"))
    return climate.subset(cells, polygons=across).select("cell_id", "lat", "lon", "value")


@query("SELECT cell_id, lat, lon, value FROM cells WHERE lat BETWEEN 5 AND 30 AND lon BETWEEN 1 AND 20", ("cells",))
def box_subset(spark, sf):
    return spatial.box_subset(views.cells(spark, sf), (5, 30), (1, 20))


@query("SELECT gid, lat, (lon + 360e0) % 360e0 AS lon FROM sites WHERE lat BETWEEN -60 AND 60 AND lon BETWEEN -50 AND 40", ("sites",))
def box_subset_seam(spark, sf):
    from metforge.functions.physics import wrap_longitude

    sites = views.sites(spark, sf).withColumn("lon", wrap_longitude(F.col("lon")))
    return climate.subset(sites, lat_bounds=(-60, 60), lon_bounds=(-50, 40))


MASK_BOX = "(SELECT min(cx - h) AS x0, max(cx + h) AS x1, min(cy - h) AS y0, max(cy + h) AS y1 FROM zones)"


@query(
    f"""SELECT c.cell_id, c.lat, c.lon, CASE WHEN EXISTS (SELECT 1 FROM zones z WHERE {IN_DIAMOND}) THEN c.value END AS value
FROM cells c, {MASK_BOX} b WHERE c.lon BETWEEN x0 AND x1 AND c.lat BETWEEN y0 AND y1""",
    ("cells", "zones"),
)
def polygon_mask(spark, sf):
    masked = spatial.polygon_mask(views.cells(spark, sf), views.diamonds(spark, sf), "value")
    return masked.select("cell_id", "lat", "lon", "value")


@query(f"SELECT c.cell_id, z.gid FROM cells c JOIN zones z ON {IN_BOX}", ("cells", "zones"))
def cells_in_boxes(spark, sf):
    return spatial.cells_in_polygons(views.cells(spark, sf), views.boxes(spark, sf))


@query(f"SELECT c.cell_id, z.gid FROM cells c JOIN zones z ON {IN_DIAMOND}", ("cells", "zones"))
def cells_in_polygon(spark, sf):
    return spatial.cells_in_polygons(views.cells(spark, sf), views.diamonds(spark, sf))


@query(
    """WITH o AS (SELECT c.cell_id, z.gid, least(c.lon + 0.5e0, z.cx + z.h) - greatest(c.lon - 0.5e0, z.cx - z.h) AS ox,
 least(c.lat + 0.5e0, z.cy + z.h) - greatest(c.lat - 0.5e0, z.cy - z.h) AS oy FROM cells c, zones z
 WHERE abs(c.lon - z.cx) < z.h + 0.5e0 AND abs(c.lat - z.cy) < z.h + 0.5e0)
SELECT cell_id, gid, round(ox * oy, 6) AS w FROM o WHERE ox > 1e-9 AND oy > 1e-9""",
    ("cells", "zones"),
)
def overlap_weights(spark, sf):
    w = spatial.overlap_weights(views.cells(spark, sf), views.boxes(spark, sf), 1.0)
    return w.where(F.col("w") > 1e-9).select("cell_id", "gid", rounded("w").alias("w"))


@query(
    """SELECT c.cell_id FROM cells c WHERE EXISTS (SELECT 1 FROM zones z WHERE abs(c.lon - z.cx) <= z.h + 0.5e0 AND abs(c.lat - z.cy) <= z.h + 0.5e0)""",
    ("cells", "zones"),
)
def grid_intersects(spark, sf):
    cells = views.cells(spark, sf).select(
        "cell_id", F.lit("Polygon").alias("geom_type"), F.array(geo.box_ring(F.col("lon"), F.col("lat"), 0.5)).alias("rings")
    )
    return spatial.intersecting(cells, views.boxes(spark, sf), gid="cell_id").select("cell_id")


@query(
    "SELECT c.cell_id, c.value FROM cells c WHERE c.cell_id IN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000)", ("cells",)
)
def cells_by_id_list(spark, sf):
    from metforge.operators.skew import lookup_join

    wanted = views.table(spark, sf, "orders").where(F.col("o_totalprice") > 400000).select(F.col("o_custkey").alias("cell_id")).distinct()
    return lookup_join(views.cells(spark, sf), wanted, "cell_id", "left_semi").select("cell_id", "value")


# --- zonal means ------------------------------------------------------------------------

MAP = f"""inside AS (SELECT c.cell_id, z.gid FROM cells c JOIN zones z ON {IN_BOX}),
lone AS (SELECT * FROM zones WHERE gid NOT IN (SELECT gid FROM inside)),
near AS ({nearest('lone', 'cx', 'cy')}),
cmap AS (SELECT cell_id, gid FROM inside UNION ALL SELECT c.cell_id, n.gid FROM near n JOIN cells c USING (lat, lon))"""


@query(
    f"""WITH {MAP} SELECT gid, strftime(time, '%Y-%m-%d %H:%M') AS date, round(avg(value), 6) AS value
FROM cell_series JOIN cmap USING (cell_id) GROUP BY gid, time""",
    ("cells", "zones", "cell_series"),
)
def zonal_mean(spark, sf):
    cell_map, _ = zonal.sampling_map(views.cells(spark, sf), views.boxes(spark, sf))
    means = zonal.zonal_mean(views.cell_series(spark, sf), cell_map, ["value"])
    return means.select("gid", temporal.stamp(F.col("time"), "minute").alias("date"), rounded("value").alias("value"))


@query(
    f"""WITH {MAP}, o AS (SELECT c.cell_id, z.gid, (least(c.lon + 0.5e0, z.cx + z.h) - greatest(c.lon - 0.5e0, z.cx - z.h)) *
 (least(c.lat + 0.5e0, z.cy + z.h) - greatest(c.lat - 0.5e0, z.cy - z.h)) AS w FROM cells c, zones z
 WHERE abs(c.lon - z.cx) < z.h + 0.5e0 AND abs(c.lat - z.cy) < z.h + 0.5e0 AND z.gid IN (SELECT gid FROM inside)
 UNION ALL SELECT c.cell_id, n.gid, 1e0 FROM near n JOIN cells c USING (lat, lon))
SELECT gid, strftime(time, '%Y-%m-%d %H:%M') AS date, round(sum(w * value) / sum(w), 6) AS value
FROM cell_series JOIN o USING (cell_id) GROUP BY gid, time""",
    ("cells", "zones", "cell_series"),
)
def zonal_mean_overlap(spark, sf):
    cell_map, _ = zonal.sampling_map(views.cells(spark, sf), views.boxes(spark, sf), weights="overlap")
    means = zonal.zonal_mean(views.cell_series(spark, sf), cell_map, ["value"])
    return means.select("gid", temporal.stamp(F.col("time"), "minute").alias("date"), rounded("value").alias("value"))


@query(
    f"""WITH {MAP}, b AS (SELECT date_trunc('day', max(time)) AS top FROM cell_series)
SELECT gid, strftime(time, '%Y-%m-%d %H:%M') AS date, round(avg(value), 6) AS value,
 CASE WHEN time < TIMESTAMP '1998-02-01' THEN 'job_1996-02-01_1998-02-01' WHEN time < TIMESTAMP '2000-02-01' THEN 'job_1998-02-01_2000-02-01'
  ELSE 'job_2000-02-01_' || strftime(least(top, TIMESTAMP '2031-01-01'), '%Y-%m-%d') END AS batch
FROM cell_series JOIN cmap USING (cell_id), b WHERE time >= TIMESTAMP '1996-02-01' AND time < least(top, TIMESTAMP '2031-01-01') GROUP BY gid, time, top""",
    ("cells", "zones", "cell_series"),
)
def sample_batches(spark, sf):
    request = sampling.SampleRequest("1996-02-01", "2031-01-01", ["value"], 2, "job", 1.0)
    rows, _ = sampling.sample_zonal(views.cell_series(spark, sf), views.cells(spark, sf), views.boxes(spark, sf), request)
    return rows.select("gid", "date", rounded("value").alias("value"), "batch")


@query(
    """SELECT CAST(CAST(floor(lat / 3e0) AS BIGINT) AS VARCHAR) || '_' || CAST(CAST(floor(lon / 3e0) AS BIGINT) AS VARCHAR) AS cell_id,
 strftime(time, '%Y-%m-%d %H:%M') AS date, round(avg(s.value), 6) AS value FROM cell_series s JOIN cells USING (cell_id) GROUP BY ALL""",
    ("cells", "cell_series"),
)
def coarse_cells(spark, sf):
    means, _ = zonal.coarsen(views.cell_series(spark, sf), views.cells(spark, sf), ["value"], 3, 1.0)
    return means.select("cell_id", temporal.stamp(F.col("time"), "minute").alias("date"), rounded("value").alias("value"))


@query(
    f"""WITH blocks AS (SELECT cell_id, floor(lat / 2e0) * 2e0 + 1e0 AS lat, floor(lon / 2e0) * 2e0 + 1e0 AS lon FROM cells),
coarse AS (SELECT lat, lon, time, avg(value) AS value FROM cell_series JOIN blocks USING (cell_id) GROUP BY 1, 2, 3),
places AS (SELECT DISTINCT lat, lon FROM blocks),
inside AS (SELECT z.gid, c.lat, c.lon FROM places c JOIN zones z ON {IN_BOX}),
lone AS (SELECT * FROM zones WHERE gid NOT IN (SELECT gid FROM inside)),
near AS ({nearest('lone', 'cx', 'cy', 'places')}),
cmap AS (SELECT gid, lat, lon FROM inside UNION ALL SELECT n.gid, n.lat, n.lon FROM near n JOIN places USING (lat, lon)),
b AS (SELECT date_trunc('day', max(time)) AS top FROM cell_series)
SELECT gid, strftime(time, '%Y-%m-%d %H:%M') AS date, round(avg(value), 6) AS value FROM coarse JOIN cmap USING (lat, lon), b
WHERE time >= TIMESTAMP '1996-01-01' AND time < top GROUP BY gid, time""",
    ("cells", "zones", "cell_series"),
)
def sample_coarse(spark, sf):
    request = sampling.SampleRequest("1996-01-01", "2031-01-01", ["value"], 5, "coarse", 1.0, scale=22264.0)
    rows, _ = sampling.sample_zonal(views.cell_series(spark, sf), views.cells(spark, sf), views.boxes(spark, sf), request)
    return rows.select("gid", "date", rounded("value").alias("value"))


@query(
    f"""WITH n AS (SELECT z.gid, count(c.cell_id) AS n FROM zones z LEFT JOIN cells c ON {IN_BOX} GROUP BY z.gid)
SELECT z.gid, CASE WHEN n = 0 THEN 'Point' ELSE 'Polygon' END AS geom_type, n AS n_cells, CASE WHEN n = 0 THEN round(cx, 6) END AS x,
 CASE WHEN n = 0 THEN round(cy, 6) END AS y FROM zones z JOIN n USING (gid)""",
    ("cells", "zones"),
)
def coverage_fallback(spark, sf):
    boxes = views.boxes(spark, sf)
    covered = spatial.cells_in_polygons(views.cells(spark, sf), boxes)
    kept = spatial.effective_geometries(boxes, covered)
    is_point = F.col("geom_type") == "Point"
    at = F.col("rings")[0][0]
    return kept.select(
        "gid", "geom_type", "n_cells", F.when(is_point, rounded(at["x"])).alias("x"), F.when(is_point, rounded(at["y"])).alias("y")
    )


# --- shapes -----------------------------------------------------------------------------


@query(
    f"""WITH top AS (SELECT min(time) AS t FROM cell_series WHERE time >= TIMESTAMP '1996-01-01' AND time < TIMESTAMP '2031-01-01'),
valid AS (SELECT DISTINCT cell_id, true AS ok FROM cell_series JOIN top ON time = t WHERE value IS NOT NULL),
n AS (SELECT z.gid, count(v.ok) AS n, count(c.cell_id) AS n_all FROM zones z LEFT JOIN cells c ON {IN_BOX} LEFT JOIN valid v USING (cell_id) GROUP BY z.gid)
SELECT gid, CASE WHEN n = 0 THEN 'Point' ELSE 'Polygon' END AS geom_type, n AS n_cells, CASE WHEN n = 0 THEN 1 ELSE n_all END AS n_sampled FROM n""",
    ("cells", "zones", "cell_series"),
)
def coverage_valid(spark, sf):
    """Polygons without a cell that has data in the first image become points."""
    request = sampling.SampleRequest("1996-01-01", "2031-01-01", ["value"], sample_image=("1996-01-01", "2031-01-01"), sample_band="value")
    valid = sampling.valid_cells(views.cell_series(spark, sf), request)
    cell_map, effective = zonal.sampling_map(views.cells(spark, sf), views.boxes(spark, sf), valid=valid)
    sampled = cell_map.groupBy("gid").agg(F.count(F.lit(1)).alias("n_sampled"))
    return effective.select("gid", "geom_type", "n_cells").join(sampled, "gid", "left")


@query(
    """SELECT gid, round(cy, 6) AS lat, round(cx, 6) AS lon, 'sampled across provided polygon' AS method,
 'POLYGON ((' || x1 || ' ' || yc || ', ' || xc || ' ' || y1 || ', ' || x0 || ' ' || yc || ', ' || xc || ' ' || y0 || ', ' || x1 || ' ' || yc || '))'
   AS sampled_geometry FROM (SELECT gid, cx, cy, printf('%.2f', cx) AS xc, printf('%.2f', cy) AS yc, printf('%.2f', cx - h) AS x0, printf('%.2f', cx + h) AS x1,
   printf('%.2f', cy - h) AS y0, printf('%.2f', cy + h) AS y1 FROM (SELECT gid, cx + 0.01e0 AS cx, cy + 0.01e0 AS cy, h FROM zones))""",
    ("zones",),
)
def centroid_wkt(spark, sf):
    # two decimals, neither of them zero at the end, so that both engines print them alike
    two = lambda p: geo.point(F.round(p["x"] + 0.01, 2), F.round(p["y"] + 0.01, 2))
    shaped = views.diamonds(spark, sf).withColumn("rings", F.transform("rings", lambda r: F.transform(r, two)))
    out = spatial.locations(shaped)
    return out.withColumns({"lat": rounded("lat"), "lon": rounded("lon")})


@query("SELECT gid, lat, lon, lon - 0.5e0 AS min_x, lat - 0.5e0 AS min_y, lon + 0.5e0 AS max_x, lat + 0.5e0 AS max_y, 5 AS vertices FROM sites", ("sites",))
def box_around_point(spark, sf):
    ring = geo.box_ring(F.col("lon"), F.col("lat"), 0.5)
    return (
        views.sites(spark, sf)
        .withColumn("r", F.array(ring))
        .select("gid", "lat", "lon", geo.bounds(F.col("r")).alias("b"), F.size(F.col("r")[0]).alias("vertices"))
        .select("gid", "lat", "lon", "b.min_x", "b.min_y", "b.max_x", "b.max_y", "vertices")
    )


@query(
    """SELECT printf('%.2f,%.2f', lat, lon) AS pid, lat, lon, lon - 0.5e0 AS west, lat - 0.5e0 AS south, lon + 0.5e0 AS east, lat + 0.5e0 AS north
FROM cells WHERE lat >= 20 AND value IS NOT NULL""",
    ("cells",),
)
def grid_cells(spark, sf):
    g = spatial.grid_cells(views.cells(spark, sf), "value", min_lat=20.0)
    r = F.col("ring")
    return g.select(
        "pid", "lat", "lon", r[0]["x"].alias("west"), r[0]["y"].alias("south"), r[2]["x"].alias("east"), r[2]["y"].alias("north")
    )


@query("SELECT printf('%.2f,%.2f', lat, lon) AS pid, round(lat, 2) AS lat, round(lon, 2) AS lon FROM sites", ("sites",))
def parse_cell_id(spark, sf):
    pid = views.sites(spark, sf).select(labels.cell_label(F.col("lat"), F.col("lon")).alias("pid"))
    return pid.select("pid", labels.label_lat(F.col("pid")).alias("lat"), labels.label_lon(F.col("pid")).alias("lon"))


@query(
    """WITH a AS (SELECT gid, 6371008.8e0 * 6371008.8e0 * radians(2 * h) * (sin(radians(cy + h)) - sin(radians(cy - h))) AS area FROM zones)
SELECT gid, round(area / 1e6, 3) AS area_km2, round(greatest(sqrt(area / 5500), 5), 4) AS scale_m FROM a""",
    ("zones",),
)
def sampling_scale(spark, sf):
    out = terrain.sampling_scale(views.boxes(spark, sf), 11)
    return out.select("gid", rounded(F.col("area_m2") / 1e6, 3).alias("area_km2"), rounded("scale_m", 4).alias("scale_m"))


# --- terrain ----------------------------------------------------------------------------

THRESH = """ranked AS (SELECT feature_id, elevation, row_number() OVER (PARTITION BY feature_id ORDER BY elevation) - 1 AS pos,
 count(*) OVER (PARTITION BY feature_id) AS n FROM {dem}),
edges AS (SELECT feature_id, max(CASE WHEN pos = CAST(floor(25e0 * n / 100e0) AS BIGINT) THEN elevation END) AS t1,
 max(CASE WHEN pos = CAST(floor(50e0 * n / 100e0) AS BIGINT) THEN elevation END) AS t2,
 max(CASE WHEN pos = CAST(floor(75e0 * n / 100e0) AS BIGINT) THEN elevation END) AS t3 FROM ranked GROUP BY feature_id)"""


@query(
    f"WITH {THRESH.format(dem='parts_dem')} SELECT feature_id, 0e0 AS t0, round(t1, 6) AS t1, round(t2, 6) AS t2, round(t3, 6) AS t3, 100000e0 AS t4 FROM edges",
    ("parts_dem",),
)
def elev_thresholds(spark, sf):
    t = terrain.elevation_thresholds(views.parts_dem(spark, sf), 4)
    return t.select("feature_id", *[rounded(F.col("thresholds")[i]).alias(f"t{i}") for i in range(5)])


def _units_sql(dem: str) -> str:
    return f"""WITH {THRESH.format(dem=dem)}, bands AS (SELECT feature_id, b.u, b.lo, b.hi FROM edges,
 LATERAL (VALUES (1, 0e0, t1), (2, t1, t2), (3, t2, t3), (4, t3, 100000e0)) AS b(u, lo, hi))"""


@query(
    f"""{_units_sql('parts_dem')} SELECT b.feature_id, CAST(u AS INTEGER) AS topounit_id, round(lo, 6) AS min_elev, round(hi, 6) AS max_elev,
 count(d.cell) AS n_cells, round(count(d.cell) * 4e0, 6) AS area, round(avg(d.elevation), 6) AS mean_elev
FROM bands b LEFT JOIN parts_dem d ON d.feature_id = b.feature_id AND d.elevation >= lo AND d.elevation < hi GROUP BY ALL""",
    ("parts_dem",),
)
def topounits_elev(spark, sf):
    units = topographic.topounits(views.parts_dem(spark, sf), max_units=4, cell_area=4.0)
    numbers = {c: rounded(c) for c in ("min_elev", "max_elev", "area", "mean_elev")}
    return units.select("feature_id", "topounit_id", "min_elev", "max_elev", "n_cells", "area", "mean_elev").withColumns(numbers)


@query(
    f"""{_units_sql('parts_dem')}, cls(i, aspect_name, aspect_start, aspect_end) AS (VALUES (0, 'N', 270e0, 90e0), (1, 'S', 90.01e0, 269.99e0)),
d AS (SELECT *, CASE WHEN aspect >= 270e0 OR aspect < 90e0 THEN 0 WHEN aspect >= 90.01e0 AND aspect < 269.99e0 THEN 1 END AS i FROM parts_dem)
SELECT b.feature_id, CAST((u - 1) * 2 + cls.i + 1 AS INTEGER) AS topounit_id, round(lo, 6) AS min_elev, round(hi, 6) AS max_elev,
 aspect_name, aspect_start, aspect_end, count(d.cell) AS n_cells, round(avg(d.elevation), 6) AS mean_elev
FROM bands b CROSS JOIN cls LEFT JOIN d ON d.feature_id = b.feature_id AND d.elevation >= lo AND d.elevation < hi AND d.i = cls.i GROUP BY ALL""",
    ("parts_dem",),
)
def topounits_elev_aspect(spark, sf):
    units = topographic.topounits(views.parts_dem(spark, sf), method="elevaspect", bins=4)
    numbers = {c: rounded(c) for c in ("min_elev", "max_elev", "mean_elev")}
    columns = ["feature_id", "topounit_id", "min_elev", "max_elev", "aspect_name", "aspect_start", "aspect_end", "n_cells", "mean_elev"]
    return units.select(*columns).withColumns(numbers)


@query(
    """WITH g AS (SELECT d.feature_id, d.row, d.col, (e.elevation - w.elevation) / 2e0 AS dx, (n.elevation - s.elevation) / 2e0 AS dy
 FROM lattice_dem d LEFT JOIN lattice_dem e ON e.feature_id = d.feature_id AND e.row = d.row AND e.col = d.col + 1
 LEFT JOIN lattice_dem w ON w.feature_id = d.feature_id AND w.row = d.row AND w.col = d.col - 1
 LEFT JOIN lattice_dem n ON n.feature_id = d.feature_id AND n.row = d.row - 1 AND n.col = d.col
 LEFT JOIN lattice_dem s ON s.feature_id = d.feature_id AND s.row = d.row + 1 AND s.col = d.col),
a AS (SELECT *, degrees(atan2(-dx, -dy)) AS t FROM g)
SELECT feature_id, row, col, round(CASE WHEN dx <> 0 OR dy <> 0 THEN CASE WHEN t < 0 THEN t + 360e0 ELSE t END END, 6) AS aspect FROM a""",
    ("lattice_dem",),
)
def dem_aspect(spark, sf):
    out = terrain.with_aspect(views.lattice_dem(spark, sf), tile=16)
    return out.select("feature_id", "row", "col", rounded("aspect").alias("aspect"))


@query("SELECT feature_id, row, col, elevation FROM lattice_dem WHERE row % 3 = 0 AND col % 3 = 0", ("lattice_dem",))
def dem_downsample(spark, sf):
    return terrain.downsample(views.lattice_dem(spark, sf), 6.0).select("feature_id", "row", "col", "elevation")


@query(
    f"""{_units_sql('lattice_dem')}, m AS (SELECT d.feature_id, CAST(u AS INTEGER) AS topounit_id, d.row, d.col FROM lattice_dem d
 JOIN bands b ON d.feature_id = b.feature_id AND d.elevation >= lo AND d.elevation < hi),
s AS (SELECT feature_id, topounit_id, e.* FROM m, LATERAL (VALUES (row, col, row, col + 1), (row + 1, col, row + 1, col + 1),
 (row, col, row + 1, col), (row, col + 1, row + 1, col + 1)) AS e(row0, col0, row1, col1)),
k AS (SELECT feature_id, topounit_id, row0 = row1 AS level, CASE WHEN row0 = row1 THEN row0 ELSE col0 END AS line,
 CASE WHEN row0 = row1 THEN col0 ELSE row0 END AS place FROM s GROUP BY feature_id, topounit_id, row0, col0, row1, col1 HAVING count(*) = 1),
i AS (SELECT *, place - row_number() OVER (PARTITION BY feature_id, topounit_id, level, line ORDER BY place) AS run FROM k),
e AS (SELECT feature_id, topounit_id, level, line, min(place) AS a, max(place) + 1 AS b FROM i GROUP BY feature_id, topounit_id, level, line, run)
SELECT feature_id, topounit_id, CASE WHEN level THEN line ELSE a END AS row0, CASE WHEN level THEN a ELSE line END AS col0,
 CASE WHEN level THEN line ELSE b END AS row1, CASE WHEN level THEN b ELSE line END AS col1 FROM e""",
    ("lattice_dem",),
)
def topounit_outline(spark, sf):
    from metforge.session import materialize

    dem = views.lattice_dem(spark, sf)
    thresholds = materialize(terrain.elevation_thresholds(dem, 4))
    return terrain.outline_segments(terrain.assign_units(dem, thresholds), tile=16)
