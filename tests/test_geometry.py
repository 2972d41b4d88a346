import json
import math
import random

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from metforge.functions import geometry as geo
from metforge.operators import spatial, zonal
from metforge.plans import climate, sampling
from metforge.sources import readers, sinks


def features(spark, items):
    rows = [json.dumps({"type": "Feature", "geometry": {"type": t, "coordinates": c}, "properties": {"gid": g, "n": 1}}) for g, t, c in items]
    parsed = spark.createDataFrame([(r,) for r in rows], "value string").select(F.from_json("value", readers.FEATURE).alias("f")).select("f.*")
    return readers.geometries(parsed, "gid")


def star(rnd, cx, cy, n, big):
    angles = sorted(rnd.uniform(0, 2 * math.pi) for _ in range(n))
    return [[cx + big * rnd.uniform(0.3, 1) * math.cos(a), cy + big * rnd.uniform(0.3, 1) * math.sin(a)] for a in angles]


def inside(rings, x, y):
    odd = False
    for ring in rings:
        for (ax, ay), (bx, by) in zip(ring, ring[1:] + ring[:1]):
            if (ay > y) != (by > y) and x < (bx - ax) * (y - ay) / (by - ay) + ax:
                odd = not odd
    return odd


@pytest.mark.parametrize("limit", [None, 0])
def test_containment_matches_brute_force(spark, monkeypatch, limit):
    if limit is not None:  # force the path for lookup sides too large to broadcast
        monkeypatch.setattr(spatial, "lookup_join", lambda f, d, on, how="inner": spatial_salted(f, d, on, how))
    rnd = random.Random(11)
    shapes = {f"g{i}": [star(rnd, rnd.uniform(0, 30), rnd.uniform(0, 30), 9, rnd.choice([0.2, 2, 14]))] for i in range(25)}
    shapes["holed"] = [[[2, 2], [20, 2], [20, 20], [2, 20]], [[5, 5], [15, 5], [15, 15], [5, 15]]]
    geoms = features(spark, [(g, "Polygon", rings) for g, rings in shapes.items()])
    pts = [(i, rnd.uniform(-2, 33), rnd.uniform(-2, 33)) for i in range(900)]
    cells = spark.createDataFrame(pts, "cell_id int, lon double, lat double")
    got = {tuple(r) for r in spatial.cells_in_polygons(cells, geoms).collect()}
    want = {(i, g) for i, x, y in pts for g, rings in shapes.items() if inside(rings, x, y)}
    assert got == want and len(want) > 300


def spatial_salted(fact, dim, on, how):
    from metforge.operators.skew import salted_join

    return salted_join(fact, dim, [on] if isinstance(on, str) else on, how, share=20)


def test_boundary_is_not_inside(spark):
    box = features(spark, [("b", "Polygon", [[[0, 0], [2, 0], [2, 2], [0, 2], [0, 0]]])])
    cells = spark.createDataFrame([(1, 1.0, 1.0), (2, 0.0, 1.0), (3, 2.0, 2.0), (4, 1.0, 2.0)], "cell_id int, lon double, lat double")
    assert [r["cell_id"] for r in spatial.cells_in_polygons(cells, box).collect()] == [1]


def test_intersection_matches_brute_force(spark):
    rnd = random.Random(5)
    zones = {f"z{i}": star(rnd, rnd.uniform(0, 20), rnd.uniform(0, 20), 7, rnd.choice([0.3, 1, 6])) for i in range(12)}
    geoms = features(spark, [(g, "Polygon", [r]) for g, r in zones.items()])
    cells = [(f"{i}_{j}", float(i), float(j)) for i in range(20) for j in range(20)]
    grid = spark.createDataFrame(cells, "pid string, lon double, lat double")
    boxes = grid.select("pid", F.lit("Polygon").alias("geom_type"), F.array(geo.box_ring(F.col("lon"), F.col("lat"), 0.5)).alias("rings"))
    got = {r["pid"] for r in spatial.intersecting(boxes, geoms).select("pid").collect()}

    def meet(box, ring):
        def cross(o, a, b):
            return (a[0] - o[0]) * (b[1] - o[1]) - (a[1] - o[1]) * (b[0] - o[0])

        sides = list(zip(box, box[1:] + box[:1]))
        for a, b in zip(ring, ring[1:] + ring[:1]):
            for c, d in sides:
                if cross(a, b, c) * cross(a, b, d) <= 0 and cross(c, d, a) * cross(c, d, b) <= 0:
                    return True
        return inside([ring], *box[0]) or inside([box], *ring[0])

    want = set()
    for pid, x, y in cells:
        box = [[x - 0.5, y - 0.5], [x + 0.5, y - 0.5], [x + 0.5, y + 0.5], [x - 0.5, y + 0.5]]
        if any(meet(box, r) for r in zones.values()):
            want.add(pid)
    assert got == want


def test_area_centroid_with_hole_and_multipolygon(spark):
    outer, hole = [[0, 0], [0, 4], [4, 4], [4, 0], [0, 0]], [[1, 1], [2, 1], [2, 2], [1, 2], [1, 1]]
    g = features(
        spark,
        [("p", "Polygon", [outer, hole]), ("m", "MultiPolygon", [[[[0, 0], [2, 0], [2, 2], [0, 2]]], [[[4, 0], [6, 0], [6, 2], [4, 2]]]]), ("o", "Point", [1.5, -2])],
    )
    e = geo.edges(F.col("rings"))
    got = {r["gid"]: r for r in g.select("gid", geo.area(e).alias("a"), geo.centroid(e).alias("c")).collect()}
    assert got["p"]["a"] == 15 and got["p"]["c"]["x"] == pytest.approx((32 - 1.5) / 15)
    assert got["m"]["a"] == 8 and tuple(got["m"]["c"]) == pytest.approx((3, 1))
    table = {r["gid"]: r for r in spatial.locations(g).collect()}
    assert table["o"]["sampled_geometry"] == "POINT (1.5 -2)" and table["o"]["method"] == "sampled at provided coordinate"
    assert table["p"]["sampled_geometry"] == "POLYGON ((0 0, 4 0, 4 4, 0 4, 0 0), (1 1, 1 2, 2 2, 2 1, 1 1))"
    assert table["m"]["sampled_geometry"] == "MULTIPOLYGON (((0 0, 2 0, 2 2, 0 2, 0 0)), ((4 0, 6 0, 6 2, 4 2, 4 0)))"
    assert table["m"]["method"] == "sampled across provided multipolygon"


@pytest.mark.parametrize("size", [37, 200, 1 << 20])
def test_collections_split_anywhere(spark, tmp_path, size):
    """Blocks of few bytes: cuts fall into strings, escapes, characters and braces, and features span many blocks."""
    notes = ['a "quoted" {brace}', "}{", "\\", 'end\\"', "é🙂 } {", "", '"', "{\"type\": \"Feature\"}"]
    collection = {
        "type": "FeatureCollection", "name": 'odd "name" {', "crs": {"type": "name", "properties": {"name": "urn:{x}"}},
        "features": [
            {"type": "Feature", "properties": {"gid": f"{i}{n}", "inner": {"deep": {"er": n}}}, "geometry": {"type": "Point", "coordinates": [i, 0.5]}}
            for i, n in enumerate(notes)
        ],
        "bbox": [0, 0, 9, 9],
    }
    for k, indent in enumerate((None, 2)):
        (tmp_path / f"c{k}.json").write_text(json.dumps(collection, indent=indent, ensure_ascii=k == 0) + "\n" * k)
    (tmp_path / "empty.json").write_text('{"type": "FeatureCollection", "features": []}')
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    try:
        got = [(r.gid, r.rings[0][0].x) for r in readers.geojson(spark, str(tmp_path), lines=False).collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sorted(got) == sorted([(f"{i}{n}", float(i)) for i, n in enumerate(notes)] * 2)


def test_geojson_round_trip_and_errors(spark, tmp_path):
    g = features(
        spark,
        [("p", "Polygon", [[[0, 0], [4, 0], [4, 4], [0, 4]], [[1, 1], [2, 1], [2, 2], [1, 2]]]), ("m", "MultiPolygon", [[[[0, 0], [2, 0], [2, 2]]], [[[4, 0], [6, 0], [6, 2]]]]), ("o", "Point", [1.5, -2])],
    )
    sinks.features(g, str(tmp_path / "f"), ["gid"])
    back = readers.geojson(spark, str(tmp_path / "f"))
    assert sorted(map(str, back.collect())) == sorted(map(str, g.collect()))
    whole = {"type": "FeatureCollection", "features": [json.loads(r.value) for r in sinks.feature_text(g, ["gid"]).collect()]}
    (tmp_path / "c.json").write_text(json.dumps(whole, indent=1))
    again = readers.geojson(spark, str(tmp_path / "c.json"), lines=False)
    assert sorted(map(str, again.collect())) == sorted(map(str, g.collect()))
    with pytest.raises(PySparkException, match="feature without site"):
        readers.geojson(spark, str(tmp_path / "f"), "site").collect()
    with pytest.raises(ValueError, match="KML"):
        sinks.features(g, str(tmp_path / "k"), ["gid"], "KML")


def test_box_ring(spark):
    r = spark.range(1).select(geo.box_ring(F.lit(18.78333), F.lit(68.35), 0.5).alias("r")).first()["r"]
    assert [tuple(round(v, 5) for v in p) for p in r] == [
        (18.28333, 67.85), (19.28333, 67.85), (19.28333, 68.85), (18.28333, 68.85), (18.28333, 67.85),
    ]


def test_overlap_weights_sum_to_the_area(spark):
    rnd = random.Random(2)
    rings = [star(rnd, 10, 10, 11, 6)]
    g = features(spark, [("s", "Polygon", rings), ("h", "Polygon", [[[3, 3], [9, 3], [9, 9], [3, 9]], [[4.2, 4.2], [7.7, 4.2], [7.7, 7.7], [4.2, 7.7]]])])
    cells = spark.range(400).select(F.col("id").alias("cell_id"), (F.col("id") % 20).cast("double").alias("lon"), F.floor(F.col("id") / 20).cast("double").alias("lat"))
    got = {r["gid"]: r["s"] for r in spatial.overlap_weights(cells, g, 1.0).groupBy("gid").agg(F.sum("w").alias("s")).collect()}
    want = {r["gid"]: r["a"] for r in g.select("gid", geo.area(geo.edges(F.col("rings"))).alias("a")).collect()}
    assert got["s"] == pytest.approx(want["s"]) and got["h"] == pytest.approx(36 - 3.5 * 3.5)


def test_zonal_mean_skips_missing_cells_and_stays_in_range(spark):
    cells = spark.createDataFrame([(1, 0.0, 0.0), (2, 0.0, 1.0), (3, 9.0, 9.0)], "cell_id int, lat double, lon double")
    series = spark.createDataFrame([(1, 1, 10.0, None), (2, 1, 20.0, 4.0), (3, 1, 5.0, 5.0), (1, 2, None, None)], "cell_id int, time int, a double, b double")
    geoms = features(spark, [("p", "Polygon", [[[-1, -1], [2, -1], [2, 1], [-1, 1]]]), ("tiny", "Polygon", [[[8, 8], [8.1, 8], [8.1, 8.1], [8, 8.1]]]), ("pt", "Point", [8.6, 8.9])])
    cell_map, effective = zonal.sampling_map(cells, geoms)
    got = {(r["gid"], r["time"]): (r["a"], r["b"]) for r in zonal.zonal_mean(series, cell_map, ["a", "b"]).collect()}
    assert got == {("p", 1): (15.0, 4.0), ("p", 2): (None, None), ("tiny", 1): (5.0, 5.0), ("pt", 1): (5.0, 5.0)}
    assert {r["gid"]: r["geom_type"] for r in effective.collect()} == {"p": "Polygon", "tiny": "Point", "pt": "Point"}


def test_polygons_without_data_become_points(spark):
    cells = spark.createDataFrame([(i, float(i // 4), float(i % 4)) for i in range(16)], "cell_id int, lat double, lon double")
    box = lambda x: [[[x - 0.5, -0.5], [x + 1.5, -0.5], [x + 1.5, 1.5], [x - 0.5, 1.5]]]  # four cells
    geoms = features(spark, [("west", "Polygon", box(0)), ("east", "Polygon", box(2))])
    image = [(0, 2.0), (1, None), (2, float("nan")), (3, None)]
    series = [(c, "2001-01-01 05:00:00", v) for c, v in image] + [(c, "2001-01-01 06:00:00", 1.0) for c in range(16)]
    rows = spark.createDataFrame(series, "cell_id int, time string, temperature_2m double").withColumn("time", F.col("time").cast("timestamp_ntz"))
    request = sampling.SampleRequest("2001-01-01", "2001-01-03", ["temperature_2m"], resolution=1.0, sample_image=("2001-01-01", "2001-01-02"))
    valid = sampling.valid_cells(rows, request)
    assert [r["cell_id"] for r in valid.collect()] == [0]
    for weights in ("centre", "overlap"):
        cell_map, effective = zonal.sampling_map(cells, geoms, 1.0, weights, valid=valid)
        assert {r["gid"]: (r["geom_type"], r["n_cells"]) for r in effective.collect()} == {"west": ("Polygon", 1), "east": ("Point", 0)}
        got = cell_map.groupBy("gid").agg(F.count("cell_id").alias("n")).collect()
        assert {r["gid"]: r["n"] for r in got} == {"west": 4, "east": 1}
    none = zonal.sampling_map(cells, geoms, 1.0, valid=valid.where("false"))[1]
    assert {r["geom_type"] for r in none.collect()} == {"Point"}
    _, places = sampling.sample_zonal(rows, cells, geoms, request)
    assert {r["gid"]: r["method"] for r in places.collect()} == {"west": spatial.METHODS["Polygon"], "east": spatial.METHODS["Point"]}


def test_climate_subset(spark):
    cells = spark.createDataFrame([(i, float(lat), float(lon), 1.0) for i, (lat, lon) in enumerate((a, b) for a in (10, 20) for b in (5, 100, 350))], "cell_id int, lat double, lon double, value double")
    at = climate.subset(cells, point=(14.0, -9.0)).collect()
    assert [(r["lat"], r["lon"]) for r in at] == [(10.0, 350.0)]
    seam = climate.subset(cells, lat_bounds=(0, 15), lon_bounds=(-20, 10)).collect()
    assert sorted(r["lon"] for r in seam) == [5.0, 350.0]
    west = features(spark, [("w", "Polygon", [[[-20, 5], [-5, 5], [-5, 25], [-20, 25]]])])
    assert {(r["lat"], r["lon"], r["value"]) for r in climate.subset(cells, polygons=west).collect()} == {(10.0, 350.0, 1.0), (20.0, 350.0, 1.0)}
    assert climate.subset(cells).count() == 6


def test_no_polygons_no_cells(spark):
    cells = spark.createDataFrame([(1, 0.0, 0.0, 1.0)], "cell_id int, lat double, lon double, value double")
    none = features(spark, [("o", "Point", [0, 0])]).where("false")
    assert spatial.cells_in_polygons(cells, none).count() == 0
    assert spatial.polygon_mask(cells, none, "value").count() == 0
    assert spatial.intersecting(none.withColumnRenamed("gid", "pid"), none).count() == 0


def test_scale(spark):
    assert zonal.sampling_scale_m("native") == 11132 and zonal.sampling_scale_m(5) == 11132 and zonal.sampling_scale_m(20000) == 20000


def plain_inside(ring, x, y):
    """Even-odd test of many points against one ring, without the boundary."""
    inside, on = np.zeros(len(x), bool), np.zeros(len(x), bool)
    for (ax, ay), (bx, by) in zip(ring[:-1], ring[1:]):
        turn = (bx - ax) * (y - ay) - (x - ax) * (by - ay)
        inside ^= ((ay > y) != (by > y)) & ((turn > 0) == (by > ay)) & (turn != 0)
        on |= (turn == 0) & (x >= min(ax, bx)) & (x <= max(ax, bx)) & (y >= min(ay, by)) & (y <= max(ay, by))
    return inside & ~on


def ring_rows(spark, rings):
    rows = [(g, "Polygon", [[(float(x), float(y)) for x, y in r] for r in parts]) for g, parts in rings.items()]
    return spark.createDataFrame(rows, "gid string, geom_type string, rings array<array<struct<x:double,y:double>>>")


def closed(points):
    return [*points, points[0]]


def jagged_rings(seed):
    """Rings whose vertices and edges lie on rows, on points, between them, and on one another's lines."""
    rng = np.random.default_rng(seed)
    angle = np.sort(rng.random(40)) * 2 * np.pi
    star = closed([(10 + r * np.cos(a), 10 + r * np.sin(a)) for a, r in zip(angle, rng.uniform(2, 9, 40))])
    steps = closed([(2, 2), (9, 2), (9, 5), (12, 5), (12, 2), (18, 2), (18, 11), (12, 11), (12, 14), (9, 14), (9, 11), (5, 17), (2, 11)])
    diamond = closed([(18, 10), (10, 18), (2, 10), (10, 2)])
    whole = closed([(float(x), float(y)) for x, y in rng.integers(0, 20, (9, 2))])  # crosses itself
    return {"star": [star], "steps": [steps], "diamond": [diamond], "whole": [whole]}


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("scattered", [False, True])
def test_points_in_jagged_rings(spark, seed, scattered):
    rings = jagged_rings(seed)
    rng = np.random.default_rng(seed + 10)
    x, y = (rng.uniform(-1, 21, (2, 400)) if scattered else np.array([(a, b) for a in range(21) for b in range(21)], float).T)
    cells = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(zip(x, y))] + [(-1, None, 1.0), (-2, float("nan"), 1.0)], "cell_id int, lon double, lat double")
    got = {tuple(r) for r in spatial.cells_in_polygons(cells, ring_rows(spark, rings)).collect()}
    want = {(int(i), g) for g, (ring,) in rings.items() for i in np.flatnonzero(plain_inside(ring, x, y))}
    assert got == want


def test_shares_of_cells_against_clipping(spark):
    star = jagged_rings(4)["star"][0]
    hole = closed([(8.2, 8.7), (8.9, 10.6), (10.4, 10.1), (10.8, 8.3)])  # clockwise
    wide = closed([(-3.3, -2.0), (22.5, -2.0), (22.5, 22.25), (-3.3, 21.1)])
    geoms = ring_rows(spark, {"star": [star], "holed": [wide, hole], "box": [closed([(0.5, 0.5), (3.5, 0.5), (3.5, 2.5), (0.5, 2.5)])]})
    cells = spark.createDataFrame([(i, float(i % 21), float(i // 21)) for i in range(441)], "cell_id int, lon double, lat double")
    got = {(r["cell_id"], r["gid"]): r["w"] for r in spatial.overlap_weights(cells, geoms, 1.0).collect()}
    both = cells.crossJoin(geoms)
    for axis, c, above in (("x", F.col("lon") - 0.5, True), ("x", F.col("lon") + 0.5, False), ("y", F.col("lat") - 0.5, True), ("y", F.col("lat") + 0.5, False)):
        both = both.withColumn("rings", F.transform("rings", lambda r: geo.clip_half_plane(r, axis, c, above)))
    want = {(r["cell_id"], r["gid"]): r["w"] for r in both.select("cell_id", "gid", geo.area(geo.edges(F.col("rings"))).alias("w")).collect() if r["w"] > 1e-9}
    assert got.keys() == want.keys()
    assert all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_cells_beside_the_lattice_are_an_error(spark):
    cells = spark.createDataFrame([(1, 0.0, 0.0), (2, 1.3, 0.0)], "cell_id int, lon double, lat double")
    with pytest.raises(Exception, match="lattice"):
        spatial.overlap_weights(cells, ring_rows(spark, {"a": [closed([(-1, -1), (3, -1), (3, 3), (-1, 3)])]}), 1.0).collect()


def test_a_part_inside_and_a_crossing_without_vertices(spark):
    square = lambda x, y, h: closed([(x - h, y - h), (x + h, y - h), (x + h, y + h), (x - h, y + h)])
    left = ring_rows(spark, {"around": [square(0, 0, 50)], "cross": [closed([(-60, -1), (60, -1), (60, 1), (-60, 1)])], "far": [square(500, 0, 3)], "touch": [square(14, 14, 4)]})
    right = ring_rows(spark, {"r": [square(5, 5, 5), square(300, 300, 1)]})
    got = {r["gid"] for r in spatial.intersecting(left, right, gid="gid").select("gid").collect()}
    assert got == {"around", "cross", "touch"}


def test_ring_never_joins_with_cells(spark):
    cells = spark.createDataFrame([(1, 0.0, 0.0)], "cell_id int, lon double, lat double")
    out = spatial.cells_in_polygons(cells, ring_rows(spark, jagged_rings(1)))
    assert "array<" not in out._jdf.queryExecution().toString()
