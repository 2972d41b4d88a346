import math
import random

import pytest
from pyspark.sql import functions as F

from metforge.operators import terrain
from metforge.plans import topographic

DEM = "feature_id string, row int, col int, x double, y double, elevation double"


def column(spark, values):
    return spark.createDataFrame([("f", i, 0, float(i), 0.0, float(v)) for i, v in enumerate(values)], DEM)


def test_thresholds_and_unit_sizes(spark):
    dem = column(spark, range(10, 101, 10))
    assert terrain.elevation_thresholds(dem, 4).first()["thresholds"] == [0, 30, 60, 80, 100000]
    units = topographic.topounits(dem, bins=4).orderBy("topounit_id").collect()
    assert [u["n_cells"] for u in units] == [2, 3, 2, 3]
    assert [(u["min_elev"], u["max_elev"]) for u in units][1] == (30, 60)


@pytest.mark.parametrize("bins", [1, 3, 7, 11])
def test_thresholds_match_sorting(spark, bins):
    rnd = random.Random(bins)
    values = [rnd.choice([5.0, 5.0, 8.0, rnd.uniform(0, 900)]) for _ in range(997)]
    got = terrain.elevation_thresholds(column(spark, values), bins).first()["thresholds"]
    ranked = sorted(values)
    want = [ranked[int(i * (100 / bins) * len(values) / 100)] for i in range(1, bins)]
    assert got == [0.0, *want, 100000.0]


def test_below_zero_is_in_no_unit(spark):
    units = topographic.topounits(column(spark, [-5, -1, 1, 2]), bins=2).collect()
    assert sum(u["n_cells"] for u in units) == 2


def test_aspect_classes(spark):
    angles = [0, 89.9, 90, 90.005, 90.01, 269.99, 270, 359]
    dem = spark.createDataFrame([(float(a),) for a in angles], "aspect double")
    classes = [(270.0, 90.0, "N"), (90.01, 269.99, "S")]
    got = [r[0] for r in dem.select(terrain.aspect_class(dem["aspect"], classes)).collect()]
    assert got == [0, 0, None, None, 1, None, 0, 0]


@pytest.mark.parametrize("tile", [2, 5, 256])
def test_aspect_does_not_depend_on_tiles(spark, tile):
    rnd = random.Random(9)
    grid = {(r, c): float(rnd.randrange(5)) for r in range(13) for c in range(11) if rnd.random() > 0.05}
    dem = spark.createDataFrame([("f", r, c, float(c), float(-r), z) for (r, c), z in grid.items()], DEM)
    got = {(r["row"], r["col"]): r["aspect"] for r in terrain.with_aspect(dem, tile).collect()}
    assert set(got) == set(grid)
    for (r, c), a in got.items():
        around = [grid.get(k) for k in ((r, c + 1), (r, c - 1), (r - 1, c), (r + 1, c))]
        if None in around or (around[0] == around[1] and around[2] == around[3]):
            assert a is None
        else:
            dx, dy = (around[0] - around[1]) / 2, (around[2] - around[3]) / 2
            assert a == pytest.approx(math.degrees(math.atan2(-dx, -dy)) % 360)


def test_slope_down_to_the_south_faces_south(spark):
    dem = spark.createDataFrame([("f", r, c, float(c), float(-r), 10.0 - r) for r in range(3) for c in range(3)], DEM)
    got = [r["aspect"] for r in terrain.with_aspect(dem).collect() if r["aspect"] is not None]
    assert got == [180.0]


def test_unit_numbers_and_limits(spark):
    dem = spark.createDataFrame([("f", 0, i, 0.0, 0.0, float(e), a) for i, (e, a) in enumerate([(1, 0.0), (1, 180.0), (9, 0.0), (9, 180.0), (9, 90.0)])], DEM + ", aspect double")
    units = topographic.topounits(dem, method="elevaspect", bins=2).orderBy("topounit_id").collect()
    assert [(u["topounit_id"], u["aspect_name"], u["n_cells"]) for u in units] == [(1, "N", 1), (2, "S", 1), (3, "N", 1), (4, "S", 1)]
    with pytest.raises(ValueError, match="12 units exceed"):
        topographic.topounits(dem, method="elevaspect", bins=6)
    with pytest.raises(ValueError, match="needs a number"):
        topographic.topounits(dem, method="elevaspect")
    with pytest.raises(ValueError, match="unknown method"):
        topographic.topounits(dem, method="other")


def test_empty_units_stay(spark):
    units = topographic.topounits(column(spark, [5] * 10), bins=3).orderBy("topounit_id").collect()
    assert [u["n_cells"] for u in units] == [0, 0, 10]


def test_outline_of_two_cells(spark):
    dem = spark.createDataFrame([("f", 0, 0), ("f", 0, 1)], "feature_id string, row int, col int")
    got = {tuple(r)[2:] for r in terrain.outline_segments(dem.withColumn("topounit_id", F.lit(1))).collect()}
    assert got == {(0, 0, 0, 2), (1, 0, 1, 2), (0, 0, 1, 0), (0, 2, 1, 2)}


@pytest.mark.parametrize("tile", [3, 256])
def test_outline_against_single_sides(spark, tile):
    rnd = random.Random(6)
    unit = {(r, c): rnd.randrange(3) for r in range(12) for c in range(14) if rnd.random() < 0.9}
    rows = [("f", r, c, u) for (r, c), u in unit.items()]
    got = terrain.outline_segments(spark.createDataFrame(rows, "feature_id string, row int, col int, topounit_id int"), tile).collect()
    want = set()
    for (r, c), u in unit.items():
        near = {(r, c, r, c + 1): (r - 1, c), (r + 1, c, r + 1, c + 1): (r + 1, c), (r, c, r + 1, c): (r, c - 1), (r, c + 1, r + 1, c + 1): (r, c + 1)}
        want |= {(u, *side) for side, other in near.items() if unit.get(other) != u}
    parts = []
    for _, u, r0, c0, r1, c1 in map(tuple, got):
        parts += [(u, r0, c, r1, c + 1) for c in range(c0, c1)] if r0 == r1 else [(u, r, c0, r + 1, c1) for r in range(r0, r1)]
    assert len(parts) == len(set(parts)) and set(parts) == want
    ends = {(r.topounit_id, r.row1, r.col1, r.row0 == r.row1) for r in got}
    assert not any((r.topounit_id, r.row0, r.col0, r.row0 == r.row1) in ends for r in got)  # none can be made longer



def test_scales():
    assert terrain.export_scale("native") == 2.0 and terrain.export_scale("native", native=False) == 100.0 and terrain.export_scale(30) == 30.0
