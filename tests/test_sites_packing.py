import random

import pytest
from pyspark.sql import functions as F

from metforge.functions import codec, labels
from metforge.operators import packing, quality, sites

# fixed values: seven example sites
SITES = [
    ("abisko", 68.35, 18.78333), ("tvc", 68.742, -133.499), ("toolik", 68.62758, -149.59429), ("chars", 69.13, -105.0415),
    ("qhi", 69.5795, -139.0762), ("sam", 72.22, 126.3), ("sjb", 78.92163, 11.83109),
]


@pytest.fixture(scope="module")
def places(spark):
    return spark.createDataFrame(SITES, "gid string, lat double, lon double")


def test_round_robin_zones(places):
    got = sites.with_zones(places, 2).orderBy("site_no").collect()
    assert [r["gid"] for r in got] == ["abisko", "toolik", "tvc", "chars", "qhi", "sam", "sjb"]
    assert [r["zone"] for r in got] == [1, 2, 1, 2, 1, 2, 1]


@pytest.mark.parametrize("zones", [1, 3, 5, 11])
def test_zones_are_balanced(spark, zones):
    many = spark.range(97).select(F.col("id").cast("string").alias("gid"), (F.col("id") % 7).alias("lat"), F.lit(1.0).alias("lon"))
    sizes = [r["count"] for r in sites.with_zones(many, zones).groupBy("zone").count().collect()]
    assert len(sizes) == zones and max(sizes) - min(sizes) <= 1


def test_given_zones_stay(places):
    given = places.withColumn("zone", F.lit(7))
    assert {r["zone"] for r in sites.with_zones(given, 2).collect()} == {7}


def test_zone_mapping(places):
    got = {r["id"]: r for r in sites.zone_mapping(sites.with_zones(places, 2)).collect()}
    assert got[2]["lon"] == pytest.approx(210.40571) and got[2]["zone"] == "02"
    single = sites.zone_mapping(places, site=True).collect()
    assert {(r["id"], r["zone"]) for r in single} == {(1, "01")} and len(single) == 7


def test_labels(spark):
    d = spark.createDataFrame([(3, "a/b/pr_M_ssp1_x.nc"), (123, "tas.v1.nc")], "z int, p string")
    got = d.select(labels.zone_code(F.col("z")), labels.file_stem(F.col("p")), labels.stem_part(F.col("p"), 2)).collect()
    assert [tuple(r) for r in got] == [("03", "pr_M_ssp1_x", "ssp1"), ("123", "tas.v1", None)]
    name = labels.dataset_name(F.lit("TBOT"), F.lit(1980), F.lit(2000), F.lit(1))
    assert d.select(name).first()[0] == "ERA5_TBOT_1980-2000_z01"


def test_ids_match_as_text(spark, places):
    numeric = spark.createDataFrame([(1, 2.0), (2, 3.0)], "gid int, v double")
    table = spark.createDataFrame([("1", 0.0, 0.0)], "gid string, lat double, lon double")
    assert [tuple(r) for r in sites.attach_locations(numeric, table).collect()] == [("1", 2.0, 0.0, 0.0)]


def test_packing_vector(spark):
    d = spark.createDataFrame([("g", "TBOT", 230.0), ("g", "TBOT", 300.0), ("g", "TBOT", None)], "gid string, variable string, value double")
    p = packing.packing_params(d, ["gid", "variable"]).first()
    assert p["scale_factor"] == pytest.approx(0.0011868228751631881, rel=1e-15)
    assert p["add_offset"] == pytest.approx(265.0005934114376, rel=1e-15)
    assert sorted(r["packed"] for r in packing.pack_table(d, ["gid", "variable"]).collect()) == [-32767, -29491, 29490]


def test_constant_variable_packs(spark):
    d = spark.createDataFrame([("g", 5.0), ("g", 5.0)], "gid string, value double")
    back = packing.unpack_table(packing.pack_table(d, ["gid"])).collect()
    assert [r["value"] for r in back] == [5.0, 5.0]


@pytest.mark.parametrize("target", ["int16", "int32", "uint16"])
def test_round_trip_error(spark, target):
    rnd = random.Random(1)
    d = spark.createDataFrame([(f"g{i % 3}", rnd.uniform(-5, 900)) for i in range(500)], "gid string, value double")
    packed = packing.pack_table(d, ["gid"], target=target)
    back = codec.unpack(F.col("packed"), F.col("add_offset"), F.col("scale_factor"))
    worst = packed.select(F.max(F.abs(back - F.col("value")) / F.col("scale_factor"))).first()[0]
    assert worst <= 0.5000001


def test_preset_ranges_and_overflow(spark):
    d = spark.createDataFrame([("TBOT", 175.0), ("TBOT", 350.0), ("TBOT", 900.0), ("ZBOT", 1.0)], "variable string, value double")
    got = packing.pack_table(d, ["variable"], params=packing.preset_params(d)).collect()
    assert sorted((r["value"], r["packed"]) for r in got) == [(1.0, -32767), (175.0, -29491), (350.0, 29490), (900.0, -32767)]


def test_dense_index(spark):
    rows = [(t, g, lat, 0.0, 1.0) for t in (10, 20, 30) for g, lat in (("b", 1.0), ("a", 2.0), ("c", 1.0))]
    d = spark.createDataFrame(rows, "time int, gid string, LATIXY double, LONGXY double, v double")
    got = {(r["time"], r["gid"]): (r["t_idx"], r["n_idx"]) for r in packing.dense_index(d).collect()}
    assert got[(10, "b")] == (0, 0) and got[(20, "c")] == (1, 1) and got[(30, "a")] == (2, 2)
    assert packing.dense_coverage(d).first()["complete"]
    assert not packing.dense_coverage(d.where("not (time = 10 and gid = 'a')")).first()["complete"]


def test_celsius_is_flagged(spark):
    d = spark.createDataFrame([("TBOT", 9.0), ("TBOT", 11.0), ("QBOT", -1.0), ("XYZ", 1.0)], "variable string, value double")
    got = {r["variable"]: r for r in quality.range_report(d).collect()}
    t = got["TBOT"]
    assert t["magnitude_gap"] == pytest.approx(1.42, abs=0.01)
    assert t["magnitude_concern"] and t["range_concern"] and t["hard_limit_concern"]
    assert not got["QBOT"]["magnitude_concern"] and got["QBOT"]["range_concern"]
    assert not got["XYZ"]["has_stats"] and not got["XYZ"]["range_concern"] and got["XYZ"]["outside_fraction"] is None


def test_nan_is_missing_in_statistics(spark):
    d = spark.createDataFrame([("TBOT", 250.0), ("TBOT", float("nan")), ("TBOT", 260.0)], "variable string, value double")
    s = quality.variable_stats(d).first()
    assert s["mean"] == 255.0 and s["max"] == pytest.approx(259.9)
    assert quality.range_report(d).first()["max"] == 260.0


def test_axis_check(spark):
    e = spark.createDataFrame([("a", 1, 0.0), ("a", 2, 1.0), ("a", 3, 2.0)], "gid string, p int, d double")
    a = spark.createDataFrame([("a", 1, 0.0), ("a", 2, 1.0 + 5e-6), ("a", 4, 2.0)], "gid string, p int, d double")
    assert tuple(quality.axis_check(e, a, ["gid"], "p", "d").first()) == ("a", 3, 3, 2)
