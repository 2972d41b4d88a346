import math

import pytest
from pyspark.sql import functions as F

from metforge.functions import physics
from metforge.plans import forcing
from metforge.operators import projection


def values(df, *cols):
    return [tuple(r) for r in df.select(*cols).collect()]


def test_wind(spark):
    df = spark.createDataFrame([(3.0, 4.0), (1.0, 0.0), (-1.0, 0.0), (0.0, 1.0), (0.0, -1.0), (-0.0, -1.0)], "u double, v double")
    u, v = F.col("u"), F.col("v")
    got = values(df, physics.wind_speed(u, v), physics.wind_direction(u, v))
    want = [(5, 216.869898), (1, 270), (1, 90), (1, 180), (1, 180), (1, 0)]
    for g, w in zip(got, want):
        assert g == pytest.approx(w, abs=1e-6)
    fixed = values(df, physics.wind_direction(u, v, fix_north=True))
    assert fixed[4][0] == pytest.approx(360)


def test_humidity(spark):
    df = spark.createDataFrame(
        [(280.0, 275.0, 101325.0), (260.0, 255.0, 98000.0), (273.15, 270.0, 100000.0)], "t double, d double, p double"
    )
    got = values(
        df,
        physics.relative_humidity(F.col("t"), F.col("d")),
        physics.specific_humidity(F.col("t"), F.col("d"), F.col("p")),
    )
    want = [(72.282527, 0.00437544281), (78.163210, 0.00097130483), (79.690964, 0.00303404473)]
    for (rh, q), (wrh, wq) in zip(got, want):
        assert rh == pytest.approx(wrh, abs=1e-6)
        assert q == pytest.approx(wq, abs=1e-10)


def test_consistent_latent_heat_changes_warm_air(spark):
    df = spark.createDataFrame([(280.0, 280.0)], "t double, d double")
    assert values(df, physics.relative_humidity(F.col("t"), F.col("d"), True))[0][0] == pytest.approx(100)
    assert values(df, physics.relative_humidity(F.col("t"), F.col("d")))[0][0] != pytest.approx(100, abs=1)


def test_degenerate_pressure_is_missing_not_an_error(spark):
    df = spark.createDataFrame([(0.0, 0.0, 0.0)], "t double, d double, p double")
    assert values(df, physics.specific_humidity(F.col("t"), F.col("d"), F.col("p"))) == [(None,)]


def test_units_and_clip(spark):
    df = spark.createDataFrame([(0.36, 3600000.0, None), (-0.36, -1.0, -1.0), (0.0, 0.0, 2.0)], "p double, s double, c double")
    got = values(
        df,
        physics.metres_per_hour_to_mm_per_second(F.col("p")),
        physics.joules_per_hour_to_watts(F.col("s")),
        physics.clip_negative(F.col("c")),
    )
    assert got[0][:2] == pytest.approx((0.1, 1000.0))
    assert [g[2] for g in got] == [None, 0.0, 2.0]


def test_clip_keeps_nan(spark):
    df = spark.createDataFrame([(float("nan"),)], "c double")
    assert math.isnan(values(df, physics.clip_negative(F.col("c")))[0][0])
    assert values(df, physics.nan_to_null(F.col("c"))) == [(None,)]


def test_longitude(spark):
    df = spark.createDataFrame([(-149.59429,), (18.78333,), (360.0,), (-360.0,)], "lon double")
    assert [r[0] for r in values(df, physics.wrap_longitude(F.col("lon")))] == pytest.approx([210.40571, 18.78333, 0, 0])


def test_absent_columns_are_skipped(spark):
    df = spark.createDataFrame([(1.0,)], "total_precipitation_hourly double")
    out = forcing.clip_nonnegative(forcing.derive_humidity(forcing.convert_units(df)))
    assert out.columns == ["total_precipitation_hourly"]


def test_final_selection_names_all_missing(spark):
    df = spark.createDataFrame([("a", 1.0, 1.0)], "gid string, lat double, lon double")
    with pytest.raises(ValueError, match="TBOT.*WIND"):
        projection.strict_select(df, projection.profile_variables("BYPASS"))
    with pytest.raises(ValueError, match="unknown output profile"):
        projection.profile_variables("OTHER")
    with pytest.raises(ValueError, match="one, two"):
        projection.resolve_bands(["temperature_2m", "one", "two"])
    assert projection.resolve_bands("elm")[0] == "temperature_2m"
    assert len(projection.resolve_bands("all")) == 69
    assert projection.infer_id_column(["lat", "gid", "pid", "site_id"]) == "gid"
    with pytest.raises(ValueError, match="no id column"):
        projection.infer_id_column(["lat", "lon"])
