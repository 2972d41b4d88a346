"""Files, streams and whole flows."""

import pytest
from pyspark.sql import functions as F

from metforge import dims
from metforge.functions import temporal
from metforge.operators import projection, sites
from metforge.plans import forcing, sampling
from metforge.sources import readers, sinks
from metforge.streaming import ingest

HEADER = "gid,date," + ",".join(dims.REQUIRED_BANDS)
PLACES = "gid string, lat double, lon double"


def line(gid, date, t=280.0):
    return f"{gid},{date},{t},3.0,4.0,3600000.0,7200000.0,0.36,101325.0,275.0"


def year_of(gid, year, t=280.0):
    return [line(gid, f"{year}-01-01 00:00", t), line(gid, f"{year}-02-29 00:00", t) if year % 4 == 0 else line(gid, f"{year}-03-01 00:00", t), line(gid, f"{year}-12-31 23:00", t + 5)]


@pytest.fixture
def folder(tmp_path):
    d = tmp_path / "in"
    d.mkdir()
    (d / "a.csv").write_text("\n".join([HEADER, *year_of("1", 2000), *year_of("2", 2000, 250.0)]))
    (d / "b.csv").write_text("\n".join([HEADER, *year_of("1", 2001), line("2", "2001-01-01 00:00"), line("9", "2001-05-05 05:00")]))
    (d / "notes.txt").write_text("not a table")
    return d


@pytest.fixture(scope="module")
def places(spark):
    return spark.createDataFrame([("1", 68.35, 18.8), ("2", 68.6, -149.6)], PLACES)


def test_csv_folder_is_one_table(spark, folder):
    df = readers.hourly_csv(spark, str(folder))
    assert df.count() == 11 and dict(df.dtypes)["date"] == "timestamp_ntz"
    plan = readers.hourly_dates(spark, str(folder))._jdf.queryExecution().executedPlan().toString()
    assert "temperature_2m" not in plan.split("ReadSchema")[1]


def test_csv_files_by_their_own_headers(spark, folder):
    (folder / "c.csv").write_text('date,gid,other\n2000-01-01 00:00,7,5\n\n2000-01-01 01:00,"8",\n')
    (folder / "empty.csv").write_text("")
    df = readers.hourly_csv(spark, str(folder))
    assert df.count() == 13 and df.columns[0] == "gid"
    got = {r["gid"]: (r["other"], r["temperature_2m"]) for r in df.where("gid IN ('7', '8')").collect()}
    assert got == {"7": (5.0, None), "8": (None, None)}
    assert df.where("gid NOT IN ('7', '8')").where("temperature_2m IS NULL OR other IS NOT NULL").count() == 0


def test_forcing_end_to_end(spark, folder, places):
    hourly = readers.hourly_csv(spark, str(folder))
    options = forcing.ForcingOptions()
    assert forcing.year_bounds(hourly, options) == (2000, 2001)
    ready = forcing.forcing_ready(hourly, places, options)
    assert ready.columns == dims.PROFILES["BYPASS"] + forcing.KEYS
    rows = sites.sorted_observations(ready).collect()
    assert len(rows) == 8  # without the leap days and the unknown site
    first = rows[0]
    assert (first["WIND"], first["FSDS"], first["FLDS"]) == (5.0, 1000.0, 2000.0)
    assert first["PRECTmms"] == pytest.approx(0.1) and first["QBOT"] == pytest.approx(0.00437544281)
    with pytest.raises(ValueError, match="ZBOT"):
        forcing.forcing_ready(hourly, places, forcing.ForcingOptions(profile="DATM_MODE"))
    tower = forcing.forcing_ready(hourly.withColumn("ZBOT", F.lit(10.0)), places, forcing.ForcingOptions(profile="DATM_MODE"))
    assert "RH" in tower.columns and "QBOT" not in tower.columns


@pytest.mark.parametrize("layout,sets", [("site", 14), ("grid", 7)])
def test_packed_dataset(spark, folder, places, tmp_path, layout, sets):
    hourly = readers.hourly_csv(spark, str(folder))
    located = sites.with_zones(places, 1)
    ready = forcing.forcing_ready(hourly, located)
    values, meta = forcing.packed_dataset(ready, located, 2000, 2001, layout=layout)
    sinks.packed_dataset(values, meta, str(tmp_path / "out"), layout)
    meta = spark.read.parquet(str(tmp_path / "out/metadata"))
    assert meta.count() == sets and meta.where("units = 'K'").count() == sets // 7
    assert {r["dataset"] for r in meta.collect()} == {f"ERA5_{v}_2000-2001_z01" for v in dims.PROFILES["BYPASS"]}
    back = spark.read.parquet(str(tmp_path / "out/values"))
    stamps = ready.select("time").distinct().count()
    assert back.count() == (8 if layout == "site" else stamps * 2) * 7 and dict(back.dtypes)["packed"] == "smallint"
    if layout == "grid":  # dense, the cells without data hold the fill value
        one = back.where("variable = 'TBOT'")
        assert {(r["t_idx"], r["n_idx"]) for r in one.collect()} == {(t, n) for t in range(stamps) for n in range(2)}
        assert one.where("packed <> -32767").count() == 8
    last = back.where("gid = 1 and variable = 'TBOT'").orderBy(F.desc("time")).first()
    assert last["dtime"] == pytest.approx(730 + 23 / 24)


def test_packed_columns(spark, folder, places, tmp_path):
    """A row is stored for each stamp of a site, not for each variable, and read back as in the site layout."""
    located = sites.with_zones(places, 1)
    ready = forcing.forcing_ready(readers.hourly_csv(spark, str(folder)), located)
    values, meta = forcing.packed_dataset(ready, located, 2000, 2001)
    wide, same = forcing.packed_columns(ready, located, 2000, 2001)
    sinks.packed_columns(wide, same, str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out/values")).count() == 8
    back = readers.packed_columns(spark, str(tmp_path / "out"))
    assert back.schema["packed"].dataType == values.schema["packed"].dataType
    as_rows = lambda df: sorted(tuple(map(str, r)) for r in df.select("gid", "variable", "zone", "time", "dtime", "packed").collect())
    assert as_rows(back) == as_rows(values) and len(as_rows(back)) == 8 * 7
    assert as_rows(readers.packed_columns(spark, str(tmp_path / "out"), ["TBOT"])) == as_rows(values.where("variable = 'TBOT'"))
    written = spark.read.parquet(str(tmp_path / "out/metadata"))
    assert sorted(map(str, written.collect())) == sorted(map(str, meta.collect()))


def test_coarse_axis_has_fill_values(spark, places):
    rows = [("1", f"2001-01-01 {h:02d}:00", 280.0 + h, 3.0, 4.0, 1.0, 1.0, 1.0, 1e5, 275.0) for h in range(1, 8)]
    hourly = spark.createDataFrame(rows, ["gid", "date", *dims.REQUIRED_BANDS])
    located = sites.with_zones(places, 1)
    options = forcing.ForcingOptions(resolution_hours=3)
    ready = forcing.model_ready(hourly, located, 2001, 2001, options)
    values, _ = forcing.packed_dataset(ready, located, 2001, 2001, options)
    got = values.where("variable = 'TBOT'").orderBy("time").collect()
    assert [r["dtime"] * 24 for r in got] == [0, 3, 6]
    assert got[0]["packed"] == -32767 and got[1]["packed"] < got[2]["packed"]


def test_sites_of_a_grid_share_their_bins(spark, places):
    rows = [("1", "2001-01-01 00:00", 280.0), ("1", "2001-01-02 12:00", 281.0), ("2", "2001-01-02 12:00", 290.0)]
    hourly = spark.createDataFrame([(*r, 3.0, 4.0, 1.0, 1.0, 1.0, 1e5, 275.0) for r in rows], ["gid", "date", *dims.REQUIRED_BANDS])
    located = sites.with_zones(places, 1)
    options = forcing.ForcingOptions(resolution_hours=36)
    ready = forcing.model_ready(hourly, located, 2001, 2001, options)
    values, _ = forcing.packed_dataset(ready, located, 2001, 2001, options, layout="grid")
    got = {(r["gid"], r["dtime"]): r["packed"] for r in values.where("variable = 'TBOT'").collect()}
    assert set(got) == {("1", 0.0), ("1", 1.5), ("2", 0.0), ("2", 1.5)}
    assert [k for k, v in got.items() if v == -32767] == [("2", 0.0)]


def test_site_store_and_mapping(spark, folder, places, tmp_path):
    ready = forcing.forcing_ready(readers.hourly_csv(spark, str(folder)), places)
    sinks.site_store(ready, str(tmp_path / "store"))
    assert readers.site_store(spark, str(tmp_path / "store"), ["2"]).count() == 3
    sinks.zone_mapping(sites.zone_mapping(places, site=True), str(tmp_path / "zones"), per_site=True)
    text = spark.read.text(str(tmp_path / "zones")).where("gid = 2").first()["value"]
    assert text == "210.4\t68.6\t01\t1"


def test_site_store_reads_few_row_groups(spark, tmp_path):
    rows = spark.range(200_000).select((F.col("id") % 500).cast("string").alias("gid"), F.timestamp_micros(F.col("id") * 3_600_000_000).alias("time"), F.rand(1).alias("TBOT"))
    path = str(tmp_path / "store")
    spark.conf.set("parquet.block.size", 16 * 1024)
    try:
        sinks.site_store(rows, path)
    finally:
        spark.conf.unset("parquet.block.size")
    folders = [p.name for p in (tmp_path / "store").iterdir() if p.is_dir()]
    assert len(folders) == sinks.SITE_BUCKETS  # not one for each of 500 sites
    kept = readers.site_store(spark, path, ["77"])
    assert kept.count() == 400 and "bucket" not in kept.columns
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan or "bucket#" in plan.split("PartitionFilters")[1].split("]")[0]
    assert "PushedFilters" in plan and "77" in plan.split("PushedFilters")[1]
    assert readers.site_store(spark, path, []).count() == 0


def test_a_batch_that_runs_again_replaces_itself(spark, folder, places, tmp_path):
    located, store = sites.with_zones(places, 1), str(tmp_path / "store")
    hourly = readers.hourly_csv(spark, str(folder))
    for number in (0, 0, 1, 0):
        ingest.write_batch(hourly, number, located, store, 2000, 2001)
    assert readers.site_store(spark, store).count() == 16


def test_a_batch_with_most_rows_at_one_site(spark, folder, places, tmp_path, monkeypatch):
    from metforge.operators import skew

    monkeypatch.setattr(skew, "fits_broadcast", lambda df, limit=0: False)
    monkeypatch.setattr(skew.salted_join, "__defaults__", ("inner", 20))
    one = readers.hourly_csv(spark, str(folder)).where("gid = '1'").limit(1).drop("gid", "date")
    start = F.lit("2000-01-01 00:00:00").cast("timestamp_ntz")
    rows = spark.range(5000).select(F.when(F.col("id") % 10 < 9, "1").otherwise("2").alias("gid"), (start + F.make_dt_interval(F.lit(0), F.col("id").cast("int"))).alias("date"))
    batch = rows.crossJoin(one)
    store = str(tmp_path / "store")
    ingest.write_batch(batch, 0, sites.with_zones(places, 1), store, 2000, 2000)
    counts = {r["gid"]: r["count"] for r in readers.site_store(spark, store).groupBy("gid").count().collect()}
    leap = sum(1 for i in range(5000) if 59 * 24 <= i < 60 * 24 and i % 10 < 9), sum(1 for i in range(5000) if 59 * 24 <= i < 60 * 24 and i % 10 == 9)
    assert counts == {"1": 4500 - leap[0], "2": 500 - leap[1]}


def test_catalogue_outputs_by_all_keys(spark, tmp_path):
    rows = [("pr", "M1", "ssp1", "r1", "x"), ("tas", "M1", "ssp1", "r1", "y"), ("pr", "M2", "ssp1", "r2", "z")]
    table = spark.createDataFrame(rows, "variable_id string, source_id string, experiment_id string, member_id string, zstore string")
    sinks.catalogue_outputs(table, str(tmp_path / "out"))
    assert (tmp_path / "out/variable_id=pr/source_id=M2/experiment_id=ssp1/member_id=r2").is_dir()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 3


def test_variables_are_discovered_by_their_dimensions(spark, tmp_path):
    from metforge.operators import catalog

    rows = [(2000, 1, 1, 0, 1.0, 2.0, "pr_M_ssp1_r1.nc", 0.5, 0.7, 9.0)]
    table = spark.createDataFrame(rows, "year int, month int, day int, second int, lon double, lat double, path string, pr double, tas double, height double")
    sinks.gridded(table, str(tmp_path / "g"), {"pr": ["time", "lat", "lon"], "tas": ["lat"], "height": ["level"], "lat": ["lat"]})
    back = spark.read.parquet(str(tmp_path / "g"))
    assert sorted(catalog.gridded_variables(back)) == ["pr", "tas"]
    assert {r["var"] for r in catalog.long_table(back).collect()} == {"pr", "tas"}
    with pytest.raises(ValueError, match="gridded"):
        catalog.long_table(table)


def test_sinks_overwrite(spark, tmp_path):
    d = spark.createDataFrame([("a", 1.0, "x")], "gid string, v double, batch string")
    for _ in range(2):
        sinks.zonal_csv(d, str(tmp_path / "z"))
    assert spark.read.option("header", True).csv(str(tmp_path / "z")).count() == 1
    assert not sinks.climate_long(d.where("false"), str(tmp_path / "none")) and not (tmp_path / "none").exists()


def test_stream_takes_each_file_once(spark, folder, places, tmp_path):
    store, progress = str(tmp_path / "store"), str(tmp_path / "progress")
    located = sites.with_zones(places, 1)

    def run():
        ingest.ingest(ingest.hourly_stream(spark, str(folder)), located, store, progress, 2000, 2001).awaitTermination()
        return readers.site_store(spark, store).count()

    assert run() == 8
    assert run() == 8
    (folder / "later.csv").write_text("\n".join([HEADER, line("2", "2001-06-01 00:00")]))
    assert run() == 9
    batch = forcing.model_ready(readers.hourly_csv(spark, str(folder)), located, 2000, 2001)
    cols = dims.PROFILES["BYPASS"] + ["gid", "time"]
    stored = readers.site_store(spark, store)
    assert sorted(map(tuple, stored.select(*cols).collect())) == sorted(map(tuple, batch.select(*cols).collect()))


def test_reference_tables(spark, tmp_path):
    (tmp_path / "stats.csv").write_text(",A,B\nmean,1.0,2.0\nmin,0.5,1.5\nmax,9,8\n")
    got = {r["variable"]: tuple(r)[1:] for r in readers.reference_stats(spark, str(tmp_path / "stats.csv")).collect()}
    assert got == {"A": (1.0, 0.5, 9.0), "B": (2.0, 1.5, 8.0)}
    (tmp_path / "bands.csv").write_text('band_name,units,description\nt,K,"warm, ""very"" warm"\nu,,\n')
    rows = readers.band_catalogue(spark, str(tmp_path / "bands.csv")).collect()
    assert [tuple(r) for r in rows] == [("t", "K", 'warm, "very" warm'), ("u", None, None)]


def test_model_outputs_are_tagged(spark, tmp_path):
    spark.range(3).withColumn("pr", F.lit(1.0)).write.parquet(str(tmp_path / "o/one"))
    spark.range(2).withColumn("tas", F.lit(1.0)).write.parquet(str(tmp_path / "o/two"))
    got = readers.model_outputs(spark, str(tmp_path / "o"), "pr")
    assert got.count() == 3 and got.where("source_file is null").count() == 0
    with pytest.raises(ValueError, match="huss"):
        readers.model_outputs(spark, str(tmp_path / "o"), "huss")


def test_unsupported_elevation_source(spark):
    with pytest.raises(ValueError, match="other"):
        readers.elevation_model(spark, "x", "other")


def test_sampling_cuts_at_the_latest_day(spark):
    series = spark.createDataFrame([(1, f"2001-0{m}-01 06:00", float(m)) for m in range(1, 7)], "cell_id int, t string, v double")
    series = series.select("cell_id", temporal.naive(F.col("t")).alias("time"), "v")
    cells = spark.createDataFrame([(1, 0.0, 0.0)], "cell_id int, lat double, lon double")
    geoms = spark.createDataFrame([("p", "Point", [[(0.2, 0.1)]])], "gid string, geom_type string, rings array<array<struct<x:double,y:double>>>")
    request = sampling.SampleRequest("2001-02-01", "2030-01-01", ["v"], 1, "j", 1.0)
    rows, places = sampling.sample_zonal(series, cells, geoms, request)
    got = rows.orderBy("date").collect()
    assert [(r["date"], r["v"], r["batch"]) for r in got] == [(f"2001-0{m}-01 06:00", float(m), "j_2001-02-01_2001-06-01") for m in range(2, 6)]
    assert places.first()["method"] == "sampled at provided coordinate"
    empty = sampling.SampleRequest("2031-01-01", "2032-01-01", ["v"], 1, "j", 1.0)
    assert sampling.sample_zonal(series, cells, geoms, empty)[0].count() == 0
    with pytest.raises(ValueError, match="unknown bands: w"):
        sampling.sample_zonal(series, cells, geoms, sampling.SampleRequest("2001-01-01", "2002-01-01", ["w"]))


def test_band_table_and_ids(spark):
    d = spark.createDataFrame([(7, "2000-01-01 05:30", 1.0, 2.0)], "pid int, t string, a double, b double")
    got = projection.band_table(projection.with_gid(d), "gid", "t", ["b"]).first()
    assert tuple(got) == ("7", "2000-01-01 05:30", 2.0)


def test_gathered_grid_is_the_dense_one_without_its_fill_values(spark, places, tmp_path):
    rows = [("1", "2001-01-01 00:00", 280.0), ("1", "2001-01-01 01:00", 281.0), ("2", "2001-01-02 12:00", 290.0), ("2", "2001-01-02 13:00", None)]
    schema = "gid string, date string, " + ", ".join(f"{b} double" for b in dims.REQUIRED_BANDS)
    hourly = spark.createDataFrame([(*r, 3.0, 4.0, 1.0, 1.0, 1.0, 1e5, 275.0) for r in rows], schema)
    located = sites.with_zones(places, 1)
    ready = forcing.model_ready(hourly, located, 2001, 2001)
    dense, _ = forcing.packed_dataset(ready, located, 2001, 2001, layout="grid")
    values, meta, times, at = forcing.gathered_dataset(ready, located, 2001, 2001)
    path = str(tmp_path / "out")
    sinks.gathered_dataset(values, meta, times, at, path)
    written = spark.read.parquet(f"{path}/values")
    assert written.where("variable = 'TBOT'").count() == 3 and written.where("packed = -32767").count() == 0
    back = readers.gathered_grid(spark, path)
    assert sorted(map(tuple, back.select(*dense.columns).collect())) == sorted(map(tuple, dense.collect()))
    assert back.where("variable = 'TBOT'").count() == 4 * 2


def test_lines_of_mixed_files_are_parsed_once(spark, folder):
    (folder / "c.csv").write_text("date,gid,other\n2000-01-01 00:00,7,5\n2000-01-01 01:00\n2000-01-01 02:00,8,6,9,9\n")
    df = readers.hourly_csv(spark, str(folder))
    got = {r["date"].hour: (r["gid"], r["other"]) for r in df.where("temperature_2m IS NULL").collect()}
    assert got == {0: ("7", 5.0), 1: (None, None), 2: ("8", 6.0)}
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_csv") == 1
