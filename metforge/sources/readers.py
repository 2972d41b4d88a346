"""Readers.  All of them are lazy scans that prune columns and rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from metforge import dims
from metforge.functions import geometry as geo
from metforge.functions import temporal
from metforge.functions.physics import nan_to_null
from metforge.operators import projection
from metforge.operators.skew import lookup_join
from metforge.session import materialize
from metforge.sources import collections, sinks
from metforge.sources.sinks import site_bucket


def hourly_schema(id_col: str = "gid", bands: Sequence[str] = tuple(dims.REQUIRED_BANDS)) -> T.StructType:
    fields = [T.StructField(id_col, T.StringType()), T.StructField("date", T.StringType())]
    return T.StructType(fields + [T.StructField(b, T.DoubleType()) for b in bands])


def _csv_files(reader: DataFrameReader) -> DataFrameReader:
    return reader.option("pathGlobFilter", "*.csv").option("recursiveFileLookup", True)


def csv_headers(spark: SparkSession, path: str) -> DataFrame:
    """``file, header``: the first line of every ``.csv`` below a folder."""
    lines = _csv_files(spark.read).text(path).select("value", "_metadata.file_path", "_metadata.file_block_start")
    first = lines.withColumn("_at", F.monotonically_increasing_id()).where(F.col("file_block_start") == 0)
    return first.groupBy(F.col("file_path").alias("file")).agg(F.min_by("value", "_at").alias("header"))


def csv_by_header(spark: SparkSession, path: str, headers: DataFrame) -> DataFrame:
    """Text columns of CSV files that differ in the order or number of their columns.

    Each line is taken apart by the header of its own file; a column that a file lacks is null.  Columns are those of all
    headers, in the order of their first place.  A quoted field may not hold a line break.
    """
    width = headers.agg(F.max(F.size(F.split("header", ",")))).first()[0] or 1
    fields = ", ".join(f"c{i} string" for i in range(width))
    # a text is parsed once, by all columns: fields taken from from_csv itself would each parse it again
    parsed = lambda df, c: df.withColumn("_c", F.from_csv(c, fields)).withColumn(c, F.array(*[F.col(f"_c.c{i}") for i in range(width)])).drop("_c")
    named = parsed(headers.withColumn("names", F.col("header")), "names")
    places = named.select(F.posexplode("names").alias("place", "name")).where("name IS NOT NULL")
    # one row per column name
    names = [r["name"] for r in places.groupBy("name").agg(F.min("place").alias("place")).orderBy("place", "name").collect()]
    # where a file has each of the columns, found once per file
    place = lambda name: F.nullif(F.array_position("names", F.lit(name)).cast("int"), F.lit(0))
    layouts = materialize(named.select("file", "header", F.array(*[place(n) for n in names]).alias("at")))
    lines = _csv_files(spark.read).text(path).select("value", F.col("_metadata.file_path").alias("file"))
    # the header itself has no cells at all, so that no later cast meets its names
    line = F.when((F.col("value") != F.col("header")) & (F.trim("value") != ""), F.col("value"))
    rows = lookup_join(lines, layouts, "file").withColumn("cells", line).where("cells IS NOT NULL").select("at", "cells")
    return parsed(rows, "cells").select(*[F.element_at("cells", F.col("at")[i]).alias(n) for i, n in enumerate(names)])


def hourly_csv(spark: SparkSession, path: str, id_col: str | None = None) -> DataFrame:
    """Every ``.csv`` of a folder as one hourly table with ``gid, date`` and double bands.

    Columns are found by the header of each file.  Files with one and the same header go to the CSV reader, which
    skips columns that are not needed; others are taken apart line by line.
    """
    headers = materialize(csv_headers(spark, path))
    if headers.select("header").distinct().limit(2).count() < 2:
        raw = _csv_files(spark.read.option("header", True).option("enforceSchema", False)).csv(path)
    else:
        raw = csv_by_header(spark, path, headers)
    table = projection.with_gid(raw, id_col)
    bands = [nan_to_null(F.col(c).cast("double")).alias(c) for c in table.columns if c not in ("gid", "date")]
    return table.select("gid", temporal.naive(F.col("date")).alias("date"), *bands)


def hourly_dates(spark: SparkSession, path: str, id_col: str | None = None) -> DataFrame:
    """Only the dates of the same files; the parser skips the other columns."""
    return hourly_csv(spark, path, id_col).select("date")


def band_catalogue(spark: SparkSession, path: str) -> DataFrame:
    return (
        spark.read.option("header", True)
        .option("escape", '"')
        .schema("band_name string, units string, description string")
        .csv(path)
    )


def reference_stats(spark: SparkSession, path: str) -> DataFrame:
    """Statistics as ``(variable, ref_mean, ref_min, ref_max)``: a row per variable, or wide with a row per mean, min, max."""
    wide = spark.read.option("header", True).csv(path)
    if "variable" in wide.columns:
        return wide.select("variable", *[F.col(c).cast("double").alias(f"ref_{c}") for c in ("mean", "min", "max")])
    index, variables = wide.columns[0], wide.columns[1:]
    long = wide.select(F.col(index).alias("_stat"), *[F.col(f"`{v}`").cast("double").alias(v) for v in variables]).unpivot(
        ["_stat"], variables, "variable", "_v"
    )
    pick = lambda name: F.max(F.when(F.col("_stat") == name, F.col("_v"))).alias(f"ref_{name}")
    return long.groupBy("variable").agg(pick("mean"), pick("min"), pick("max"))


FEATURE = "type string, geometry struct<type:string, coordinates:string>, properties map<string,string>"


def geometries(features: DataFrame, id_field: str) -> DataFrame:
    """``(gid, geom_type, rings)`` from parsed features; a feature without the id is an error."""
    text = F.col("geometry.coordinates")
    kind = F.col("geometry.type")
    vertex = lambda p: geo.point(p[0], p[1])
    ring = lambda r: F.transform(r, vertex)
    polygon = lambda p: geo.normalise_part(F.transform(p, ring))
    rings = (
        F.when(kind == "Point", F.array(F.array(vertex(F.from_json(text, "array<double>")))))
        .when(kind == "Polygon", polygon(F.from_json(text, "array<array<array<double>>>")))
        .when(kind == "MultiPolygon", F.flatten(F.transform(F.from_json(text, "array<array<array<array<double>>>>"), polygon)))
        .otherwise(F.raise_error(F.concat(F.lit("unsupported geometry type: "), kind)))
    )
    gid = F.coalesce(F.try_element_at(F.col("properties"), F.lit(id_field)), F.raise_error(F.lit(f"feature without {id_field}")))
    return features.select(gid.cast("string").alias("gid"), kind.alias("geom_type"), rings.alias("rings"))


def geojson(spark: SparkSession, path: str, id_field: str = "gid", lines: bool = True) -> DataFrame:
    """Geometries of GeoJSON files.

    ``lines`` expects one feature per line; otherwise each file is one feature collection.  Both split over tasks
    at any byte.
    """
    if lines:
        return geometries(spark.read.schema(FEATURE).json(path), id_field)
    parsed = collections.feature_objects(spark, path).select(F.from_json("value", FEATURE).alias("f")).select("f.*")
    return geometries(parsed.where("type = 'Feature'"), id_field)


def raster_series(spark: SparkSession, path: str, start: str, end: str, bands: Sequence[str]) -> DataFrame:
    """Cells in ``[start, end)``; the year partitions and the time range are both pruned."""
    years = F.col("year").between(int(start[:4]), int(end[:4]))
    t = F.col("time")
    return spark.read.parquet(path).where(years & temporal.in_half_open(t, start, end)).select("cell_id", "lat", "lon", "time", *bands)


def elevation_model(spark: SparkSession, path: str, source: str = "parquet") -> DataFrame:
    if source != "parquet":
        raise ValueError(f"unsupported elevation source {source!r}")
    return spark.read.parquet(path).select("feature_id", "row", "col", "x", "y", "elevation")


def climate_catalogue(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("header", True).csv(path)


def climate_cells(spark: SparkSession, path: str) -> DataFrame:
    """Gridded model cells with calendar fields and the path each row came from."""
    return spark.read.parquet(path).withColumn("path", F.col("_metadata.file_path"))


def model_outputs(spark: SparkSession, path: str, variable: str) -> DataFrame:
    """Output tables that hold ``variable``, rows tagged with their ``source_file`` and ``source_path``.

    Files may differ in columns.  Files without the variable are left out, by their schema; of the others all rows stay,
    also those without a value.
    """
    files = spark.read.option("recursiveFileLookup", True).parquet(path).inputFiles()
    held = [f for f in files if variable in spark.read.parquet(f).columns]
    if not held:
        raise ValueError(f"no file below {path} holds {variable}")
    merged = spark.read.option("mergeSchema", True).parquet(*held)
    return merged.withColumns({"source_file": F.col("_metadata.file_name"), "source_path": F.col("_metadata.file_path")})


def site_store(spark: SparkSession, path: str, gids: Sequence[str] | None = None) -> DataFrame:
    """Site store of :func:`metforge.sources.sinks.site_store`, pruned to some sites if named.

    Sites lie in buckets by their hash, so only the buckets named are listed; inside, rows are sorted by site, and
    the statistics of row groups skip the others.
    """
    df = spark.read.option("basePath", path).parquet(path)
    if gids is not None:
        buckets = [site_bucket(F.lit(str(g)), sinks.SITE_BUCKETS) for g in gids]
        df = df.where(F.col("bucket").isin(*buckets) & F.col("gid").isin([str(g) for g in gids])) if buckets else df.limit(0)
    return df.select(*[c for c in df.columns if c not in ("bucket", "batch")])


def packed_columns(spark: SparkSession, path: str, variables: Sequence[str] | None = None) -> DataFrame:
    """Values written by :func:`metforge.sources.sinks.packed_columns`, as the ``site`` layout has them: a row for each variable.

    Only the columns of ``variables`` are read, if given.
    """
    wide, kept = spark.read.parquet(f"{path}/values"), ["gid", "zone", "time", "dtime"]
    variables = [c for c in wide.columns if c not in (*kept, "bucket")] if variables is None else list(variables)
    values = projection.melt(projection.strict_select(wide, [*kept, *variables]), kept, variables, value="packed")
    return values.select("gid", "variable", "zone", "time", "dtime", "packed")


def gathered_grid(spark: SparkSession, path: str) -> DataFrame:
    """Every cell of the data sets of :func:`metforge.sources.sinks.gathered_dataset`, as the ``grid`` layout has them."""
    values, meta, times, sites = (spark.read.parquet(f"{path}/{name}") for name in ("values", "metadata", "times", "sites"))
    cells = lookup_join(lookup_join(times, meta.select("variable", "zone", "fill"), "zone"), sites, "zone")
    held = values.select("variable", "zone", "t_idx", "n_idx", "packed")
    full = cells.join(held, ["variable", "zone", "t_idx", "n_idx"], "left")
    return full.select("gid", "variable", "zone", "time", "dtime", "t_idx", "n_idx", F.coalesce("packed", "fill").alias("packed"))
