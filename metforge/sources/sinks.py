"""Writers.  Rows are spread by the output partitioning before they are written.

The spreading uses the rebalance hint: adaptive execution merges small output
partitions and splits large ones, so that one busy site does not become one task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metforge.functions import geometry as geo


def _spread(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.hint("rebalance", *[F.col(c) for c in columns])


def zonal_csv(df: DataFrame, path: str) -> None:
    """One folder per ``batch`` with ``id, date, bands``."""
    _spread(df, ["batch"]).write.mode("overwrite").partitionBy("batch").option("header", True).csv(path)


SITE_BUCKETS = 64  # folders of a site store, whatever the number of sites


def site_bucket(gid: Column, buckets: int = SITE_BUCKETS) -> Column:
    return F.pmod(F.xxhash64(gid.cast("string")), F.lit(buckets).cast("bigint")).cast("int")


def bucketed(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """``df`` with its ``bucket``, dealt by it and sorted inside; a bucket that is too large for a task is split."""
    rows = df.withColumn("gid", F.col("gid").cast("string")).withColumn("bucket", site_bucket(F.col("gid")))
    return _spread(rows, ["bucket"]).sortWithinPartitions("bucket", *order)


def site_store(df: DataFrame, path: str, time: str = "time") -> None:
    """Parquet in ``SITE_BUCKETS`` folders, sorted by site and time."""
    bucketed(df, ["gid", time]).write.mode("overwrite").partitionBy("bucket").parquet(path)


def packed_dataset(values: DataFrame, metadata: DataFrame, path: str, layout: str = "site") -> None:
    """``<path>/values`` and ``<path>/metadata``.

    ``site`` has the buckets of a site store, with the variables of a site one after the other; ``grid`` has one
    folder per variable and zone.
    """
    if layout == "site":
        bucketed(values, ["gid", "variable", "time"]).write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/values")
    else:
        columns = ["variable", "zone"]
        _spread(values, columns).sortWithinPartitions(*columns, "time", "gid").write.mode("overwrite").partitionBy(*columns).parquet(f"{path}/values")
    metadata.write.mode("overwrite").parquet(f"{path}/metadata")


def packed_columns(values: DataFrame, metadata: DataFrame, path: str) -> None:
    """``<path>/values``, a site store with one packed column for each variable, and ``<path>/metadata``."""
    site_store(values, f"{path}/values")
    metadata.write.mode("overwrite").parquet(f"{path}/metadata")


def gathered_dataset(values: DataFrame, metadata: DataFrame, times: DataFrame, sites: DataFrame, path: str) -> None:
    """``<path>/values``, one folder per variable and zone, with ``metadata``, ``times`` and ``sites`` beside it.

    Rows are melted where they are read, so nothing is shuffled; each task writes its part of every data set.
    """
    columns = ["variable", "zone"]
    values.sortWithinPartitions(*columns, "time", "gid").write.mode("overwrite").partitionBy(*columns).parquet(f"{path}/values")
    for name, table in (("metadata", metadata), ("times", times), ("sites", sites)):
        table.write.mode("overwrite").parquet(f"{path}/{name}")


def zone_mapping(df: DataFrame, path: str, per_site: bool = False) -> None:
    """Tab-separated without header; per site one folder per ``gid``."""
    writer = df.write.mode("overwrite").option("sep", "\t").option("header", False)
    (writer.partitionBy("gid") if per_site else writer).csv(path)


def gridded(df: DataFrame, path: str, dimensions: Mapping[str, Sequence[str]]) -> None:
    """Gridded table whose columns carry the names of their dimensions, kept in the files' schema."""
    for column, names in dimensions.items():
        df = df.withMetadata(column, {"dimensions": list(names)})
    df.write.mode("overwrite").parquet(path)


def climate_long(df: DataFrame, path: str) -> bool:
    """CSV of the long table; nothing is written when there are no rows."""
    if df.isEmpty():
        return False
    df.write.mode("overwrite").option("header", True).csv(path)
    return True


DATASET = ("variable_id", "source_id", "experiment_id", "member_id")


def catalogue_outputs(df: DataFrame, path: str, columns: Sequence[str] = DATASET) -> None:
    """One Parquet folder per data set of the catalogue, or per coarser ``columns``."""
    _spread(df, columns).write.mode("overwrite").partitionBy(*columns).parquet(path)


def grid(df: DataFrame, path: str) -> None:
    """Cell polygons and centre points, as two tables."""
    df.select("pid", geo.wkt(F.lit("Polygon"), F.array("ring")).alias("geometry")).write.mode("overwrite").parquet(f"{path}/polygons")
    df.select("pid", "lat", "lon").write.mode("overwrite").parquet(f"{path}/centres")


def feature_text(df: DataFrame, properties: Sequence[str], kind: str = "geom_type", rings: str = "rings") -> DataFrame:
    """One GeoJSON feature per row, in column ``value``."""
    pair = lambda p: F.array(p["x"], p["y"])
    coords = lambda r: F.transform(r, lambda ring: F.transform(ring, pair))
    all_rings = coords(F.col(rings))
    # a counter-clockwise ring opens the next part
    starts = F.filter(F.sequence(F.lit(0), F.size(rings) - 1), lambda i: geo.signed_area(F.col(rings)[i]) > 0)
    parts = F.transform(
        starts,
        lambda s, k: F.slice(
            all_rings,
            s + 1,
            F.coalesce(F.try_element_at(starts, k + 2), F.size(rings)) - s,
        ),
    )
    geometry = (
        F.when(F.col(kind) == "Point", F.to_json(F.struct(F.lit("Point").alias("type"), all_rings[0][0].alias("coordinates"))))
        .when(F.col(kind) == "Polygon", F.to_json(F.struct(F.lit("Polygon").alias("type"), all_rings.alias("coordinates"))))
        .otherwise(F.to_json(F.struct(F.lit("MultiPolygon").alias("type"), parts.alias("coordinates"))))
    )
    props = F.to_json(F.struct(*properties))
    return df.select(F.concat(F.lit('{"type":"Feature","geometry":'), geometry, F.lit(',"properties":'), props, F.lit("}")).alias("value"))


def features(df: DataFrame, path: str, properties: Sequence[str], file_format: str = "GeoJSON") -> None:
    """Feature table as line-wise GeoJSON, or its properties as CSV."""
    if file_format == "GeoJSON":
        feature_text(df, properties).write.mode("overwrite").text(path)
    elif file_format == "CSV":
        df.select(*properties).write.mode("overwrite").option("header", True).csv(path)
    else:
        raise ValueError(f"unsupported file format {file_format!r}; choose CSV or GeoJSON")


def feature_collection(df: DataFrame, path: str, properties: Sequence[str]) -> None:
    """All features as one document in one file, which one task writes row by row."""
    line = lambda part, value: df.sparkSession.range(1).select(F.lit(part).alias("part"), F.lit(0).cast("bigint").alias("no"), F.lit(value).alias("value"))
    body = feature_text(df, properties).coalesce(1).select(F.lit(1).alias("part"), F.monotonically_increasing_id().alias("no"), "value")
    body = body.withColumn("value", F.concat(F.when(F.col("no") > 0, ",").otherwise(""), "value"))
    rows = line(0, '{"type":"FeatureCollection","features":[').unionByName(body).unionByName(line(2, "]}"))
    rows.coalesce(1).sortWithinPartitions("part", "no").select("value").write.mode("overwrite").text(path)


def stats(df: DataFrame, path: str) -> None:
    """Statistics with a row per variable, as :func:`metforge.sources.readers.reference_stats` reads them."""
    df.select("variable", "mean", "min", "max").write.mode("overwrite").option("header", True).csv(path)
