"""Newly delivered files to the site store, batch by batch."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from metforge import dims
from metforge.operators import projection
from metforge.plans.forcing import ForcingOptions, model_ready
from metforge.sources.readers import hourly_schema
from metforge.sources.sinks import bucketed


def hourly_stream(
    spark: SparkSession, path: str, id_col: str = "gid", bands: Sequence[str] = tuple(dims.REQUIRED_BANDS), files_per_batch: int = 1000
) -> DataFrame:
    """CSV files of a folder as they arrive."""
    raw = (
        spark.readStream.schema(hourly_schema(id_col, bands))
        .option("header", True)
        .option("enforceSchema", False)
        .option("pathGlobFilter", "*.csv")
        .option("recursiveFileLookup", True)
        .option("maxFilesPerTrigger", files_per_batch)
        .csv(path)
    )
    return projection.with_gid(raw, id_col)


def write_batch(
    batch: DataFrame, number: int, locations: DataFrame, path: str, first_year: int, last_year: int, options: ForcingOptions = ForcingOptions()
) -> None:
    """Convert one batch and write it as ``batch=<number>`` below ``path``, in place of whatever an earlier try left there.

    A batch is a table like any other, so a site with most of its rows is spread: rows meet their locations through the
    salted join, and adaptive execution splits the bucket that it is written to.
    """
    ready = model_ready(batch, locations, first_year, last_year, options)
    bucketed(ready, ["gid", "time"]).write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/batch={number}")


def ingest(
    stream: DataFrame, locations: DataFrame, path: str, checkpoint: str, first_year: int, last_year: int,
    options: ForcingOptions = ForcingOptions(),
) -> StreamingQuery:
    """Convert what has arrived and add it to the site store at ``path``.

    Year bounds and packing need the whole data set: the bounds are given, packing runs
    on the store afterwards.  The checkpoint numbers the batches, and a batch that runs again after a failure
    replaces its own output, so each file counts exactly once.
    """
    write = lambda batch, number: write_batch(batch, number, locations, path, first_year, last_year, options)
    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
