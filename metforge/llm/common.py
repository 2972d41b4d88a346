"""Helpers shared by the operators: Arrow passes over texts, word hashes, reading tables."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from metforge.session import scratch_path

WHITE = b" \t\n\x0b\x0c\r"
LOWER = bytes(range(256)).lower()  # A-Z only: bytes.lower() leaves other bytes alone

ARROW = {
    "bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(), "boolean": pa.bool_(), "string": pa.string(),
    "binary": pa.binary(), "array<double>": pa.list_(pa.float64()), "array<bigint>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32()),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores until no column of ``df`` has it (in any case of letters)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def add_columns(
    df: DataFrame, column: str, fn: Callable[..., Sequence], fields: dict[str, str], more: Sequence[str] = (), drop: Sequence[str] = ()
) -> DataFrame:
    """``df`` without ``drop``, with the ``fields`` that ``fn`` makes of each batch of ``column``.

    ``fn`` gets the texts as a list of bytes (None for null), then the values of the columns
    ``more``, and returns one sequence per field.  Batches follow Spark's Arrow limits on rows
    and bytes, so memory does not depend on the length of the table.
    """
    keep = [f for f in df.schema.fields if f.name not in drop]
    schema = T.StructType([*keep, *T._parse_datatype_string(", ".join(f"`{k}` {v}" for k, v in fields.items())).fields])
    names, kinds = df.columns, [ARROW[v] for v in fields.values()]
    at, others = names.index(column), [names.index(c) for c in more]
    kept = [names.index(f.name) for f in keep]
    out_names = [f.name for f in schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = batch.column(at).cast(pa.binary()).to_pylist()
            made = fn(texts, *[batch.column(i).to_pylist() for i in others])
            arrays = [m if isinstance(m, pa.Array) else pa.array(m, type=k) for m, k in zip(made, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in kept], *arrays], names=out_names)

    small_batches(df.sparkSession)
    return df.mapInArrow(run, schema)


BATCH_BYTES = 8 << 20


def small_batches(spark: SparkSession) -> None:
    """Keep Arrow batches under ``BATCH_BYTES``: texts are large, and each task holds several batches at a time."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    number, unit = re.fullmatch(r"(\d+)([kmgtp]?)b?", spark.conf.get(key).lower()).groups()
    if int(number) << 10 * " kmgtp".index(unit or " ") > BATCH_BYTES:
        spark.conf.set(key, f"{BATCH_BYTES}b")


SLICE = 512  # rows that are Python objects at one time


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in small pieces, so that what is made of the rows in between stays small."""
    for batch in batches:
        for first in range(0, batch.num_rows, SLICE):
            yield batch.slice(first, SLICE)


def hashed(words: Sequence[bytes]) -> np.ndarray:
    """64-bit hashes of words."""
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


GAMMA = np.uint64(0x9E3779B97F4A7C15)  # the multiplier of the usual 64-bit mixing functions


def mixed(h: np.ndarray) -> np.ndarray:
    """Bijective mixing of 64-bit values, so that every bit depends on all others."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def windows(h: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` consecutive hashes; empty if there are fewer."""
    n = len(h) - size + 1
    if n <= 0:
        return h[:0]
    acc = h[:n].copy()
    for j in range(1, size):
        acc *= GAMMA
        acc += h[j : j + n]
    return mixed(acc)


def lists(values: np.ndarray, lengths: np.ndarray, kind: pa.DataType) -> pa.Array:
    """An Arrow list column from concatenated values and the length of each list."""
    offsets = np.zeros(len(lengths) + 1, np.int32)
    np.cumsum(lengths, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))


def packed(df: DataFrame, label: str) -> DataFrame:
    """A large intermediate as a strongly compressed table in the shared folder."""
    path = scratch_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
