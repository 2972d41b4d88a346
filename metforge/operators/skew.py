"""Joins of a large table with a lookup side, safe at any size and under skew."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from metforge.session import materialize

BROADCAST_BYTES = 32 * 1024 * 1024
# estimates ignore compression and the fan-out of explode (at most about 100 keys here)
ESTIMATE_MARGIN = 256
HEAVY_SHARE = 1000  # a key is heavy when it holds more than 1/1000 of the rows


def _width(field: T.StructField) -> Column:
    c = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(c), F.lit(0)) + 16
    if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
        return F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0)) + 16
    return F.lit(8)


def measured_bytes(df: DataFrame) -> int:
    """Size of the rows themselves, measured by one aggregate."""
    width = F.lit(16)
    for field in df.schema.fields:
        width = width + _width(field)
    return df.agg(F.sum(width.cast("bigint"))).first()[0] or 0


def fits_broadcast(df: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    """Whether the rows fit; the planner's estimate decides only where it is far below the limit."""
    estimate = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return estimate * ESTIMATE_MARGIN <= limit or measured_bytes(df) <= limit


def dealt(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rows dealt by ``by``, no value of which may hold many rows, into all ``spark.sql.shuffle.partitions`` and left there.

    Adaptive execution merges the parts of a shuffle by their compressed bytes; where a task holds each row in several
    hash tables, these grow far beyond that.  A number given to the shuffle keeps its parts as they are.  What is grouped by columns
    that contain ``by`` is not shuffled again.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *by)


def salted_join(fact: DataFrame, dim: DataFrame, on: Sequence[str], how: str = "inner", share: int = HEAVY_SHARE) -> DataFrame:
    """Shuffle join that splits heavy keys of ``fact``.

    At most ``share - 1`` keys can each hold more than ``1/share`` of the rows, so the
    table of heavy keys is bounded whatever the data, and may be broadcast.  The rows
    of a heavy key are spread by a hash of the whole row (repeatable when a task is
    run again), the matching ``dim`` rows are repeated once per salt.
    """
    on = list(on)
    seen = Observation()
    counts = fact.groupBy(*on).agg(F.count(F.lit(1)).alias("_n")).observe(seen, F.sum("_n").alias("total"))
    top = materialize(counts.orderBy(F.desc("_n")).limit(share - 1))  # only these can be heavy, so only these are kept
    total = seen.get["total"] or 0
    heavy = F.broadcast(
        top.where((F.col("_n") * share > total) & (F.col("_n") > share)).select(
            *on, F.ceil(F.col("_n") * share / F.lit(float(max(total, 1)))).cast("int").alias("_salts")
        )
    )
    row_hash = F.xxhash64(*[F.col(f"`{c}`") for c in fact.columns])
    spread = F.when(F.col("_salts").isNull(), 0).otherwise(F.pmod(row_hash, F.col("_salts").cast("bigint")).cast("int"))
    # a null key matches nothing, so its rows may go anywhere
    unmatched = reduce(lambda x, y: x | y, [F.col(f"`{c}`").isNull() for c in on])
    spread = F.when(unmatched, F.pmod(row_hash, F.lit(share)).cast("int")).otherwise(spread)
    left = fact.join(heavy, on, "left").withColumn("_salt", spread).drop("_salts")
    right = (
        dim.join(heavy, on, "left")
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_salts"), F.lit(1)) - 1)))
        .drop("_salts")
    )
    return left.join(right, [*on, "_salt"], how).drop("_salt")


def lookup_join(
    fact: DataFrame, dim: DataFrame, on: str | Sequence[str], how: str = "inner", limit: int = BROADCAST_BYTES, unique: bool = False
) -> DataFrame:
    """``fact`` joined with ``dim``: broadcast when the measured size allows, salted shuffle join beyond.

    ``how`` is inner, left, left_semi or left_anti (``fact`` is the preserved side).  ``unique`` says that no key of
    ``fact`` has many rows, so that they need not be counted for salts.
    """
    on = [on] if isinstance(on, str) else list(on)
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"lookup_join cannot preserve the lookup side: {how}")
    if fits_broadcast(dim, limit):
        return fact.join(F.broadcast(dim), on, how)
    if unique or fact.isStreaming:  # row counts of a stream are unknown; adaptive execution splits what it can
        return fact.join(dim, on, how)
    return salted_join(fact, dim, on, how)
