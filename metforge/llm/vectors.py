"""Vector columns as exact integers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SCALE = 256


def usable(vector: str, size: int | None = None) -> Column:
    """Whether a vector is there, has ``size`` components if given, and every component is a finite number."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    whole = F.col(vector).isNotNull() & F.forall(F.col(vector).cast("array<double>"), finite)
    return F.coalesce(whole if size is None else whole & (F.size(vector) == size), F.lit(False))


def scaled(vector: str, scale: int = SCALE) -> Column:
    """``floor(scale * x)`` of each component as BIGINT."""
    return F.transform(F.col(vector).cast("array<double>"), lambda x: F.floor(x * F.lit(float(scale))))
