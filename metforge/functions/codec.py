"""Linear packing of doubles into small integers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fill value of each target, outside the inner 90 % that packing uses.
FILLS = {"int16": -32767, "int32": -(2**31) + 1, "uint16": 2**16 - 1}
FILL = FILLS["int16"]

# Integer targets: Spark type, lowest and highest value of the encoding.
TARGETS = {
    "int16": ("smallint", -(2**15), 2**15 - 1),
    "int32": ("int", -(2**31), 2**31 - 1),
    "uint16": ("int", 0, 2**16 - 1),
}


def packed_range(target: str = "int16") -> tuple[int, int]:
    """The inner 90 % of the integer range is used, truncated towards zero."""
    _, low, high = TARGETS[target]
    return int(low * 0.9), int(high * 0.9)


def scale_factor(low: Column, high: Column, target: str = "int16") -> Column:
    """Width of one integer step; a constant variable gets 1.0 instead of 0."""
    imin, imax = packed_range(target)
    step = (high - low) / F.lit(float(imax - imin))
    return F.when(step == 0.0, F.lit(1.0)).otherwise(step)


def add_offset(low: Column, high: Column, target: str = "int16") -> Column:
    imin, _ = packed_range(target)
    return F.when(high == low, low).otherwise(low - F.lit(float(imin)) * scale_factor(low, high, target))


def pack(value: Column, offset: Column, scale: Column, target: str = "int16", fill: int | None = None, beyond: str = "fill") -> Column:
    """Nearest step (half to even); missing values become the fill value.

    ``beyond`` says what becomes of steps that cannot be stored, the fill value among them: ``fill``, ``clip`` (to the
    nearest step that can) or ``fail``.
    """
    kind, low, high = TARGETS[target]
    fill = FILLS[target] if fill is None else fill
    step = F.rint((value - offset) / scale)
    inside = step.between(float(low), float(high)) & (step != float(fill))
    missing = F.lit(fill).cast(kind)
    if beyond == "fill":
        other = missing
    elif beyond == "clip":
        towards = -1 if fill > 0 else 1  # the fill value lies at one end of the range
        least, most = (fill + 1, high) if towards > 0 else (low, fill - 1)
        other = F.greatest(F.lit(float(least)), F.least(F.lit(float(most)), step)).cast(kind)
    elif beyond == "fail":
        other = F.raise_error(F.concat(F.lit("no step for "), value.cast("string"))).cast(kind)
    else:
        raise ValueError(f"beyond must be fill, clip or fail, not {beyond!r}")
    return F.when(step.isNull() | F.isnan(step), missing).when(inside, step.cast(kind)).otherwise(other)


def unpack(packed: Column, offset: Column, scale: Column, target: str = "int16", fill: int | None = None) -> Column:
    fill = FILLS[target] if fill is None else fill
    return F.when(packed != fill, packed * scale + offset)
