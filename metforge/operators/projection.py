"""Column selection, renaming and reshaping."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metforge import dims
from metforge.functions import temporal


def resolve_bands(requested: str | Sequence[str], available: Iterable[str] | None = None) -> list[str]:
    """``"all"``, ``"elm"`` or a list; every unknown name is reported at once."""
    available = list(available) if available is not None else list(dims.BANDS)
    if requested == "all":
        return available
    wanted = list(dims.REQUIRED_BANDS) if requested == "elm" else [requested] if isinstance(requested, str) else list(requested)
    unknown = [b for b in wanted if b not in set(available)]
    if unknown:
        raise ValueError(f"unknown bands: {', '.join(unknown)}")
    return wanted


def unknown_names(requested: DataFrame, catalogue: DataFrame, requested_col: str, catalogue_col: str) -> DataFrame:
    """Requested names missing from a catalogue, both as tables."""
    known = catalogue.select(F.col(catalogue_col).alias(requested_col)).distinct()
    return requested.select(requested_col).distinct().join(known, requested_col, "left_anti")


def band_table(df: DataFrame, id_col: str, time_col: str, bands: str | Sequence[str]) -> DataFrame:
    """Id, time stamp as ``yyyy-MM-dd HH:mm`` and the selected bands."""
    names = resolve_bands(bands, None if isinstance(bands, str) else df.columns)
    return strict_select(
        df.withColumn("date", temporal.stamp(F.col(time_col), "minute")), [id_col, "date", *names]
    )


def infer_id_column(columns: Sequence[str]) -> str:
    """Shortest name with ``id`` in it; the first one on ties."""
    named = [c for c in columns if "id" in c]
    if not named:
        raise ValueError(f"no id column among {', '.join(columns)}; name it explicitly")
    return min(named, key=len)


def with_gid(df: DataFrame, id_col: str | None = None) -> DataFrame:
    """The id column under the name ``gid``, as text."""
    id_col = id_col or infer_id_column(df.columns)
    return df.withColumnRenamed(id_col, "gid").withColumn("gid", F.col("gid").cast("string"))


def strict_select(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df.select(*columns)


def profile_variables(profile: str) -> list[str]:
    if profile not in dims.PROFILES:
        raise ValueError(f"unknown output profile {profile!r}; choose one of {', '.join(dims.PROFILES)}")
    return list(dims.PROFILES[profile])


def to_model_names(df: DataFrame, profile: str = "BYPASS") -> DataFrame:
    """Source names to model names, restricted to the variables of the profile."""
    wanted = set(profile_variables(profile))
    names = {source: name for source, name in dims.SHORT_NAMES.items() if name in wanted}
    names |= {"date": "time", "lon": "LONGXY", "lat": "LATIXY"}
    return df.withColumnsRenamed({old: new for old, new in names.items() if old in df.columns})


def melt(df: DataFrame, ids: Sequence[str], variables: Sequence[str], name: str = "variable", value: str = "value") -> DataFrame:
    """Wide to long, all variables in one pass."""
    return df.unpivot(list(ids), list(variables), name, value)


def spread(df: DataFrame, keys: Sequence[str], variables: Sequence[str], name: str = "variable", value: str = "value") -> DataFrame:
    """Long to wide; of several values under one key and variable the smallest is taken."""
    picked = [F.min(F.when(F.col(name) == v, F.col(value))).alias(v) for v in variables]
    return df.where(F.col(name).isin(list(variables))).groupBy(*keys).agg(*picked)


def concat_tables(tables: Sequence[DataFrame]) -> DataFrame:
    """Rows of several tables; columns a table lacks are null."""
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t, allowMissingColumns=True)
    return out
