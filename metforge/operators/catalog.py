"""Climate-model catalogue search and long tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metforge import dims
from metforge.functions import labels, temporal
from metforge.operators.projection import melt, spread
from metforge.operators.skew import lookup_join
from metforge.session import materialize

# request name -> catalogue column
FACETS = {
    "experiment": "experiment_id",
    "table": "table_id",
    "variables": "variable_id",
    "ensemble": "member_id",
    "models": "source_id",
}


def required_variables(variables: str | Sequence[str]) -> list[str]:
    """``"elm"`` stands for the variables the land model needs; a single name is a list of one."""
    if variables == "elm":
        return list(dims.REQUIRED_CLIMATE_VARIABLES)
    return [variables] if isinstance(variables, str) else list(variables)


def facet_search(catalogue: DataFrame, request: Mapping[str, str | Sequence[str]]) -> DataFrame:
    """Rows that match every facet given, each by one value or any of a list."""
    out = catalogue
    for name, column in FACETS.items():
        if name in request:
            wanted = request[name]
            if name == "variables":
                wanted = required_variables(wanted)
            out = out.where(F.col(column).isin([wanted] if isinstance(wanted, str) else list(wanted)))
    return out


def _qualifying(catalogue: DataFrame, variables: Sequence[str], model: str, variable: str) -> DataFrame:
    present = F.count_distinct(F.when(F.col(variable).isin(list(variables)), F.col(variable)))
    return catalogue.groupBy(model).agg(present.alias("_n")).where(F.col("_n") == len(set(variables))).select(model)


def complete_models(
    catalogue: DataFrame, variables: str | Sequence[str], model: str = "source_id", variable: str = "variable_id"
) -> DataFrame:
    """All rows of the models that offer every required variable."""
    models = materialize(_qualifying(catalogue, required_variables(variables), model, variable))
    return lookup_join(catalogue, models, model, "left_semi")


def first_models(
    catalogue: DataFrame, variables: str | Sequence[str], limit: int = 5, model: str = "source_id", variable: str = "variable_id"
) -> DataFrame:
    """All rows of the first ``limit`` qualifying models in name order."""
    models = _qualifying(catalogue, required_variables(variables), model, variable).orderBy(model).limit(limit)
    return lookup_join(catalogue, models, model, "left_semi")


def find_available(catalogue: DataFrame, request: Mapping[str, str | Sequence[str]]) -> DataFrame:
    """Facet search, then only models with all of the requested variables."""
    if "variables" not in request:
        raise ValueError("name the required variables")
    return complete_models(facet_search(catalogue, request), request["variables"])


def output_name(prefix_columns: Sequence[str] = ("variable_id", "source_id", "experiment_id", "member_id")) -> Column:
    """``pr_MODEL_ssp585_r1i1p1f1``."""
    return F.concat_ws("_", *[F.col(c) for c in prefix_columns])


def in_window(df: DataFrame, first: str, last: str) -> DataFrame:
    """Rows of a calendar table between two dates, each in its own calendar."""
    cond = temporal.in_calendar_window(
        F.col("year"), F.col("month"), F.col("day"), F.col("second"), F.col("calendar"), first, last
    )
    return df.where(cond)


GRID = ("time", "lat", "lon")


def gridded_variables(df: DataFrame) -> list[str]:
    """Columns that have a time, lat or lon dimension by their metadata (see :func:`metforge.sources.sinks.gridded`)."""
    return [f.name for f in df.schema.fields if set(GRID) & set(f.metadata.get("dimensions", ())) and f.name not in GRID]


def long_table(df: DataFrame, variables: Sequence[str] | None = None, path: str = "path") -> DataFrame:
    """Gridded variables to ``(date, lon, lat, value, var, model, ssp)``; without a list, all that the files name.

    Model and scenario come from the file name; dates are ISO text because they may lie
    on a calendar without a Spark type.
    """
    variables = gridded_variables(df) if variables is None else list(variables)
    if not variables:
        raise ValueError("no gridded variables: name them, or write the table with their dimensions")
    iso = temporal.civil_iso(F.col("year"), F.col("month"), F.col("day"), F.col("second"))
    wide = df.select(
        iso.alias("date"),
        "lon",
        "lat",
        labels.stem_part(F.col(path), 1).alias("model"),
        labels.stem_part(F.col(path), 2).alias("ssp"),
        *variables,
    )
    long = melt(wide, ["date", "lon", "lat", "model", "ssp"], variables, "var", "value")
    return long.select("date", "lon", "lat", "value", "var", "model", "ssp")


def merge_variables(df: DataFrame, keys: Sequence[str], variables: Sequence[str]) -> DataFrame:
    """Several variables of a model as columns of one row."""
    return spread(df, keys, variables)
