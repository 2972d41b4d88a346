"""Registered queries over the driver tables and their SQL equivalents."""

from metforge.workload import climate_queries, forcing_queries, io_queries, spatial_queries, time_queries  # noqa: F401
from metforge.workload.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
