"""Shape of the physical plans; nested loops and Python evaluation are ruled out in oracle.py."""

import re

import pytest

from metforge.workload import QUERIES

def plan(spark, sf, name):
    return QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()


def test_only_needed_columns_are_read(spark, sf):
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan(spark, sf, "zonal_mean"))
    assert any(set(c.split(":")[0] for c in s.split(",")) == {"o_custkey", "o_orderdate", "o_totalprice"} for s in schemas)


@pytest.mark.parametrize("name,column", [("year_range", "o_orderdate"), ("half_open_window", "ts"), ("drop_leap_days", None), ("raster_scan", "time")])
def test_time_filters_reach_the_scan(spark, sf, name, column):
    text = plan(spark, sf, name)
    if column:
        assert re.search(rf"PushedFilters: \[[^\]]*GreaterThanOrEqual\({column},", text)


def test_year_partitions_are_pruned(spark, sf):
    assert re.search(r"PartitionFilters: \[[^\]]*year#\d+ >= 1996", plan(spark, sf, "raster_scan"))


def test_aspect_needs_one_shuffle(spark, sf):
    assert plan(spark, sf, "dem_aspect").count("Exchange hashpartitioning") == 1
