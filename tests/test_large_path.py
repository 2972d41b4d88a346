"""The same queries with every lookup side treated as too large to broadcast."""

import pytest

from metforge.operators import skew
from metforge.workload import ORACLES, QUERIES
from oracle import compare, connect

NAMES = [
    "forcing_ready", "pack_values", "dense_index", "axis_check", "resample_mean_uneven", "range_validation",
    "complete_models", "point_samples", "polygon_mask", "grid_intersects", "zonal_mean", "topounits_elev_aspect",
    "packed_grid_shape",
]


@pytest.mark.parametrize("name", NAMES)
def test_without_broadcast(spark, sf, monkeypatch, name):
    monkeypatch.setattr(skew, "fits_broadcast", lambda df, limit=0: False)
    monkeypatch.setattr(skew, "HEAVY_SHARE", 20)
    monkeypatch.setattr(skew.salted_join, "__defaults__", ("inner", 20))
    problems = [p for p in compare(spark, connect(sf), name, QUERIES[name], ORACLES[name], sf) if not p.endswith("no rows")]
    assert not problems
