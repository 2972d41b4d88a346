import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from metforge.operators import ordering, skew


def skewed(spark, n=4000):
    rnd = random.Random(7)
    rows = [("hot" if i % 3 == 0 else f"k{rnd.randrange(50)}", float(rnd.randrange(40)) if i % 2 else rnd.random() * 40, i) for i in range(n)]
    return spark.createDataFrame(rows, "k string, v double, i int")


def test_row_numbers_are_a_total_order(spark):
    df = skewed(spark)
    got = ordering.global_row_number(df, ["v", "i"], "r").orderBy("r").collect()
    assert [r["r"] for r in got] == list(range(1, df.count() + 1))
    keys = [(r["v"], r["i"]) for r in got]
    assert keys == sorted(keys)


def test_group_row_number(spark):
    got = ordering.group_row_number(skewed(spark), ["k"], ["v", "i"], "r").toPandas()
    want = got.sort_values(["k", "v", "i"]).groupby("k").cumcount() + 1
    assert (got.loc[want.index, "r"] == want).all()


@pytest.mark.parametrize("p", [0.0, 0.01, 0.5, 0.99, 1.0])
def test_quantiles_match_numpy(spark, p):
    df = skewed(spark)
    got = {r["k"]: r["q"] for r in ordering.quantiles(df, ["k"], "v", {"q": p}).collect()}
    for k, g in df.toPandas().groupby("k"):
        assert got[k] == pytest.approx(np.percentile(g["v"], p * 100), abs=1e-12)


@pytest.mark.parametrize("spread", ["uniform", "ties", "one value", "heavy tail"])
@pytest.mark.parametrize("at_once", [65536, 20])
def test_refined_quantiles_match_numpy(spark, monkeypatch, spread, at_once):
    monkeypatch.setattr(ordering, "AT_ONCE", at_once)
    monkeypatch.setattr(ordering, "FINE", 16)
    rng = np.random.default_rng(4)
    n = 30_000
    v = {
        "uniform": rng.random(n) + 250,
        "ties": rng.integers(-2, 3, n).astype(float),
        "one value": np.full(n, 3.0),
        "heavy tail": np.exp(rng.normal(0, 4, n)) * rng.choice([-1, 1], n),
    }[spread]
    groups = np.where(rng.random(n) < 0.6, "hot", np.where(rng.random(n) < 0.999, "mid", "rare"))
    import pandas as pd

    pdf = pd.DataFrame({"k": groups, "v": v})
    probs = {"a": 0.0, "b": 0.01, "c": 0.5, "d": 0.99, "e": 1.0}
    got = {r["k"]: r for r in ordering.quantiles(spark.createDataFrame(pdf), ["k"], "v", probs, mean="m").collect()}
    for k, g in pdf.groupby("k"):
        assert got[k]["n"] == len(g) and got[k]["m"] == pytest.approx(g["v"].mean(), rel=1e-9)
        for name, p in probs.items():
            assert got[k][name] == pytest.approx(np.percentile(g["v"], p * 100), rel=1e-12, abs=1e-12)


def test_value_bins_never_fall(spark):
    rng = np.random.default_rng(2)
    v = np.concatenate([np.exp(rng.normal(0, 200, 5000)) * rng.choice([-1, 1], 5000), [0.0, -0.0, 5e-324, -5e-324, np.inf, -np.inf, 1.7e308]])
    df = spark.createDataFrame([(float(x),) for x in v] + [(float("nan"),)], "v double").select("v", ordering.value_bin(F.col("v")).alias("b"))
    bins = [r["b"] for r in df.orderBy("v").collect()]
    assert bins == sorted(bins) and bins[-1] > bins[-2]


def test_order_statistics_without_rows(spark):
    df = spark.createDataFrame([], "k string, v double")
    assert ordering.quantiles(df, ["k"], "v", {"q": 0.5}).collect() == []


def test_quantiles_without_group_ignore_nulls(spark):
    df = spark.createDataFrame([(1.0,), (None,), (2.0,), (4.0,)], "v double")
    assert tuple(ordering.quantiles(df, [], "v", {"q": 0.5}).first()) == (3, 2.0)


def test_order_statistics_with_one_value(spark):
    df = spark.createDataFrame([("a", 5.0)] * 1000, "k string, v double")
    out = ordering.order_statistics(df, ["k"], "v", lambda n: {"first": n * 0, "last": n - 1}).first()
    assert (out["n"], out["first"], out["last"]) == (1000, 5.0, 5.0)


def test_nearest_matches_brute_force(spark):
    rnd = random.Random(3)
    axis = sorted({round(rnd.uniform(-50, 50), 1) for _ in range(60)})
    pts = [(i, rnd.choice([round(rnd.uniform(-70, 70), 2), rnd.choice(axis), (axis[3] + axis[4]) / 2])) for i in range(500)]
    points = spark.createDataFrame(pts, "i int, c double")
    marks = spark.createDataFrame([(a,) for a in axis], "a double")
    got = {r["i"]: r["near"] for r in ordering.nearest_values(points, {"c": marks}, {"c": "near"}).collect()}
    for i, c in pts:
        best = min(abs(a - c) for a in axis)
        assert got[i] == max(a for a in axis if abs(a - c) == best)


def test_nearest_ties_go_up(spark):
    points = spark.createDataFrame([(0.5,), (1.5,), (-9.0,), (9.0,)], "c double")
    marks = spark.createDataFrame([(0.0,), (1.0,), (2.0,)], "a double")
    got = {r["c"]: r["n"] for r in ordering.nearest_values(points, {"c": marks}, {"c": "n"}).collect()}
    assert got == {0.5: 1.0, 1.5: 2.0, -9.0: 0.0, 9.0: 2.0}


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_plain_join(spark, how):
    fact = skewed(spark)
    dim = spark.createDataFrame([("hot", 1), ("hot", 2)] + [(f"k{i}", i) for i in range(25)], "k string, d int")
    salted = skew.salted_join(fact, dim, ["k"], how, share=10)
    plain = fact.join(dim, "k", how)
    assert salted.columns == plain.columns
    assert sorted(map(tuple, salted.collect()), key=repr) == sorted(map(tuple, plain.collect()), key=repr)


def test_salted_join_spreads_the_heavy_key(spark):
    fact, dim = skewed(spark), spark.createDataFrame([("hot", 1)], "k string, d int")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        out = skew.salted_join(fact, dim, ["k"], share=50).groupBy(F.spark_partition_id().alias("p")).count().collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    hot = fact.where("k = 'hot'").count()
    assert sum(r["count"] for r in out) == hot
    assert max(r["count"] for r in out) < hot / 2


def test_lookup_join_picks_by_size(spark):
    fact, dim = skewed(spark), spark.createDataFrame([("hot", 1)], "k string, d int")
    assert "BroadcastHashJoin" in skew.lookup_join(fact, dim, "k")._jdf.queryExecution().toString()
    wide = skew.lookup_join(fact, dim, "k", limit=0)
    assert "_salt" in wide._jdf.queryExecution().toString()
    assert wide.count() == fact.where("k = 'hot'").count()
    with pytest.raises(ValueError):
        skew.lookup_join(fact, dim, "k", "right")


def test_nearest_has_no_frame_that_is_computed_anew_for_each_row(spark, monkeypatch):
    plans = []
    monkeypatch.setattr(ordering, "materialize", lambda df: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or df)
    points = spark.createDataFrame([(0.4,), (7.6,), (-3.0,)], ["c"])
    near = ordering.nearest_values(points, {"c": spark.createDataFrame([(0.0,), (1.0,), (8.0,)], ["m"])}, {"c": "n"})
    assert {r["c"]: r["n"] for r in near.collect()} == {0.4: 0.0, 7.6: 8.0, -3.0: 0.0}
    assert "windowspecdefinition" in plans[0].lower() and "unboundedfollowing" not in plans[0].lower()
