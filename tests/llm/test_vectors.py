"""Hard negatives, clustering and the MinHash join beside plain versions, with nulls, ties, repeated rows and empty tables."""

from __future__ import annotations

import hashlib
import math
import os
import random
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from test_llm_operators import SCHEMA, edited, fixture_rows, text_of  # noqa: E402

from metforge.llm import clustering, hard_negatives, minhash_join, queries  # noqa: E402
from metforge.operators import skew  # noqa: E402
from oracle import compare, connect  # noqa: E402

VECTORS = "vec_id bigint, embedding array<float>, label int, score string, rank string, cluster string"
OWN = ("own", "own", "own")  # columns named like results


def vector_rows(size: int = 64) -> list[tuple]:
    r = random.Random(5)
    rows = [(i, [float(np.float32(r.gauss(0.1 * (i % 3), 0.2))) for _ in range(size)], i % 3) for i in range(260)]
    rows += [(i, rows[i % 7][1], i % 3) for i in range(260, 290)]  # ties
    rows += [(300, None, 1), (301, [0.5] * size, None), (302, [None] + [0.5] * (size - 1), 1), (303, [math.nan] * size, 1), (304, [math.inf] * size, 1)]
    rows += [(None, [0.25] * size, 1), (305, [], 1), (306, [0.5, -0.5], 2), (400, rows[0][1], 1), rows[3], rows[3], (200, rows[5][1], 2)]
    return [(*x, *OWN) for x in rows]


@pytest.fixture(scope="module")
def vectors(spark):
    return spark.createDataFrame(vector_rows(), VECTORS).repartition(5).cache()


def usable(x):
    return x is not None and all(v is not None and math.isfinite(v) for v in x)


def negatives_naive(rows, every=100):
    v = {(i, tuple(math.floor(256 * c) for c in x), lab) for i, x, lab, *_ in rows if i is not None and lab is not None and usable(x)}
    product = lambda a, b: sum(p * q for p, q in zip(a, b))
    out = []
    for anchor in sorted({i for i, _, _ in v if i % every == 0}):
        lab, x = min((lab, x) for i, x, lab in v if i == anchor)
        score = {}
        for i, y, other in v:
            if i != anchor:
                score.setdefault((other == lab, i), []).append(product(x, y))
        best = lambda s: sorted(s, key=lambda p: (-p[0], p[1]))
        for top, pos in best([(max(s), i) for (same, i), s in score.items() if same])[:5]:
            band = [(max(t), i) for (same, i), s in score.items() if not same and (t := [q for q in s if 30 * top <= 100 * q <= 90 * top])]
            out += [(anchor, pos, k, i, top, q) for k, (q, i) in enumerate(best(band)[:10], 1)]
    return out


@pytest.mark.parametrize("at_once", [16384, 1])
def test_hard_negatives(vectors, at_once):
    found = hard_negatives.mine(vectors, F.col("vec_id") % 100 == 0, anchors_at_once=at_once)
    want = negatives_naive(vector_rows())
    assert sorted(map(tuple, found.collect())) == sorted(want) and len({w[0] for w in want}) >= 3


def test_hard_negatives_without_rows(vectors):
    assert hard_negatives.mine(vectors.limit(0), F.lit(True)).collect() == []
    assert hard_negatives.mine(vectors, F.lit(None).cast("boolean")).collect() == []


def test_bounds_hold_and_sort_out(spark):
    r = np.random.default_rng(3)
    x = r.integers(-120, 120, (300, 64))
    x[150:] = 100 + x[150:] // 20  # a second kind with a large mean and a small deviation
    a = hard_negatives.block(np.arange(300), np.zeros(300), x)
    exact = x @ x.T
    for s, d, w in a.levels:
        centre, spread = s @ s.T / w, d @ d.T
        assert (centre - spread - 1e-6 <= exact).all() and (exact <= centre + spread + 1e-6).all()
    low = np.full(300, 400_000.0)
    i, j, score = hard_negatives.possible(a, a, low, np.full(300, np.inf))
    assert set(zip(i.tolist(), j.tolist())) == set(zip(*(c.tolist() for c in np.nonzero(exact >= 400_000))))
    s, d, w = a.levels[0]
    assert not (s[:150] @ s.T / w + d[:150] @ d.T >= 400_000).any()  # whole vectors drop out before any exact score


def lloyd_naive(rows, k, rounds, size=64):
    v = [(i, [math.floor(256 * c) for c in x]) for i, x, *_ in rows if usable(x) and len(x) == size]
    key = lambda p: ("z" if p[0] is None else hashlib.sha256(f"2:{p[0]}".encode()).hexdigest(), p[1])
    centroids = [x for _, x in sorted(v, key=key)[:k]]
    nearest = lambda x: min((sum((a - b) ** 2 for a, b in zip(x, c)), j) for j, c in enumerate(centroids))
    for _ in range(rounds):
        by = [nearest(x)[1] for _, x in v]
        for j in set(by):
            own = [x for (_, x), c in zip(v, by) if c == j]
            centroids[j] = [sum(c) // len(own) for c in zip(*own)]
    return [(i, nearest(x)[1], nearest(x)[0]) for i, x in v], centroids


def first(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1:]))


@pytest.mark.parametrize("k", [7, 500])
def test_lloyd(vectors, k):
    rows, centroids = clustering.lloyd(vectors, k=k, rounds=2)
    want, cells = lloyd_naive(vector_rows(), k, 2)
    assert first(map(tuple, rows.collect())) == first(want)
    assert {r.cluster: list(r.centroid) for r in centroids.collect()} == dict(enumerate(cells))


def test_lloyd_without_rows_and_other_sizes(vectors):
    rows, centroids = clustering.lloyd(vectors.limit(0))
    assert rows.collect() == [] and centroids.collect() == []
    rows, _ = clustering.lloyd(vectors, k=3, size=2)  # one vector of two components, less than a block of columns
    assert [tuple(r) for r in rows.collect()] == [(306, 0, 0)]


def test_partial_distances_beyond_doubles():
    x, c = np.array([[1 << 28, -5]]), np.array([[3, 1 << 28]])
    assert clustering.partial_distances(x, c, 2)[0, 0] == ((1 << 28) - 3) ** 2 + ((1 << 28) + 5) ** 2
    with pytest.raises(ValueError):
        clustering.partial_distances(x << 4, c, 2)


# --- MinHash join ------------------------------------------------------------------------------


def near_rows() -> list[tuple]:
    """The common fixture, and a family whose members link with few of the others."""
    rows = fixture_rows()
    base = text_of(220, 77)
    rows += [(200 + i, edited(base, i, 0.03), "en", "s1", 0) for i in range(40)]
    rows += [(300 + i, edited(base, 1000 + i, 0.1), "en", "s1", 0) for i in range(20)]
    return rows


def components_naive(rows):
    sets = []
    for _, text, *_ in rows:
        w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").replace("\v", " ").split()
        sets.append({tuple(w[i : i + 4]) for i in range(len(w) - 3)} if len(w) >= 4 else {tuple(w)} if w else set())
    label = [r[0] for r in rows]
    for i, a in enumerate(sets):
        for j in range(i):
            common = len(a & sets[j])
            if common and label[i] != label[j] and None not in (rows[i][0], rows[j][0]) and 100 * common >= 80 * (len(a) + len(sets[j]) - common):
                low, high = sorted((label[i], label[j]))
                label = [low if x == high else x for x in label]
    return sorted((r[0], len(s), c) for r, s, c in zip(rows, sets, label))


@pytest.mark.parametrize("refused", [False, True])
def test_minhash_join(spark, monkeypatch, refused):
    if refused:  # every side treated as too large to broadcast, tiles of a few classes
        monkeypatch.setattr(skew, "fits_broadcast", lambda df, limit=0: False)
        monkeypatch.setattr(minhash_join, "TILE", 7)
        monkeypatch.setattr(minhash_join, "AT_ONCE", 3)
    rows = near_rows()
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("kept", F.lit("own")).withColumn("h", F.lit("own"))
    out = minhash_join.near_duplicates(docs.repartition(3)).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in out) == components_naive(rows)
    assert all(r.kept == (r.doc_id == r.component_id) for r in out)


def test_minhash_join_without_rows_or_ids(spark):
    assert minhash_join.near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []
    rows = [(None, text_of(50, 1), "en", "s", 0), (None, text_of(50, 1), "en", "s", 0), (1, None, None, None, None)]
    out = minhash_join.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r.component_id or 0, r.n_shingles, r.kept) for r in out) == [(0, 47, True), (0, 47, True), (1, 0, True)]


def test_signatures_under_the_distance_share_a_key():
    r = np.random.default_rng(1)
    a = r.integers(0, 1 << 16, (50, minhash_join.SYMBOLS)).astype("<u2")
    b = a.copy()
    for row in b:
        row[r.choice(minhash_join.SYMBOLS, minhash_join.DISTANCE, replace=False)] ^= 1
    for x, y in zip(minhash_join.chunk_keys(a), minhash_join.chunk_keys(b)):
        assert set(x.tolist()) & set(y.tolist())


@pytest.mark.parametrize("name", ["op11_minhash_join", "op12_hard_negatives", "op13_centroid_clustering"])
def test_beside_sql(spark, sf, name, monkeypatch):
    import oracle

    monkeypatch.setattr(oracle, "UNWANTED", ("CartesianProduct",))
    assert compare(spark, connect(sf), name, queries.QUERIES[name], queries.ORACLES[name], sf) == []
