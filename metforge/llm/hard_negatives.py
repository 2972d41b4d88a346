"""Hard negatives by inner product, with segment summaries that bound scores.

Of each segment of a vector its sum and its deviation (the length of what remains when the mean is taken off) are
stored.  The inner product of two segments of width ``w`` is the product of their sums over ``w``, plus or
minus at most the product of the deviations.  Added up over the segments this bounds the score of a pair from both sides.
Four neighbouring segments make one of the next coarser level, so one stored level gives them all.  A block of
vectors is held against a block of anchors level by level, from whole vectors to the finest segments; anchors and
vectors of which no pair can come into a list any more drop out, and the others are scored exactly.

Anchors are taken in passes of bounded size, against all vectors in blocks.  A task keeps the best of each list
only, whose least score is the bound for what follows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from metforge.llm.common import lists, small_batches, table
from metforge.llm.vectors import scaled, usable
from metforge.operators.ordering import global_row_number
from metforge.session import scratch_path, stored

POSITIVES, NEGATIVES = 5, 10
LEAST, MOST = 30, 90  # per cent of the positive's score
WIDTH, FAN = 4, 4  # of the finest segments, and how many make one of the next level
LEVELS = 3
WHOLE = WIDTH * FAN ** (LEVELS - 1)  # vectors are filled up with zeros to a multiple of this
ANCHOR_BYTES = 32 << 20  # anchors of a pass
ANCHORS = 16384
ROWS, SIDE = 2048, 256  # vectors and anchors of a block
NONE = np.iinfo(np.int64)


@dataclass
class Block:
    """Vectors with their summaries, coarse level first."""

    ids: np.ndarray
    labels: np.ndarray
    x: np.ndarray
    levels: list[tuple[np.ndarray, np.ndarray, int]]  # sums, deviations, width

    def part(self, at: np.ndarray | slice) -> Block:
        return Block(self.ids[at], self.labels[at], self.x[at], [(s[at], d[at], w) for s, d, w in self.levels])


def summaries(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sum and squared deviation of each of the finest segments."""
    parts = x.reshape(len(x), -1, WIDTH).astype(np.float64)
    total = parts.sum(2)
    return total, np.square(parts - total[:, :, None] / WIDTH).sum(2)


def _levels(total: np.ndarray, square: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, int]]:
    out, width = [(total, np.sqrt(square), WIDTH)], WIDTH
    while len(out) < LEVELS:
        parts = total.reshape(len(total), -1, FAN)
        merged = parts.sum(2)
        apart = np.square(parts / width - merged[:, :, None] / (FAN * width)).sum(2) * width
        square = square.reshape(len(square), -1, FAN).sum(2) + apart
        total, width = merged, width * FAN
        out.append((total, np.sqrt(square), width))
    return out[::-1]


def block(ids: np.ndarray, labels: np.ndarray, x: np.ndarray, stored_levels: tuple[np.ndarray, np.ndarray] | None = None) -> Block:
    total, square = stored_levels or summaries(x)
    return Block(ids, labels, x.astype(np.float64), _levels(total, square))


def possible(a: Block, b: Block, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs (as positions in ``a`` and ``b``) with their exact scores, from ``low`` to ``high`` of the anchor ``a``."""
    own, other = np.arange(len(a.ids)), np.arange(len(b.ids))
    for k in range(len(a.levels)):
        if not len(own) or not len(other):
            break
        (s, d, w), (t, e, _) = a.levels[k], b.levels[k]
        centre, spread = s[own] @ t[other].T / w, d[own] @ e[other].T
        spread += 0.5 + 1e-9 * (np.abs(centre) + spread)  # scores are whole numbers; more than the rounding of these sums
        ok = (centre + spread >= low[own, None]) & (centre - spread <= high[own, None])
        own, other = own[ok.any(1)], other[ok.any(0)]
    if not len(own) or not len(other):
        return own[:0], other[:0], np.zeros(0, np.int64)
    score = a.x[own] @ b.x[other].T
    i, j = np.nonzero((score >= low[own, None]) & (score <= high[own, None]))
    return own[i], other[j], score[i, j].astype(np.int64)


class Lists:
    """The best ``size`` (score, id) of each of ``n`` lists, an id once."""

    def __init__(self, n: int, size: int):
        self.size = size
        self.score = np.full((n, size), NONE.min)
        self.id = np.full((n, size), NONE.max)

    def least(self) -> np.ndarray:
        return self.score[:, -1]

    def add(self, at: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        if not len(at):
            return
        used = np.unique(at)
        where = np.concatenate([np.repeat(used, self.size), at])
        score = np.concatenate([self.score[used].ravel(), score])
        ids = np.concatenate([self.id[used].ravel(), ids])
        order = np.lexsort((-score.astype(np.float64), ids, where))  # an id's best score first
        where, score, ids = where[order], score[order], ids[order]
        new = np.concatenate([[True], (where[1:] != where[:-1]) | (ids[1:] != ids[:-1])])
        new |= ids == NONE.max  # empty places
        where, score, ids = where[new], score[new], ids[new]
        order = np.lexsort((ids, -score.astype(np.float64), where))
        where, score, ids = where[order], score[order], ids[order]
        first = np.flatnonzero(np.concatenate([[True], where[1:] != where[:-1]]))
        rank = np.arange(len(where)) - np.repeat(first, np.diff(np.append(first, len(where))))
        keep = rank < self.size
        self.score[where[keep], rank[keep]], self.id[where[keep], rank[keep]] = score[keep], ids[keep]

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        at, place = np.nonzero(self.id != NONE.max)
        return at, self.score[at, place], self.id[at, place]


def _checked(x: np.ndarray) -> np.ndarray:
    """Scores are summed in doubles, which hold whole numbers up to 2**53."""
    if x.shape[1] * int(np.abs(x).max(initial=0)) ** 2 >= 1 << 53:
        raise ValueError("components too large: scores may leave the whole numbers of a double")
    return x


def _filled(flat: np.ndarray, lengths: np.ndarray, size: int) -> np.ndarray:
    """Rows of different lengths, zeros at their ends."""
    out = np.zeros((len(lengths), size), np.int64)
    out[np.arange(size) < lengths[:, None]] = flat
    return out


STORED = "vec_id bigint, label int, x array<int>, total array<int>, square array<float>"


def _summarised(points: DataFrame, size: int) -> DataFrame:
    """``points`` (vec_id, label, x) with the finest summaries, stored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, ROWS):
                piece = batch.slice(first, ROWS)
                x = _vectors(piece.column(2), size)
                total, square = summaries(_checked(x))
                n = np.full(len(x), x.shape[1])
                up = np.nextafter(square.astype(np.float32), np.float32(np.inf))  # never below the exact one
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column(0), piece.column(1), lists(x.ravel(), n, pa.int32()),
                        lists(total.astype(np.int32).ravel(), n // WIDTH, pa.int32()), lists(up.ravel(), n // WIDTH, pa.float32()),
                    ],
                    names=["vec_id", "label", "x", "total", "square"],
                )

    small_batches(points.sparkSession)
    return stored(points.mapInArrow(run, STORED), "segment-summaries")


def _vectors(column: pa.Array, size: int) -> np.ndarray:
    lengths = np.diff(column.offsets.to_numpy())
    return _filled(column.flatten().to_numpy(zero_copy_only=False), lengths, size)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[Block]:
    for batch in batches:
        for first in range(0, batch.num_rows, ROWS):
            piece = batch.slice(first, ROWS)
            n = piece.num_rows
            columns = [piece.column(i).flatten().to_numpy(zero_copy_only=False).reshape(n, -1) for i in (2, 3, 4)]
            yield block(piece.column(0).to_numpy(), piece.column(1).to_numpy(), columns[0], (columns[1].astype(np.float64), columns[2].astype(np.float64)))


def _found(at: np.ndarray, place: np.ndarray, anchors: Block, score: np.ndarray, ids: np.ndarray) -> pa.RecordBatch:
    columns = [anchors.ids[at], place, score, ids]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["anchor_id", "place", "score", "other_id"])


FOUND = "anchor_id bigint, place bigint, score bigint, other_id bigint"


def _positives(rows: DataFrame, anchors: Block, size: int) -> DataFrame:
    sent = rows.sparkSession.sparkContext.broadcast(anchors)  # bounded by the size of a pass

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        best = Lists(len(own.ids), size)
        groups = [np.flatnonzero(own.labels == v) for v in np.unique(own.labels)]
        for others in _read(batches):
            for group in groups:
                same = np.flatnonzero(others.labels == own.labels[group[0]])
                for first in range(0, len(group), SIDE):
                    at = group[first : first + SIDE]
                    low = best.least()[at].astype(np.float64)
                    i, j, score = possible(own.part(at), others.part(same), low, np.full(len(at), np.inf))
                    i, ids = at[i], others.ids[same[j]]
                    apart = ids != own.ids[i]
                    best.add(i[apart], score[apart], ids[apart])
        at, score, ids = best.rows()
        yield _found(at, np.zeros(len(at), np.int64), own, score, ids)

    return _ranked(rows.mapInArrow(run, FOUND), ["anchor_id"], size)


def _negatives(rows: DataFrame, anchors: Block, positive: np.ndarray, size: int, least: int, most: int) -> DataFrame:
    """The best of each anchor and positive; ``positive`` has the scores of each anchor's positives, the least number for none."""
    sent = rows.sparkSession.sparkContext.broadcast((anchors, positive))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, top = sent.value
        n, m = top.shape
        there = top >= 0  # no score is at the same time at least 30 and at most 90 per cent of a negative one
        floor = np.where(there, -((-least * np.where(there, top, 0)) // 100), NONE.max).astype(np.float64)
        ceiling = np.where(there, most * np.where(there, top, 0) // 100, -1).astype(np.float64)
        best = Lists(n * m, size)
        for others in _read(batches):
            for first in range(0, n, SIDE):
                at = np.arange(first, min(n, first + SIDE))
                low = np.maximum(floor[at], best.least().reshape(n, m)[at])
                i, j, score = possible(own.part(at), others, low.min(1), ceiling[at].max(1))
                apart = (own.labels[at[i]] != others.labels[j]) & (own.ids[at[i]] != others.ids[j])
                i, j, score = i[apart], j[apart], score[apart]
                for p in range(m):
                    ok = (score >= low[i, p]) & (score <= ceiling[at[i], p])
                    best.add(at[i[ok]] * m + p, score[ok], others.ids[j[ok]])
        at, score, ids = best.rows()
        yield _found(at // m, at % m, own, score, ids)

    return _ranked(rows.mapInArrow(run, FOUND), ["anchor_id", "place"], size)


def _ranked(found: DataFrame, keys: list[str], size: int) -> DataFrame:
    """The first of what the tasks found; each task gives at most ``size`` rows of a key."""
    once = found.groupBy(*keys, "other_id").agg(F.max("score").alias("score"))
    order = W.partitionBy(*keys).orderBy(F.col("score").desc(), "other_id")
    return once.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= size)


RESULT = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"


def mine(
    df: DataFrame, anchor: Column, vec_id: str = "vec_id", label: str = "label", vector: str = "embedding",
    positives: int = POSITIVES, negatives: int = NEGATIVES, least: int = LEAST, most: int = MOST, anchors_at_once: int = ANCHORS,
) -> DataFrame:
    """For each row where ``anchor`` holds and each of its positives, the best rows of other labels within a band of scores.

    Returns ``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.  Rows without an id, label
    or vector, or with a component that is null or not finite, take no part.  A shorter vector counts as filled up with
    zeros, an empty one scores 0 with every other.  Rows that repeat an id count once for an anchor, by their best
    score; an anchor of several versions has the least label, then the least vector, and rows with its own id are neither its
    positives nor its negatives.  Ties go to the smaller id.  A positive with a negative score has no
    negatives.  Further columns, of whatever name, are not read.  Components so large that a score may leave 2**53 are an error.
    """
    spark = df.sparkSession
    points = df.where(F.col(vec_id).isNotNull() & F.col(label).isNotNull() & usable(vector)).select(
        F.col(vec_id).cast("bigint").alias("vec_id"), F.col(label).cast("int").alias("label"), scaled(vector).alias("x"), F.coalesce(anchor, F.lit(False)).alias("anchor")
    )
    longest = points.agg(F.max(F.size("x"))).first()[0]
    if longest is None:
        return spark.createDataFrame([], RESULT)
    width = max(WHOLE, -(-longest // WHOLE) * WHOLE)
    rows = _summarised(points.select("vec_id", "label", "x"), width)
    heads = points.where("anchor").groupBy("vec_id").agg(F.min(F.struct("label", "x")).alias("v")).select("vec_id", "v.*")
    numbered = stored(global_row_number(heads, ["vec_id"], "_n"), "anchors")
    size = max(1, min(anchors_at_once, ANCHOR_BYTES // (8 * width)))
    count = numbered.agg(F.max("_n")).first()[0] or 0
    path, passes = scratch_path(spark, "hard-negatives"), []
    for first in range(0, count, size):
        taken = numbered.where(F.col("_n").between(first + 1, first + size)).orderBy("_n").toArrow().combine_chunks()
        if not taken.num_rows:
            continue
        x = _vectors(taken["x"].chunk(0), width)
        own = block(taken["vec_id"].to_numpy(), taken["label"].to_numpy(), _checked(x))
        best = stored(_positives(rows, own, positives), "positives")
        place = {int(v): i for i, v in enumerate(own.ids)}
        top = np.full((len(own.ids), positives), -1, np.int64)
        for r in best.collect():  # at most positives * size rows
            top[place[r.anchor_id], r["rank"] - 1] = max(r.score, -1)
        pairs = best.select("anchor_id", (F.col("rank") - 1).cast("bigint").alias("place"), F.col("other_id").alias("positive_id"), F.col("score").alias("positive_score"))
        found = _negatives(rows, own, top, negatives, least, most)
        out = found.join(F.broadcast(pairs), ["anchor_id", "place"]).select(
            "anchor_id", "positive_id", "rank", F.col("other_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
        )
        passes.append(f"{path}/{first}")
        out.write.parquet(passes[-1])
    return spark.read.schema(RESULT).parquet(*passes) if passes else spark.createDataFrame([], RESULT)


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding")
    moved = rows.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return mine(moved, F.col("vec_id") % 100 == 0)


SQL = f"""
WITH v AS MATERIALIZED (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
  list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
  AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
s AS MATERIALIZED (SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
  CAST(coalesce(list_sum(list_transform(range(1, least(len(a.x), len(b.x)) + 1), lambda i: a.x[i] * b.x[i])), 0) AS BIGINT) AS score
  FROM v AS a JOIN v AS b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT * FROM (SELECT anchor_id, other_id AS positive_id, score AS positive_score,
  row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) AS k FROM s WHERE same) WHERE k <= {POSITIVES})
SELECT * FROM (SELECT p.anchor_id, p.positive_id, CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other_id) AS INTEGER) AS rank,
  s.other_id AS negative_id, p.positive_score, s.score AS negative_score
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND {LEAST} * p.positive_score <= 100 * s.score AND 100 * s.score <= {MOST} * p.positive_score)
WHERE rank <= {NEGATIVES}
"""
