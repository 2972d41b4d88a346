"""Lloyd clustering of integer vectors, sharded by dimension.

The vectors are cut once into chunks of rows and blocks of columns, and stored by block.  In each round

* a task of one block computes the exact partial squared distances of its columns to its slice of the centroids,
* the partial distances of a chunk are added over the blocks and the nearest centroid is taken,
* each block sums its own columns by cluster and updates its own slice.

No task holds whole centroids or a chunk of unbounded size, chunks do not depend on values, so no cluster or
vector can make one task larger than another, and every sum is exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from metforge.llm.common import small_batches, table
from metforge.llm.vectors import scaled, usable
from metforge.operators.skew import lookup_join
from metforge.session import scratch_path, stored

CENTROIDS = 40
ROUNDS = 5
SIZE = 64  # components of a vector
COLUMNS = 16  # of a block
ROWS = 4096  # of a chunk, fewer if there are many centroids and blocks
CHUNK_BYTES = 32 << 20  # partial distances of a chunk over all blocks
PREFIX = "2:"  # of the ids, before they are hashed for the start
KIND = np.dtype("<i8")

BLOCK = "shard int, chunk bigint, n int, ids array<bigint>, part binary"


def _packed(values: np.ndarray) -> bytes:
    """Integers in the narrowest of the three widths that holds them all; :func:`_integers` tells it from the length."""
    most = int(np.abs(values).max(initial=0))
    return values.astype("<i2" if most < 1 << 15 else "<i4" if most < 1 << 31 else "<i8").tobytes()


def _integers(raw: bytes, rows: int, columns: int) -> np.ndarray:
    return np.frombuffer(raw, f"<i{len(raw) // max(rows * columns, 1) or 2}").reshape(rows, columns)


def partial_distances(x: np.ndarray, c: np.ndarray, size: int) -> np.ndarray:
    """Squared distances of rows to centroids over a block of columns, exact; ``size`` is the number of all columns."""
    most = max(int(np.abs(x.astype(KIND)).max(initial=0)), int(np.abs(c).max(initial=0)))
    if size * (2 * most) ** 2 >= 1 << 63:
        raise ValueError("components too large: squared distances may leave BIGINT")
    if 4 * size * most**2 < 1 << 53:  # every product and sum is a whole number that a double holds
        a, b = x.astype(np.float64), c.astype(np.float64)
        return ((a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)).astype(KIND)
    out = np.empty((len(x), len(c)), KIND)
    for j, row in enumerate(c):
        gap = x.astype(KIND) - row
        out[:, j] = (gap * gap).sum(1)
    return out


def _blocks(points: DataFrame, size: int, k: int) -> DataFrame:
    """``points`` (vec_id, x) as chunks by block of columns, stored by block."""
    rows = max(64, min(ROWS, CHUNK_BYTES // (8 * k * -(-size // COLUMNS))))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = TaskContext.get().partitionId() << 32
        for batch in batches:
            for first in range(0, batch.num_rows, rows):
                piece = batch.slice(first, rows)
                n, ids = piece.num_rows, piece.column(0).to_pylist()
                x = piece.column(1).flatten().to_numpy(zero_copy_only=False).reshape(n, size)
                parts = [_packed(x[:, j : j + COLUMNS]) for j in range(0, size, COLUMNS)]
                m = len(parts)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(range(m), pa.int32()), pa.array([at] * m, pa.int64()), pa.array([n] * m, pa.int32()),
                        pa.array([ids] + [None] * (m - 1), pa.list_(pa.int64())), pa.array(parts, pa.binary()),
                    ],
                    names=["shard", "chunk", "n", "ids", "part"],
                )
                at += 1

    spark = points.sparkSession
    small_batches(spark)
    path = scratch_path(spark, "vector-blocks")
    points.mapInArrow(cut, BLOCK).write.partitionBy("shard").parquet(path)
    return spark.read.schema(BLOCK).parquet(path)


def _slices(spark: SparkSession, centroids: list[list[int]], size: int) -> DataFrame:
    """``shard, cells``: of each block its columns of all centroids, centroid by centroid."""
    rows = [(j // COLUMNS, [v for c in centroids for v in c[j : j + COLUMNS]]) for j in range(0, size, COLUMNS)]
    return spark.createDataFrame(rows, "shard int, cells array<bigint>")


def _assign(blocks: DataFrame, slices: DataFrame, size: int, k: int, final: bool) -> DataFrame:
    """Nearest centroids: ``chunk, nearest`` (packed), or ``vec_id, cluster, distance``."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                n, cells = row.column("n")[0].as_py(), row.column("cells").flatten().to_numpy(zero_copy_only=False)
                centroids = cells.reshape(k, -1)
                x = _integers(row.column("part")[0].as_py(), n, centroids.shape[1])
                made = _packed(partial_distances(x, centroids, size))
                yield pa.RecordBatch.from_arrays(
                    [row.column("chunk"), row.column("n"), row.column("ids"), pa.array([made], pa.binary())], names=["chunk", "n", "ids", "part"]
                )

    def nearest(blocks: pa.Table) -> pa.Table:
        n = blocks["n"][0].as_py()
        total = np.zeros((n, k), KIND)
        for raw in blocks["part"]:
            total += _integers(raw.as_py(), n, k)
        best = total.argmin(1)  # the first of equals
        if not final:
            return pa.table({"chunk": blocks["chunk"][:1], "nearest": pa.array([_packed(best)], pa.binary())})
        ids = next(v.as_py() for v in blocks["ids"] if v.is_valid)
        return pa.table(
            {"vec_id": pa.array(ids, pa.int64()), "cluster": pa.array(best, pa.int32()), "distance": pa.array(total[np.arange(n), best], pa.int64())}
        )

    columns = ["shard", "chunk", "n", "part", "ids"] if final else ["shard", "chunk", "n", "part", F.lit(None).cast("array<bigint>").alias("ids")]
    parts = lookup_join(blocks.select(*columns), slices, "shard").mapInArrow(measure, "chunk bigint, n int, ids array<bigint>, part binary")
    return parts.groupBy("chunk").applyInArrow(nearest, "vec_id bigint, cluster int, distance bigint" if final else "chunk bigint, nearest binary")


def _moved(blocks: DataFrame, nearest: DataFrame, slices: DataFrame, k: int) -> DataFrame:
    """Slices of the floored means of each cluster; an empty cluster keeps its centroid."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}  # of the blocks that this task reads: by cluster the sum of each column, then the count
        for batch in batches:
            for i in range(batch.num_rows):
                shard, n = batch.column("shard")[i].as_py(), batch.column("n")[i].as_py()
                raw = batch.column("part")[i].as_py()
                by = _integers(batch.column("nearest")[i].as_py(), n, 1)[:, 0]
                width = batch.column("width")[i].as_py()
                x = _integers(raw, n, width).astype(KIND)
                own = totals.setdefault(shard, np.zeros((k, width + 1), KIND))
                order = np.argsort(by, kind="stable")
                used, first = np.unique(by[order], return_index=True)
                own[used, :-1] += np.add.reduceat(x[order], first, axis=0)
                own[used, -1] += np.diff(np.append(first, n))
        for shard, own in totals.items():
            width = own.shape[1] - 1
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(k * width, shard), pa.int32()), pa.array(np.arange(k * width), pa.int32()),
                    pa.array(own[:, :-1].ravel(), pa.int64()), pa.array(np.repeat(own[:, -1], width), pa.int64()),
                ],
                names=["shard", "cell", "total", "n"],
            )

    old = slices.select("shard", F.posexplode("cells").alias("cell", "old"))
    wide = slices.select("shard", (F.size("cells") / k).cast("int").alias("width"))
    rows = lookup_join(lookup_join(blocks.select("shard", "chunk", "n", "part"), nearest, "chunk"), wide, "shard")
    found = rows.mapInArrow(sums, "shard int, cell int, total bigint, n bigint").groupBy("shard", "cell").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
    mean = F.expr("(total - pmod(total, n)) div n")  # exact floor
    cells = old.join(found, ["shard", "cell"], "left").select("shard", "cell", F.when(F.col("n") > 0, mean).otherwise(F.col("old")).alias("value"))
    ordered = F.array_sort(F.collect_list(F.struct("cell", "value")))
    return cells.groupBy("shard").agg(F.transform(ordered, lambda c: c["value"]).alias("cells"))


def lloyd(
    df: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, size: int = SIZE, vec_id: str = "vec_id", vector: str = "embedding", prefix: str = PREFIX
) -> tuple[DataFrame, DataFrame]:
    """``(vec_id, cluster, distance)`` of every kept vector, and the centroids ``(cluster, centroid)``.

    Vectors without exactly ``size`` components, or with one that is null or not finite, are left out.  The first
    centroids are the ``k`` vectors (all, if fewer) whose ids, after ``prefix``, have the least SHA-256; vectors that
    repeat an id follow in the order of their components, and those without an id come last.  Every row is a
    vector of its own, repeated ones too.  A tie goes to the smaller cluster.  Without vectors both tables
    are empty.  Other columns, of whatever name, are not read.  Components so large that a distance may leave BIGINT are an error.
    The ``k * size`` numbers of the starting centroids pass through the driver.
    """
    spark = df.sparkSession
    points = df.where(usable(vector, size)).select(F.col(vec_id).cast("bigint").alias("vec_id"), scaled(vector).alias("x"))
    order = [F.sha2(F.concat(F.lit(prefix), F.col("vec_id").cast("string")), 256).asc_nulls_last(), F.col("x")]
    starts = [list(r.x) for r in points.orderBy(*order).limit(k).collect()]
    k = len(starts)
    if not k:
        return spark.createDataFrame([], "vec_id bigint, cluster int, distance bigint"), spark.createDataFrame([], "cluster int, centroid array<bigint>")
    blocks, slices = _blocks(points, size, k), _slices(spark, starts, size)
    for _ in range(rounds):
        nearest = stored(_assign(blocks, slices, size, k, False), "nearest")
        slices = stored(_moved(blocks, nearest, slices, k), "slices")
    rows = stored(_assign(blocks, slices, size, k, True), "clusters")
    width = F.size("cells") / k
    cells = slices.select("shard", width.cast("int").alias("width"), F.posexplode("cells").alias("cell", "value"))
    place = F.struct("shard", (F.col("cell") % F.col("width")).alias("column"), "value")
    centroids = cells.groupBy((F.col("cell") / F.col("width")).cast("int").alias("cluster")).agg(
        F.transform(F.array_sort(F.collect_list(place)), lambda c: c["value"]).alias("centroid")
    )
    return rows, centroids


def op13_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, centroids = lloyd(table(spark, sf_dir, "embeddings"))
    digest = centroids.select("cluster", F.sha2(F.array_join(F.transform("centroid", lambda v: v.cast("string")), ","), 256).alias("centroid_sha256"))
    inertia = rows.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    whole = rows.agg(F.sum("distance").alias("inertia"))
    # one row per cluster, and a single one: bounded by the number of centroids
    side = stored(digest.join(inertia, "cluster").join(F.broadcast(whole.withColumn("_one", F.lit(1))), F.lit(1) == F.col("_one")).drop("_one"), "inertia")
    return rows.join(F.broadcast(side), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _sql() -> str:
    """The same in SQL, one pair of tables per round."""
    c = [
        f"""v AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS x
 FROM embeddings WHERE len(embedding) = {SIZE} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {SIZE}),
p AS MATERIALIZED (SELECT r, unnest(range(1, {SIZE + 1})) AS d, unnest(x) AS x FROM v),
s AS (SELECT x, row_number() OVER (ORDER BY sha256('{PREFIX}' || CAST(vec_id AS VARCHAR)) NULLS LAST, x) - 1 AS c FROM v),
c0 AS MATERIALIZED (SELECT c, unnest(range(1, {SIZE + 1})) AS d, unnest(x) AS y FROM s WHERE c < {CENTROIDS})"""
    ]
    for i in range(ROUNDS + 1):
        c.append(
            f"""a{i} AS MATERIALIZED (SELECT r, c, q FROM (SELECT r, c, q, row_number() OVER (PARTITION BY r ORDER BY q, c) AS k
 FROM (SELECT r, c, CAST(sum((x - y) * (x - y)) AS BIGINT) AS q FROM p JOIN c{i} USING (d) GROUP BY r, c)) WHERE k = 1)"""
        )
        if i < ROUNDS:
            c.append(
                f"""m{i} AS (SELECT c, d, CAST(sum(x) AS BIGINT) AS t, count(*) AS n FROM p JOIN a{i} USING (r) GROUP BY c, d),
c{i + 1} AS MATERIALIZED (SELECT o.c, o.d, CASE WHEN n IS NULL THEN y ELSE (t - ((t % n) + n) % n) // n END AS y FROM c{i} AS o LEFT JOIN m{i} AS m ON m.c = o.c AND m.d = o.d)"""
            )
    last = ROUNDS
    return f"""WITH {', '.join(c)},
h AS (SELECT c, sha256(string_agg(CAST(y AS VARCHAR), ',' ORDER BY d)) AS h FROM c{last} GROUP BY c)
SELECT v.vec_id, CAST(a.c AS INTEGER) AS cluster, a.q AS distance, CAST(sum(a.q) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia,
 CAST(sum(a.q) OVER () AS BIGINT) AS inertia, h.h AS centroid_sha256 FROM a{last} AS a JOIN v USING (r) JOIN h ON h.c = a.c"""


SQL = _sql()
