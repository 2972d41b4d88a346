"""Near-duplicate documents by Jaccard similarity of word shingles, through R-trees of count vectors.

A document's distinct shingles are hashed into groups.  Two things come of the groups:

* A finer grouping, chosen by size class, gives keys: the number and the content hash of a group that is not
  empty.  Similar sets differ in few shingles, each of which spoils one group at most, so
  among the first ``n // 3 + 1`` keys of either, in the order of their hashes, one is the same.  Documents whose groups
  are too few for that argument add the shingles of an ordinary prefix filter as keys.
* The counts of a coarser grouping are a point.  The overlap of two sets is at most the sum of the
  smaller coordinates, and that of all points in two boxes the same sum over the boxes' upper
  corners.  The documents of a key are packed into an R-tree, and pairs of boxes are descended as long as the
  bound allows a link.  Larger sets have points of more coordinates, two to four shingles to each, as sets that
  have nothing in common look alike in few; neighbouring coordinates add up to those of the next smaller resolution.

Pairs that survive are joined to candidate components, inside which all shingles are compared
exactly.  Equal sets are one class with one representative throughout.  Keys or components with many documents are
cut into tiles of two blocks each, bounded by documents and, where full sets are compared, by shingles.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from metforge.llm.common import LOWER, add_columns, fresh, hashed, lists, mixed, small_batches, table, windows
from metforge.llm.components import components
from metforge.operators.skew import HEAVY_SHARE, lookup_join
from metforge.session import materialize, stored

SHINGLE = 5
COARSE = 16  # coordinates of the smallest points
FULL = 255  # a count of this or more
PERCENT = 75  # similarity that links; the arguments about keys below hold for 75 or more
LEAF = 32  # points in a leaf of the tree, children of a node
BLOCK = 4096  # documents of a key, or of a component, in one block
BLOCK_SHINGLES = 1_000_000  # of the documents of a component in one block
SKETCH_KEYS = 8  # keys that the sketch of heavy keys tracks, for each that may be heavy


# --- sets and keys ---------------------------------------------------------------------------


def shingles(text: bytes | None) -> np.ndarray:
    """Sorted hashes of the distinct shingles."""
    words = (text or b"").translate(LOWER).split()
    h = hashed(words)
    if not len(h):
        return h
    if len(h) < SHINGLE:  # the whole sequence; its length keeps it apart from ordinary shingles
        return mixed(windows(h, len(h)) + np.uint64(len(h)))
    return np.unique(windows(h, SHINGLE))


def _keys(sets: np.ndarray) -> np.ndarray:
    """Keys of a set; sets of at least ``PERCENT`` similarity share one."""
    n = len(sets)
    out, thin = [], False
    level = 0
    while 4 ** (level + 1) <= n:
        level += 1
    levels = [level] + [level + 1] * (4 * n >= 3 * 4 ** (level + 1))  # those near the next class meet it there
    prefix = n // 3 + 1
    for k in levels:
        groups = 2 * 4**k
        at = (sets >> np.uint64(20)) % np.uint64(groups)
        order = np.argsort(at, kind="stable")
        at = at[order]
        first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        content = np.add.reduceat(mixed(sets[order] + np.uint64(k + 1)), first)
        made = mixed(content ^ (at[first] * np.uint64(0x9E3779B97F4A7C15)) ^ np.uint64(k))
        thin |= len(made) < prefix
        out.append(np.partition(made, prefix - 1)[:prefix] if len(made) > prefix else made)
    if thin:
        single = mixed(sets ^ np.uint64(0x5851F42D4C957F2D))
        length = n - (PERCENT * n + 99) // 100 + 1
        out.append(np.partition(single, length - 1)[:length])
    return np.unique(np.concatenate(out))


def resolution(n: int) -> int:
    """Binary digits of the number of coordinates for a set of ``n``."""
    return max(COARSE.bit_length(), n.bit_length() - 1) - 1


def point(sets: np.ndarray) -> np.ndarray:
    bits = resolution(len(sets))
    return np.minimum(np.bincount((sets >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits), FULL).astype(np.uint8)


def _at(points: list[np.ndarray], bits: int) -> np.ndarray:
    """Points as rows of ``1 << bits`` counts; a full count is as good as any number."""
    out = np.empty((len(points), 1 << bits), np.int32)
    for i, p in enumerate(points):
        wide = p.astype(np.int32)
        wide[p == FULL] = 1 << 24
        out[i] = wide.reshape(1 << bits, -1).sum(1) if len(p) > 1 << bits else wide
    return out


def _signatures(texts: list[bytes | None]) -> tuple:
    n, h1, h2, vec, keys = [], [], [], [], []
    for t in texts:
        s = shingles(t)
        n.append(len(s))
        h1.append(int(mixed(s).sum(dtype=np.uint64).astype(np.int64)))
        h2.append(int(mixed(s ^ np.uint64(0xD6E8FEB86659FD93)).sum(dtype=np.uint64).astype(np.int64)))
        vec.append(point(s).tobytes())
        keys.append(_keys(s).view(np.int64) if len(s) else np.zeros(0, np.int64))
    return n, h1, h2, vec, lists(np.concatenate(keys), np.array([len(k) for k in keys]), pa.int64())


# --- R-tree -------------------------------------------------------------------------------


class Forest:
    """Union-find over 0..n-1 as an array of labels."""

    def __init__(self, n: int):
        self.label = np.arange(n)
        self.parts = n
        self.links: list[tuple[int, int]] = []

    def join(self, i: int, others: np.ndarray) -> None:
        """Link ``i`` with each of ``others`` that is in another part."""
        own = self.label[i]
        labels, first = np.unique(self.label[others], return_index=True)
        for lab, j in zip(labels, others[first], strict=True):
            if lab != own:
                self.links.append((i, int(j)))
        self.label[np.isin(self.label, labels)] = own
        self.parts -= int((labels != own).sum())


def _need(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least overlap of linked sets of these sizes: 100 o >= P (a + b - o)."""
    return (PERCENT * (a + b) + 99 + PERCENT) // (100 + PERCENT)


class Tree:
    """R-tree packed level by level: sizes first, then the widest coordinate."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray):
        n = len(points)
        order = np.argsort(sizes, kind="stable")
        wide = int(points.var(0).argmax())
        slab = max(LEAF, int(np.ceil(n / max(1, np.ceil(np.sqrt(n / LEAF))))))
        for at in range(0, n, slab):
            part = order[at : at + slab]
            order[at : at + slab] = part[np.argsort(points[part, wide], kind="stable")]
        self.order = order
        self.levels = [(points[order], sizes[order])]  # upper corners and least sizes, leaves' points first
        while len(self.levels[-1][0]) > 1:
            corners, least = self.levels[-1]
            at = np.arange(0, len(corners), LEAF)
            self.levels.append((np.maximum.reduceat(corners, at), np.minimum.reduceat(least, at)))

    def candidates(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of points (as positions before packing) whose bound allows a link, a few boxes at a time."""
        top = len(self.levels) - 1
        stack = [(top, np.zeros(1, np.int64), np.zeros(1, np.int64))]
        while stack:
            level, left, right = stack.pop()
            if level == 0:
                yield self.order[left], self.order[right]
                continue
            size = len(self.levels[level - 1][0])
            step = np.arange(LEAF)
            for a, b in zip(left, right, strict=True):  # pairs of boxes: descend to pairs of children
                x, y = a * LEAF + step, b * LEAF + step
                x, y = x[x < size], y[y < size]
                cx, nx = self.levels[level - 1][0][x], self.levels[level - 1][1][x]
                cy, ny = self.levels[level - 1][0][y], self.levels[level - 1][1][y]
                bound = np.minimum(cx[:, None, :], cy[None, :, :]).sum(2, dtype=np.int64)
                i, j = np.nonzero(bound >= _need(nx[:, None], ny[None, :]))
                keep = x[i] <= y[j] if level > 1 else x[i] < y[j]
                if keep.any():
                    stack.append((level - 1, x[i][keep], y[j][keep]))


def _leaf(points: list[np.ndarray], sizes: np.ndarray) -> list[tuple[int, int]]:
    """The same for points that fill one leaf at most: all bounds at once."""
    bits = [len(p).bit_length() - 1 for p in points]
    label, links = list(range(len(points))), []
    for k in sorted(set(bits)):
        at = [i for i, b in enumerate(bits) if k <= b <= k + 1]
        x, n = _at([points[i] for i in at], k), sizes[at]
        close = np.minimum(x[:, None], x[None]).sum(2, dtype=np.int64) >= _need(n[:, None], n[None])
        for a, b in zip(*(c.tolist() for c in np.nonzero(np.triu(close, 1))), strict=True):
            i, j = at[a], at[b]
            if min(bits[i], bits[j]) == k and label[i] != label[j]:
                links.append((i, j))
                old, new = label[j], label[i]
                label = [new if v == old else v for v in label]
    return links


def _bucket(points: list[np.ndarray], sizes: np.ndarray) -> list[tuple[int, int]]:
    """Links of a spanning forest over the pairs that may be similar."""
    if len(points) <= LEAF:
        return _leaf(points, sizes)
    forest = Forest(len(points))
    bits = np.array([len(p).bit_length() - 1 for p in points])
    for k in np.unique(bits):  # sizes of similar sets differ by a third at most, so resolutions by one step
        own = np.flatnonzero(bits == k)
        near = np.flatnonzero((bits == k + 1) & (PERCENT * sizes <= 100 * sizes[own].max()))
        at = np.concatenate([own, near])
        if len(at) < 2:
            continue
        for a, b in Tree(_at([points[i] for i in at], k), sizes[at]).candidates():
            one = (a < len(own)) | (b < len(own))  # two of the finer resolution meet there
            a, b = at[a[one]], at[b[one]]
            for i in np.unique(a):
                forest.join(int(i), b[a == i])
            if forest.parts == 1:
                return forest.links
    return forest.links


def _pairs(points: list[np.ndarray], sizes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Which of the buckets of two, at ``first`` and the next row, may be similar."""
    size = np.array([len(p) for p in points])
    low = np.minimum(size[first], size[first + 1])
    out = np.zeros(len(first), bool)
    for g in np.unique(low):
        at = first[low == g]
        bits = int(g).bit_length() - 1
        bound = np.minimum(_at([points[i] for i in at], bits), _at([points[i + 1] for i in at], bits)).sum(1, dtype=np.int64)
        out[low == g] = bound >= _need(sizes[at], sizes[at + 1])
    return out


def _exact(sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """Links of a spanning forest over the pairs that are similar, from inverted lists of the shingles."""
    sizes = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), sizes)
    _, shingle, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    by = np.argsort(shingle, kind="stable")
    posting, start = owner[by], np.cumsum(counts) - counts
    first = np.cumsum(sizes) - sizes
    # documents made of common shingles first: they join most of the others
    weight = np.add.reduceat(counts[shingle], first) / sizes
    forest = Forest(len(sets))
    for x in np.argsort(-weight, kind="stable"):
        own = shingle[first[x] : first[x] + sizes[x]]
        own = own[counts[own] > 1]
        many = counts[own]
        at = np.repeat(start[own] - (np.cumsum(many) - many), many) + np.arange(many.sum())
        overlap = np.bincount(posting[at], minlength=len(sets))
        hit = np.flatnonzero(100 * overlap >= PERCENT * (sizes[x] + sizes - overlap))
        forest.join(int(x), hit[hit != x])
        if forest.parts == 1:
            break
    return forest.links


# --- Spark -----------------------------------------------------------------------------------


def _runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The rows of sorted batches as tables of whole groups; one group, or those that end in a batch, in memory at a time."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        marks = np.stack([batch.column(k).to_numpy() for k in keys])
        change = np.flatnonzero((marks[:, 1:] != marks[:, :-1]).any(0)) + 1
        if held and list(marks[:, 0]) != [held[-1].column(k)[-1].as_py() for k in keys]:
            yield pa.Table.from_batches(held)
            held = []
        if len(change):
            yield pa.Table.from_batches([*held, batch.slice(0, int(change[-1]))])
            held = [batch.slice(int(change[-1]))]
        else:
            held.append(batch)
    if held:
        yield pa.Table.from_batches(held)


def _starts(rows: pa.Table, keys: list[str]) -> np.ndarray:
    """Bounds of the groups in sorted rows."""
    marks = np.stack([rows[k].to_numpy() for k in keys])
    first = np.flatnonzero(np.concatenate([[True], (marks[:, 1:] != marks[:, :-1]).any(0)]))
    return np.append(first, rows.num_rows)


def _grouped(df: DataFrame, keys: list[str], read: Callable, links: Callable) -> DataFrame:
    """``a, b``: ``links`` of the rows of each group, ids in the column ``doc_id``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _runs(batches, keys):
            ids = rows["doc_id"].to_numpy()
            found = [(ids[i], ids[j]) for i, j in links(read(rows), _starts(rows, keys))]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found, strict=True)], names=["a", "b"])

    return df.repartition(*keys).sortWithinPartitions(*keys, "doc_id").mapInArrow(run, "a bigint, b bigint")


def _heavy(keyed: DataFrame, share: int) -> DataFrame:
    """Keys with more than ``1 / share`` of the rows, and perhaps some with less; fewer than ``2 * share``.

    They come from a mergeable sketch of all rows, whose counts are never too low, and only decide which way rows take.
    """
    top = keyed.agg(F.expr(f"approx_top_k(key, {2 * share}, {SKETCH_KEYS * share})").alias("top"), F.count(F.lit(1)).alias("total"))
    found = top.select(F.explode("top").alias("t"), "total").where((F.col("t.count") * share > F.col("total")) & (F.col("t.count") > share))
    return materialize(found.select(F.col("t.item").alias("key")))


def _buckets(keyed: DataFrame, share: int = HEAVY_SHARE) -> DataFrame:
    """``bucket, count, doc_id`` of the keys that several rows ``doc_id, key`` have; keys with the same documents are one bucket.

    Rows are shuffled by their key once, at any size.  Those of the few heavy keys stay where they are: their counts
    are combined before the shuffle, and of those with the same documents one key is kept.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _runs(batches, ["key"]):
            starts = _starts(rows, ["key"])
            ids, count = rows["doc_id"].to_numpy(), np.diff(starts)
            prints = mixed(np.add.reduceat(mixed(ids.view(np.uint64)), starts[:-1]) + count.astype(np.uint64))  # of the documents in any order
            several = np.flatnonzero(count > 1)
            own = several[np.unique(prints[several], return_index=True)[1]]
            at = np.repeat(starts[own] - (np.cumsum(count[own]) - count[own]), count[own]) + np.arange(count[own].sum())
            columns = np.repeat(prints[own], count[own]).view(np.int64), np.repeat(count[own], count[own]), ids[at]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["bucket", "count", "doc_id"])

    small_batches(keyed.sparkSession)
    heavy = F.broadcast(_heavy(keyed, share))  # fewer than 2 * share rows
    dealt = keyed.join(heavy, "key", "left_anti").repartition("key").sortWithinPartitions("key")
    out = dealt.select("key", "doc_id").mapInArrow(run, "bucket bigint, count bigint, doc_id bigint")
    h = F.xxhash64("doc_id")
    # halves, as the sum of whole hashes leaves BIGINT; a sum also tells repeated ids, which cancel each other in bit_xor
    low, high = F.sum(h.bitwiseAND(F.lit(0xFFFFFFFF))), F.sum(F.shiftrightunsigned(h, 32))
    sums = keyed.join(heavy, "key").groupBy("key").agg(F.count(F.lit(1)).alias("count"), low.alias("low"), high.alias("high")).where("count > 1")
    wide = materialize(sums.groupBy("count", F.xxhash64("low", "high").alias("bucket")).agg(F.min("key").alias("key")))
    return out.unionByName(keyed.join(F.broadcast(wide), "key").select("bucket", "count", "doc_id")).distinct()


def _tiles(df: DataFrame, blocks: Column) -> DataFrame:
    """Rows of a group of so many ``blocks`` dealt to tiles of two blocks; one tile for a group of one block."""
    blocks = blocks.cast("int")
    own = F.pmod(F.xxhash64("doc_id"), blocks.cast("bigint")).cast("int")
    other = F.when(blocks == 1, F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), blocks - 1))
    rows = df.withColumn("_own", own).withColumn("_blocks", blocks).withColumn("_other", F.explode(other))
    # with several blocks, the tile of a block with itself is part of its other tiles
    rows = rows.where((F.col("_blocks") == 1) | (F.col("_own") != F.col("_other")))
    tile = F.least("_own", "_other").cast("bigint") * F.lit(1 << 31) + F.greatest("_own", "_other")
    return rows.withColumn("tile", tile).drop("_own", "_other", "_blocks")


def _maybe(rows: tuple[list[np.ndarray], np.ndarray], starts: np.ndarray) -> Iterator[tuple[int, int]]:
    """Links of all buckets, given by the bounds of their rows."""
    points, sizes = rows
    length = np.diff(starts)
    two = starts[:-1][length == 2]
    if len(two):
        for i in two[_pairs(points, sizes, two)]:
            yield i, i + 1
    for s, n in zip(starts[:-1][length > 2], length[length > 2], strict=True):
        for i, j in _bucket(points[s : s + n], sizes[s : s + n]):
            yield s + i, s + j


def _points(rows: pa.Table) -> tuple[list[np.ndarray], np.ndarray]:
    return [np.frombuffer(v, np.uint8) for v in rows["vec"].to_pylist()], rows["n"].to_numpy()


def _sure(sets: list[np.ndarray], starts: np.ndarray) -> Iterator[tuple[int, int]]:
    for s, e in zip(starts[:-1], starts[1:], strict=True):
        for i, j in _exact(sets[s:e]) if e - s > 1 else ():
            yield s + i, s + j


def _sets(rows: pa.Table) -> list[np.ndarray]:
    return [shingles(t) for t in rows["text"].cast(pa.binary()).to_pylist()]


def similar(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, n_shingles, component_id``.

    Null and empty texts, and those without words, have no shingles and are linked with nothing.
    Fewer than five words are one shingle.  Rows that repeat an id are one document, linked by all
    their texts; a row without an id is linked with nothing and has no component.  Whole texts are compared, ties do not matter.
    """
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    fields = {"n": "bigint", "h1": "bigint", "h2": "bigint", "vec": "binary", "keys": "array<bigint>"}
    sig = stored(add_columns(rows, "text", _signatures, fields, drop=["text"]), "shingle-signatures")
    known = sig.where("n > 0 AND doc_id IS NOT NULL")
    classes = stored(known.groupBy("h1", "h2", "n").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies")), "shingle-classes")
    # all but one document of each class
    many = classes.where("copies > 1").select("h1", "h2", "rep")
    copies = lookup_join(known.select("doc_id", "h1", "h2"), many, ["h1", "h2"]).where("doc_id <> rep").select("doc_id", "h1", "h2").distinct()
    reps = lookup_join(known, stored(copies, "shingle-copies"), ["doc_id", "h1", "h2"], "left_anti")

    # keys that several representatives have
    reps = stored(reps.select("doc_id", "keys"), "shingle-representatives")
    met = stored(_buckets(reps.select("doc_id", F.explode("keys").alias("key"))), "shingle-buckets")
    placed = lookup_join(met, sig.select("doc_id", "n", "vec").where("n > 0").dropDuplicates(["doc_id", "vec"]), "doc_id")
    maybe = _grouped(_tiles(placed, F.ceil(F.col("count") / BLOCK)), ["bucket", "count", "tile"], _points, _maybe)
    near = stored(components(maybe), "shingle-candidates")

    # inside a candidate component everything is compared
    near = near.select(F.col("node").alias("doc_id"), "component")
    near = stored(lookup_join(near, sig.where("n > 0").groupBy("doc_id").agg(F.sum("n").alias("n")), "doc_id", unique=True), "shingle-near")
    whole = near.groupBy("component").agg(F.ceil(F.greatest(F.count(F.lit(1)) / BLOCK, F.sum("n") / BLOCK_SHINGLES)).alias("blocks"))
    near = stored(lookup_join(near, whole, "component").drop("n"), "shingle-members")
    members = lookup_join(rows.where("doc_id IS NOT NULL AND text IS NOT NULL"), near, "doc_id").distinct()
    sure = _grouped(_tiles(members, F.col("blocks")).drop("blocks"), ["component", "tile"], _sets, _sure)
    linked = stored(components(sure), "shingle-components")

    # classes that have copies or links, then every document by its class
    side = classes.join(linked, F.col("rep") == F.col("node"), "left").where("copies > 1 OR component IS NOT NULL").select(
        "h1", "h2", F.coalesce("component", "rep").alias("component")
    )
    out = lookup_join(sig.select("doc_id", "n", "h1", "h2"), stored(side, "shingle-links"), ["h1", "h2"], "left")
    own = F.when((F.col("n") > 0) & F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), own.alias("component_id"))


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows that lead their component, with all columns; rows without an id stay.  Repeated rows of a leader are one."""
    found = similar(docs, doc_id, text).where("doc_id IS NOT NULL AND doc_id <> component_id").select("doc_id").distinct()
    key = fresh(docs, "_key")
    gone = stored(found.select(F.col("doc_id").alias(key)), "shingle-gone")
    return lookup_join(docs.withColumn(key, F.col(doc_id).cast("bigint")), gone, key, "left_anti").drop(key)


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar(table(spark, sf_dir, "documents"))
