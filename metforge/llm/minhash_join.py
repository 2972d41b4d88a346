"""Near-duplicate documents by MinHash signatures and a multi-index Hamming join.

A signature has ``SYMBOLS`` values of 16 bits, each the hash of the least shingle under one of as many orders of all
shingles.  It is split into ``CHUNKS`` chunks of ``LENGTH`` values.  If two signatures differ in at most ``DISTANCE`` values,
which is less than twice the number of chunks, some chunk differs in one value at most (pigeonhole).  So a document has a
key for each chunk and each of its values that may be wrong, made of the chunk's other values; all pairs under the
threshold share a key.  Documents of a similarity of 0.8 differ in 20 of 100 values on average, and in more than 39 with a
probability of 3e-6, which falls fast above that similarity.  A sketch of 4 bits of each value, and of ``MORE`` others, sorts out
pairs before full sets are compared.

Equal sets are one class throughout.  What shares a key is linked in steps, each confirmed on full sets:

1. each class with the least class of one of its keys, then, where that left two parts, of its other keys;
2. under the keys whose classes still lie in different parts, sketches are compared in tiles of bounded size, and a
   spanning forest joins the parts that may link to candidate groups;
3. inside a candidate group the full sets of all classes outside its largest part are compared with those of all
   others, in tiles of bounded bytes.  The parts that result are the components.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from metforge.llm.common import LOWER, add_columns, hashed, mixed, slices, small_batches, table, windows
from metforge.llm.components import components
from metforge.operators.skew import lookup_join
from metforge.session import stored

SHINGLE = 4
PERCENT = 80
CHUNKS, LENGTH = 20, 5
SYMBOLS = CHUNKS * LENGTH
DISTANCE = 2 * CHUNKS - 1
MORE = 92
SKETCH = (SYMBOLS + MORE) // 2  # bytes
# differing values of 4 bits at the threshold: 3/16 of all on average, plus 5.2 standard deviations
APART = int((SYMBOLS + MORE) * 0.1875 + 5.2 * ((SYMBOLS + MORE) * 0.1875 * 0.8125) ** 0.5)
ORDERS = mixed(np.arange(1, SYMBOLS + MORE + 1, dtype=np.uint64)) | np.uint64(1)  # odd factors, so that each permutes the hashes
TILE = 1024  # classes in one block
TILE_SHINGLES = 500_000  # of the full sets in one block
AT_ONCE = 256  # classes compared with one in one task


def shingles(text: bytes | None) -> np.ndarray:
    """Sorted hashes of the distinct shingles."""
    words = (text or b"").translate(LOWER).split()
    h = hashed(words)
    if not len(h):
        return h
    if len(h) < SHINGLE:  # the whole sequence; its length keeps it apart from ordinary shingles
        return mixed(windows(h, len(h)) + np.uint64(len(h)))
    return np.unique(windows(h, SHINGLE))


def signatures(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Signature (``SYMBOLS`` values) and sketch (``SKETCH`` bytes) of each set, none of them empty."""
    flat = np.concatenate(sets)
    starts = np.cumsum([0] + [len(s) for s in sets[:-1]])
    least = np.empty((len(sets), SYMBOLS + MORE), np.uint64)
    for k, factor in enumerate(ORDERS):
        least[:, k] = np.minimum.reduceat(flat * factor, starts)
    value = mixed(least)
    four = (value & np.uint64(15)).astype(np.uint8)
    return value[:, :SYMBOLS].astype("<u2"), four[:, ::2] | four[:, 1::2] << 4


def _described(texts: list[bytes | None]) -> tuple:
    """Of each text: number of shingles, two hashes of the set, signature and sketch."""
    sets = [shingles(t) for t in texts]
    full = [s for s in sets if len(s)]
    rows = zip(*signatures(full), strict=True) if full else iter(())
    h = [_name(s) for s in sets]
    g = [int(mixed(s ^ np.uint64(0xD6E8FEB86659FD93)).sum(dtype=np.uint64).astype(np.int64)) for s in sets]
    both = [next(rows) if len(s) else (b"", b"") for s in sets]
    return [len(s) for s in sets], h, g, [bytes(x) for x, _ in both], [bytes(x) for _, x in both]


def _name(s: np.ndarray) -> int:
    return int((mixed(s).sum(dtype=np.uint64) + np.uint64(len(s))).astype(np.int64))


def _matrix(column: pa.Array, kind: str, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, width)


def chunk_keys(sig: np.ndarray) -> np.ndarray:
    """Keys of each signature: of every chunk, without each of its values in turn, hashed with the number of both."""
    symbols = sig.reshape(-1, CHUNKS, LENGTH).astype(np.uint64)
    out = np.empty((len(sig), CHUNKS, LENGTH), np.uint64)
    for wrong in range(LENGTH):
        key = np.zeros((len(sig), CHUNKS), np.uint64)
        for i in range(LENGTH):
            if i != wrong:
                key = key << np.uint64(16) | symbols[:, :, i]
        place = np.arange(CHUNKS, dtype=np.uint64) * np.uint64(LENGTH) + np.uint64(wrong + 1)
        out[:, :, wrong] = mixed(mixed(key) + place)
    return out.reshape(len(sig), -1).view(np.int64)


def near(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Whether sketches (rows, or one against rows) may belong to sets that link."""
    x = a ^ b
    differ = ((x & 15) != 0).sum(-1) + (x > 15).sum(-1)
    return (differ <= APART) & (100 * np.minimum(n_a, n_b) >= PERCENT * np.maximum(n_a, n_b))


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    common = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * common >= PERCENT * (len(a) + len(b) - common)


# --- Spark -----------------------------------------------------------------------------------


def _keyed(nodes: DataFrame) -> DataFrame:
    """``key, h`` of every class; made anew from the signatures each time, as these are far smaller than the keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            keys = chunk_keys(_matrix(batch.column(1), "<u2", SYMBOLS))
            h = np.repeat(batch.column(0).to_numpy(), keys.shape[1])
            yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(h)], names=["key", "h"])

    small_batches(nodes.sparkSession)
    return nodes.select("h", "sig").mapInArrow(run, "key bigint, h bigint")


def _sketches(nodes: DataFrame, wanted: DataFrame) -> DataFrame:
    """``h, id, n, sketch`` of the classes named in ``wanted``."""
    return stored(lookup_join(nodes.select("h", "id", "n", "sketch"), wanted.select("h").distinct(), "h", "left_semi", unique=True), "minhash-sketches")


def _may_link(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Those of the pairs ``a, b`` whose sketches are near, with the ids of both."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                c = {n: batch.column(n) for n in ("n_a", "n_b", "sketch_a", "sketch_b")}
                both = [_matrix(c[n], "u1", SKETCH) for n in ("sketch_a", "sketch_b")]
                ok = near(*both, c["n_a"].to_numpy(), c["n_b"].to_numpy())
                yield batch.select(["a", "b", "id_a", "id_b"]).filter(pa.array(ok))

    pairs = stored(pairs, "minhash-met")
    known = _sketches(nodes, pairs.select(F.col("a").alias("h")).unionByName(pairs.select(F.col("b").alias("h"))))
    side = lambda c: known.select(*[F.col(n).alias(c if n == "h" else f"{n}_{c}") for n in ("h", "id", "n", "sketch")])
    both = lookup_join(lookup_join(pairs, side("a"), "a"), side("b"), "b")
    return both.select("a", "b", "id_a", "id_b", "n_a", "n_b", "sketch_a", "sketch_b").mapInArrow(run, "a bigint, b bigint, id_a bigint, id_b bigint")


def _confirmed(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs ``a, b`` (with ``id_a, id_b``) whose full sets link.

    The text of ``b`` goes once to every ``AT_ONCE`` classes that are compared with it.
    """
    pairs = stored(pairs, "minhash-pairs")
    tasks = pairs.groupBy("b", "id_b").agg(F.ceil(F.count(F.lit(1)) / AT_ONCE).cast("int").alias("tasks"))
    tasks = stored(tasks, "minhash-heads")
    other = lookup_join(pairs, tasks, ["b", "id_b"]).select(
        F.col("id_a").alias("id"), F.col("a").alias("h"), "b", F.pmod(F.xxhash64("a"), F.col("tasks").cast("bigint")).cast("int").alias("task"), F.lit(1).alias("role")
    )
    head = tasks.select(F.col("id_b").alias("id"), F.col("b").alias("h"), "b", F.explode(F.sequence(F.lit(0), F.col("tasks") - 1)).alias("task"), F.lit(0).alias("role"))
    wanted = stored(other.unionByName(head), "minhash-texts")
    rows = lookup_join(texts, wanted, "id", unique=True).select("b", "task", "role", "h", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, own = None, None
        for batch in slices(batches):
            found: list[tuple[int, int]] = []
            columns = [batch.column(i).to_pylist() for i in range(4)]
            for b, task, role, h, text in zip(*columns, batch.column(4).cast(pa.binary()).to_pylist(), strict=True):
                s = shingles(text)
                if _name(s) != h:  # another row with the same id
                    continue
                if (b, task) != now:
                    now, own = (b, task), None
                if role == 0:
                    own = s
                elif own is not None and linked(s, own):
                    found.append((h, b))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found, strict=True)], names=["a", "b"])

    small_batches(pairs.sparkSession)
    dealt = rows.repartition("b", "task").sortWithinPartitions("b", "task", "role")
    return stored(dealt.mapInArrow(run, "a bigint, b bigint"), "minhash-links")


def _parts(links: DataFrame) -> DataFrame:
    return stored(components(links).select(F.col("node").alias("h"), F.col("component").alias("part")), "minhash-parts")


def _across(pairs: DataFrame, parts: DataFrame) -> DataFrame:
    """The pairs whose two classes lie in different parts."""
    out = pairs
    for c in ("a", "b"):
        out = lookup_join(out, parts.select(F.col("h").alias(c), F.col("part").alias(f"part_{c}")), c, "left")
    return out.where(F.coalesce("part_a", "a") != F.coalesce("part_b", "b")).drop("part_a", "part_b")


def _candidates(nodes: DataFrame, met: DataFrame, parts: DataFrame) -> DataFrame:
    """Links ``a, b`` that join parts which may link, found under the keys of three or more classes."""
    rows = lookup_join(_keyed(nodes), met.where("count > 2").select("key"), "key")
    rows = stored(lookup_join(rows, parts, "h", "left").select("key", "h", F.coalesce("part", "h").alias("part")), "minhash-members")
    print_of = F.xxhash64(F.sum(F.col("h").bitwiseAND(F.lit(0xFFFFFFFF))), F.sum(F.shiftrightunsigned("h", 32)))  # of the classes in any order
    kinds = rows.groupBy("key").agg(F.min("part").alias("low"), F.max("part").alias("high"), F.count(F.lit(1)).alias("count"), print_of.alias("bucket"))
    kinds = stored(kinds.where("low <> high").groupBy("bucket", "count").agg(F.min("key").alias("key")), "minhash-mixed")  # equal groups once
    rows = stored(lookup_join(rows, kinds, "key"), "minhash-unlike")
    # a link between two parts has a class outside the largest part of its group: these meet each other and all others
    sizes = rows.groupBy("bucket", "part").agg(F.count(F.lit(1)).alias("c")).groupBy("bucket").agg(F.max(F.struct("c", "part")).alias("top"), F.sum("c").alias("all"))
    blocks = lambda c: F.ceil(c / TILE).cast("int")
    sizes = stored(sizes.select("bucket", F.col("top.part").alias("largest"), blocks(F.col("all") - F.col("top.c")).alias("lefts"), blocks(F.col("top.c")).alias("rights")), "minhash-sizes")
    rows = lookup_join(rows, sizes, "bucket").withColumn("outside", F.col("part") != F.col("largest"))
    own = F.pmod(F.xxhash64("h"), F.when(F.col("outside"), F.col("lefts")).otherwise(F.col("rights")).cast("bigint")).cast("int")
    rows = rows.withColumn("own", own)
    every = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    tile = lambda x, y: F.struct(x.alias("x"), y.alias("y"))
    # tiles of two blocks outside; the blocks of the largest part follow those
    among = F.transform(every("lefts"), lambda i: tile(F.least("own", i), F.greatest("own", i)))
    across = F.transform(every("rights"), lambda i: tile(F.col("own"), F.col("lefts") + i))
    inside = F.transform(every("lefts"), lambda i: tile(i, F.col("lefts") + F.col("own")))
    single = F.col("lefts") + F.col("rights") == 2  # a small group is one tile
    copies = F.when(single, F.array(tile(F.lit(0), F.lit(0)))).when(F.col("outside"), F.concat(among, across)).otherwise(inside)
    # narrow rows are copied, sketches join them afterwards
    tiled = rows.select("bucket", "h", "part", F.explode(copies).alias("t")).select("bucket", "t.x", "t.y", "h", "part")
    tiled = lookup_join(tiled, _sketches(nodes, rows).drop("id"), "h").select("bucket", "x", "y", "h", "part", "n", "sketch")

    def links(tile: pa.Table) -> list[tuple[int, int]]:
        h, part, n = (tile[c].to_numpy() for c in ("h", "part", "n"))
        sketch = _matrix(tile["sketch"].combine_chunks(), "u1", SKETCH)
        forest = Forest(part)
        for i in forest.outside():
            other = np.flatnonzero(forest.label != forest.label[i])
            forest.join(i, other[near(sketch[i], sketch[other], n[i], n[other])])
        return [(h[i], h[j]) for i, j in forest.links]

    return _tiles(tiled, ["bucket", "x", "y"], links).distinct()


class Forest:
    """Union of parts, with the links that joined them."""

    def __init__(self, part: np.ndarray):
        _, self.label, counts = np.unique(part, return_inverse=True, return_counts=True)
        self.largest = counts.argmax()
        self.links: list[tuple[int, int]] = []

    def outside(self) -> np.ndarray:
        """Members outside the largest part: a link between two parts has one of them."""
        return np.flatnonzero(self.label != self.largest)

    def join(self, i: int, others: np.ndarray) -> None:
        own = self.label[i]
        labels, first = np.unique(self.label[others], return_index=True)
        self.links += [(int(i), int(j)) for lab, j in zip(labels, others[first], strict=True) if lab != own]
        self.label[np.isin(self.label, labels)] = own


def _tiles(df: DataFrame, keys: list[str], links: Callable[[pa.Table], list[tuple[int, int]]]) -> DataFrame:
    """``a, b``: the links of each run of rows with the same keys; one run in memory at a time."""
    at = [df.columns.index(k) for k in keys]

    def made(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = links(pa.Table.from_batches(held)) if held else []
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found, strict=True)], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        now = None
        for batch in batches:
            if not batch.num_rows:
                continue
            marks = np.stack([batch.column(i).to_numpy() for i in at])
            cuts = [0, *(np.flatnonzero((marks[:, 1:] != marks[:, :-1]).any(0)) + 1).tolist(), batch.num_rows]
            for first, end in zip(cuts[:-1], cuts[1:], strict=True):
                mark = tuple(marks[:, first].tolist())
                if mark != now:
                    yield from made(held)
                    held, now = [], mark
                held.append(batch.slice(first, end - first))
        yield from made(held)

    small_batches(df.sparkSession)
    return df.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, "a bigint, b bigint")


def _compared(joined: DataFrame, parts: DataFrame, nodes: DataFrame, texts: DataFrame) -> DataFrame:
    """Links ``a, b`` between parts that ``joined`` puts into one candidate group, on full sets."""
    member = joined.select(F.col("a").alias("h")).unionByName(joined.select(F.col("b").alias("h"))).distinct()
    ends = lookup_join(member, parts, "h", "left").select("h", F.coalesce("part", "h").alias("part"))
    ends = stored(ends, "minhash-ends")
    between = joined
    for c in ("a", "b"):
        between = lookup_join(between, ends.select(F.col("h").alias(c), F.col("part").alias(f"part_{c}")), c)
    groups = _parts(between.select(F.col("part_a").alias("a"), F.col("part_b").alias("b"))).select(F.col("h").alias("part"), F.col("part").alias("grp"))
    # all classes of the parts concerned
    whole = lookup_join(nodes.select("h", "id", "n"), parts, "h", "left", unique=True).withColumn("part", F.coalesce("part", "h"))
    rows = stored(lookup_join(whole, groups, "part"), "minhash-groups")
    sizes = rows.groupBy("grp", "part").agg(F.count(F.lit(1)).alias("c"), F.sum("n").alias("s"))
    blocks = lambda c, s: F.ceil(F.greatest(F.col(c) / TILE, F.col(s) / TILE_SHINGLES)).cast("int")
    totals = sizes.groupBy("grp").agg(F.max(F.struct("c", "s", "part")).alias("top"), F.sum("c").alias("all_c"), F.sum("s").alias("all_s"))
    totals = totals.select("grp", F.col("top.part").alias("largest"), "all_c", "all_s", (F.col("all_c") - F.col("top.c")).alias("out_c"), (F.col("all_s") - F.col("top.s")).alias("out_s"))
    totals = stored(totals.select("grp", "largest", blocks("out_c", "out_s").alias("lefts"), blocks("all_c", "all_s").alias("rights")), "minhash-totals")
    rows = lookup_join(rows, totals, "grp")
    place = lambda n: F.pmod(F.xxhash64("h"), F.col(n).cast("bigint")).cast("int")
    outside, single = F.col("part") != F.col("largest"), (F.col("lefts") == 1) & (F.col("rights") == 1)
    every = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    right = F.transform(every("lefts"), lambda i: F.struct(i.alias("x"), place("rights").alias("y"), outside.alias("left")))
    left = F.transform(every("rights"), lambda i: F.struct(place("lefts").alias("x"), i.alias("y"), F.lit(True).alias("left")))
    copies = F.when(single | ~outside, right).otherwise(F.concat(left, F.filter(right, lambda t: t["x"] != place("lefts"))))
    tiled = stored(rows.select("id", "h", "part", "grp", F.explode(copies).alias("t")).select("id", "h", "part", "grp", "t.*"), "minhash-tiled")
    tiled = lookup_join(texts, tiled, "id", unique=True).select("grp", "x", "y", "left", "h", "part", "text")

    def links(tile: pa.Table) -> list[tuple[int, int]]:
        sets = [shingles(t) for t in tile["text"].cast(pa.binary()).to_pylist()]
        h = tile["h"].to_numpy()
        own = np.flatnonzero([_name(s) == v for s, v in zip(sets, h.tolist(), strict=True)])  # not another row with the same id
        if len(own) < 2:
            return []
        h, sets, left = h[own], [sets[i] for i in own], tile["left"].to_numpy()[own]
        forest = Forest(tile["part"].to_numpy()[own])
        sizes = np.array([len(s) for s in sets])
        _, shingle, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        holders = np.repeat(np.arange(len(sets)), sizes)[np.argsort(shingle, kind="stable")]
        start, first = np.cumsum(counts) - counts, np.cumsum(sizes) - sizes
        for i in np.flatnonzero(left):
            if (forest.label == forest.label[i]).all():
                break
            mine = shingle[first[i] : first[i] + sizes[i]]
            many = counts[mine]
            at = np.repeat(start[mine] - (np.cumsum(many) - many), many) + np.arange(many.sum())
            common = np.bincount(holders[at], minlength=len(sets))
            forest.join(i, np.flatnonzero((100 * common >= PERCENT * (sizes[i] + sizes - common)) & (forest.label != forest.label[i])))
        return [(h[i], h[j]) for i, j in forest.links]

    return stored(_tiles(tiled, ["grp", "x", "y"], links), "minhash-compared")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, n_shingles, component_id, kept``.

    Null and empty texts, and those without words, have no shingles and are linked with nothing; fewer than four words are one
    shingle.  Every row is a document: rows that repeat an id are linked by their own texts only, and equal rows get equal
    results.  A component is named by its smallest id, so ties do not arise.  A row without an id is linked with
    nothing, has no component and is kept.  Whole texts are compared, of any length.  Other columns are not read.
    """
    texts = docs.select(F.col(doc_id).cast("bigint").alias("id"), F.col(text).alias("text"))
    fields = {"n": "bigint", "h": "bigint", "g": "bigint", "sig": "binary", "sketch": "binary"}
    rows = stored(add_columns(texts, "text", _described, fields, drop=["text"]), "minhash-signatures")
    known = rows.where("n > 0 AND id IS NOT NULL")
    of_class = [F.min("id").alias("id"), F.first("sig").alias("sig"), F.first("sketch").alias("sketch")]
    nodes = stored(known.groupBy("h", "g", "n").agg(*of_class).drop("g"), "minhash-classes")
    texts = texts.where("id IS NOT NULL AND text IS NOT NULL")

    met = stored(_keyed(nodes).groupBy("key").agg(F.min("h").alias("b"), F.count(F.lit(1)).alias("count")).where("count > 1"), "minhash-keys")
    pairs = lookup_join(_keyed(nodes), met.select("key", "b"), "key").where("h <> b").select(F.col("h").alias("a"), "b").distinct()
    pairs = stored(_may_link(pairs, nodes), "minhash-near")
    least = pairs.groupBy("a", "id_a").agg(F.min(F.struct("b", "id_b")).alias("m")).select("a", "id_a", "m.*")
    links = _confirmed(least, texts)
    links = links.unionByName(_confirmed(_across(pairs, _parts(links)), texts))
    parts = _parts(links)
    joined = stored(_candidates(nodes, met, parts), "minhash-candidates")
    links = links.unionByName(_compared(joined, parts, nodes, texts))

    parts = _parts(links)
    names = lookup_join(nodes.select("h", "n", "id"), parts, "h", unique=True)
    names = stored(lookup_join(names, names.groupBy("part").agg(F.min("id").alias("component")), "part").select("h", "n", "component"), "minhash-components")
    # classes of copies without links to others are named by their smallest id
    alone = known.groupBy("h", "n").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("copies")).where("copies > 1").select("h", "n", "least")
    side = stored(alone.join(names, ["h", "n"], "full_outer").select("h", "n", F.coalesce("component", "least").alias("component")), "minhash-names")
    out = lookup_join(rows.select("id", "n", "h"), side, ["h", "n"], "left")
    own = F.when((F.col("n") > 0) & F.col("id").isNotNull(), F.coalesce("component", "id")).otherwise(F.col("id"))
    return out.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), own.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    )


def op11_minhash_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
