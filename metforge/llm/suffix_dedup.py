"""Repeated strings of ``LENGTH`` bytes, by a radix sort of suffixes no deeper than that.

Suffixes are sorted by most significant digits and only through ``LENGTH`` bytes; a group that
has one member, or whose outcome is known, is not sorted on.  A digit is a fingerprint of many bytes,
as only equality matters.

1. The first digit of a string is the least of its fingerprints of ``GRAM`` bytes (its anchor).  Equal strings have equal
   anchors at equal places, so it is enough to sort the anchors of the corpus, one position in about 26.
2. Anchors of equal digit are sorted by the next one, all bytes that a string over the anchor can have.
   In a group the first member keeps its strings, and those of the others are repeated, byte for byte.
3. Where an anchor's group falls apart into several, the strings of each group's first member
   are sorted by what they hold: equal groups are exactly the repeated strings.  A group of
   bounded size is sorted inside a task, from the bytes around its anchors; a larger one by Spark, string by string.

Equal texts are found before as wholes.  Positions covered are merged as ranges.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from metforge.llm.common import ARROW, add_columns, mixed, slices, small_batches, table
from metforge.operators.skew import lookup_join
from metforge.session import stored

LENGTH = 100
GRAM = 50
SPAN = LENGTH - GRAM + 1  # fingerprints in a string
SAMPLE = 64  # one document in so many is looked at for digits that are everywhere
HEAVY_SHARE = 0.02  # of the documents sampled
SALTS = 64
GROUP = 1 << 14  # members that are sorted inside a task, at most (under 3 KB each)
LAST = (1 << 63) - 1  # order of a null id
POS_BITS = 40

_tables: dict[str, list[np.ndarray]] = {}


class _Rolling:
    """Fingerprints of byte strings modulo 2**64, from prefix sums of powers of an odd base."""

    def __init__(self, seed: int):
        draw = np.random.default_rng(seed).integers(0, 1 << 63, 258, dtype=np.uint64)
        self.values = draw[:256] * np.uint64(2) + np.uint64(1)
        self.base = int(draw[256]) * 8 + 5
        self.inverse = pow(self.base, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def grow(self, n: int) -> None:
        while len(self.up) < n:
            k = len(self.up)
            self.up = np.concatenate([self.up, self.up * np.uint64(pow(self.base, k, 1 << 64))])
            self.down = np.concatenate([self.down, self.down * np.uint64(pow(self.inverse, k, 1 << 64))])

    def prefix(self, b: np.ndarray) -> np.ndarray:
        self.grow(len(b) + 1)
        out = np.zeros(len(b) + 1, np.uint64)
        np.cumsum(self.values[b] * self.up[: len(b)], out=out[1:])
        return out

    def all(self, prefix: np.ndarray, length: int) -> np.ndarray:
        """Of every string of this length."""
        n = len(prefix) - length
        return mixed((prefix[length:] - prefix[:n]) * self.down[:n])

    def some(self, prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((prefix[end] - prefix[start]) * self.down[start])


def _rollers() -> tuple[_Rolling, _Rolling]:
    if "rollers" not in _tables:
        _tables["rollers"] = [_Rolling(11), _Rolling(12)]
    return tuple(_tables["rollers"])


def _slide(x: np.ndarray, size: int, pick) -> np.ndarray:
    """Least or largest of every ``size`` consecutive values, by doubling."""
    done = 1
    while done * 2 <= size:
        x = pick(x[:-done], x[done:])
        done *= 2
    return pick(x[: len(x) - (size - done)], x[size - done :]) if done < size else x


def _anchors(b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Fingerprints by position, the least in each string, and the positions that are least in some string."""
    one, _ = _rollers()
    grams = one.all(one.prefix(b), GRAM)
    least = _slide(grams, SPAN, np.minimum)
    padded = np.concatenate([np.zeros(SPAN - 1, np.uint64), least, np.zeros(SPAN - 1, np.uint64)])
    return grams, least, np.flatnonzero(_slide(padded, SPAN, np.maximum) == grams)


def _first_digits(ids: list[int], versions: list[int], texts: list[bytes]) -> tuple[np.ndarray, ...]:
    """``id, pos, gram, context, known`` of all anchors; a position has the number of the version above its low bits.

    An anchor that follows one of equal digits is known to be a repetition; it is dealt out by its place instead.
    Rows that repeat a version are one text, and do not repeat themselves.
    """
    _, two = _rollers()
    out: list[list[np.ndarray]] = [[], [], [], []]
    seen: set[tuple[int, int]] = set()
    for i, v, t in zip(ids, versions, texts, strict=True):
        if len(t) < LENGTH or (i, v) in seen:
            continue
        seen.add((i, v))
        b = np.frombuffer(t, np.uint8)
        grams, _, at = _anchors(b)
        start, end = np.maximum(at - (SPAN - 1), 0), np.minimum(at + LENGTH, len(b))
        context = mixed(two.some(two.prefix(b), start, end) + (at - start).astype(np.uint64) * np.uint64(1 << 32) + (end - at).astype(np.uint64))
        for part, x in zip(out, (np.full(len(at), i, np.int64), at + (v << POS_BITS), grams[at].view(np.int64), context.view(np.int64)), strict=True):
            part.append(x)
    i, p, gram, context = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in out)
    order = np.lexsort((p, i, context, gram))
    g, c = gram[order], context[order]
    known = np.zeros(len(order), bool)
    known[order[1:]] = (g[1:] == g[:-1]) & (c[1:] == c[:-1])
    return i, p, np.where(known, mixed((i * 31 + p).view(np.uint64)).view(np.int64), gram), context, known


def _strings(ids: list[int], versions: list[int], texts: list[bytes], places: list[list[int]]) -> tuple[np.ndarray, ...]:
    """``id, pos, half, whole`` of the strings whose anchor is at one of the places."""
    _, two = _rollers()
    out: list[list[np.ndarray]] = [[] for _ in range(4)]
    for i, v, t, at in zip(ids, versions, texts, places, strict=True):
        if len(t) < LENGTH:
            continue
        b = np.frombuffer(t, np.uint8)
        grams, least, _ = _anchors(b)
        p = np.array(at, np.int64)
        s = p[:, None] - np.arange(SPAN)[None, :]
        ok = (s >= 0) & (s < len(least))
        ok &= least[np.where(ok, s, 0)] == grams[p][:, None]
        s = np.unique(s[ok])
        whole = two.some(two.prefix(b), s, s + LENGTH)
        for part, x in zip(out, (np.full(len(s), i, np.int64), s + (v << POS_BITS), grams[s].view(np.int64), whole.view(np.int64)), strict=True):
            part.append(x)
    return tuple(np.concatenate(p) if p else np.zeros(0, np.int64) for p in out)


def _surroundings(ids: list[int], versions: list[int], texts: list[bytes], places: list[list[int]]) -> tuple:
    """``id, pos, gram, left, bytes`` of the anchors at the places; ``left`` of the bytes lie before the anchor."""
    one, _ = _rollers()
    out: tuple[list, ...] = ([], [], [], [], [])
    for i, v, t, at in zip(ids, versions, texts, places, strict=True):
        p = np.array(at, np.int64)
        grams = one.some(one.prefix(np.frombuffer(t, np.uint8)), p, p + GRAM).view(np.int64)
        for x, g in zip(at, grams.tolist(), strict=True):
            left = min(x, SPAN - 1)
            for part, value in zip(out, (i, x + (v << POS_BITS), g, left, t[x - left : x + LENGTH]), strict=True):
                part.append(value)
    return out


def _repeats(grams: np.ndarray, lefts: np.ndarray, around: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows with a string that an earlier row of the same anchor has, and what it covers, from the anchor's place.

    Rows of one anchor are in order.  All strings of a row hold its anchor, so they cover one range.
    """
    one, _ = _rollers()
    width = LENGTH + SPAN - 1
    wide = np.zeros((len(around), width), np.uint8)
    for row, left, b in zip(wide, lefts.tolist(), around, strict=True):
        row[SPAN - 1 - left : SPAN - 1 - left + len(b)] = np.frombuffer(b, np.uint8)
    one.grow(width + 1)
    sums = np.zeros((len(around), width + 1), np.uint64)
    np.cumsum(one.values[wide] * one.up[:width], axis=1, out=sums[:, 1:])
    keys = (sums[:, LENGTH:] - sums[:, :SPAN]) * one.down[:SPAN]
    keys = mixed(mixed(keys) + grams.view(np.uint64)[:, None] * np.uint64(0x9E3779B97F4A7C15) + np.arange(SPAN, dtype=np.uint64))
    begins = SPAN - 1 - lefts.astype(np.int64)
    ends = begins + np.array([len(b) for b in around])
    start = np.arange(SPAN)[None, :]
    real = (start >= begins[:, None]) & (start + LENGTH <= ends[:, None])
    at = np.flatnonzero(real)
    _, first = np.unique(keys.ravel()[at], return_index=True)
    again = np.ones(len(at), bool)
    again[first] = False
    row, offset = np.divmod(at[again], SPAN)
    rows, begin = np.unique(row, return_index=True)
    last = np.append(begin[1:], len(row)) - 1
    return rows, offset[begin] - (SPAN - 1), offset[last] - (SPAN - 1) + LENGTH if len(rows) else offset[:0]


def _sorted_inside(df: DataFrame) -> DataFrame:
    """``id, pos, from, upto`` of the anchors of ``df`` that cover repeated strings; a group is in one task."""

    def flush(parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(parts)
        place = np.stack([rows[k].to_numpy() for k in ("gram", "id", "pos")])  # one row for each place, however often its text is repeated
        rows = rows.filter(pa.array(np.concatenate([[True], (place[:, 1:] != place[:, :-1]).any(0)])))
        hit, low, high = _repeats(rows["gram"].to_numpy(), rows["left"].to_numpy(), rows["bytes"].to_pylist())
        yield pa.RecordBatch.from_arrays([
            rows["id"].combine_chunks().take(pa.array(hit)), rows["pos"].combine_chunks().take(pa.array(hit)), pa.array(low, pa.int64()), pa.array(high, pa.int64())
        ], names=["id", "pos", "from", "upto"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            grams = batch.column(2).to_numpy()
            if held and held[-1].column(2)[-1].as_py() != grams[0]:
                yield from flush(held)
                held = []
            change = np.flatnonzero(grams[1:] != grams[:-1])
            if len(change):
                yield from flush([*held, batch.slice(0, int(change[-1]) + 1)])
                held = [batch.slice(int(change[-1]) + 1)]
            else:
                held.append(batch)
        if held:
            yield from flush(held)

    dealt = df.select("id", "pos", "gram", "left", "bytes").repartition("gram").sortWithinPartitions("gram", "id", "pos")
    return dealt.mapInArrow(run, "id bigint, pos bigint, `from` bigint, upto bigint")


def _flat(df: DataFrame, fn, schema: str, names: list[str]) -> DataFrame:
    """Rows made of each batch by ``fn`` of its columns (texts as bytes)."""
    kinds = [ARROW[k.split()[-1]] for k in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            columns = [c.cast(pa.binary()) if pa.types.is_string(c.type) or pa.types.is_large_string(c.type) else c for c in batch.columns]
            made = fn(*[c.to_pylist() for c in columns])
            for at in range(0, len(made[0]), 1 << 16):
                yield pa.RecordBatch.from_arrays([pa.array(x[at : at + (1 << 16)], k) for x, k in zip(made, kinds, strict=True)], names=names)

    small_batches(df.sparkSession)
    return df.mapInArrow(run, schema)


def _digits(rows: DataFrame) -> DataFrame:
    return _flat(rows.select("id", "version", "text"), _first_digits, "id bigint, pos bigint, gram bigint, context bigint, known boolean", ["id", "pos", "gram", "context", "known"])


def _heavy(rows: DataFrame) -> DataFrame:
    """Digits found in a large share of a sample of documents.  They only decide how rows are dealt to tasks."""
    some = rows.where(F.pmod(F.xxhash64("id", "version"), F.lit(SAMPLE)) == 0)
    counts = stored(_digits(some).where("NOT known").groupBy("gram").agg(F.countDistinct("id").alias("docs")).where("docs > 3"), "heavy-digits")
    total = some.count()
    # a document has a limited number of anchors, so few digits can have such a share
    return counts.where(F.col("docs") > HEAVY_SHARE * total).select("gram", F.lit(True).alias("heavy"))


def _split(pos: Column) -> tuple[Column, Column]:
    return F.shiftright(pos, POS_BITS).cast("int"), pos.bitwiseAND(F.lit((1 << POS_BITS) - 1))


def _ranges(rows: DataFrame) -> DataFrame:
    """``id, version, start, end`` of bytes covered by repeated strings; ranges overlap."""
    heavy = _heavy(rows)
    found = _digits(rows).join(F.broadcast(heavy), "gram", "left")
    found = found.withColumn("salt", F.when(F.col("heavy"), F.pmod("context", F.lit(SALTS))).otherwise(0).cast("int"))
    group = W.partitionBy("gram", "salt")
    found = found.repartition("gram", "salt").withColumns({
        "count": F.count(F.lit(1)).over(group), "low": F.min("context").over(group), "high": F.max("context").over(group),
    }).where((F.col("count") > 1) | F.col("heavy") | F.col("known"))
    place = F.struct("id", "pos")
    found = found.withColumn("first", F.min(place).over(W.partitionBy("gram", "salt", "context")))
    several = (F.col("low") != F.col("high")) | F.coalesce("heavy", F.lit(False))
    found = found.withColumn("again", F.col("known") | (place != F.col("first"))).where(F.col("again") | several)
    found = found.withColumn("members", F.count(F.when(~F.col("again"), 1)).over(group))
    found = found.withColumn("spread", F.when(F.col("heavy"), F.col("gram")))
    version, pos = _split(F.col("pos"))
    found = stored(found.select("id", version.alias("version"), pos.alias("pos"), "again", "members", "spread"), "anchors")
    # the few digits that were dealt out by context are counted as wholes
    whole = found.where("spread IS NOT NULL AND NOT again").groupBy("spread").agg(F.count(F.lit(1)).alias("all"))
    found = found.join(F.broadcast(whole), "spread", "left").withColumn("large", F.coalesce("all", "members") > GROUP)
    around = found.where("again").select("id", "version", F.greatest(F.col("pos") - (SPAN - 1), F.lit(0)).alias("start"), (F.col("pos") + LENGTH).alias("end"))
    places = [
        stored(found.where("NOT again").where(size).groupBy("id", "version").agg(F.collect_set("pos").alias("places")), "anchor-places")
        for size in ("NOT large", "large")
    ]
    open_ = [lookup_join(rows, p, ["id", "version"]).select("id", "version", "text", "places") for p in places]
    near = _flat(open_[0], _surroundings, "id bigint, pos bigint, gram bigint, left int, bytes binary", ["id", "pos", "gram", "left", "bytes"])
    inside = _sorted_inside(near).select("id", version.alias("version"), (pos + F.col("from")).alias("start"), (pos + F.col("upto")).alias("end"))
    names = ["id", "pos", "half", "whole"]
    strings = stored(_flat(open_[1], _strings, "id bigint, pos bigint, half bigint, whole bigint", names), "strings")
    firsts = strings.groupBy("half", "whole").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    later = lookup_join(strings, stored(firsts, "string-firsts"), ["half", "whole"]).where(place != F.col("first"))
    later = later.select("id", version.alias("version"), pos.alias("start"), (pos + LENGTH).alias("end"))
    around = around.unionByName(inside)
    return around.unionByName(later)


def _merged(ranges: DataFrame) -> DataFrame:
    """``id, version, runs``: starts and ends of the maximal runs, one after the other."""
    order = W.partitionBy("id", "version").orderBy("start", "end")
    sofar = F.max("end").over(order.rowsBetween(W.unboundedPreceding, -1))
    rows = ranges.withColumn("opens", F.coalesce((F.col("start") > sofar).cast("int"), F.lit(1)))
    rows = rows.withColumn("run", F.sum("opens").over(order.rowsBetween(W.unboundedPreceding, W.currentRow)))
    runs = rows.groupBy("id", "version", "run").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    both = F.transform(F.array_sort(F.collect_list(F.struct("start", "end"))), lambda r: F.array(r["start"], r["end"]))
    return runs.groupBy("id", "version").agg(F.flatten(both).alias("runs"))


def _numbered(docs: DataFrame, doc_id: str, text: str, versions: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """``doc_id, id, hash, version, text``, and the numbers of the texts that are not the first of their id."""
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(doc_id).cast("bigint"), F.lit(LAST)).alias("id"), F.xxhash64(body).alias("hash"), body.alias("text"))
    if versions is None:
        ids = stored(rows.groupBy("id", "hash").agg(F.count(F.lit(1)).alias("rows")), "text-hashes")
        many = ids.groupBy("id").agg(F.count(F.lit(1)).alias("texts")).where("texts > 1").select("id")
        number = F.row_number().over(W.partitionBy("id").orderBy("hash")) - 1
        versions = stored(ids.join(many, "id", "left_semi").select("id", "hash", number.alias("version")).where("version > 0"), "text-versions")
    return lookup_join(rows, versions, ["id", "hash"], "left").withColumn("version", F.coalesce("version", F.lit(0))), versions


def covered(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """``id, version, runs`` of the texts with repeated strings (see :func:`dedup_strings`), and the versions."""
    rows, versions = _numbered(docs, doc_id, text)
    rows = rows.where(F.octet_length("text") >= LENGTH)
    # equal texts: all but the first go as wholes
    texts = stored(rows.select("id", "version", "hash", F.xxhash64(F.lit("second"), "text").alias("second"), F.octet_length("text").alias("bytes")).distinct(), "texts")
    place = F.struct("id", "version")
    firsts = texts.groupBy("hash", "second", "bytes").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    copies = lookup_join(texts, stored(firsts, "equal-firsts"), ["hash", "second", "bytes"]).where(place != F.col("first"))
    copies = stored(copies.select("id", "version", "bytes"), "equal-texts")
    distinct = lookup_join(rows, copies.select("id", "version"), ["id", "version"], "left_anti")
    merged = _merged(_ranges(distinct))
    whole = copies.select("id", "version", F.array(F.lit(0), F.col("bytes")).cast(merged.schema["runs"].dataType).alias("runs"))
    return stored(merged.unionByName(whole), "covered-runs"), versions


def dedup_strings(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, n_bytes, n_removed, n_spans, kept`` (the bytes that remain).

    Every byte goes that lies in a string of ``LENGTH`` bytes that also starts earlier, in a
    document of smaller id or before in the same one.  Null texts count as empty; shorter texts stay.
    Null ids come last in the order.  Rows that repeat id and text are one document; other rows of
    one id are ordered by a hash of their text.
    """
    runs, versions = covered(docs, doc_id, text)
    rows, _ = _numbered(docs, doc_id, text, versions)
    rows = lookup_join(rows, runs, ["id", "version"], "left").select("doc_id", "text", "runs")

    def run(texts, runs):
        n, removed, spans, kept = [], [], [], []
        for t, r in zip(texts, runs, strict=True):
            r = [min(x, len(t)) for x in r or []]
            pieces = [t[a:b] for a, b in zip([0, *r[1::2]], [*r[::2], len(t)], strict=True)]
            kept.append(b"".join(pieces))
            n.append(len(t))
            removed.append(len(t) - len(kept[-1]))
            spans.append(len(r) // 2)
        return n, removed, spans, kept

    fields = {"n_bytes": "bigint", "n_removed": "bigint", "n_spans": "bigint", "kept": "binary"}
    return add_columns(rows, "text", run, fields, ["runs"], ["text", "runs"])


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = dedup_strings(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def naive(docs: list[tuple[int, bytes]], length: int = LENGTH) -> dict[int, tuple[int, int, int, str]]:
    """Plain search, for tests: bytes, bytes removed, spans and digest by id (ids without repeats)."""
    seen: set[bytes] = set()
    out = {}
    for i, t in sorted(docs):
        flags = bytearray(len(t))
        for s in range(len(t) - length + 1):
            w = t[s : s + length]
            if w in seen:
                flags[s : s + length] = b"\x01" * length
            seen.add(w)
        spans = sum(f and not p for f, p in zip(flags, b"\0" + flags, strict=False))
        out[i] = (len(t), sum(flags), spans, hashlib.sha256(bytes(c for c, f in zip(t, flags, strict=True) if not f)).hexdigest())
    return out
