"""Benchmark decontamination: Wu-Manber search for many windows of words at once.

The alphabet is the words of the benchmark (all other words are one foreign letter), a pattern is
a window of an item.  For patterns of one length ``L`` the search looks only at every
``L - 1``-th block of two words: a block that is in no pattern rules out every occurrence over it,
which is the full shift.  A block that is in patterns has its shifts in the table, each of which
is one place where an occurrence could end; the block at that end selects a bucket of patterns,
and the words are compared with each of them.

The benchmark is read in blocks of bounded size, one pass over the documents for each, so that
no table sent to the executors grows with the benchmark.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from metforge.llm.common import LOWER, add_columns, fresh, lists, table

WINDOW = 10
BLOCK_BYTES = 2_000_000  # of item texts searched for in one pass
# every ASCII character but digits and lower-case letters parts words, after lower-casing
_PART = bytes(c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in LOWER)


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_PART).split()


def _spread(starts: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For rows of ``counts`` consecutive entries from ``starts``: the row and the entry, one by one."""
    row = np.repeat(np.arange(len(counts)), counts)
    first = np.cumsum(counts) - counts
    return row, np.arange(len(row)) - first[row] + starts[row]


class _Length:
    """Tables for the patterns of one length."""

    def __init__(self, patterns: np.ndarray, base: int):
        self.length = patterns.shape[1]
        self.width = min(2, self.length)  # words in a block
        self.base, self.step = base, self.length - self.width + 1
        self.patterns = patterns[np.argsort(self.block(patterns[:, -self.width :]), kind="stable")]
        ends = self.block(self.patterns[:, -self.width :])
        self.suffix, self.bucket = np.unique(ends, return_index=True)
        self.bucket = np.append(self.bucket, len(ends))
        pairs = {(int(b), at) for at in range(self.step) for b in self.block(self.patterns[:, at : at + self.width])}
        found = np.array(sorted(pairs), np.int64).reshape(-1, 2)
        self.blocks, self.first = np.unique(found[:, 0], return_index=True)
        self.first = np.append(self.first, len(found))
        self.places = found[:, 1]  # of a block in patterns

    def block(self, rows: np.ndarray) -> np.ndarray:
        key = rows[..., 0].astype(np.int64)
        return key * self.base + rows[..., 1] if self.width == 2 else key

    def _lookup(self, table: np.ndarray, bounds: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(table, keys)
        hit = np.flatnonzero(at < len(table))
        hit = hit[table[at[hit]] == keys[hit]]
        row, entry = _spread(bounds[at[hit]], bounds[at[hit] + 1] - bounds[at[hit]])
        return hit[row], entry

    def search(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts of occurrences and the pattern of each."""
        at = np.arange(0, max(0, len(ids) - self.width + 1), self.step)
        if self.width == 2:
            at = at[(ids[at] > 0) & (ids[at + 1] > 0)]
            keys = ids[at].astype(np.int64) * self.base + ids[at + 1]
        else:
            at = at[ids[at] > 0]
            keys = ids[at].astype(np.int64)
        hit, entry = self._lookup(self.blocks, self.first, keys)
        start = np.unique(at[hit] - self.places[entry])
        start = start[(start >= 0) & (start + self.length <= len(ids))]
        end = start + self.length - self.width
        keys = ids[end].astype(np.int64) * self.base + ids[end + 1] if self.width == 2 else ids[end].astype(np.int64)
        hit, pattern = self._lookup(self.suffix, self.bucket, keys)
        start = start[hit]
        for j in range(self.length):  # direct comparison
            same = ids[start + j] == self.patterns[pattern, j]
            start, pattern = start[same], pattern[same]
        return start, pattern


class Patterns:
    """All windows of a block of items."""

    def __init__(self, items: Sequence[tuple[int, bytes]], window: int = WINDOW):
        self.vocabulary: dict[bytes, int] = {}
        owners: dict[int, dict[tuple[int, ...], set[int]]] = {}
        for item, text in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words_of(text)]
            size = min(window, len(ids))
            for i in range(len(ids) - size + 1 if size else 0):
                owners.setdefault(size, {}).setdefault(tuple(ids[i : i + size]), set()).add(item)
        self.tables: list[tuple[_Length, list[list[int]]]] = []
        for size in sorted(owners):
            made = _Length(np.array(list(owners[size]), np.int32), len(self.vocabulary) + 1)
            self.tables.append((made, [sorted(owners[size][tuple(map(int, p))]) for p in made.patterns]))

    def find(self, texts: Sequence[bytes | None]) -> tuple[np.ndarray, list[np.ndarray], list[set[int]]]:
        """Of each text: its number of words, the flags of its words that are hit, the items found."""
        split = [words_of(t) for t in texts]
        counts = np.array([len(w) for w in split], np.int64)
        gaps = counts + 1  # a foreign word after each text, so that nothing runs across
        starts = np.cumsum(gaps) - gaps
        ids = np.zeros(int(gaps.sum()), np.int32)
        for words, at in zip(split, starts, strict=True):
            ids[at : at + len(words)] = np.fromiter(map(self.vocabulary.get, words, repeat(0)), np.int32, len(words))
        steps = np.zeros(len(ids) + 1, np.int32)
        items: list[set[int]] = [set() for _ in texts]
        for made, owners in self.tables:
            start, pattern = made.search(ids)
            np.add.at(steps, start, 1)
            np.add.at(steps, start + made.length, -1)
            doc = np.searchsorted(starts, start, side="right") - 1
            for d, p in np.unique(np.stack([doc, pattern], 1), axis=0) if len(doc) else ():
                items[d].update(owners[p])
        hit = np.cumsum(steps[:-1]) > 0
        return counts, [hit[s : s + n] for s, n in zip(starts, counts, strict=True)], items


def _blocks(benchmark: DataFrame, item_id: str, text: str) -> Iterator[list[tuple[int, bytes]]]:
    """Items in lists of bounded size, one read at a time."""
    items = benchmark.select(F.col(item_id).alias("item"), F.col(text).alias("text")).where("item IS NOT NULL AND text IS NOT NULL").distinct()
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = size // BLOCK_BYTES + 1
    part = F.pmod(F.xxhash64("item", "text"), F.lit(count))
    for k in range(count):
        yield [(r.item, r.text.encode()) for r in items.where(part == k).collect()]


def _merge(hit: np.ndarray, before: Sequence[int]) -> np.ndarray:
    """Flags with those of earlier passes, given as the words hit."""
    if len(before):
        hit = hit.copy()
        hit[np.asarray(before, np.int64)] = True
    return hit


def searched(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", names: Sequence[str] = ("n_words", "words_hit", "items")) -> DataFrame:
    """``docs`` with the number of words, the positions of the words hit and the items found."""
    spark = docs.sparkSession
    out = docs
    fields = dict(zip(names, ("bigint", "array<int>", "array<bigint>"), strict=True))
    for k, block in enumerate(_blocks(benchmark, item_id, item_text)):
        sent = spark.sparkContext.broadcast(Patterns(block))

        def run(texts, hits=None, items=None, sent=sent):
            counts, flags, found = sent.value.find(texts)
            if hits is not None:
                flags = [_merge(f, b) for f, b in zip(flags, hits, strict=True)]
                found = [f.union(b) for f, b in zip(found, items, strict=True)]
            at = [np.flatnonzero(f).astype(np.int32) for f in flags]
            where = lists(np.concatenate(at), np.array([len(a) for a in at]), pa.int32())
            return counts, where, [sorted(f) for f in found]

        out = add_columns(out, text, run, fields, *((names[1:], names) if k else ()))
    return out


def contamination(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: ``n_words, words_hit, items`` and the flag ``contaminated``.

    A null or empty text has no words and is clean; items without words or without an id find
    nothing; items that repeat are searched for once.  Whole texts are searched.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return searched(rows, benchmark).drop("text").withColumn("contaminated", F.size("words_hit") > 0)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The rows without any benchmark window, with all their columns."""
    names = [fresh(docs, n) for n in ("_n_words", "_words_hit", "_items")]
    rows = searched(docs, benchmark, text, names=names)
    return rows.where(F.size(names[1]) == 0).select(*[F.col(f"`{c}`") for c in docs.columns])


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    ids = F.array_join(F.array_sort(F.transform("items", lambda x: x.cast("string"))), ",")
    return rows.select(
        "doc_id", "n_words", F.size("words_hit").cast("bigint").alias("n_hit"), F.size("items").cast("bigint").alias("n_items"),
        F.sha2(ids, 256).alias("items_sha256"), "contaminated",
    )


def naive(text: str | None, items: Sequence[tuple[int, str]], window: int = WINDOW) -> tuple[int, int, list[str]]:
    """Plain search for one text, for tests: words, words hit, items as sorted strings."""
    words = words_of(text.encode() if text else None)
    hit, found = set(), set()
    for item, t in items:
        own = words_of(t.encode() if t else None)
        size = min(window, len(own))
        for i in range(len(own) - size + 1 if size else 0):
            for j in range(len(words) - size + 1):
                if words[j : j + size] == own[i : i + size]:
                    hit.update(range(j, j + size))
                    found.add(str(item))
    return len(words), len(hit), sorted(found)


def digest(items: Sequence[str]) -> str:
    return hashlib.sha256(",".join(items).encode()).hexdigest()
