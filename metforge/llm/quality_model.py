"""Quality by voting of the nearest labelled documents in a latent semantic space.

Terms of a text are its words, the shapes of its words (runs of letters, capitals, digits and marks) and a
few coarse measures, hashed into columns.  The columns, weighted by their rarity among the
labelled documents, are projected on the leading singular vectors of the labelled sample.  The
unit vectors of the sample are broadcast: their number is bounded by ``sample``, whatever the corpus.
Vectors are rounded to whole steps; with these, every document's cosines with all of them are computed in blocks, exactly, and
its nearest ones vote with their similarity as weight.
"""

from __future__ import annotations

from collections import Counter
from operator import eq

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from metforge.llm.common import LOWER, WHITE, add_columns, lists, table
from metforge.operators.skew import lookup_join
from metforge.session import materialize

SAMPLE = 4000  # labelled documents (ids with a text) fitted and broadcast, at most: those with the smallest hash of their id
WORDS, SHAPES, MEASURES = 3072, 960, 64  # columns
RANK = 48
NEIGHBOURS = 15
STEPS = 4000  # components of the unit vectors are whole multiples of 1 / STEPS
SHARPNESS = 8  # exponent of the similarity as a weight
BLOCK = 512  # documents multiplied at once
THRESHOLD = 0.3
WEIGHTS = {"word": 0.5, "shape": 2.0, "measure": 1.0}

_CLASS = bytes(
    32 if c in WHITE else 97 if c >= 128 or 97 <= c <= 122 else 65 if 65 <= c <= 90 else 48 if 48 <= c <= 57 else c for c in range(256)
)


def _column(term: bytes, first: int, count: int) -> int:
    return first + xxhash.xxh3_64_intdigest(term) % count


def terms(text: bytes | None) -> dict[int, float]:
    """Columns and weights of a text."""
    b = text or b""
    words = b.translate(LOWER).split()
    n = max(len(words), 1)
    out: Counter[int] = Counter()
    for w, c in Counter(words).items():
        out[_column(w, 0, WORDS)] += WEIGHTS["word"] * (c / n) ** 0.5
    marks = np.frombuffer(b.translate(_CLASS), np.uint8)
    if len(marks):
        runs = marks[np.concatenate([[True], marks[1:] != marks[:-1]])].tobytes()
        for s, c in Counter(runs.split()).items():
            out[_column(s, WORDS, SHAPES)] += WEIGHTS["shape"] * (c / n) ** 0.5
    lines = [x for x in b.split(b"\n") if x.strip()]
    solid = max(len(b) - sum(b.count(bytes([x])) for x in WHITE), 1)
    measures = {
        b"length": int(np.log2(n + 1) * 2),
        b"word": min(int(solid / n), 20),
        b"distinct": int(10 * len(set(words)) / n),
        b"echo": int(10 * sum(map(eq, words, words[1:])) / n),
        b"lines": int(10 * len(set(lines)) / max(len(lines), 1)),
        b"per_line": int(np.log2(n / max(len(lines), 1) + 1)),
        b"capitals": int(10 * int(((marks == 65).sum())) / solid),
    }
    for name, level in measures.items():
        out[_column(name + b"%d" % level, WORDS + SHAPES, MEASURES)] += WEIGHTS["measure"]
    return out


class Model:
    """Projection and labelled vectors, from the columns of labelled documents."""

    def __init__(self, rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, rank: int = RANK):
        width = WORDS + SHAPES + MEASURES
        x = np.zeros((len(rows), width), np.float32)
        for i, (at, value) in enumerate(rows):
            x[i, at] = value
        seen = (x > 0).sum(0)
        self.rarity = np.log((1 + len(rows)) / (1 + seen)).astype(np.float32) + 1
        x *= self.rarity
        x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)
        self.projection = leading(x, min(rank, *x.shape))
        self.labels = labels.astype(np.float32)
        self.vectors = stepped(x @ self.projection)

    def project(self, rows: list[dict[int, float]]) -> np.ndarray:
        out = np.zeros((len(rows), self.projection.shape[1]), np.float32)
        for i, row in enumerate(rows):
            at = np.fromiter(row.keys(), np.int64, len(row))
            value = np.fromiter(row.values(), np.float32, len(row)) * self.rarity[at]
            out[i] = value @ self.projection[at]
        return stepped(out)

    def cosines(self, texts: list[bytes | None]) -> np.ndarray:
        """With every labelled document; no sum rounds, so equal texts have equal ones in any block."""
        return self.project([terms(t) for t in texts]) @ self.vectors.T / np.float32(STEPS * STEPS)

    def score(self, texts: list[bytes | None]) -> np.ndarray:
        out = np.zeros(len(texts))
        for first in range(0, len(texts), BLOCK):
            cosines = self.cosines(texts[first : first + BLOCK])
            near = nearest(cosines, min(NEIGHBOURS, len(self.labels)))
            weight = np.maximum(np.take_along_axis(cosines, near, 1), 1e-6).astype(np.float64) ** SHARPNESS
            out[first : first + BLOCK] = (weight * self.labels[near]).sum(1) / weight.sum(1)
        return np.clip(np.round(out, 6), 0.0, 1.0)


def nearest(cosines: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` largest of each row; of equal ones at the end, the first places."""
    least = np.partition(cosines, cosines.shape[1] - k, axis=1)[:, [-k]]
    above, level = cosines > least, cosines == least
    taken = above | (level & (np.cumsum(level, axis=1) <= k - above.sum(1, keepdims=True)))
    return np.nonzero(taken)[1].reshape(-1, k)


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


def stepped(x: np.ndarray) -> np.ndarray:
    """Unit vectors in whole ``STEPS``: products of two stay below 2^24, so single precision adds them exactly, in any order."""
    return np.rint(unit(x) * np.float32(STEPS))


def leading(x: np.ndarray, rank: int, rounds: int = 6) -> np.ndarray:
    """Leading right singular vectors by subspace iteration from a fixed start."""
    q = np.random.default_rng(7).standard_normal((x.shape[1], rank + 16)).astype(np.float32)
    for _ in range(rounds):
        q, _ = np.linalg.qr(x.T @ (x @ q))
    _, _, vt = np.linalg.svd(x @ q, full_matrices=False)
    return np.ascontiguousarray((q @ vt.T)[:, :rank], np.float32)


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", doc_id: str = "doc_id", text: str = "text", sample: int = SAMPLE) -> Model | None:
    """Model of at most ``sample`` labelled documents that are not held out; None if there are none.

    Rows with the same id and text are one document; an id with several texts is as many.  Labels without a document, null
    labels and null ids do not count.  Of several labels of an id the largest holds.
    """
    known = labels.select(F.col(doc_id).alias("id"), F.col(label).alias("label")).where(
        F.col("id").isNotNull() & F.col("label").isNotNull() & ~held_out(F.col("id"))
    )
    known = known.groupBy("id").agg(F.max("label").alias("label"))
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"), F.xxhash64(text).alias("version"))
    found = lookup_join(rows.select("id", "version"), known, "id").distinct()
    found = materialize(found.orderBy(F.xxhash64("id"), "id", "version").limit(sample))  # bounded, so it may be broadcast
    chosen = rows.join(F.broadcast(found), ["id", "version"]).dropDuplicates(["id", "version"])

    def run(texts):
        rows = [terms(t) for t in texts]
        counts = np.array([len(r) for r in rows])
        at = lists(np.array([k for r in rows for k in r], np.int32), counts, pa.int32())
        return at, [np.fromiter(r.values(), np.float64, len(r)) for r in rows]

    made = add_columns(chosen, "text", run, {"at": "array<int>", "value": "array<double>"}, drop=["text"]).toArrow().sort_by([("id", "ascending"), ("version", "ascending")])
    if not made.num_rows:
        return None
    rows = [(np.asarray(a, np.int64), np.asarray(v, np.float32)) for a, v in zip(made["at"].to_pylist(), made["value"].to_pylist(), strict=True)]
    return Model(rows, np.array([float(x > 0) for x in made["label"].to_pylist()]))


def quality_scores(docs: DataFrame, model: Model | None, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row, from its whole text alone.

    A null text counts as empty and gets the score that short texts have.  Without any label all
    scores are 0.5.  Equal texts get equal scores.  Of labelled documents equally near, those with smaller ids vote.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    if model is None:
        scored = rows.select("doc_id", F.lit(0.5).alias("score"))
    else:
        sent = docs.sparkSession.sparkContext.broadcast(model)
        scored = add_columns(rows, "text", lambda texts: (sent.value.score(texts),), {"score": "double"}, drop=["text"])
    return scored.select(
        "doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )


def op1_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality_scores(docs, fit(docs, table(spark, sf_dir, "labels")))
