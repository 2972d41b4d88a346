"""Quality rules whose thresholds follow the data: quantile sketches per language and source.

Each text is measured once.  Every measure goes into a sketch of relative-error bins
(bin ``ceil(ln(x) / ln(BASE))``), which is a plain table ``(lang, source, measure, bin, n)``:
two sketches merge by adding counts, in any order, with the same result.  The fences of a group
are taken from its sketch; a group with few documents uses the merged sketch of its language,
and that of all documents if its language has few as well.  Documents are then joined with
their group's fences.
"""

from __future__ import annotations

from operator import eq

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from metforge.llm.common import WHITE, add_columns, fresh, hashed, table, windows
from metforge.operators.skew import lookup_join
from metforge.session import stored

REPEAT = 8  # words in a window whose repetition counts
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
SYMBOLS = b"#*$%&|<>"
_CONTINUATION = bytes(range(0x80, 0xC0))
_UPPER = bytes(range(65, 91))

BASE = 1.02  # bins are 2 % wide: quantiles are right to 1 %
MIN_GROUP = 100  # documents a group needs for a sketch of its own
SPREAD = 6.0  # an upper fence is the median + SPREAD x (third quartile - median) + slack
# but that distance counts up to SKEW x (median - first quartile), as the third quartile is junk where a quarter of a group is
SKEW = 2.0

# measure: (numerator, denominator, slack). The slack keeps a fence off the bulk where the quartiles coincide.
RATIOS = {
    "symbols": ("n_symbols", "word_chars", 0.03),
    "capitals": ("n_capitals", "word_chars", 0.15),
    "dup_lines": ("n_dup_lines", "n_lines", 0.40),
    "repeats": ("n_repeat_words", "n_words", 0.28),
    "echoes": ("n_echo_words", "n_words", 0.15),
    "word_length": ("word_chars", "n_words", 3.0),
}
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_capitals", "n_lines", "n_echo_words")


def measure(texts: list[bytes | None]) -> list[list[int]]:
    """The counts of ``COUNTS`` for each text."""
    rows = []
    for text in texts:
        b = text or b""
        words = b.split()
        lines = [x for x in b.split(b"\n") if x.strip()]
        chars = len(b.translate(None, WHITE + _CONTINUATION))
        symbols = len(b) - len(b.translate(None, SYMBOLS))
        capitals = len(b) - len(b.translate(None, _UPPER))
        rows.append((len(words), chars, symbols, len(lines) - len(set(lines)), repeat_words(words), capitals, len(lines), sum(map(eq, words, words[1:]))))
    return [list(c) for c in zip(*rows, strict=True)]  # batches have rows


def repeat_words(words: list[bytes]) -> int:
    """Words inside windows of ``REPEAT`` words that occur more than once."""
    if len(words) < REPEAT + 1:
        return 0
    _, inverse, counts = np.unique(windows(hashed(words), REPEAT), return_inverse=True, return_counts=True)
    again = np.flatnonzero(counts[inverse] > 1)
    if not len(again):
        return 0
    steps = np.zeros(len(words) + 1, np.int64)
    steps[again] += 1
    steps[again + REPEAT] -= 1
    return int((np.cumsum(steps) > 0).sum())


def measured(docs: DataFrame, text: str = "text", prefix: str = "") -> DataFrame:
    """All columns of ``docs`` and the counts, their names with ``prefix``."""
    return add_columns(docs, text, measure, {f"{prefix}{c}": "bigint" for c in COUNTS})


def _ratio(name: str, prefix: str) -> Column:
    top, bottom, _ = RATIOS[name]
    return F.col(f"{prefix}{top}") / F.col(f"{prefix}{bottom}")  # null where there are no words


def _bin(x: Column) -> Column:
    """Number of the sketch bin of a ratio; zero has the lowest bin."""
    return F.when(x <= 0, F.lit(-10000)).otherwise(F.ceil(F.ln(x) / F.lit(float(np.log(BASE))))).cast("int")


def sketches(counts: DataFrame, lang: str = "lang", source: str = "source", prefix: str = "") -> DataFrame:
    """``(lang, source, measure, bin, n)``: one sketch per group and measure."""
    entries = [F.struct(F.lit(k).alias("measure"), _bin(_ratio(k, prefix)).alias("bin")) for k in RATIOS]
    return (
        counts.where(F.col(f"{prefix}n_words") > 0)
        .select(F.col(lang).alias("lang"), F.col(source).alias("source"), F.explode(F.array(*entries)).alias("e"))
        .groupBy("lang", "source", "e.measure", "e.bin")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def _fence(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """Rows and fence of each group and measure, from bin counts."""
    by = [*keys, "measure"]
    merged = sketch.groupBy(*by, "bin").agg(F.sum("n").alias("n"))
    upto = F.sum("n").over(W.partitionBy(*by).orderBy("bin"))
    ranked = merged.withColumn("upto", upto).withColumn("rows", F.sum("n").over(W.partitionBy(*by)))
    at = lambda q: F.min(F.when(F.col("upto") >= F.col("rows") * q, F.col("bin")))
    value = lambda c: F.when(F.col(c) <= -10000, 0.0).otherwise(2 * F.pow(F.lit(BASE), F.col(c)) / (1 + BASE))
    slack = F.create_map(*[F.lit(x) for k, (_, _, s) in RATIOS.items() for x in (k, s)])
    return (
        ranked.groupBy(*by, "rows")
        .agg(at(0.25).alias("b25"), at(0.5).alias("b50"), at(0.75).alias("b75"))
        .withColumn("upper", F.least(value("b75") - value("b50"), SKEW * (value("b50") - value("b25"))))
        .withColumn("fence", value("b50") + SPREAD * F.col("upper") + slack[F.col("measure")])
        .select(*by, "rows", "fence")
    )


def fences(sketch: DataFrame) -> DataFrame:
    """One row per (lang, source): the fence of every measure, from the smallest group that has enough rows."""
    own = _fence(sketch, ["lang", "source"])
    lang = _fence(sketch, ["lang"]).select(F.col("lang").alias("l_lang"), F.col("measure").alias("l_measure"), F.col("rows").alias("l_rows"), F.col("fence").alias("l_fence"))
    every = _fence(sketch, []).select(F.col("measure").alias("e_measure"), F.col("fence").alias("e_fence"))
    fence = F.when(F.col("rows") >= MIN_GROUP, F.col("fence")).when(F.col("l_rows") >= MIN_GROUP, F.col("l_fence")).otherwise(F.col("e_fence"))
    return (
        own.join(lang, F.col("lang").eqNullSafe(F.col("l_lang")) & (F.col("measure") == F.col("l_measure")))
        .join(every, F.col("measure") == F.col("e_measure"))
        .groupBy("lang", "source")
        .agg(*[F.max(F.when(F.col("measure") == k, fence)).alias(f"fence_{k}") for k in RATIOS])
    )


def judged(counts: DataFrame, limits: DataFrame, lang: str = "lang", source: str = "source", prefix: str = "") -> DataFrame:
    """``counts`` with ``base_failed`` and ``kept`` (prefixed) by the fences of each row's group."""
    # null groups meet under a marker that no prefixed name can be
    mark = lambda c: F.concat(F.when(c.isNull(), "n").otherwise("v"), F.coalesce(c, F.lit("")))
    keys = [fresh(counts, "_lang_key"), fresh(counts, "_source_key")]
    made = {k: fresh(counts, f"_fence_{k}") for k in RATIOS}
    side = limits.select(mark(F.col("lang")).alias(keys[0]), mark(F.col("source")).alias(keys[1]), *[F.col(f"fence_{k}").alias(v) for k, v in made.items()])
    rows = lookup_join(counts.withColumns({keys[0]: mark(F.col(lang)), keys[1]: mark(F.col(source))}), side, keys, "left")
    words, repeats = F.col(f"{prefix}n_words"), F.col(f"{prefix}n_repeat_words")
    failed = (words < MIN_WORDS) | (100 * repeats > MAX_REPEAT_PERCENT * words)
    beyond = F.lit(False)
    for k, fence in made.items():
        beyond = beyond | F.coalesce(_ratio(k, prefix) > F.col(fence), F.lit(False))
    return rows.withColumns({f"{prefix}base_failed": failed, f"{prefix}kept": ~failed & ~beyond}).drop(*keys, *made.values())


def quality_rules(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """One row per input row: its counts, ``base_failed`` and ``kept``.

    A null or empty text has no words, so it fails the base rule.  Null languages and sources are
    groups of their own.  Repeated rows are judged alike; an empty table gives no rows.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.col(lang).alias("lang"), F.col(source).alias("source"))
    # narrow, so that texts are measured once and the sketches and the verdict read the same counts
    counts = stored(add_columns(rows, "text", measure, {c: "bigint" for c in COUNTS}, drop=["text"]), "quality-counts")
    return judged(counts, fences(sketches(counts)))


def keep_good(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """The rows that pass, with all their columns.  Texts are measured a second time instead of being shuffled."""
    prefix = "_q_"
    while any(c.lower().startswith(prefix) for c in docs.columns):
        prefix += "_"
    narrow = docs.select(F.col(text).alias("text"), F.col(lang).alias("lang"), F.col(source).alias("source"))
    counts = add_columns(narrow, "text", measure, {c: "bigint" for c in COUNTS}, drop=["text"])
    limits = stored(fences(sketches(counts)), "quality-fences")
    rows = judged(measured(docs, text, prefix), limits, lang, source, prefix)
    return rows.where(F.col(f"{prefix}kept")).select(*[F.col(f"`{c}`") for c in docs.columns])


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality_rules(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
