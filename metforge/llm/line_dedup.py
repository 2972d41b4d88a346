"""Line dedup by overlapping windows of three lines.

Every window of three consecutive lines is hashed to 128 bits; of windows found more than once
in the corpus the first (smallest document id, then first line) stays, and the lines that later
ones cover go.  A window without any visible character does not count.  Covered positions are
merged by comparing each removed window with the one before it, so a document of any number of
lines is rebuilt in one pass over its lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from metforge.llm.common import fresh, table
from metforge.session import stored

LINES = 3
BLANK = "[\\x20\\x09-\\x0D]*"


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _windows(rows: DataFrame) -> DataFrame:
    """``(doc_id, version, pos, h1, h2)`` of every window; ``pos`` counts from 0."""
    lines = F.col("lines")
    part = lambda i: [F.get(lines, i + j) for j in range(LINES)]
    made = F.transform(
        F.sequence(F.lit(0), F.size(lines) - LINES),
        lambda i: F.struct(
            i.alias("pos"), F.xxhash64(*part(i)).alias("h1"), F.xxhash64(F.lit("second"), *part(i)).alias("h2"),
            F.forall(F.slice(lines, i + 1, LINES), lambda x: x.rlike(f"^{BLANK}$")).alias("blank"),
        ),
    )
    rows = rows.withColumn("lines", _lines(F.col("text"))).where(F.size("lines") >= LINES)
    return rows.select("doc_id", "version", F.explode(made).alias("w")).where("NOT w.blank").select("doc_id", "version", "w.pos", "w.h1", "w.h2")


def removed_lines(rows: DataFrame) -> DataFrame:
    """``(doc_id, version, kept, last, n_removed, n_spans)`` of the documents that lose lines.

    ``kept`` are the runs of lines (start from 1, length) before ``last``, the last covered line.
    """
    found = stored(_windows(rows), "line-windows")
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "version", "pos")
    # stored, so that both sides of the join are plain shuffles, which adaptive execution can split at a hot window
    firsts = stored(
        found.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"), "line-firsts"
    )
    later = found.join(firsts.hint("merge"), ["h1", "h2"]).where(place != F.col("first")).select("doc_id", "version", "pos")
    before = F.coalesce(F.lag("pos").over(W.partitionBy("doc_id", "version").orderBy("pos")), F.lit(-LINES))
    gap = F.col("pos") - F.col("before") - LINES
    run = F.when(gap > 0, F.struct((F.col("before") + LINES + 1).alias("start"), gap.alias("length")))
    opens = (gap > 0) | (F.col("before") < 0)
    return later.withColumn("before", before).groupBy("doc_id", "version").agg(
        F.array_sort(F.collect_list(run)).alias("kept"),
        (F.max("pos") + LINES).alias("last"),
        F.sum(F.least(F.lit(LINES), F.col("pos") - F.col("before")).cast("bigint")).alias("n_removed"),
        F.sum(opens.cast("bigint")).alias("n_spans"),
    )


def _rejoined(docs: DataFrame, doc_id: str, text: str, names: dict[str, str]) -> DataFrame:
    """``docs`` with the lines kept and the counts, under ``names``."""
    version = F.xxhash64(F.col(text))  # tells apart rows that share an id
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), version.alias("version")).where("text IS NOT NULL")
    key, ver = fresh(docs, "_key"), fresh(docs, "_version")
    prefix = fresh(docs, "_line")
    side = removed_lines(rows).select(F.col("doc_id").alias(key), F.col("version").alias(ver), *[F.col(c).alias(prefix + c) for c in ("kept", "last", "n_removed", "n_spans")])
    split = fresh(docs, "_split")  # a column of its own, so that a text is split once
    joined = docs.join(side, F.col(doc_id).eqNullSafe(F.col(key)) & (version == F.col(ver)), "left").withColumn(split, _lines(F.col(text)))
    lines, last = F.col(split), F.col(f"{prefix}last")
    pieces = F.transform(F.col(f"{prefix}kept"), lambda r: F.slice(lines, r["start"], r["length"]))
    rest = F.slice(lines, last + 1, F.greatest(F.size(lines) - last, F.lit(0)))
    out = joined.withColumns({
        names["text"]: F.when(last.isNull(), F.col(text)).otherwise(F.array_join(F.concat(F.flatten(pieces), rest), "\n")),
        names["n_lines"]: F.when(F.col(text).isNull(), 0).otherwise(F.size(lines)).cast("bigint"),
        names["n_removed"]: F.coalesce(F.col(f"{prefix}n_removed"), F.lit(0).cast("bigint")),
        names["n_spans"]: F.coalesce(F.col(f"{prefix}n_spans"), F.lit(0).cast("bigint")),
    })
    return out.drop(key, ver, split, *[prefix + c for c in ("kept", "last", "n_removed", "n_spans")])


def line_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, n_lines, n_removed, n_spans, text`` (the lines kept).

    A null text has no lines and stays null; a text of fewer than three lines stays as it is; null ids come last in
    the order of documents.  Rows that repeat id and text are one document; other rows that share
    an id are told apart, and ordered, by a hash of their text.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("raw"))
    out = _rejoined(rows, "doc_id", "raw", {c: c for c in ("text", "n_lines", "n_removed", "n_spans")})
    return out.select("doc_id", "n_lines", "n_removed", "n_spans", "text")


def drop_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", n_chars: str = "n_chars") -> DataFrame:
    """All columns of ``docs`` with the lines kept as text and ``n_chars`` (if there) counted anew.

    Rows that lose every line, copies that say nothing new, go.
    """
    names = {c: fresh(docs, f"_{c}_made") for c in ("text", "n_lines", "n_removed", "n_spans")}
    out = _rejoined(docs, doc_id, text, names)
    out = out.where((F.col(names["n_removed"]) == 0) | (F.col(names["n_removed"]) < F.col(names["n_lines"])))
    made = F.col(names["text"])
    changed = F.col(names["n_removed"]) > 0
    columns = []
    for c in docs.columns:
        value = F.col(f"`{c}`")
        if c == text:
            value = made
        elif c == n_chars:
            value = F.when(changed, F.length(made).cast(docs.schema[c].dataType)).otherwise(value)
        columns.append(value.alias(c))
    return out.select(*columns)


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup(table(spark, sf_dir, "documents"))


SQL = r"""
WITH d AS (SELECT doc_id, text, string_split(text, chr(10)) AS l FROM documents),
w AS (
  SELECT doc_id, p, l[p] || chr(10) || l[p + 1] || chr(10) || l[p + 2] AS s
  FROM (SELECT doc_id, l, unnest(range(1, len(l) - 1)) AS p FROM d)
),
r AS (
  SELECT doc_id, p FROM (
    SELECT doc_id, p, row_number() OVER (PARTITION BY s ORDER BY doc_id, p) AS k
    FROM w WHERE regexp_matches(s, '[^\x20\x09-\x0D]')
  ) WHERE k > 1
),
c AS (SELECT DISTINCT doc_id, p + o AS i FROM r CROSS JOIN (SELECT unnest([0, 1, 2]) AS o)),
e AS (SELECT doc_id, unnest(l) AS line, unnest(range(1, len(l) + 1)) AS i FROM d),
m AS (
  SELECT e.doc_id, e.line, e.i, c.i IS NOT NULL AS gone, b.i IS NULL AS opens
  FROM e LEFT JOIN c ON c.doc_id = e.doc_id AND c.i = e.i LEFT JOIN c AS b ON b.doc_id = e.doc_id AND b.i = e.i - 1
)
SELECT d.doc_id, COALESCE(len(d.l), 0) AS n_lines, COALESCE(x.n_removed, 0) AS n_removed,
  COALESCE(x.n_spans, 0) AS n_spans, CASE WHEN d.text IS NOT NULL THEN COALESCE(x.text, '') END AS text
FROM d LEFT JOIN (
  SELECT doc_id, count(*) FILTER (gone) AS n_removed, count(*) FILTER (gone AND opens) AS n_spans,
    string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone) AS text
  FROM m GROUP BY doc_id
) AS x ON x.doc_id = d.doc_id
"""
