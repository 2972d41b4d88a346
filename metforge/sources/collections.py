"""Features of large GeoJSON documents, cut out over byte ranges.

A file is read in pieces that end at closing braces, so it splits anywhere.  Whether a piece starts inside a string, how
deep it lies and which feature it belongs to are running sums: within a block of the file (what one task reads), carried
from block to block by one row each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from metforge.operators.skew import lookup_join
from metforge.session import materialize, stored

BLOCK = ["file", "block"]
# up to the first brace outside of strings, and from there on; possessive, so that long strings need no stack
_BODY = r'(?s)^[^"{]*+(?:"[^"\\]*+(?:\\.[^"\\]*+)*+"[^"{]*+)*+(\{.*)$'


def _times(text: Column, mark: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(mark), F.lit("")))


def _opens(bare: Column, within: bool) -> Column:
    """Opening braces outside of strings, of a piece that starts ``within`` a string or not."""
    text = F.concat(F.lit('"'), bare) if within else bare
    return _times(F.regexp_replace(text, '"[^"]*+(?:"|$)', ""), "{")


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """``file, block, at, value, quotes, opens_out, opens_in``; ``at`` orders the pieces of a block."""
    raw = spark.read.option("lineSep", "}").text(path)
    rows = raw.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"), "value"
    )
    bare = F.regexp_replace("value", r"(?s)\\.", "")  # no escape contains a brace, so none is cut in two
    return rows.withColumns({"quotes": _times(bare, '"'), "opens_out": _opens(bare, False), "opens_in": _opens(bare, True)})


def _depths(pieces: DataFrame, start: Column) -> tuple[Column, Column]:
    """Of each piece, in a block that starts in a string (``start`` = 1) or not: change of depth, and if it ends outside of strings."""
    upto = F.sum("quotes").over(W.partitionBy(*BLOCK).orderBy("at")) + start
    closes = upto % 2 == 0
    opens = F.when((upto - F.col("quotes")) % 2 == 0, F.col("opens_out")).otherwise(F.col("opens_in"))
    return opens - closes.cast("int"), closes


def _before(value: str) -> Column:
    by = W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    return F.coalesce(F.sum(value).over(by), F.lit(0))


def _blocks(pieces: DataFrame) -> DataFrame:
    """``file, block, start, depth``: the state in which each block begins."""
    narrow = pieces.select(*BLOCK, "at", "quotes", "opens_out", "opens_in")
    change = {f"change_{k}": _depths(narrow, F.lit(k))[0] for k in (0, 1)}
    sums = narrow.withColumns(change).groupBy(*BLOCK).agg(*[F.sum(c).alias(c) for c in ("quotes", *change)])
    begun = sums.withColumn("start", _before("quotes") % 2)
    return begun.withColumn("change", F.when(F.col("start") == 0, F.col("change_0")).otherwise(F.col("change_1"))).select(
        *BLOCK, "start", _before("change").alias("depth")
    )


def _ended(pieces: DataFrame, blocks: DataFrame) -> DataFrame:
    """``pieces`` with ``ends``: 1 where an object directly below the document ends."""
    rows = lookup_join(pieces, blocks, BLOCK)
    change, closes = _depths(rows, F.col("start"))
    depth = F.col("depth") + F.sum("_change").over(W.partitionBy(*BLOCK).orderBy("at"))
    return rows.withColumns({"_change": change, "_closes": closes}).withColumn("ends", ((depth == 1) & F.col("_closes")).cast("int"))


def feature_objects(spark: SparkSession, path: str) -> DataFrame:
    """``file, value``: the objects one level below the documents of a folder or file, each as JSON text.

    Objects other than features, such as a reference system, are among them.  A document that is no collection, or
    an empty file, gives no feature; an object that the file does not end is left out.
    """
    pieces = stored(_pieces(spark, path), "pieces")
    blocks = materialize(_blocks(pieces))
    narrow = pieces.select(*BLOCK, "at", "quotes", "opens_out", "opens_in")
    ends = _ended(narrow, blocks).groupBy(*BLOCK).agg(F.sum("ends").alias("n_ends"))
    begun = materialize(ends.withColumn("first", _before("n_ends")).select(*BLOCK, "first"))
    rows = lookup_join(_ended(pieces, blocks), begun, BLOCK)
    earlier = F.coalesce(F.sum("ends").over(W.partitionBy(*BLOCK).orderBy("at").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    parts = rows.withColumn("no", F.col("first") + earlier).groupBy("file", "no").agg(
        F.array_sort(F.collect_list(F.struct("block", "at", "value"))).alias("parts"), F.max("ends").alias("ends")
    )
    text = F.concat(F.array_join(F.transform("parts", lambda p: p["value"]), "}"), F.lit("}"))
    # the first object follows the brace of the document itself
    inner = F.when(F.col("no") == 0, F.regexp_replace(text, r"^[^{]*+\{", "")).otherwise(text)
    return parts.where("ends = 1").select("file", F.regexp_extract(inner, _BODY, 1).alias("value"))
