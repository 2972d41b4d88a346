"""Token counts of documents in flat token files without an index.

A token file is a run of fixed-width ids in which each document ends with an end-of-document id.
It is read as blocks of fixed size, cut anywhere.  Every block is searched for the separator with one
vectorised comparison; what crosses block ends is settled on one summary row per block by prefix
scans (tokens, separators and last separator so far), first inside runs of blocks, then
over the runs, so that a long file is not scanned by one task.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from metforge.llm.common import packed, table

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"  # parameter: ranks of a byte-level vocabulary
# Fixed value: the split pattern that belongs to the vocabulary
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
EOD = 50256  # the id that the vocabulary leaves free
BLOCK = 1 << 16  # ids in a block
RUN = 4096  # blocks scanned together


@cache
def _encoding(ranks: bytes) -> tiktoken.Encoding:
    made = {base64.b64decode(t): int(n) for t, n in map(bytes.split, ranks.splitlines()) if t}
    return tiktoken.Encoding("flat", pat_str=PATTERN, mergeable_ranks=made, special_tokens={})


def token_files(docs: DataFrame, vocabulary: str = VOCABULARY, doc_id: str = "doc_id", text: str = "text", block: int = BLOCK, eod: int = EOD) -> tuple[DataFrame, DataFrame]:
    """Blocks ``file, block, ids`` (two bytes an id) of one token file per input partition, and the
    manifest ``file, ordinal, doc_id`` of the documents in the order of the file."""
    spark = docs.sparkSession
    with open(vocabulary, "rb") as f:  # under 1 MB, whatever the corpus
        ranks = spark.sparkContext.broadcast(f.read())
    schema = "file int, block bigint, ids binary, ordinal bigint, doc_id bigint"
    kinds = pa.schema([("file", pa.int32()), ("block", pa.int64()), ("ids", pa.binary()), ("ordinal", pa.int64()), ("doc_id", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoding(ranks.value).encode_ordinary
        file, at, ordinal = TaskContext.get().partitionId(), 0, 0
        rest = np.zeros(0, np.uint16)

        def blocks(ids: list[np.ndarray]) -> pa.RecordBatch:
            n = len(ids)
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(
                ([file] * n, range(at, at + n), [i.tobytes() for i in ids], [None] * n, [None] * n), kinds.types, strict=True)], schema=kinds)

        for batch in batches:
            names = batch.column(0).to_pylist()
            n = len(names)
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(
                ([file] * n, [None] * n, [None] * n, range(ordinal, ordinal + n), names), kinds.types, strict=True)], schema=kinds)
            ordinal += n
            made = [rest]
            for t in batch.column(1).to_pylist():
                made.append(np.array([*encode(t or ""), eod], np.uint16))
            ids = np.concatenate(made)
            full = len(ids) // block
            if full:
                yield blocks(list(ids[: full * block].reshape(full, block)))
            at += full
            rest = ids[full * block :].copy()
        if len(rest):
            yield blocks([rest])

    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, schema)
    rows = packed(rows, "token-files")
    return rows.where("ids IS NOT NULL").select("file", "block", "ids"), rows.where("ids IS NULL").select("file", "ordinal", "doc_id")


def read_token_files(spark: SparkSession, path: str, block: int = BLOCK) -> DataFrame:
    """Blocks of flat files of two-byte ids, ``file`` being the path (files up to the 2 GB that a row can hold)."""
    size = block * 2
    files = spark.read.format("binaryFile").load(path).select(F.col("path").alias("file"), "content")
    at = F.sequence(F.lit(0).cast("bigint"), F.floor((F.octet_length("content") - 1) / size))
    cut = files.where(F.octet_length("content") > 0).select("file", F.explode(at).alias("block"), "content")
    return cut.select("file", "block", F.substring("content", (F.col("block") * size + 1).cast("int"), F.lit(size)).alias("ids"))


def scan(blocks: DataFrame, eod: int = EOD) -> DataFrame:
    """``file, block, n, first, last, inner``: ids and separators of each block; ``inner`` are the lengths between separators."""
    schema = f"{blocks.select('file', 'block')._jdf.schema().toDDL()}, n bigint, first bigint, last bigint, inner array<int>"
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for raw in batch.column(2).to_pylist():
                ids = np.frombuffer(raw, "<u2", len(raw) // 2)
                at = np.flatnonzero(ids == eod)
                ends = (int(at[0]), int(at[-1])) if len(at) else (None, None)
                rows.append((len(ids), *ends, np.diff(at) - 1))
            made = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)] if rows else [pa.array([], k) for k in kinds]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *made], names=["file", "block", "n", "first", "last", "inner"])

    return blocks.select("file", "block", "ids").mapInArrow(run, schema)


def count_tokens(blocks: DataFrame, eod: int = EOD) -> DataFrame:
    """``file, ordinal, n_tokens, complete`` of every document, in the order of its file.

    The separator is not counted; two separators in a row are an empty document.  Ids after the last
    separator of a file are a document that is not ``complete``.  Blocks that repeat are an error
    of the input; a file without ids has no documents.
    """
    seps = F.when(F.col("first").isNull(), 0).otherwise(F.size("inner") + 1).cast("bigint")
    rows = packed(scan(blocks, eod), "token-scan").withColumn("seps", seps).withColumn("run", F.floor(F.col("block") / RUN))
    before = W.partitionBy("file", "run").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    zero = lambda c: F.coalesce(c, F.lit(0))
    rows = rows.withColumns({"in_n": zero(F.sum("n").over(before)), "in_seps": zero(F.sum("seps").over(before))})
    rows = rows.withColumn("in_last", F.max(F.col("in_n") + F.col("last")).over(before))
    runs = rows.groupBy("file", "run").agg(F.sum("n").alias("run_n"), F.sum("seps").alias("run_seps"), F.max(F.col("in_n") + F.col("last")).alias("run_last"))
    over = W.partitionBy("file").orderBy("run").rowsBetween(W.unboundedPreceding, -1)
    runs = runs.withColumns({"from_n": zero(F.sum("run_n").over(over)), "from_seps": zero(F.sum("run_seps").over(over))})
    ending = F.row_number().over(W.partitionBy("file").orderBy(F.desc("run"))) == 1
    runs = runs.withColumn("from_last", F.max(F.col("from_n") + F.col("run_last")).over(over)).withColumn("ending", ending)
    rows = rows.join(runs.select("file", "run", "from_n", "from_seps", "from_last"), ["file", "run"])
    # the separator before this block, as a place in the file
    previous = F.coalesce(F.col("from_n") + F.col("in_last"), F.col("from_last"), F.lit(-1))
    head = F.col("from_n") + F.col("in_n") + F.col("first") - previous - 1
    lengths = F.concat(F.array(head), F.transform("inner", lambda x: x.cast("bigint")))
    done = rows.where("seps > 0").select("file", (F.col("from_seps") + F.col("in_seps")).alias("base"), F.posexplode(lengths).alias("i", "n_tokens"))
    done = done.select("file", (F.col("base") + F.col("i")).alias("ordinal"), "n_tokens", F.lit(True).alias("complete"))
    end, total = F.coalesce(F.col("from_n") + F.col("run_last"), F.col("from_last"), F.lit(-1)), F.col("from_n") + F.col("run_n")
    tail = runs.where(F.col("ending") & (total - end - 1 > 0)).select(
        "file", (F.col("from_seps") + F.col("run_seps")).alias("ordinal"), (total - end - 1).alias("n_tokens"), F.lit(False).alias("complete")
    )
    return done.unionByName(tail)


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id, n_tokens`` of all documents: written as flat token files, then counted by scanning these alone.

    A null or empty text has no tokens.  Rows that repeat an id are counted one by one.
    """
    blocks, manifest = token_files(table(spark, sf_dir, "documents"))
    counted = count_tokens(blocks).select("file", "ordinal", "n_tokens")
    return manifest.join(counted, ["file", "ordinal"], "left").select("doc_id", "n_tokens")
