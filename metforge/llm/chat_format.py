r"""Chat formatting in budgeted windows.

Prefix sums of turn tokens cut a conversation into spans of whole turns: a turn that lies inside
one stride of the sum joins the others inside it, a turn that crosses the end of a stride is
a window of its own, so no window of several new turns exceeds the stride.  Every later window
starts with the system turn and as many of the turns before it as the history budget holds; these
are repeated without loss, so each assistant text is a target exactly once.

Control strings cannot occur in a formatted text: ``\``, ``#``, ``<`` (and ``:`` in roles) are
replaced by a backslash and a letter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from metforge.llm.common import table

BUDGET = 512  # tokens of a window: system turn, history and new turns
HISTORY = 128  # of them for turns repeated
OVERHEAD = 4  # tokens that the marks of a turn count as
WORD = "[^\\x20\\x09-\\x0D]+"
ESCAPES = (("\\", "\\b"), ("#", "\\h"), ("<", "\\l"))  # in this order; undone in reverse
ROLE_ESCAPES = (*ESCAPES, (":", "\\c"))
END = "</turn>\n"
BLOCK = 256  # turn numbers summed together before the sums of blocks
NEXT = 4  # windows that can start within one history budget (at most the stride) after a turn


def escape(c: Column, pairs: tuple = ESCAPES) -> Column:
    for old, new in pairs:
        c = F.replace(c, F.lit(old), F.lit(new))
    return c


def unescape(c: Column, pairs: tuple = ESCAPES) -> Column:
    for old, new in reversed(pairs):
        c = F.replace(c, F.lit(new), F.lit(old))
    return c


def _placed(rows: DataFrame, budget: int, history: int) -> DataFrame:
    """Turns with ``pos`` (from 1), ``before`` (tokens before, without the system turn), ``system`` and ``window``."""
    tokens = F.regexp_count("text", F.lit(WORD)) + OVERHEAD
    rows = rows.withColumn("tokens", tokens.cast("bigint")).withColumn("block", F.floor(F.col("turn") / BLOCK))
    inside = W.partitionBy("conv", "block").orderBy(F.col("turn").asc_nulls_last(), "role", "text").rowsBetween(W.unboundedPreceding, -1)
    rows = rows.withColumn("in_before", F.coalesce(F.sum("tokens").over(inside), F.lit(0))).withColumn("in_pos", F.count(F.lit(1)).over(inside))
    over = W.partitionBy("conv").orderBy(F.col("block").asc_nulls_last()).rowsBetween(W.unboundedPreceding, -1)
    first = F.min_by(F.struct("role", "tokens"), F.col("in_pos"))
    blocks = rows.groupBy("conv", "block").agg(F.sum("tokens").alias("t"), F.count(F.lit(1)).alias("n"), first.alias("first"))
    head = F.first("first").over(W.partitionBy("conv").orderBy(F.col("block").asc_nulls_last()))
    blocks = blocks.select(
        F.col("conv").alias("conv_b"), F.col("block").alias("block_b"), F.coalesce(F.sum("t").over(over), F.lit(0)).alias("block_before"),
        F.coalesce(F.sum("n").over(over), F.lit(0)).alias("block_pos"), head.alias("head"),
    )
    rows = rows.join(blocks, F.col("conv").eqNullSafe(F.col("conv_b")) & F.col("block").eqNullSafe(F.col("block_b")))
    led = F.col("head.role") == "system"
    rows = rows.withColumn("pos", F.col("block_pos") + F.col("in_pos") + 1).withColumn("system", led & (F.col("pos") == 1))
    own = F.when(led, F.col("head.tokens")).otherwise(0)
    before = F.when(F.col("system"), 0).otherwise(F.col("block_before") + F.col("in_before") - own)
    rows = rows.withColumn("before", before).withColumn("stride", F.greatest(F.lit(budget - history) - own, F.lit(max(history, budget // 4))))
    at = F.floor(F.col("before") / F.col("stride"))
    crosses = ~F.col("system") & (F.floor((F.col("before") + F.col("tokens") - 1) / F.col("stride")) > at)
    window = F.when(F.col("system"), 0).otherwise(2 * at + crosses.cast("bigint"))
    return rows.select("conv", "pos", "role", "text", "tokens", "before", "system", window.cast("bigint").alias("window"))


def chat_windows(
    turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", budget: int = BUDGET, history: int = HISTORY
) -> DataFrame:
    """One row per window: ``conv_id, window, formatted, n_tokens, n_turns, n_context, loss``.

    ``n_context`` turns at the head are repeated ones; ``loss`` lists the spans (start, end in code
    points of ``formatted``) to learn.  Turns are ordered by number, then role and text; null roles and texts are
    empty, rows with a null number come last, null conversations are one.  A turn beyond the budget is a window by itself, whole.
    """
    if not 0 <= history <= budget // 2:
        raise ValueError("the history may take half of the budget at most")
    rows = turns.select(
        F.col(conv).alias("conv"), F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text")
    )
    placed = _placed(rows, budget, history)
    head = F.concat(F.lit("### "), escape(F.col("role"), ROLE_ESCAPES), F.lit(": "))
    body = escape(F.col("text"))
    placed = placed.withColumn("head", head).withColumn("body", body)
    order = W.partitionBy("conv").orderBy("window")
    starts = placed.groupBy("conv", "window").agg(F.min(F.when(~F.col("system"), F.col("before"))).alias("start"))
    nexts = [F.lead(F.struct("window", "start"), k).over(order).alias(f"next{k}") for k in range(1, NEXT + 1)]
    starts = starts.select(F.col("conv").alias("conv_w"), F.col("window").alias("window_w"), *nexts)
    placed = placed.join(starts, F.col("conv").eqNullSafe(F.col("conv_w")) & (F.col("window") == F.col("window_w")))
    later = F.filter(F.array(*[F.col(f"next{k}") for k in range(1, NEXT + 1)]), lambda n: n.isNotNull() & (n["start"] - F.col("before") <= history))
    copies = F.concat(F.array(F.struct(F.lit(2).alias("kind"), "window")), F.transform(F.when(F.col("system"), F.array().cast(later_type())).otherwise(later), lambda n: F.struct(F.lit(1).alias("kind"), n["window"].alias("window"))))
    used = placed.select("conv", "pos", "role", "tokens", "head", "body", F.explode(copies).alias("c")).select("conv", "c.window", "c.kind", "pos", "role", "tokens", "head", "body")
    lead = placed.where("system").select(F.col("conv").alias("conv_s"), F.lit(0).alias("kind"), "pos", "role", "tokens", "head", "body")
    others = starts.where("window_w > 0").select(F.col("conv_w").alias("conv"), F.col("window_w").alias("window"))
    again = others.join(lead, F.col("conv").eqNullSafe(F.col("conv_s"))).drop("conv_s")
    used = used.unionByName(again)
    entry = F.struct("kind", "pos", "role", "tokens", "head", "body")
    made = used.groupBy("conv", "window").agg(F.array_sort(F.collect_list(entry)).alias("turns"))
    piece = F.transform("turns", lambda t: F.concat(t["head"], t["body"], F.lit(END)))
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("loss"))

    def step(acc: Column, t: Column) -> Column:  # windows are bounded by the budget, so these lists are short
        start = acc["at"] + F.length(t["head"])
        end = start + F.length(t["body"])
        new = F.when((t["kind"] == 2) & (t["role"] == "assistant"), F.array(F.struct(start.alias("start"), end.alias("end")))).otherwise(F.array().cast("array<struct<start:int,end:int>>"))
        return F.struct((end + len(END)).alias("at"), F.concat(acc["loss"], new).alias("loss"))

    return made.select(
        F.col("conv").alias("conv_id"), "window", F.array_join(piece, "").alias("formatted"),
        F.aggregate("turns", F.lit(0).cast("bigint"), lambda a, t: a + t["tokens"]).alias("n_tokens"),
        F.size("turns").alias("n_turns"), F.size(F.filter("turns", lambda t: t["kind"] < 2)).alias("n_context"),
        F.aggregate("turns", zero, step, lambda a: a["loss"]).alias("loss"),
    )


def later_type() -> str:
    return "array<struct<window:bigint,start:bigint>>"


def read_back(windows: DataFrame) -> DataFrame:
    """``conv_id, window, turns, targets``: what the formatted texts say, without the repeated turns."""
    pieces = F.split("formatted", END)
    own = F.slice(pieces, F.col("n_context") + 1, F.col("n_turns") - F.col("n_context"))
    parsed = F.transform(own, lambda p: F.struct(
        unescape(F.substring(F.substring_index(p, ": ", 1), F.lit(5), F.length(p)), ROLE_ESCAPES).alias("role"),
        unescape(F.substring(p, F.length(F.substring_index(p, ": ", 1)) + 3, F.length(p))).alias("text"),
    ))
    targets = F.transform("loss", lambda s: unescape(F.substring("formatted", s["start"] + 1, s["end"] - s["start"])))
    return windows.select("conv_id", "window", F.length("formatted").alias("chars"), parsed.alias("turns"), targets.alias("targets"))


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hard = "\\### Assistant: </turn> ok"
    extra = spark.range(2).select(
        F.lit(-7).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(hard).alias("text"),
    )
    back = read_back(chat_windows(turns.unionByName(extra)))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    parts = back.select("conv_id", F.struct("window", F.size("turns").alias("n"), said.alias("said"), F.array_join("targets", "").alias("loss"), "chars").alias("w"))
    # the digests are of whole conversations, so here, and only here, a conversation is put together
    whole = parts.groupBy("conv_id").agg(F.array_sort(F.collect_list("w")).alias("w"))
    loss = F.array_join(F.transform("w", lambda w: w["loss"]), "")
    total = lambda name: F.aggregate("w", F.lit(0).cast("bigint"), lambda a, w: a + w[name])
    return whole.select(
        "conv_id", total("n").alias("n_turns"), F.sha2(F.array_join(F.transform("w", lambda w: w["said"]), ""), 256).alias("turns_sha256"),
        F.length(loss).cast("bigint").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"), total("chars").alias("formatted_chars"),
    )


SQL = rf"""
WITH c AS (
  SELECT conv_id, turn, role, text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
),
t AS (
  SELECT conv_id, COALESCE(role, '') AS role, COALESCE(text, '') AS text,
    len(regexp_extract_all(COALESCE(text, ''), '[^\x20\x09-\x0D]+')) + {OVERHEAD} AS tokens,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS LAST, COALESCE(role, ''), COALESCE(text, '')) AS pos
  FROM c
),
u AS (
  SELECT *, pos = 1 AND role = 'system' AS system,
    max(CASE WHEN pos = 1 AND role = 'system' THEN tokens ELSE 0 END) OVER (PARTITION BY conv_id) AS own,
    CAST(COALESCE(sum(tokens) OVER (PARTITION BY conv_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS sofar,
    length(replace(replace(replace(replace(role, '\', '\b'), '#', '\h'), '<', '\l'), ':', '\c'))
      + length(replace(replace(replace(text, '\', '\b'), '#', '\h'), '<', '\l')) + {len('### : ') + len(END)} AS chars
  FROM t
),
v AS (
  SELECT *, CASE WHEN system THEN 0 ELSE sofar - own END AS before, greatest({BUDGET - HISTORY} - own, {max(HISTORY, BUDGET // 4)}) AS stride FROM u
),
w AS (
  SELECT *, CASE WHEN system THEN 0 ELSE 2 * (before // stride) + CASE WHEN (before + tokens - 1) // stride > before // stride THEN 1 ELSE 0 END END AS win FROM v
),
s AS (SELECT conv_id, win, min(before) FILTER (NOT system) AS start FROM w GROUP BY conv_id, win),
f AS (
  SELECT w.conv_id, sum(w.chars) AS chars FROM w GROUP BY w.conv_id
  UNION ALL
  SELECT w.conv_id, sum(w.chars) FROM w JOIN s ON s.conv_id = w.conv_id AND s.win > w.win AND (w.system OR s.start - w.before <= {HISTORY}) GROUP BY w.conv_id
),
g AS (SELECT conv_id, CAST(sum(chars) AS BIGINT) AS formatted_chars FROM f GROUP BY conv_id)
SELECT t.conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY pos)) AS turns_sha256,
  CAST(COALESCE(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(COALESCE(string_agg(text, '' ORDER BY pos) FILTER (role = 'assistant'), '')) AS loss_sha256,
  any_value(g.formatted_chars) AS formatted_chars
FROM t JOIN g ON g.conv_id = t.conv_id GROUP BY t.conv_id
"""
