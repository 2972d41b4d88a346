"""Points in polygons, shares of cells and meeting boundaries, edge by edge.

No row ever carries a whole ring.  Edges are exploded to the lattice rows they run through and joined on row or
bucket keys; what a ring as a whole decides is a running sum along one row:

* a point lies inside if an odd number of edges cross its row to the west of it;
* the share of a cell that is covered is the height of all edges west of it in its row, signed by direction, plus what the
  edges inside the cell cover of it.

A window holds one row of one polygon, so its size does not depend on the number of polygons or rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from metforge.functions import geometry as geo
from metforge.operators.skew import lookup_join
from metforge.session import stored

EDGE = ["ax", "ay", "bx", "by"]
KEYS = 8  # points of one key, or keys of a long edge
RUN = 64  # lattice columns of one key
LEAST_SHARE = 1e-9  # smaller shares of a cell are rounding


def edge_table(geoms: DataFrame, gid: str, rings: str = "rings") -> DataFrame:
    """``gid, ax, ay, bx, by``: one row per boundary segment."""
    return geoms.select(gid, F.explode(geo.edges(F.col(rings))).alias("_e")).select(gid, *[F.col(f"_e.{c}") for c in EDGE])


def _size(level: Column, base: float) -> Column:
    return F.lit(base) * F.pow(F.lit(2.0), level)


def _crossing(y: Column) -> tuple[Column, Column]:
    """Whether an edge crosses the row of ``y``, lower end included, and where."""
    crosses = (F.col("ay") > y) != (F.col("by") > y)
    at = F.col("ax") + (y - F.col("ay")) * ((F.col("bx") - F.col("ax")) / (F.col("by") - F.col("ay")))
    return crosses, F.when(crosses, at)


def _side(x: Column, y: Column) -> Column:
    """Sign of the turn from the edge to the point; 0 on its line.  No division, so exact for coordinates that products hold."""
    return (F.col("bx") - F.col("ax")) * (y - F.col("ay")) - (x - F.col("ax")) * (F.col("by") - F.col("ay"))


def points_in_polygons(points: DataFrame, edges: DataFrame, point_id: str, gid: str, base: float = 1.0) -> DataFrame:
    """``(point_id, gid)`` of the points ``(point_id, _x, _y)`` inside a polygon, boundary excluded.

    ``edges`` is ``gid, ax, ay, bx, by``.  ``base`` is the typical distance of rows and only affects speed.  Points
    without coordinates are in no polygon.
    """
    points = points.where(F.col("_x").isNotNull() & F.col("_y").isNotNull() & ~F.isnan("_x") & ~F.isnan("_y"))
    band = lambda c: F.floor(c / F.lit(base))
    low, high = F.least("ay", "by"), F.greatest("ay", "by")
    banded = edges.withColumn("_band", F.explode(F.sequence(band(low), band(high))))
    rows = points.select("_y").distinct().withColumn("_band", band(F.col("_y")))
    crosses, at = _crossing(F.col("_y"))
    met = lookup_join(banded, rows, "_band").where((F.col("_y") >= low) & (F.col("_y") <= high)).withColumn("_at", at)
    touches = F.col("_at").isNull() & ((F.col("ay") == F.col("_y")) | (F.col("by") == F.col("_y")))
    seen = Observation()
    met = met.select(gid, "_y", *EDGE, "_at").observe(seen, F.max(F.greatest(*[F.abs(c) for c in EDGE])).alias("widest"), F.count_if(touches).alias("touching"))
    met = stored(met, "row-edges")
    slack = 1e-12 * max(seen.get["widest"] or 1.0, 1.0)  # more than the rounding of a crossing

    crossing = met.where(F.col("_at").isNotNull())
    spans = crossing.groupBy(gid, "_y").agg((F.min("_at") - slack).alias("_lo"), (F.max("_at") + slack).alias("_hi"))
    key = lambda c: F.floor(F.col(c) / F.lit(base * KEYS))
    keyed = spans.withColumn("_k", F.explode(F.sequence(key("_lo"), key("_hi"))))
    near = lookup_join(points.withColumn("_k", key("_x")), keyed, ["_y", "_k"]).where(F.col("_x").between(F.col("_lo"), F.col("_hi")))

    # crossings and points of one row of one polygon, in order of x
    none = F.lit(None).cast(points.schema[point_id].dataType)
    events = crossing.select(none.alias(point_id), gid, F.col("_at").alias("_x"), "_y", F.lit(1).alias("_edge"))
    merged = near.select(point_id, gid, "_x", "_y", F.lit(0).alias("_edge")).unionByName(events)
    until = lambda end: F.expr(f"sum(_edge) OVER (PARTITION BY `{gid}`, _y ORDER BY _x RANGE BETWEEN UNBOUNDED PRECEDING AND {slack!r}D {end})")
    counted = merged.withColumn("_west", F.coalesce(until("PRECEDING"), F.lit(0))).withColumn("_until", until("FOLLOWING")).where(F.col("_edge") == 0)
    clear = F.col("_west") == F.col("_until")
    close = Observation()
    counted = stored(counted.where(~clear | (F.col("_west") % 2 == 1)).drop("_edge").observe(close, F.count_if(~clear).alias("n")), "row-counts")
    inside = counted.where(clear).select(point_id, gid, "_x", "_y")
    if close.get["n"]:  # a crossing as near as rounding: all edges of the row by the exact test
        turn = _side(F.col("_x"), F.col("_y"))
        west = (turn != 0) & ((turn > 0) != (F.col("by") > F.col("ay")))
        exact = lookup_join(crossing, counted.where(~clear).select(point_id, gid, "_x", "_y"), [gid, "_y"]).groupBy(point_id, gid, "_x", "_y")
        exact = exact.agg(F.count_if(west).alias("_n"), F.bool_or(turn == 0).alias("_on")).where(~F.col("_on") & (F.col("_n") % 2 == 1))
        inside = inside.unionByName(exact.select(point_id, gid, "_x", "_y"))
    if seen.get["touching"]:  # edges that touch the row without crossing it have their points on the boundary
        end = lambda c: F.when(F.col(f"{c}y") == F.col("_y"), F.col(f"{c}x"))
        ends = met.where(touches).select(gid, "_y", F.least(end("a"), end("b")).alias("_lo"), F.greatest(end("a"), end("b")).alias("_hi")).distinct()
        on = lookup_join(inside, ends, [gid, "_y"]).where(F.col("_x").between(F.col("_lo"), F.col("_hi"))).select(point_id, gid).distinct()
        inside = lookup_join(inside, stored(on, "on-boundary"), [point_id, gid], "left_anti")
    return inside.select(point_id, gid)


def covered_runs(edges: DataFrame, gid: str, resolution: float, x0: float, y0: float) -> DataFrame:
    """``gid, row, first, last, w``: stretches of lattice cells of one row with the same covered share.

    Cell (0, 0) is centred at ``(x0, y0)``.  Rings run counter-clockwise, their holes clockwise.
    """
    to_cell = lambda c, origin: (F.col(c) - F.lit(origin)) / F.lit(resolution) + 0.5
    e = edges.select(gid, to_cell("ax", x0).alias("ax"), to_cell("ay", y0).alias("ay"), to_cell("bx", x0).alias("bx"), to_cell("by", y0).alias("by"))
    e = e.where(F.col("ay") != F.col("by"))  # level edges cover nothing
    rows = e.withColumn("row", F.explode(F.sequence(F.floor(F.least("ay", "by")), F.floor(F.greatest("ay", "by")))))
    # the part of an edge in a row, then the part of that in a column
    clamp = lambda v, lo: F.greatest(F.least(v, lo + 1.0), lo + 0.0)
    at = lambda y: F.least(F.greatest(F.col("ax") + (y - F.col("ay")) * ((F.col("bx") - F.col("ax")) / (F.col("by") - F.col("ay"))), F.least("ax", "bx")), F.greatest("ax", "bx"))
    rows = rows.withColumn("_p", clamp(F.col("ay"), F.col("row"))).withColumn("_q", clamp(F.col("by"), F.col("row")))
    rows = rows.where(F.col("_p") != F.col("_q")).withColumn("_u", at(F.col("_p"))).withColumn("_v", at(F.col("_q")))
    rows = rows.select(gid, "row", (F.col("_p") - F.col("_q")).alias("_d"), "_u", "_v")
    cols = rows.withColumn("col", F.explode(F.sequence(F.floor(F.least("_u", "_v")), F.floor(F.greatest("_u", "_v")))))
    left, right = clamp(F.least("_u", "_v"), F.col("col")), clamp(F.greatest("_u", "_v"), F.col("col"))
    share = F.coalesce(F.try_divide(right - left, F.abs(F.col("_u") - F.col("_v"))), F.lit(1.0))
    pieces = cols.select(gid, "row", "col", (F.col("_d") * share).alias("_d"), (F.col("col") + 1 - (left + right) / 2).alias("_part"))
    held = pieces.groupBy(gid, "row", "col").agg(F.sum("_d").alias("_d"), F.sum(F.col("_d") * F.col("_part")).alias("_a"))
    along = W.partitionBy(gid, "row").orderBy("col")
    before = F.coalesce(F.sum("_d").over(along.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0))
    held = held.withColumn("_before", before).withColumn("_next", F.lead("col").over(along))
    run = lambda first, last, w: F.struct(first.alias("first"), last.alias("last"), w.alias("w"))
    own = run(F.col("col"), F.col("col"), F.col("_before") + F.col("_a"))
    rest = run(F.col("col") + 1, F.col("_next") - 1, F.col("_before") + F.col("_d"))
    runs = held.select(gid, "row", F.inline(F.array(own, rest))).where((F.col("first") <= F.col("last")) & (F.col("w") > LEAST_SHARE))
    whole = F.abs(F.col("w") - 1.0) <= LEAST_SHARE
    return runs.withColumn("w", F.when(whole, 1.0).otherwise(F.col("w")))


def cell_shares(cells: DataFrame, edges: DataFrame, resolution: float, cell_id: str, gid: str, x: str, y: str) -> DataFrame:
    """``(cell_id, gid, w)``: share of each square cell that polygons cover, where positive.

    The centres must lie on one lattice of ``resolution``; a cell beside it is an error.
    """
    origin = cells.agg(F.min(x), F.min(y)).first()
    if origin[0] is None:
        return cells.select(cell_id).limit(0).join(edges.select(gid).limit(0)).withColumn("w", F.lit(1.0))
    number = lambda c, o: F.floor((F.col(c) - F.lit(o)) / F.lit(resolution) + 0.5)
    beside = lambda c, o: F.abs((F.col(c) - F.lit(o)) / F.lit(resolution) - number(c, o)) > 1e-6
    wrong = F.when(beside(x, origin[0]) | beside(y, origin[1]), F.raise_error(F.lit("cell centres do not lie on one lattice"))).otherwise(number(x, origin[0]))
    placed = cells.select(cell_id, number(y, origin[1]).alias("row"), wrong.cast("bigint").alias("_col")).withColumn("_k", F.floor(F.col("_col") / RUN))
    runs = covered_runs(edges, gid, resolution, *origin)
    runs = stored(runs, "covered-runs").withColumn("_k", F.explode(F.sequence(F.floor(F.col("first") / RUN), F.floor(F.col("last") / RUN))))
    met = lookup_join(placed, runs, ["row", "_k"]).where(F.col("_col").between(F.col("first"), F.col("last")))
    return met.select(cell_id, gid, "w")


def _keyed(edges: DataFrame, size: Column) -> DataFrame:
    """One row per bucket that the box of an edge touches."""
    span = lambda a, b: F.explode(F.sequence(F.floor(F.least(a, b) / size), F.floor(F.greatest(a, b) / size)))
    return edges.withColumn("_kx", span("ax", "bx")).withColumn("_ky", span("ay", "by"))


def meeting(left: DataFrame, right: DataFrame, left_id: str, right_id: str, base: float = 1.0) -> DataFrame:
    """``(left_id, right_id)`` of polygons whose boundaries share a point; both tables are edges.

    An edge has a bucket size by its length, so at most about a hundred buckets; two edges meet in the buckets of the longer one.
    """
    extent = F.greatest(F.abs(F.col("ax") - F.col("bx")), F.abs(F.col("ay") - F.col("by")), F.lit(base))
    level = F.greatest(F.lit(0), F.ceil(F.log2(extent / F.lit(base * KEYS))).cast("int"))
    a, b = (e.select(i, *EDGE, level.alias("_own")) for e, i in ((left, left_id), (right, right_id)))
    # binary orders of magnitude, so a few dozen integers
    at_levels = sorted(r[0] for r in a.select("_own").unionByName(b.select("_own")).distinct().collect())

    def spread(e: DataFrame) -> DataFrame:
        coarser = F.filter(F.array(*[F.lit(v) for v in at_levels]), lambda v: v >= F.col("_own"))
        return _keyed(e.withColumn("_level", F.explode(coarser)), _size(F.col("_level"), base))

    other = spread(b).select(right_id, F.col("_own").alias("_other"), "_level", "_kx", "_ky", *[F.col(c).alias(f"_{c}") for c in EDGE])
    pairs = lookup_join(spread(a), other, ["_level", "_kx", "_ky"]).where(F.col("_level") == F.greatest("_own", "_other"))
    meet = geo.segments_meet({c: F.col(c) for c in EDGE}, {c: F.col(f"_{c}") for c in EDGE})
    return pairs.where(meet).select(left_id, right_id).distinct()


def ring_starts(geoms: DataFrame, gid: str) -> DataFrame:
    """``gid, _x, _y``: the first vertex of every ring."""
    return geoms.select(gid, F.explode("rings").alias("_r")).select(gid, F.col("_r")[0]["x"].alias("_x"), F.col("_r")[0]["y"].alias("_y"))
