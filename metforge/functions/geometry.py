"""Planar geometry over ring arrays.

A geometry is ``rings: array<array<struct<x:double,y:double>>>``.  Every ring is
closed (last vertex = first vertex); outer rings run counter-clockwise and are
followed by their holes, which run clockwise.  :func:`normalise_part` brings
rings into that form.  Points are one ring with one vertex.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

RING_TYPE = "array<struct<x:double,y:double>>"
RINGS_TYPE = f"array<{RING_TYPE}>"
EARTH_RADIUS_M = 6_371_008.8  # mean radius


def point(x: Column, y: Column) -> Column:
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))


def box_ring(x: Column, y: Column, half_width: Column | float, half_height: Column | float | None = None) -> Column:
    """Closed counter-clockwise rectangle around a centre."""
    w = half_width if isinstance(half_width, Column) else F.lit(float(half_width))
    h = w if half_height is None else half_height
    h = h if isinstance(h, Column) else F.lit(float(h))
    return F.array(
        point(x - w, y - h), point(x + w, y - h), point(x + w, y + h), point(x - w, y + h), point(x - w, y - h)
    )


def close_ring(ring: Column) -> Column:
    closed = (ring[0]["x"] == F.element_at(ring, -1)["x"]) & (ring[0]["y"] == F.element_at(ring, -1)["y"])
    return F.when(closed | (F.size(ring) < 2), ring).otherwise(F.concat(ring, F.slice(ring, 1, 1)))


def ring_edges(ring: Column) -> Column:
    n = F.size(ring) - 1
    return F.when(
        n > 0,
        F.zip_with(
            F.slice(ring, F.lit(1), n),
            F.slice(ring, F.lit(2), n),
            lambda a, b: F.struct(a["x"].alias("ax"), a["y"].alias("ay"), b["x"].alias("bx"), b["y"].alias("by")),
        ),
    ).otherwise(F.array().cast("array<struct<ax:double,ay:double,bx:double,by:double>>"))


def edges(rings: Column) -> Column:
    """All boundary segments as ``array<struct<ax,ay,bx,by>>``."""
    return F.flatten(F.transform(rings, ring_edges))


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, v: acc + v)


def signed_area(ring: Column) -> Column:
    """Shoelace area; positive for counter-clockwise rings."""
    return _sum(F.transform(ring_edges(ring), lambda e: (e["ax"] * e["by"] - e["bx"] * e["ay"]) / 2.0))


def normalise_part(rings: Column) -> Column:
    """Close the rings of one polygon and orient them: first outer, the others holes."""

    def oriented(ring: Column, i: Column) -> Column:
        ring = close_ring(ring)
        ccw = signed_area(ring) > 0
        return F.when(ccw == (i == 0), ring).otherwise(F.reverse(ring))

    return F.transform(rings, oriented)


def area(edge_list: Column) -> Column:
    """Area of oriented rings, holes taken off."""
    return _sum(F.transform(edge_list, lambda e: (e["ax"] * e["by"] - e["bx"] * e["ay"]) / 2.0))


def sphere_area(edge_list: Column, radius: float = EARTH_RADIUS_M) -> Column:
    """Area in m2 of oriented lon/lat rings on the sphere."""
    rad = lambda c: F.radians(c)
    terms = F.transform(
        edge_list, lambda e: rad(e["bx"] - e["ax"]) * (2 + F.sin(rad(e["ay"])) + F.sin(rad(e["by"])))
    )
    return F.abs(_sum(terms)) * (radius * radius / 2.0)


def centroid(edge_list: Column) -> Column:
    """Area-weighted centre of oriented rings, as ``struct<x,y>``."""
    zero = F.struct(F.lit(0.0).alias("a"), F.lit(0.0).alias("x"), F.lit(0.0).alias("y"))

    def add(acc: Column, e: Column) -> Column:
        cross = e["ax"] * e["by"] - e["bx"] * e["ay"]
        return F.struct(
            (acc["a"] + cross).alias("a"),
            (acc["x"] + (e["ax"] + e["bx"]) * cross).alias("x"),
            (acc["y"] + (e["ay"] + e["by"]) * cross).alias("y"),
        )

    return F.aggregate(
        edge_list,
        zero,
        add,
        lambda s: point(F.try_divide(s["x"], s["a"] * 3.0), F.try_divide(s["y"], s["a"] * 3.0)),
    )


def _cross(e: Column, x: Column, y: Column) -> Column:
    return (e["bx"] - e["ax"]) * (y - e["ay"]) - (x - e["ax"]) * (e["by"] - e["ay"])


def on_boundary(edge_list: Column, x: Column, y: Column) -> Column:
    return F.exists(
        edge_list,
        lambda e: (_cross(e, x, y) == 0)
        & x.between(F.least(e["ax"], e["bx"]), F.greatest(e["ax"], e["bx"]))
        & y.between(F.least(e["ay"], e["by"]), F.greatest(e["ay"], e["by"])),
    )


def contains(edge_list: Column, x: Column, y: Column) -> Column:
    """Even-odd test without division; a boundary point is not contained."""
    crossing = F.filter(
        edge_list,
        lambda e: ((e["ay"] > y) != (e["by"] > y)) & ((_cross(e, x, y) > 0) == (e["by"] > e["ay"])),
    )
    return (F.size(crossing) % 2 == 1) & ~on_boundary(edge_list, x, y)


def segments_meet(e: Column | dict[str, Column], f: Column | dict[str, Column]) -> Column:
    """Whether two closed segments ``ax, ay, bx, by`` share a point."""
    d1, d2 = _cross(e, f["ax"], f["ay"]), _cross(e, f["bx"], f["by"])
    d3, d4 = _cross(f, e["ax"], e["ay"]), _cross(f, e["bx"], e["by"])
    overlap = lambda lo, hi: (F.least(e[lo], e[hi]) <= F.greatest(f[lo], f[hi])) & (
        F.least(f[lo], f[hi]) <= F.greatest(e[lo], e[hi])
    )
    return (F.signum(d1) * F.signum(d2) <= 0) & (F.signum(d3) * F.signum(d4) <= 0) & overlap("ax", "bx") & overlap(
        "ay", "by"
    )


def intersects(edges_a: Column, edges_b: Column) -> Column:
    """Any shared point: segments that meet, or one polygon inside the other."""
    meet = F.exists(edges_a, lambda e: F.exists(edges_b, lambda f: segments_meet(e, f)))
    return meet | contains(edges_b, edges_a[0]["ax"], edges_a[0]["ay"]) | contains(
        edges_a, edges_b[0]["ax"], edges_b[0]["ay"]
    )


def bounds(rings: Column) -> Column:
    """``struct<min_x,min_y,max_x,max_y>``."""
    pts = F.flatten(rings)
    xs, ys = F.transform(pts, lambda p: p["x"]), F.transform(pts, lambda p: p["y"])
    return F.struct(
        F.array_min(xs).alias("min_x"),
        F.array_min(ys).alias("min_y"),
        F.array_max(xs).alias("max_x"),
        F.array_max(ys).alias("max_y"),
    )


def clip_half_plane(ring: Column, axis: str, limit: Column, keep_above: bool) -> Column:
    """Part of a closed ring on one side of an axis-parallel line, closed again."""
    other = "y" if axis == "x" else "x"
    inside = (lambda c: c >= limit) if keep_above else (lambda c: c <= limit)

    def cut(e: Column) -> Column:
        a, b = e[f"a{axis}"], e[f"b{axis}"]
        share = F.try_divide(limit - a, b - a)
        crossing = {axis: limit, other: e[f"a{other}"] + share * (e[f"b{other}"] - e[f"a{other}"])}
        crossing_point = F.array(point(crossing["x"], crossing["y"]))
        end_point = F.array(point(e["bx"], e["by"]))
        return (
            F.when(inside(a) & inside(b), end_point)
            .when(inside(a), crossing_point)
            .when(inside(b), F.concat(crossing_point, end_point))
            .otherwise(F.array().cast(RING_TYPE))
        )

    kept = F.flatten(F.transform(ring_edges(ring), cut))
    # a one-element array names the vertices, so that they are computed once
    closed = F.transform(F.array(kept), lambda k: F.when(F.size(k) > 0, F.concat(F.slice(k, -1, 1), k)).otherwise(k))
    return closed[0]


def _number(c: Column) -> Column:
    """Shortest decimal text, without trailing zeros."""
    text = c.cast("decimal(30,15)").cast("string")
    return F.regexp_replace(text, r"\.?0+$", "")


def _ring_text(ring: Column) -> Column:
    vertices = F.transform(ring, lambda p: F.concat_ws(" ", _number(p["x"]), _number(p["y"])))
    return F.concat(F.lit("("), F.array_join(vertices, ", "), F.lit(")"))


def wkt(geom_type: Column, rings: Column) -> Column:
    """Well-known text; a counter-clockwise ring starts a new part of a multipolygon."""
    texts = F.transform(
        rings,
        lambda r, i: F.concat(F.when((i > 0) & (signed_area(r) > 0), "), (").when(i > 0, ", ").otherwise(""), _ring_text(r)),
    )
    body = F.concat(F.lit("("), F.array_join(texts, ""), F.lit(")"))
    return (
        F.when(geom_type == "Point", F.concat(F.lit("POINT "), _ring_text(rings[0])))
        .when(geom_type == "Polygon", F.concat(F.lit("POLYGON "), body))
        .when(geom_type == "MultiPolygon", F.concat(F.lit("MULTIPOLYGON ("), body, F.lit(")")))
    )
