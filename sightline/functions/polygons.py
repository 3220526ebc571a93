"""Convex polygons as arrays of corners (x, y): area and clipping, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

CORNERS = "array<struct<x: double, y: double>>"


def _once(x: Column, f) -> Column:
    """f of x, which is bound as the element of an array of one, so that it isn't worked out for every use."""
    return F.element_at(F.transform(F.array(x), f), 1)


def _next(p: Column, k: Column) -> Column:
    return F.get(p, F.when(k + 1 < F.size(p), k + 1).otherwise(0))


def _point(x: Column, y: Column) -> Column:
    return F.struct(x.alias("x"), y.alias("y"))


def _signed(p: Column) -> Column:
    """Twice the area, positive if the corners go from x to y."""
    turns = F.transform(p, lambda a, k: a["x"] * _next(p, k)["y"] - _next(p, k)["x"] * a["y"])
    return F.aggregate(turns, F.lit(0.0), lambda s, v: s + v)


def polygon_area(corners: Column) -> Column:
    """Of a polygon without crossings; 0 for fewer than three corners, null for null."""
    return _once(corners, lambda p: F.when(F.size(p) < 3, 0.0).otherwise(F.abs(_signed(p)) / 2))


def clip_convex(subject: Column, clip: Column) -> Column:
    """The part of a polygon inside a convex one, both of CORNERS in either direction; empty where they don't meet.

    A fold over the clipping edges: each keeps the corners on its inner side and puts a corner
    where a side of the polygon crosses it. Corners on an edge are inside, so polygons that touch
    give a part without area. Null if either is null; a clip of fewer than three corners gives an
    empty one.
    """

    def cut(p: Column, a: Column, b: Column) -> Column:
        """The part of p left of the line from a to b."""
        side = lambda q: (b["x"] - a["x"]) * (q["y"] - a["y"]) - (b["y"] - a["y"]) * (q["x"] - a["x"])

        def corner(q: Column, r: Column) -> Column:
            def parts(s: Column) -> Column:
                share = s["q"] / F.nullif(s["q"] - s["r"], F.lit(0.0))
                cross = _point(q["x"] + share * (r["x"] - q["x"]), q["y"] + share * (r["y"] - q["y"]))
                crosses = ((s["q"] > 0) & (s["r"] < 0)) | ((s["q"] < 0) & (s["r"] > 0))
                kept = F.when(s["q"] >= 0, F.array(q)).otherwise(F.array().cast(CORNERS))
                return F.concat(kept, F.when(crosses, F.array(cross)).otherwise(F.array().cast(CORNERS)))

            return _once(F.struct(side(q).alias("q"), side(r).alias("r")), parts)

        return F.flatten(F.transform(p, lambda q, k: corner(q, _next(p, k))))

    def whole(c: Column) -> Column:
        """All edges of the clip in turn, its corners going so that the inside is left."""
        edges = F.transform(c, lambda a, k: F.struct(a.alias("a"), _next(c, k).alias("b")))
        return F.aggregate(edges, subject.cast(CORNERS), lambda p, e: cut(p, e["a"], e["b"]))

    ahead = _once(clip.cast(CORNERS), lambda c: F.when(_signed(c) < 0, F.reverse(c)).otherwise(c))
    return F.when(subject.isNotNull() & clip.isNotNull(), F.when(F.size(clip) < 3, F.array().cast(CORNERS)).otherwise(_once(ahead, whole)))
