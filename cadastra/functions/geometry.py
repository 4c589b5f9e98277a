"""Planar geometry as Spark column expressions.

A multipolygon is array<polygon>, a polygon array<ring>, a ring array<struct<x,y>> closed on its first
point. All predicates run inside the JVM through higher-order functions. Callers put a box test in front of
them (see operators.filters), so they only see rows whose boxes already meet.
"""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

Box = tuple[float, float, float, float]
Coords = list[list[list[tuple[float, float]]]]

# Grid that coordinates are snapped to before adjacency tests, in degrees (about 0.1 mm).
SNAP = 1e-9


def let(value: Column, body) -> Column:
    """Evaluate `value` once and use it in `body` (higher-order functions do not share sub-expressions)."""
    return F.element_at(F.transform(F.array(value), body), 1)


def point(x: Column, y: Column) -> Column:
    """Point struct, null if either coordinate is null."""
    return F.when(x.isNotNull() & y.isNotNull(), F.struct(x.alias("x"), y.alias("y")))


def box(xmin: Column, ymin: Column, xmax: Column, ymax: Column) -> Column:
    """Box struct."""
    return F.struct(xmin.alias("xmin"), ymin.alias("ymin"), xmax.alias("xmax"), ymax.alias("ymax"))


def box_literal(bounds: Box) -> Column:
    """Box struct of constants."""
    return box(*[F.lit(float(v)) for v in bounds])


def multi(polygon: Column) -> Column:
    """Promote a polygon to a multipolygon; null stays null."""
    return F.when(polygon.isNotNull(), F.array(polygon))


def box_polygon(b: Column) -> Column:
    """Polygon (one ring, counter-clockwise) of a box struct."""
    corners = [("xmin", "ymin"), ("xmax", "ymin"), ("xmax", "ymax"), ("xmin", "ymax"), ("xmin", "ymin")]
    return F.array(F.array(*[F.struct(b[x].alias("x"), b[y].alias("y")) for x, y in corners]))


def rings(geom: Column) -> Column:
    """All rings of a multipolygon."""
    return F.flatten(geom)


def vertices(geom: Column) -> Column:
    """All vertices of a multipolygon."""
    return F.flatten(F.flatten(geom))


def vertex_count(geom: Column) -> Column:
    """Number of stored vertices."""
    return F.when(geom.isNotNull(), F.size(vertices(geom)))


def bbox_of(geom: Column) -> Column:
    """Box of a multipolygon; null when there is no vertex."""
    pts = vertices(geom)
    found = box(
        F.array_min(pts["x"]), F.array_min(pts["y"]), F.array_max(pts["x"]), F.array_max(pts["y"])
    )
    return F.when(F.size(pts) > 0, found)


def segments(ring: Column) -> Column:
    """Sides of a closed ring as array<struct<x1,y1,x2,y2>>."""
    n = F.greatest(F.size(ring) - 1, F.lit(0))
    return F.zip_with(
        F.slice(ring, F.lit(1), n),
        F.slice(ring, F.lit(2), n),
        lambda a, b: F.struct(a["x"].alias("x1"), a["y"].alias("y1"), b["x"].alias("x2"), b["y"].alias("y2")),
    )


def edges(geom: Column) -> Column:
    """All boundary segments as array<struct<x1,y1,x2,y2>>."""
    return F.flatten(F.transform(rings(geom), segments))


def ring_area(ring: Column) -> Column:
    """Signed area of a closed ring: positive when it runs counter-clockwise."""
    # Shoelace around the first vertex: small differences keep the digits that absolute longitudes lose.
    o = ring[0]
    return F.aggregate(
        segments(ring),
        F.lit(0.0),
        lambda acc, e: acc
        + ((e["x1"] - o["x"]) * (e["y2"] - o["y"]) - (e["x2"] - o["x"]) * (e["y1"] - o["y"])) / F.lit(2.0),
    )


def area(geom: Column) -> Column:
    """Area in squared coordinate units; holes (every ring after the first) are taken off."""
    return F.aggregate(
        geom,
        F.lit(0.0),
        lambda acc, poly: acc
        + F.aggregate(
            F.transform(poly, lambda ring, i: F.abs(ring_area(ring)) * F.when(i == 0, 1.0).otherwise(-1.0)),
            F.lit(0.0),
            lambda s, v: s + v,
        ),
    )


def centroid(geom: Column) -> Column:
    """Area-weighted centroid as a point; the vertex mean when the area is zero."""

    def ring_sums(ring: Column, sign: Column) -> Column:
        o = ring[0]
        zero = F.struct(F.lit(0.0).alias("a"), F.lit(0.0).alias("cx"), F.lit(0.0).alias("cy"))

        def step(acc: Column, e: Column) -> Column:
            x1, y1, x2, y2 = e["x1"] - o["x"], e["y1"] - o["y"], e["x2"] - o["x"], e["y2"] - o["y"]
            cross = x1 * y2 - x2 * y1
            return F.struct(
                (acc["a"] + cross).alias("a"),
                (acc["cx"] + (x1 + x2) * cross).alias("cx"),
                (acc["cy"] + (y1 + y2) * cross).alias("cy"),
            )

        def finish(acc: Column) -> Column:
            w = sign * F.when(acc["a"] < 0, -1.0).otherwise(1.0)
            return F.struct(
                (w * acc["a"]).alias("a"),
                (w * (acc["cx"] + F.lit(3.0) * acc["a"] * o["x"])).alias("cx"),
                (w * (acc["cy"] + F.lit(3.0) * acc["a"] * o["y"])).alias("cy"),
            )

        return F.aggregate(segments(ring), zero, step, finish)

    parts = F.flatten(
        F.transform(
            geom,
            lambda poly: F.transform(
                poly, lambda ring, i: ring_sums(ring, F.when(i == 0, 1.0).otherwise(-1.0))
            ),
        )
    )
    zero = F.struct(F.lit(0.0).alias("a"), F.lit(0.0).alias("cx"), F.lit(0.0).alias("cy"))
    total = F.aggregate(
        parts,
        zero,
        lambda acc, p: F.struct(
            (acc["a"] + p["a"]).alias("a"), (acc["cx"] + p["cx"]).alias("cx"), (acc["cy"] + p["cy"]).alias("cy")
        ),
    )
    pts = vertices(geom)
    n = F.size(pts)

    def mean(field: str) -> Column:
        return F.aggregate(pts[field], F.lit(0.0), lambda s, v: s + v) / n

    weighted = let(
        total,
        lambda t: F.when(
            t["a"] != 0,
            F.struct((t["cx"] / (F.lit(3.0) * t["a"])).alias("x"), (t["cy"] / (F.lit(3.0) * t["a"])).alias("y")),
        ),
    )
    return F.when(n > 0, F.coalesce(weighted, F.struct(mean("x").alias("x"), mean("y").alias("y"))))


def _inside(sides: Column, x: Column, y: Column) -> Column:
    """Even-odd test against an array of edges."""

    def crosses(e: Column) -> Column:
        spans = (e["y1"] > y) != (e["y2"] > y)
        along, across = (e["x2"] - e["x1"]) * (y - e["y1"]), (x - e["x1"]) * (e["y2"] - e["y1"])
        # Strictly left of the crossing, whichever way the edge runs.
        return spans & F.when(e["y2"] > e["y1"], across < along).otherwise(across > along)

    return F.aggregate(sides, F.lit(False), lambda inside, e: inside != crosses(e))


def contains_point(geom: Column, x: Column, y: Column) -> Column:
    """Even-odd test, holes included.

    Half-open on the boundary: a point shared by two polygons of a partition lies in exactly one of them.
    """
    return _inside(edges(geom), x, y)


def _cross(ax: Column, ay: Column, bx: Column, by: Column, px: Column, py: Column) -> Column:
    return (bx - ax) * (py - ay) - (by - ay) * (px - ax)


def _segment_meets_box(e: Column, b: Column) -> Column:
    corners = [
        _cross(e["x1"], e["y1"], e["x2"], e["y2"], b[x], b[y])
        for x, y in (("xmin", "ymin"), ("xmax", "ymin"), ("xmax", "ymax"), ("xmin", "ymax"))
    ]
    overlap = (
        (F.least(e["x1"], e["x2"]) <= b["xmax"])
        & (F.greatest(e["x1"], e["x2"]) >= b["xmin"])
        & (F.least(e["y1"], e["y2"]) <= b["ymax"])
        & (F.greatest(e["y1"], e["y2"]) >= b["ymin"])
    )
    return overlap & (F.least(*corners) <= 0) & (F.greatest(*corners) >= 0)


def intersects_box(geom: Column, b: Column) -> Column:
    """Exact closed test of a multipolygon against a box: touching counts."""

    def test(v: Column) -> Column:
        rim = F.exists(v["sides"], lambda e: _segment_meets_box(e, v["b"]))
        return rim | _inside(v["sides"], v["b"]["xmin"], v["b"]["ymin"])

    return let(F.struct(edges(geom).alias("sides"), b.alias("b")), test)


def _segments_meet(a: Column, b: Column) -> Column:
    overlap = (
        (F.least(a["x1"], a["x2"]) <= F.greatest(b["x1"], b["x2"]))
        & (F.greatest(a["x1"], a["x2"]) >= F.least(b["x1"], b["x2"]))
        & (F.least(a["y1"], a["y2"]) <= F.greatest(b["y1"], b["y2"]))
        & (F.greatest(a["y1"], a["y2"]) >= F.least(b["y1"], b["y2"]))
    )

    def straddles(p: Column, q: Column) -> Column:
        c1 = _cross(p["x1"], p["y1"], p["x2"], p["y2"], q["x1"], q["y1"])
        c2 = _cross(p["x1"], p["y1"], p["x2"], p["y2"], q["x2"], q["y2"])
        return ((c1 <= 0) & (c2 >= 0)) | ((c1 >= 0) & (c2 <= 0))

    return overlap & straddles(a, b) & straddles(b, a)


def _parts(geom: Column) -> Column:
    """Edges and the first vertex of every ring: what an intersection test needs of one side."""
    starts = F.transform(rings(geom), lambda r: r[0])
    return F.struct(edges(geom).alias("sides"), starts.alias("starts"))


def _parts_meet(a: Column, b: Column) -> Column:
    # Without a boundary crossing, rings are wholly inside or outside: one vertex per ring decides.
    rim = F.exists(a["sides"], lambda p: F.exists(b["sides"], lambda q: _segments_meet(p, q)))
    a_in_b = F.exists(a["starts"], lambda p: _inside(b["sides"], p["x"], p["y"]))
    b_in_a = F.exists(b["starts"], lambda p: _inside(a["sides"], p["x"], p["y"]))
    return rim | a_in_b | b_in_a


def intersects(a: Column, b: Column) -> Column:
    """Exact closed test of two multipolygons: boundaries meet or one holds a vertex of the other."""
    return let(F.transform(F.array(a, b), _parts), lambda v: _parts_meet(v[0], v[1]))


def intersects_constant(geom: Column, coords: Coords) -> Column:
    """As `intersects` against a constant multipolygon, whose edges are laid out once when the query is built."""
    found = [ring for poly in coords for ring in poly]
    sides = [
        {"x1": p[0], "y1": p[1], "x2": q[0], "y2": q[1]} for ring in found for p, q in zip(ring, ring[1:])
    ]
    starts = [{"x": ring[0][0], "y": ring[0][1]} for ring in found]
    fixed = F.from_json(
        F.lit(json.dumps({"sides": sides, "starts": starts})),
        "sides array<struct<x1: double, y1: double, x2: double, y2: double>>, "
        "starts array<struct<x: double, y: double>>",
    )
    return let(F.struct(_parts(geom).alias("a"), fixed.alias("b")), lambda v: _parts_meet(v["a"], v["b"]))


def _trapezoids(geom: Column) -> Column:
    """Signed trapezoids under every non-vertical edge; their indicator functions add up to the polygon's."""

    def of_ring(ring: Column, role: Column) -> Column:
        # The orientation of a ring is normalized, so clockwise and counter-clockwise input agree.
        sign = role * F.when(ring_area(ring) > 0, -1.0).otherwise(1.0)

        def trap(w: Column, e: Column) -> Column:
            forward = e["x1"] < e["x2"]
            return F.struct(
                F.least(e["x1"], e["x2"]).alias("xa"),
                F.greatest(e["x1"], e["x2"]).alias("xb"),
                F.when(forward, e["y1"]).otherwise(e["y2"]).alias("ya"),
                F.when(forward, e["y2"]).otherwise(e["y1"]).alias("yb"),
                (w * F.when(forward, 1.0).otherwise(-1.0)).alias("w"),
            )

        slanted = F.filter(segments(ring), lambda e: e["x1"] != e["x2"])
        return let(sign, lambda w: F.transform(slanted, lambda e: trap(w, e)))

    return F.flatten(
        F.flatten(
            F.transform(
                geom,
                lambda poly: F.transform(poly, lambda r, i: of_ring(r, F.when(i == 0, 1.0).otherwise(-1.0))),
            )
        )
    )


def overlap_area(a: Column, b: Column) -> Column:
    """Area shared by two multipolygons: exact for concave shapes and holes, without clipping.

    Each polygon is a signed sum of trapezoids under its edges, so the shared area is the signed sum over edge
    pairs of the area under the lower of two line pieces, which has a closed form. The base line cancels out;
    one near the bottom of `a` keeps the terms small.
    """
    def pair(s: Column, t: Column, y0: Column) -> Column:
        lo, hi = F.greatest(s["xa"], t["xa"]), F.least(s["xb"], t["xb"])

        def at(e: Column, x: Column) -> Column:
            return e["ya"] - y0 + (e["yb"] - e["ya"]) * ((x - e["xa"]) / (e["xb"] - e["xa"]))

        ends = F.struct(
            at(s, lo).alias("s0"), at(s, hi).alias("s1"), at(t, lo).alias("t0"), at(t, hi).alias("t1")
        )

        def under(v: Column) -> Column:
            d0, d1 = v["s0"] - v["t0"], v["s1"] - v["t1"]
            spread = F.abs(d0) + F.abs(d1)
            gap = F.when(((d0 >= 0) & (d1 >= 0)) | ((d0 <= 0) & (d1 <= 0)), spread).otherwise(
                (d0 * d0 + d1 * d1) / spread
            )
            return (v["s0"] + v["s1"] + v["t0"] + v["t1"] - gap) / F.lit(4.0)

        return F.when(lo < hi, s["w"] * t["w"] * (hi - lo) * let(ends, under)).otherwise(F.lit(0.0))

    def total(v: Column) -> Column:
        return F.aggregate(
            v["ta"],
            F.lit(0.0),
            lambda acc, s: acc + F.aggregate(v["tb"], F.lit(0.0), lambda inner, t: inner + pair(s, t, v["y0"])),
        )

    def prepared(t: Column) -> Column:
        base = F.array_min(t[0]["ya"])
        return let(F.struct(t[0].alias("ta"), t[1].alias("tb"), base.alias("y0")), total)

    area_sum = let(F.transform(F.array(a, b), _trapezoids), prepared)
    return F.greatest(area_sum, F.lit(0.0))


def snapped(geom: Column) -> Column:
    """Coordinates as whole multiples of the snapping grid, so equal corners compare equal."""

    def snap(p: Column) -> Column:
        return F.struct(
            F.round(p["x"] / F.lit(SNAP)).alias("x"), F.round(p["y"] / F.lit(SNAP)).alias("y")
        )

    return F.transform(geom, lambda poly: F.transform(poly, lambda ring: F.transform(ring, snap)))


def near_segment(x: Column, y: Column, e: Column) -> Column:
    """A point is at most one grid step away from a segment."""
    dx, dy = e["x2"] - e["x1"], e["y2"] - e["y1"]
    off = dx * (y - e["y1"]) - dy * (x - e["x1"])
    return (
        (x >= F.least(e["x1"], e["x2"]) - 1) & (x <= F.greatest(e["x1"], e["x2"]) + 1)
        & (y >= F.least(e["y1"], e["y2"]) - 1) & (y <= F.greatest(e["y1"], e["y2"]) + 1)
        & (off * off <= F.greatest(dx * dx + dy * dy, F.lit(1.0)))
    )


def _rims_near(a: Column, b: Column) -> Column:
    """Boundaries cross, or a vertex of one lies on the other as far as the snapping grid can tell."""

    def meet(p: Column, q: Column) -> Column:
        return (
            near_segment(q["x1"], q["y1"], p) | near_segment(q["x2"], q["y2"], p) | near_segment(p["x1"], p["y1"], q) | near_segment(p["x2"], p["y2"], q)
            | _segments_meet(p, q)
        )

    return F.exists(edges(a), lambda p: F.exists(edges(b), lambda q: meet(p, q)))


def _perimeter(geom: Column) -> Column:
    return F.aggregate(edges(geom), F.lit(0.0), lambda acc, e: acc + F.hypot(e["x2"] - e["x1"], e["y2"] - e["y1"]))


def touches(a: Column, b: Column) -> Column:
    """Boundaries meet and interiors do not, for multipolygons already on the snapping grid.

    Snapping moves a vertex off a slanted edge that it lies on by up to one grid step. So that far counts as on the edge,
    and a common sliver of one step along the boundaries counts as none. Coordinates are taken from the first vertex of
    `a`, so that their products stay exact.
    """

    def test(v: Column) -> Column:
        slack = F.lit(0.5) + F.lit(0.5) * (_perimeter(v[0]) + _perimeter(v[1]))
        return _rims_near(v[0], v[1]) & (overlap_area(v[0], v[1]) <= slack)

    def moved(v: Column) -> Column:
        origin = v[0][0][0][0]
        return F.transform(v, lambda g: F.transform(g, lambda poly: F.transform(poly, lambda ring: F.transform(
            ring, lambda p: F.struct((p["x"] - origin["x"]).alias("x"), (p["y"] - origin["y"]).alias("y"))
        ))))

    return let(let(F.array(a, b), moved), test)


def within(a: Column, b: Column, tolerance: float = 1e-9) -> Column:
    """`a` lies in `b`: the shared area is the whole area of `a` (up to a relative tolerance)."""
    return overlap_area(a, b) >= area(a) * F.lit(1.0 - tolerance)


def _cut_ring(ring: Column, axis: str, bound: Column, below: bool, weighted: bool = False) -> Column:
    """The part of a closed ring on one side of a line along an axis, closed again; empty if nothing is left.

    Points of a weighted ring are (x, y, w); those on the line get an infinite weight.
    """
    other = "y" if axis == "x" else "x"

    def kept(p: Column) -> Column:
        return p[axis] <= bound if below else p[axis] >= bound

    def crossing(p: Column, q: Column) -> Column:
        at = p[other] + (q[other] - p[other]) * ((bound - p[axis]) / (q[axis] - p[axis]))
        weight = [F.lit(float("inf")).alias("w")] if weighted else []
        return F.struct(*[(bound if c == axis else at).alias(c) for c in ("x", "y")], *weight)

    def piece(p: Column, q: Column) -> Column:
        return F.array(F.when(kept(p), p), F.when(kept(p) != kept(q), crossing(p, q)))

    steps = F.greatest(F.size(ring) - 1, F.lit(0))
    walked = F.array_compact(F.flatten(F.zip_with(F.slice(ring, 1, steps), F.slice(ring, 2, steps), piece)))
    return let(walked, lambda v: F.concat(v, F.slice(v, 1, 1)))


def clip_to_box(geom: Column, b: Column, weighted: bool = False, bbox: Column | None = None) -> Column:
    """Part of a multipolygon inside a box. Rings are cut at the four sides in turn, so areas are exact; a concave ring
    that falls into parts stays one ring with edges along the box. Rings and polygons outside vanish.

    With `bbox`, the box of the geometry, rings are walked only for sides that it reaches beyond.
    """

    def cut_at(axis: str, side: str, below: bool):
        if bbox is None:
            return lambda v: _cut_ring(v, axis, b[side], below, weighted)
        within_side = bbox[side] <= b[side] if below else bbox[side] >= b[side]
        return lambda v: F.when(within_side, v).otherwise(_cut_ring(v, axis, b[side], below, weighted))

    def ring(r: Column) -> Column:
        for axis, side, below in (("x", "xmin", False), ("x", "xmax", True), ("y", "ymin", False), ("y", "ymax", True)):
            r = let(r, cut_at(axis, side, below))
        return r

    cut = F.transform(geom, lambda poly: F.filter(F.transform(poly, ring), lambda r: F.size(r) >= 4))
    return F.filter(cut, lambda poly: F.size(poly) > 0)


def to_wkt(geom: Column, digits: int = 7) -> Column:
    """MULTIPOLYGON text with a fixed number of decimals."""
    fmt = f"%.{digits}f %.{digits}f"

    def ring_text(ring: Column) -> Column:
        pts = F.transform(ring, lambda p: F.format_string(fmt, p["x"], p["y"]))
        return F.concat(F.lit("("), F.array_join(pts, ", "), F.lit(")"))

    polys = F.transform(
        geom, lambda poly: F.concat(F.lit("("), F.array_join(F.transform(poly, ring_text), ", "), F.lit(")"))
    )
    return F.when(
        geom.isNotNull(),
        F.when(F.size(geom) == 0, F.lit("MULTIPOLYGON EMPTY")).otherwise(
            F.concat(F.lit("MULTIPOLYGON ("), F.array_join(polys, ", "), F.lit(")"))
        ),
    )


def closed(points: Column) -> Column:
    """A ring that ends where it begins, from its points."""
    return let(points, lambda v: F.concat(v, F.slice(v, 1, 1)))


def map_points(geom: Column, f) -> Column:
    """Apply `f(point) -> point` to every vertex."""
    return F.transform(geom, lambda poly: F.transform(poly, lambda ring: F.transform(ring, f)))


def polygon_literal(coords: Coords) -> Column:
    """Constant multipolygon from nested Python lists of (x, y)."""
    nested = [[[{"x": x, "y": y} for x, y in ring] for ring in poly] for poly in coords]
    return F.from_json(F.lit(json.dumps(nested)), "array<array<array<struct<x: double, y: double>>>>")


def bounds_of_coords(coords: Coords) -> Box:
    """Box of a constant multipolygon (the query polygon of a search)."""
    pts = [p for poly in coords for ring in poly for p in ring]
    xs, ys = [p[0] for p in pts], [p[1] for p in pts]
    return min(xs), min(ys), max(xs), max(ys)


def all_of(conditions: list[Column]) -> Column:
    """Conjunction of a non-empty list."""
    return reduce(lambda a, b: a & b, conditions)
