"""Polygons of the union of each group's polygons.

Edges that two polygons share run in opposite directions and cancel; before that, edges are split where another polygon
has a vertex on them. What is left are directed segments with the inside on their left. Each points to the one that
follows it, and pointer jumping gives every segment its ring and its place there, in a number of rounds that grows with
the logarithm of the longest ring. Holes go to the smallest outer ring around them. No group is ever in one task; a ring
is, as it becomes one value.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadastra.functions import geometry as G
from cadastra.operators.spatial_join import box_pairs
from cadastra.operators.steps import stored

P, Q = ["x1", "y1"], ["x2", "y2"]


def _directed_edges(geom: Column) -> Column:
    """Edges of a multipolygon with the inside on their left, whichever way its rings run."""

    def of_ring(ring: Column, outer: Column) -> Column:
        turn = (G.ring_area(ring) > 0) != outer
        return F.transform(
            G.segments(ring),
            lambda e: F.when(turn, F.struct(e["x2"].alias("x1"), e["y2"].alias("y1"), e["x1"].alias("x2"), e["y1"].alias("y2"))).otherwise(e),
        )

    return F.flatten(F.flatten(F.transform(geom, lambda poly: F.transform(poly, lambda ring, i: of_ring(ring, i == 0)))))


def _cancelled(edges: DataFrame, keys: list[str]) -> DataFrame:
    """Directed edges whose opposite is not there, as often as they are left over."""
    forward = F.struct(F.col("x1").alias("x"), F.col("y1").alias("y")) < F.struct(F.col("x2").alias("x"), F.col("y2").alias("y"))
    lined = edges.where((F.col("x1") != F.col("x2")) | (F.col("y1") != F.col("y2")))
    ends = [F.when(forward, F.col(p)).otherwise(F.col(q)).alias(p) for p, q in zip(P + Q, Q + P)]
    net = lined.select(*keys, *ends, F.when(forward, 1).otherwise(-1).alias("way")).groupBy(*keys, *P, *Q).agg(F.sum("way").alias("way"))
    copies = net.where("way <> 0").withColumn("_copy", F.explode(F.sequence(F.lit(1), F.abs("way").cast("int"))))
    ends = [F.when(F.col("way") > 0, F.col(p)).otherwise(F.col(q)).alias(p) for p, q in zip(P + Q, Q + P)]
    return copies.select(*keys, *ends)


def _degrees(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """Box in degrees around grid coordinates, one grid step wider."""
    s = F.lit(G.SNAP)
    return G.box((F.least(x0, x1) - 1) * s, (F.least(y0, y1) - 1) * s, (F.greatest(x0, x1) + 1) * s, (F.greatest(y0, y1) + 1) * s)


def _split(edges: DataFrame, keys: list[str]) -> DataFrame:
    """Edges cut at the vertices of the same group that lie on them, up to one grid step off."""
    edges = stored(edges.withColumn("edge", F.monotonically_increasing_id()))
    x1, y1, x2, y2 = (F.col(c) for c in P + Q)
    points = edges.select(*keys, F.col("x1").alias("px"), F.col("y1").alias("py")).distinct()
    points = points.select(F.struct(*keys).alias("_group"), "px", "py", _degrees(F.col("px"), F.col("py"), F.col("px"), F.col("py")).alias("_point_box"))
    lines = edges.select(F.struct(*keys).alias("_owner"), "edge", *P, *Q, _degrees(x1, y1, x2, y2).alias("_edge_box"))
    pairs = box_pairs(lines, points, "_edge_box", "_point_box", ["edge"])
    px, py = F.col("px"), F.col("py")
    on_line = G.near_segment(px, py, F.struct(*P, *Q))
    inner = ((px != x1) | (py != y1)) & ((px != x2) | (py != y2))
    length = (x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1)
    along = ((px - x1) * (x2 - x1) + (py - y1) * (y2 - y1)) / length
    cuts = pairs.where(F.col("_group").eqNullSafe(F.col("_owner")) & on_line & inner).select("edge", along.alias("t"), px.alias("x"), py.alias("y"))
    cut = stored(cuts.where("t > 0 and t < 1"))
    hit = edges.join(cut.select("edge").distinct(), "edge", "left_semi")
    stops = cut.unionAll(hit.select("edge", F.lit(0.0), *P)).unionAll(hit.select("edge", F.lit(1.0), *Q))
    after = Window.partitionBy("edge").orderBy("t", "x", "y")
    pieces = stops.select("edge", F.col("x").alias("x1"), F.col("y").alias("y1"), F.lead("x").over(after).alias("x2"), F.lead("y").over(after).alias("y2"))
    pieces = pieces.where("x2 is not null").join(edges.select("edge", *keys), "edge").select(*keys, *P, *Q)
    whole = edges.join(cut.select("edge").distinct(), "edge", "left_anti").select(*keys, *P, *Q)
    return whole.unionAll(pieces)


def _linked(segments: DataFrame, group: list[str], left_turns: bool) -> DataFrame:
    """id and next: at each point the segments that end there are paired with those that begin there.

    Around a point the two kinds alternate. With `left_turns` a segment goes on with the first one clockwise from where
    it came, so shapes that meet in a point stay apart; otherwise with the first one the other way round, so a ring that
    meets itself falls into simple ones. Where the kinds don't alternate (overlapping input), any pairing gives closed rings.
    """
    back = F.atan2(F.col("y1") - F.col("y2"), F.col("x1") - F.col("x2"))
    ahead = F.atan2(F.col("y2") - F.col("y1"), F.col("x2") - F.col("x1"))
    sign = F.lit(-1.0 if left_turns else 1.0)
    at = [*group, "x", "y"]

    def ranked(angle: Column, place: list[str], name: str) -> DataFrame:
        rows = segments.select(*group, F.col(place[0]).alias("x"), F.col(place[1]).alias("y"), F.col("id").alias(name), (angle * sign).alias("turn"))
        window = Window.partitionBy(*at)
        return rows.select(
            *at, name, F.min("turn").over(window).alias(f"first_{name}"), F.count("*").over(window).alias("n"),
            (F.row_number().over(window.orderBy("turn", name)) - 1).alias("place"),
        )

    ends, begins = ranked(back, Q, "id"), ranked(ahead, P, "next").drop("n")
    # Where the first in order begins, what follows the k-th end is the beginning after the k-th.
    shifts = begins.select(*at, "first_next").where("place = 0")
    ends = _same(ends, shifts, at).withColumn("place", F.pmod(F.col("place") + (F.col("first_next") < F.col("first_id")).cast("int"), F.col("n")).cast("int")).drop("first_next", "n")
    return _same(ends, begins.drop("first_next"), [*at, "place"]).select("id", "next")


def _same(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """Join on keys of which nulls are equal too."""
    names = {c: f"_r_{c}" for c in on}
    renamed = right.withColumnsRenamed(names)
    joined = left.join(renamed, G.all_of([F.col(c).eqNullSafe(F.col(n)) for c, n in names.items()]))
    return joined.drop(*names.values())


def ranked_rings(links: DataFrame) -> DataFrame:
    """id, ring (the smallest id of the cycle) and place (from 0 on, from that id) of each element of cycles id -> next.

    Pointer jumping: after k rounds an element knows the smallest id among the 2^k that follow it, and how far off that
    is. An element that knows the same as the one it points to has covered its whole cycle; it leaves, so a round takes
    only the elements of cycles that are longer than the last step.
    """
    state = stored(links.select("id", F.col("next").alias("jump"), F.col("id").alias("low"), F.lit(0).cast("long").alias("off"), F.lit(True).alias("open")))
    done: list[DataFrame] = []
    step = 1
    while True:
        other = state.select(F.col("id").alias("jump"), F.col("jump").alias("far"), F.col("low").alias("low2"), F.col("off").alias("off2"))
        better = F.col("low2") < F.col("low")
        # A cycle closes within two rounds; those closed in the first are still looked up in the second, then none is needed.
        moved = stored(state.where("open").join(other, "jump").select(
            "id", F.col("far").alias("jump"), F.least("low", "low2").alias("low"), F.when(better, F.col("off2") + step).otherwise(F.col("off")).alias("off"),
            (F.col("low") != F.col("low2")).alias("open"),
        ))
        done.append(moved.where("not open").select("id", "low", "off"))
        state, step = moved, step * 2
        if moved.where("open").isEmpty():
            break
    state = reduce(lambda a, b: a.unionAll(b), done)
    sizes = state.groupBy("low").agg(F.count("*").alias("n"))
    return state.join(sizes, "low").select("id", F.col("low").alias("ring"), F.pmod(F.col("n") - F.col("off"), F.col("n")).alias("place"))


def _rings(segments: DataFrame, keys: list[str]) -> DataFrame:
    """Simple rings: keys, ring (id), points in order (not closed, without those on straight lines)."""
    found = stored(ranked_rings(_linked(segments, keys, left_turns=True)))
    labelled = stored(segments.join(found.select("id", F.col("ring").alias("whole")), "id"))
    # Rings that pass a point more than once are linked anew, inside the ring.
    twice = labelled.groupBy("whole", *P).count().where("count > 1").select("whole").distinct()
    knotted = labelled.join(twice, "whole", "left_semi")
    again = ranked_rings(_linked(knotted, ["whole"], left_turns=False))
    simple = stored(found.join(again.select("id"), "id", "left_anti").unionAll(again))
    points = F.sort_array(F.collect_list(F.struct("place", F.col("x1").alias("x"), F.col("y1").alias("y"))))
    rings = segments.join(simple, "id").groupBy(*keys, "ring").agg(points.alias("p"))

    def corner(v: Column) -> Column:
        n = F.size(v)

        def bends(p: Column, i: Column) -> Column:
            a, b = F.get(v, F.pmod(i - 1, n)), F.get(v, F.pmod(i + 1, n))
            return (p["x"] - a["x"]) * (b["y"] - p["y"]) != (b["x"] - p["x"]) * (p["y"] - a["y"])

        return F.transform(F.filter(v, bends), lambda p: F.struct(p["x"], p["y"]))

    return rings.select(*keys, "ring", G.let(F.col("p"), corner).alias("points")).where(F.size("points") > 2)


def dissolved_polygons(df: DataFrame, *keys: str, geom: str = "geom") -> DataFrame:
    """Polygons of the union of each group's polygons: the keys and `geom`, a multipolygon of one polygon.

    Outer rings run counter-clockwise and come first, holes clockwise; rings are simple. Parts that meet in a point only
    are polygons of their own. The polygons of a group should not overlap (a coverage; corners may lie on
    another's edge, up to one grid step off it); stacked copies count once. Where they overlap, areas are those of
    the sum. Null and empty geometries have no part. Coordinates are those of the snapping grid.
    """
    if not keys:
        return dissolved_polygons(df.withColumn("_all", F.lit(0)), "_all", geom=geom).drop("_all")
    names = list(keys)
    shapes = df.where(F.size(geom) > 0).select(*names, F.col(geom).alias("_geom")).dropDuplicates([*names, "_geom"])
    edges = shapes.select(*names, F.explode(_directed_edges(G.snapped(F.col("_geom")))).alias("e")).select(*names, "e.*")
    cut = _cancelled(_split(_cancelled(edges, names), names), names)
    segments = stored(cut.withColumn("id", F.monotonically_increasing_id()))
    rings = stored(_rings(segments, names).withColumn("area", _signed_area(F.col("points"))))
    return _nested(rings, names)


def _signed_area(points: Column) -> Column:
    return G.let(G.closed(points), G.ring_area)


def _nested(rings: DataFrame, keys: list[str]) -> DataFrame:
    """Outer rings with their holes."""
    ring = G.closed(F.col("points"))
    box = F.struct(*[f(F.col("points")[c]).alias(n) for f, c, n in ((F.array_min, "x", "xmin"), (F.array_min, "y", "ymin"), (F.array_max, "x", "xmax"), (F.array_max, "y", "ymax"))])
    s = F.lit(G.SNAP)
    outer = rings.where("area > 0").select(
        *keys, "ring", "area", ring.alias("_ring"), F.struct(*keys).alias("_group"),
        G.box(*[box[c] * s for c in ("xmin", "ymin", "xmax", "ymax")]).alias("_box"),
    )
    # A point half a grid step to the left of the middle of the longest side of a hole is inside the polygon around it.
    longest = F.array_max(F.transform(G.segments(ring), lambda e: F.struct(F.hypot(e["x2"] - e["x1"], e["y2"] - e["y1"]).alias("d"), e.alias("e"))))
    holes = rings.where("area < 0").select(F.struct(*keys).alias("_hole_group"), F.col("ring").alias("hole"), ring.alias("hole_ring"), longest.alias("l"))
    e, d = F.col("l.e"), F.col("l.d")
    x = (e["x1"] + e["x2"]) / 2 - (e["y2"] - e["y1"]) / d / 2
    y = (e["y1"] + e["y2"]) / 2 + (e["x2"] - e["x1"]) / d / 2
    spots = holes.select("_hole_group", "hole", x.alias("hx"), y.alias("hy"))
    spots = spots.withColumn("_spot", G.box(F.col("hx") * s, F.col("hy") * s, F.col("hx") * s, F.col("hy") * s))
    around = box_pairs(spots, outer.select("_group", "ring", "area", "_ring", "_box"), "_spot", "_box", ["hole"])
    around = around.where(F.col("_group").eqNullSafe(F.col("_hole_group")) & G.contains_point(F.array(F.array("_ring")), F.col("hx"), F.col("hy")))
    owner = around.groupBy("hole").agg(F.min_by("ring", "area").alias("ring"))
    inside = holes.join(owner, "hole").groupBy("ring").agg(F.sort_array(F.collect_list("hole_ring")).alias("_holes"))
    whole = outer.join(inside, "ring", "left")
    rings_of = F.concat(F.array("_ring"), F.coalesce("_holes", F.array().cast(whole.schema["_holes"].dataType)))
    placed = F.transform(rings_of, lambda r: F.transform(r, lambda p: F.struct((p["x"] * s).alias("x"), (p["y"] * s).alias("y"))))
    return whole.select(*keys, F.array(placed).alias("geom"))
