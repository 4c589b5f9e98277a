"""Generalization by zoom: one weight for each vertex, found once; a zoom keeps the vertices above its threshold.

The weight of a vertex is the area of the triangle with its neighbours when its turn comes: vertices whose triangle is
smaller than those of both neighbours go first, all at once, and a vertex never weighs less than one that went before
it. Corners where more than two sides meet stay for ever. So a line between two such corners has the same weights in
both polygons beside it, whichever way they run, and neighbours have neither gaps nor overlaps at any zoom.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadastra.functions import geometry as G

# Tasks get the functions of this module with the job, so workers do not need the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Steps of a tile's side that can be told apart on the screen.
TILE_UNITS = 4096
LEAST_CORNERS = 3


def threshold(zoom: Column | int, units: float = 1.0) -> Column:
    """Weight from which a vertex stays at a zoom: the square of `units` steps of a tile, in square degrees."""
    side = F.lit(360.0 * units / TILE_UNITS) / F.pow(F.lit(2.0), F.lit(zoom) if isinstance(zoom, int) else zoom)
    return side * side


def ring_weights(x: np.ndarray, y: np.ndarray, fixed: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Weights of the vertices of open rings laid end to end; infinite for those that stay for ever.

    A ring without fixed vertices gets two: its smallest corner by (x, y) and the one farthest from it. Each ring keeps
    at least three vertices, those that weigh most. Equal triangles go by (x, y).
    """
    weight = np.where(fixed, np.inf, 0.0)
    total = len(x)
    if not total:
        return weight
    start = np.cumsum(sizes) - sizes
    ring = np.repeat(np.arange(len(sizes)), sizes)
    place = np.lexsort((y, x))
    rank = np.empty(total, np.int64)
    rank[place] = np.arange(total)
    filled = np.flatnonzero(sizes)
    free = filled[~np.logical_or.reduceat(fixed, start[filled])]
    if len(free):
        low = np.minimum.reduceat(rank, start[filled])[np.searchsorted(filled, free)]
        anchor = place[low]
        base = np.zeros(len(sizes), np.int64)
        base[free] = anchor
        away = np.where(np.isin(ring, free), (x - x[base[ring]]) ** 2 + (y - y[base[ring]]) ** 2, -1.0)
        order = np.lexsort((rank, -away, ring))
        weight[anchor] = weight[order[start[free]]] = np.inf
    before, after = np.arange(total) - 1, np.arange(total) + 1
    last = start[filled] + sizes[filled] - 1
    before[start[filled]], after[last] = last, start[filled]
    alive = np.isinf(weight)
    gone = np.zeros(total)  # the largest weight that went beside a vertex

    def triangle(v: np.ndarray) -> np.ndarray:
        p, n = before[v], after[v]
        return np.abs((x[v] - x[p]) * (y[n] - y[p]) - (x[n] - x[p]) * (y[v] - y[p])) / 2

    live = np.flatnonzero(~alive)
    area = np.full(total, np.inf)
    while len(live):
        area[live] = np.maximum(triangle(live), gone[live])
        p, n = before[live], after[live]
        own = area[live]
        # neighbours on both sides come later: they are larger, or as large and later by (x, y)
        least = ((own < area[p]) | ((own == area[p]) & (rank[live] < rank[p]))) & ((own < area[n]) | ((own == area[n]) & (rank[live] < rank[n])))
        out = live[least]
        weight[out] = area[out]
        p, n = before[out], after[out]
        after[p], before[n] = n, p
        np.maximum.at(gone, p, weight[out])
        np.maximum.at(gone, n, weight[out])
        area[out] = np.inf
        live = live[~least]
    order = np.lexsort((rank, -weight, ring))
    first = np.concatenate([start[filled] + k for k in range(LEAST_CORNERS)])
    inside = np.concatenate([sizes[filled] > k for k in range(LEAST_CORNERS)])
    weight[order[first[inside]]] = np.inf
    return weight


@F.arrow_udf(T.ArrayType(T.DoubleType()))
def _weights_of(points: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in points:
        offsets = batch.offsets.to_numpy().astype(np.int64)
        flat = batch.values.slice(offsets[0], offsets[-1] - offsets[0])
        x, y, fixed = (flat.field(c).to_numpy(zero_copy_only=False) for c in ("x", "y", "fixed"))
        weight = ring_weights(x, y, fixed.astype(bool), np.diff(offsets))
        yield pa.ListArray.from_arrays(pa.array((offsets - offsets[0]).astype(np.int32)), pa.array(weight))


def with_weights(df: DataFrame, key: list[str], geom: str = "geom") -> DataFrame:
    """The table with `geom` as multipolygons of points (x, y, w), w the weight of the vertex.

    `key` names a feature. Corners that two polygons share must be vertices of both. Vertices are compared on the snapping
    grid; a vertex gets the largest of its weights in all rings, so a ring that needs it to stay a ring keeps it in its
    neighbours too. Null geometries stay null, empty ones empty.
    """
    rings = df.select(*key, F.posexplode(geom).alias("_poly", "_rings")).select(*key, "_poly", F.posexplode("_rings").alias("_ring", "_points"))
    id_ = [*key, "_poly", "_ring"]

    def snap(c: Column) -> Column:
        return F.round(c / F.lit(G.SNAP))

    points = rings.select(*id_, F.slice("_points", F.lit(1), F.greatest(F.size("_points") - 1, F.lit(0))).alias("p"), F.size("_points").alias("n"))
    points = points.select(*id_, F.posexplode("p").alias("_at", "_here"), "p", (F.col("n") - 1).alias("n"))
    around = [F.get("p", F.pmod(F.col("_at") + k, F.col("n"))) for k in (-1, 1)]
    rows = points.select(*id_, "_at", F.col("_here.x").alias("x"), F.col("_here.y").alias("y"), *[F.struct(snap(q["x"]).alias("x"), snap(q["y"]).alias("y")).alias(f"_{k}") for k, q in enumerate(around)])
    spot = Window.partitionBy(snap(F.col("x")), snap(F.col("y")))
    sides = F.size(F.array_union(F.collect_set("_0").over(spot), F.collect_set("_1").over(spot)))
    flagged = rows.withColumn("fixed", sides != 2)
    whole = flagged.groupBy(*id_).agg(F.sort_array(F.collect_list(F.struct("_at", "x", "y", "fixed"))).alias("_p"))
    # the weights of a ring, then the largest weight at each spot
    weighed = whole.withColumn("_w", _weights_of(F.transform("_p", lambda p: F.struct(p["x"].alias("x"), p["y"].alias("y"), p["fixed"].alias("fixed")))))
    each = weighed.select(*id_, F.explode(F.zip_with("_p", "_w", lambda p, w: F.struct(p["_at"].alias("_at"), p["x"].alias("x"), p["y"].alias("y"), w.alias("w")))).alias("v")).select(*id_, "v.*")
    shared = each.withColumn("w", F.max("w").over(spot))
    open_rings = shared.groupBy(*id_).agg(F.sort_array(F.collect_list(F.struct("_at", F.struct("x", "y", "w").alias("p")))).alias("_r"))
    closed = open_rings.select(*id_, G.closed(F.transform("_r", lambda r: r["p"])).alias("_r"))
    polys = closed.groupBy(*key, "_poly").agg(F.sort_array(F.collect_list(F.struct("_ring", "_r"))).alias("_r"))
    multi = polys.groupBy(*key).agg(F.sort_array(F.collect_list(F.struct("_poly", F.transform("_r", lambda r: r["_r"]).alias("_g")))).alias("_m"))
    done = multi.select(*[F.col(k).alias(f"_k_{k}") for k in key], F.transform("_m", lambda m: m["_g"]).alias("_weighted"))
    same = G.all_of([F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in key])
    kind = done.schema["_weighted"].dataType
    found = F.when(F.col(geom).isNotNull(), F.coalesce("_weighted", F.array().cast(kind))).alias(geom)
    return df.join(done, same, "left").select(*[found if c == geom else F.col(c) for c in df.columns])


def at_threshold(geom: Column, least: Column) -> Column:
    """A weighted multipolygon without the vertices below a weight, as points (x, y)."""

    def ring(r: Column) -> Column:
        inner = F.slice(r, F.lit(1), F.greatest(F.size(r) - 1, F.lit(0)))
        kept = F.filter(inner, lambda p: p["w"] >= least)
        return G.closed(F.transform(kept, lambda p: F.struct(p["x"].alias("x"), p["y"].alias("y"))))

    return F.transform(geom, lambda poly: F.transform(poly, ring))


def at_zoom(geom: Column, zoom: Column | int, units: float = 1.0) -> Column:
    """A weighted multipolygon as it is shown at a zoom."""
    return at_threshold(geom, threshold(zoom, units))
