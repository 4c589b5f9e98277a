"""Cuts, boxes and areas of the multipolygons of a batch at a time: as in `geometry`, on flat arrays of all their points.

Array expressions of Spark are interpreted point by point; here a batch costs a few array operations for each side of the
box. The arithmetic and its order are those of `geometry.clip_to_box` and `geometry.area`, so are the results.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Tasks get the functions of this module with the job, so workers do not need the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

POINT = T.StructType([T.StructField(c, T.DoubleType()) for c in ("x", "y")])
MULTIPOLYGON = T.ArrayType(T.ArrayType(T.ArrayType(POINT)))
_SIDES = ("xmin", "ymin", "xmax", "ymax")
_PIECE = T.StructType([
    T.StructField("geom", MULTIPOLYGON), T.StructField("bbox", T.StructType([T.StructField(c, T.DoubleType()) for c in _SIDES])), T.StructField("area", T.DoubleType()),
])


def cuttable(kind: T.DataType) -> bool:
    """Whether a column is a multipolygon of points (x, y)."""
    return kind.simpleString() == MULTIPOLYGON.simpleString()


def _flat(geom: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """x and y of all points, points of each ring, rings of each polygon, polygons of each row."""
    def sizes(lists: pa.Array) -> np.ndarray:
        return lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)

    polys = geom.flatten()
    rings = polys.flatten()
    points = rings.flatten()
    x, y = (points.field(c).to_numpy(zero_copy_only=False) if len(points) else np.zeros(0) for c in (0, 1))
    return x, y, sizes(rings), sizes(polys), sizes(geom)


def _starts(sizes: np.ndarray) -> np.ndarray:
    return np.cumsum(sizes) - sizes


def _pairs(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of each point that another one of its ring follows, and its ring."""
    follows = np.ones(int(sizes.sum()), bool)
    filled = sizes > 0
    follows[(_starts(sizes) + sizes - 1)[filled]] = False
    at = np.flatnonzero(follows)
    return at, np.repeat(np.arange(len(sizes)), sizes)[at]


def cut_rings(x: np.ndarray, y: np.ndarray, sizes: np.ndarray, bound: np.ndarray, upright: bool, below: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The part of each closed ring on one side of its line, closed again; rings outside become empty."""
    along, across = (x, y) if upright else (y, x)
    p, ring = _pairs(sizes)
    limit = bound[ring]
    kept, kept_next = (along[p] <= limit, along[p + 1] <= limit) if below else (along[p] >= limit, along[p + 1] >= limit)
    cross = kept != kept_next
    if kept.all():
        return x, y, sizes
    made = kept.astype(np.int64) + cross
    left = np.bincount(ring, made, len(sizes)).astype(np.int64)
    new = left + (left > 0)
    place = _starts(new)[ring] + (np.cumsum(made) - made) - _starts(left)[ring]
    out = np.empty((2, int(new.sum())))
    out[:, place[kept]] = along[p[kept]], across[p[kept]]
    a, b, at = p[cross], p[cross] + 1, limit[cross]
    met = across[a] + (across[b] - across[a]) * ((at - along[a]) / (along[b] - along[a]))
    out[:, place[cross] + kept[cross]] = at, met
    some = left > 0
    first = _starts(new)[some]
    out[:, first + left[some]] = out[:, first]
    return (out[0], out[1], new) if upright else (out[1], out[0], new)


def ring_areas(x: np.ndarray, y: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Signed areas of closed rings, summed side by side around the first vertex."""
    p, ring = _pairs(sizes)
    first = _starts(sizes)[ring]
    ox, oy = x[first], y[first]
    terms = ((x[p] - ox) * (y[p + 1] - oy) - (x[p + 1] - ox) * (y[p] - oy)) / 2.0
    return np.bincount(ring, terms, len(sizes))


def _areas(x: np.ndarray, y: np.ndarray, sizes: np.ndarray, rings: np.ndarray, polys: np.ndarray) -> np.ndarray:
    poly = np.repeat(np.arange(len(rings)), rings)
    outer = np.arange(len(poly)) == _starts(rings)[poly]
    own = np.bincount(poly, np.abs(ring_areas(x, y, sizes)) * np.where(outer, 1.0, -1.0), len(rings))
    return np.bincount(np.repeat(np.arange(len(polys)), polys), own, len(polys))


def _lists(sizes: np.ndarray, values: pa.Array, absent: np.ndarray | None = None) -> pa.Array:
    offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
    return pa.ListArray.from_arrays(offsets, values, mask=None if absent is None else pa.array(absent))


def _absent(geom: pa.Array) -> np.ndarray:
    return geom.is_null().to_numpy(zero_copy_only=False)


@F.arrow_udf(_PIECE)
def cut_to_box(geom: pa.Array, xmin: pa.Array, ymin: pa.Array, xmax: pa.Array, ymax: pa.Array) -> pa.Array:
    """`geometry.clip_to_box` of each row, with the box and the area of what is left; null for null."""
    absent = _absent(geom)
    x, y, sizes, rings, polys = _flat(geom)
    row_of_poly = np.repeat(np.arange(len(polys)), polys)
    poly = np.repeat(np.arange(len(rings)), rings)
    row = row_of_poly[poly]
    for bound, upright, below in ((xmin, True, False), (xmax, True, True), (ymin, False, False), (ymax, False, True)):
        x, y, sizes = cut_rings(x, y, sizes, bound.to_numpy(zero_copy_only=False)[row], upright, below)
    whole = sizes >= 4
    points = np.repeat(whole, sizes)
    x, y, sizes, poly = x[points], y[points], sizes[whole], poly[whole]
    rings = np.bincount(poly, minlength=len(rings))
    some = rings > 0
    rings, row_of_poly = rings[some], row_of_poly[some]
    polys = np.bincount(row_of_poly, minlength=len(polys))
    area = _areas(x, y, sizes, rings, polys)
    count = np.bincount(np.repeat(np.repeat(row_of_poly, rings), sizes), minlength=len(polys))
    held = count > 0
    first = _starts(count)[held]
    box = []
    for values, extreme in ((x, np.minimum), (y, np.minimum), (x, np.maximum), (y, np.maximum)):
        side = np.zeros(len(polys))
        if held.any():
            side[held] = extreme.reduceat(values, first)
        box.append(pa.array(side))
    shape = _lists(polys, _lists(rings, _lists(sizes, pa.StructArray.from_arrays([pa.array(x), pa.array(y)], names=["x", "y"]))), absent)
    boxes = pa.StructArray.from_arrays(box, names=list(_SIDES), mask=pa.array(~held))
    return pa.StructArray.from_arrays([shape, boxes, pa.array(area, mask=absent)], names=["geom", "bbox", "area"])


@F.arrow_udf(T.DoubleType())
def area_of(geom: pa.Array) -> pa.Array:
    """`geometry.area` of each row; null for null."""
    return pa.array(_areas(*_flat(geom)), mask=_absent(geom))
