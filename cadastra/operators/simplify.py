"""Generalization of a layer: fewer vertices within a tolerance, rings kept closed and valid-sized."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema

# Tasks get the functions of this module with the job, so workers do not need the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

MIN_RING = 4


def _interior(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Indices strictly between first and last of every piece, the piece of each, and where each piece starts."""
    lengths = last - first - 1
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    piece = np.repeat(np.arange(len(first)), lengths)
    return np.arange(lengths.sum()) - starts[piece] + first[piece] + 1, piece, starts


def _farthest(values: np.ndarray, piece: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Largest value of every piece and the position of its first occurrence."""
    largest = np.maximum.reduceat(values, starts)
    at = np.flatnonzero(values == largest[piece])
    _, first = np.unique(piece[at], return_index=True)
    return largest, at[first]


def keep_mask(xy: np.ndarray, sizes: np.ndarray, tolerance: float) -> np.ndarray:
    """Vertices of closed rings that stay by the farthest-point rule, for all rings of a batch at once.

    A closed ring is split at the vertex farthest from its start, or its base line would have no length. Every pass
    handles all open pieces of all rings together.
    """
    ends = np.cumsum(sizes)
    begin = ends - sizes
    keep = np.ones(len(xy), dtype=bool)
    rings = np.flatnonzero(sizes > MIN_RING)
    if len(rings) == 0:
        return keep
    first, last = begin[rings], ends[rings] - 1
    index, piece, starts = _interior(first, last)
    keep[index] = False
    _, at = _farthest(((xy[index] - xy[first[piece]]) ** 2).sum(axis=1), piece, starts)
    far = index[at]
    keep[far] = True
    off_line = np.zeros(len(xy))
    first, last = np.concatenate([first, far]), np.concatenate([far, last])
    while True:
        open_piece = last - first > 1
        first, last = first[open_piece], last[open_piece]
        if len(first) == 0:
            break
        index, piece, starts = _interior(first, last)
        line = (xy[last] - xy[first])[piece]
        part = xy[index] - xy[first[piece]]
        length = (line**2).sum(axis=1)
        t = np.clip(np.divide((part * line).sum(axis=1), length, out=np.zeros(len(part)), where=length > 0), 0, 1)
        distance = np.sqrt(((part - t[:, None] * line) ** 2).sum(axis=1))
        off_line[index] = distance
        largest, at = _farthest(distance, piece, starts)
        split = largest > tolerance
        middle = index[at[split]]
        keep[middle] = True
        first, last = np.concatenate([first[split], middle]), np.concatenate([middle, last[split]])
    # A ring that would fall under the smallest valid size keeps its next most distant vertex.
    total = np.concatenate([[0], np.cumsum(keep)])
    for ring in rings[(total[ends] - total[begin])[rings] < MIN_RING]:
        inside = slice(begin[ring], ends[ring])
        keep[begin[ring] + int(np.argmax(np.where(keep[inside], -1.0, off_line[inside])))] = True
    return keep


def simplify(df: DataFrame, tolerance: float, geom: str = "geom") -> DataFrame:
    """Simplify the multipolygons of a layer with a tolerance in coordinate units.

    Rings are simplified batch by batch in Arrow, without a shuffle; every ring keeps at least four points, so no
    feature is lost. The other columns pass through untouched.
    """
    schema = df.schema
    arrow_schema = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            index = batch.schema.get_field_index(geom)
            polys = batch.column(index)
            rings = polys.flatten().flatten()
            points = rings.flatten()
            xy = np.column_stack([points.field("x").to_numpy(zero_copy_only=False),
                                  points.field("y").to_numpy(zero_copy_only=False)])
            sizes = rings.value_lengths().fill_null(0).to_numpy()
            ends = np.cumsum(sizes)
            mask = keep_mask(xy, sizes, tolerance)
            kept = np.concatenate([[0], np.cumsum(mask)])
            ring_type = arrow_schema.field(geom).type.value_type.value_type
            point_type = ring_type.value_type
            new_points = pa.StructArray.from_arrays(
                [pa.array(xy[mask, 0]), pa.array(xy[mask, 1])], fields=list(point_type)
            )
            ring_offsets = kept[np.concatenate([[0], ends])]
            new_rings = pa.ListArray.from_arrays(pa.array(ring_offsets, pa.int32()), new_points, type=ring_type)

            def rebuild(old: pa.Array, values: pa.Array, kind: pa.DataType) -> pa.Array:
                lengths = old.value_lengths().fill_null(0).to_numpy()
                offsets = pa.array(np.concatenate([[0], np.cumsum(lengths)]), pa.int32())
                return pa.ListArray.from_arrays(offsets, values, type=kind, mask=old.is_null())

            geom_type = arrow_schema.field(geom).type
            new_polys = rebuild(polys.flatten(), new_rings, geom_type.value_type)
            columns = list(batch.columns)
            columns[index] = rebuild(polys, new_polys, geom_type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema.set(index, pa.field(geom, geom_type)))

    return df.mapInArrow(run, schema)
