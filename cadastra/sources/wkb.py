"""Geometry import and export: well-known binary to nested arrays and back, in Arrow batches.

Conversion happens once, at the edge of the system. Everything inside works on nested arrays.
"""

from __future__ import annotations

import struct
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from cadastra.schemas import MULTIPOLYGON

# Tasks get the functions of this module with the job, so workers do not need the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Names a geometry column goes by when its type does not tell.
GEOMETRY_NAMES = ("geom", "geometry", "shape", "the_geom")

_POLYGON, _MULTIPOLYGON = 3, 6


def geometry_column(df: DataFrame) -> str:
    """Name of the geometry column: by type first, else by well-known name, else an error."""
    for field in df.schema.fields:
        if "geometry" in field.dataType.simpleString().lower():
            return field.name
    for field in df.schema.fields:
        if field.name.lower() in GEOMETRY_NAMES:
            return field.name
    raise ValueError("no geometry column")


def parse(blob: bytes) -> list[list[np.ndarray]]:
    """Polygons of a WKB value, each a list of (n, 2) rings. Extra dimensions and an SRID are skipped."""
    def header(at: int) -> tuple[str, int, int, int]:
        order = "<" if blob[at] == 1 else ">"
        (code,) = struct.unpack_from(order + "I", blob, at + 1)
        dims = 2 + bool(code & 0x80000000) + bool(code & 0x40000000)
        plain = code & 0x0FFFFFFF
        dims += (0, 1, 1, 2)[plain // 1000] if plain // 1000 < 4 else 0
        return order, plain % 1000, dims, at + 5 + (4 if code & 0x20000000 else 0)

    def polygon(at: int) -> tuple[list[np.ndarray], int]:
        order, kind, dims, at = header(at)
        if kind != _POLYGON:
            raise ValueError(f"geometry type {kind} is not a polygon")
        (count,) = struct.unpack_from(order + "I", blob, at)
        at, found = at + 4, []
        for _ in range(count):
            (n,) = struct.unpack_from(order + "I", blob, at)
            values = np.frombuffer(blob, order + "f8", n * dims, at + 4).reshape(n, dims)
            found.append(values[:, :2])
            at += 4 + 8 * n * dims
        return found, at

    order, kind, _, body = header(0)
    if kind == _POLYGON:
        return [polygon(0)[0]]
    if kind != _MULTIPOLYGON:
        raise ValueError(f"geometry type {kind} is not a polygon or multipolygon")
    (count,) = struct.unpack_from(order + "I", blob, body)
    at, parts = body + 4, []
    for _ in range(count):
        part, at = polygon(at)
        parts.append(part)
    return parts


def build(xy: np.ndarray, per_poly: list[int], per_ring: list[int]) -> bytes:
    """Little-endian WKB multipolygon from flat coordinates, rings per polygon and points per ring."""
    out, ring, at = [struct.pack("<BII", 1, _MULTIPOLYGON, len(per_poly))], 0, 0
    for count in per_poly:
        out.append(struct.pack("<BII", 1, _POLYGON, count))
        for n in per_ring[ring : ring + count]:
            out += [struct.pack("<I", n), xy[at : at + n].tobytes()]
            at += n
        ring += count
    return b"".join(out)


def _nested(blobs: list[bytes | None], kind: pa.DataType) -> pa.Array:
    """Nested Arrow array of parsed geometries, assembled from flat offsets."""
    per_row, per_poly, per_ring, coords = [0], [0], [0], []
    for blob in blobs:
        parts = parse(blob) if blob is not None else []
        for part in parts:
            for ring in part:
                coords.append(ring)
                per_ring.append(per_ring[-1] + len(ring))
            per_poly.append(per_poly[-1] + len(part))
        per_row.append(per_row[-1] + len(parts))
    xy = np.concatenate(coords).astype("f8") if coords else np.empty((0, 2))
    point = kind.value_type.value_type.value_type
    points = pa.StructArray.from_arrays([pa.array(xy[:, 0]), pa.array(xy[:, 1])], fields=list(point))
    rings = pa.ListArray.from_arrays(pa.array(per_ring, pa.int32()), points, type=kind.value_type.value_type)
    polys = pa.ListArray.from_arrays(pa.array(per_poly, pa.int32()), rings, type=kind.value_type)
    missing = pa.array([b is None for b in blobs])
    return pa.ListArray.from_arrays(pa.array(per_row, pa.int32()), polys, type=kind, mask=missing)


def from_wkb(df: DataFrame, column: str | None = None) -> DataFrame:
    """Replace a WKB column by nested arrays (column `geom`). Tables that already have arrays pass through."""
    column = column or geometry_column(df)
    if not isinstance(df.schema[column].dataType, T.BinaryType):
        return df.withColumnRenamed(column, "geom")
    fields = [T.StructField("geom", MULTIPOLYGON) if f.name == column else f for f in df.schema.fields]
    schema = T.StructType(fields)
    kind = to_arrow_schema(schema).field("geom").type

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            i = batch.schema.get_field_index(column)
            columns = list(batch.columns)
            columns[i] = _nested(columns[i].to_pylist(), kind)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema.set(i, pa.field("geom", kind)))

    return df.mapInArrow(run, schema)


def to_wkb(df: DataFrame, column: str = "geom") -> DataFrame:
    """Replace nested arrays by WKB, for exchange with systems that expect it."""
    fields = [T.StructField(f.name, T.BinaryType()) if f.name == column else f for f in df.schema.fields]

    def encode(shapes: pa.ListArray) -> list[bytes | None]:
        polys = shapes.flatten()
        rings = polys.flatten()
        points = rings.flatten()
        xy = np.column_stack([points.field(c).to_numpy(zero_copy_only=False) for c in ("x", "y")]).astype("<f8")
        rings_of, points_of = polys.value_lengths().to_pylist(), rings.value_lengths().to_pylist()
        out, poly, ring, point = [], 0, 0, 0
        for count in shapes.value_lengths().to_pylist():
            if count is None:
                out.append(None)
                continue
            per_poly = rings_of[poly : poly + count]
            per_ring = points_of[ring : ring + sum(per_poly)]
            n = sum(per_ring)
            out.append(build(xy[point : point + n], per_poly, per_ring))
            poly, ring, point = poly + count, ring + len(per_ring), point + n
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            i = batch.schema.get_field_index(column)
            columns = list(batch.columns)
            columns[i] = pa.array(encode(columns[i]), pa.binary())
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema.set(i, pa.field(column, pa.binary())))

    return df.mapInArrow(run, T.StructType(fields))


def edges_source(df: DataFrame, columns: list[str], source_crs: str = "EPSG:4269") -> DataFrame:
    """Boundary-edge source: selected columns, geometry reprojected to EPSG:4326."""
    from cadastra.functions.mercator import reproject

    geom = geometry_column(df)
    kept = [c for c in columns if c != geom]
    return df.select(*kept, reproject(F.col(geom), source_crs).alias(geom))
