"""Spatial joins as equi-joins on grid cells, followed by a box test and an exact test.

Every feature has a grid level fitted to its size, so it covers at most four cells there whatever its size. Two
features meet at the coarser of their two levels: each side is entered at its own level and at the coarser levels that
occur on the other side. A pair is kept only in the cell with the lower-left corner of the common part of the two boxes,
so no pair appears twice and nothing has to be made distinct. Cells follow feature size, so small features do not pile up
in large cells; coarse cells with many small features are hot keys and are salted.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from cadastra.functions import geometry as G
from cadastra.operators.filters import boxes_overlap
from cadastra.operators.layout import spread, width_of
from cadastra.operators.skew import BROADCAST_BYTES, ROWS_PER_SPLIT, grid_joined, row_bytes
from cadastra.operators.steps import stored

SLIVER = 1e-9  # share of the smaller geometry below which a common area counts as none
# Tasks get the functions of this module with the job, so workers do not need the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SHAPE_BYTES = 2 * 1024 * 1024  # input read for a task that drops copies of shapes, which may be repeated by zoom
FEW_SIDES = 16  # vertices up to which a geometry is not cut to the common box first
MOST_SIDES = 64  # vertices of a part of a large polygon
MOST_CUTS = 48  # times that a geometry is halved at most
# Cell sizes in degrees: from about 100 m, each four times the last, to wider than the world.
CELL_SIZES = [0.001 * 4**level for level in range(11)]


def _level(bbox: Column) -> Column:
    longer = F.greatest(bbox["xmax"] - bbox["xmin"], bbox["ymax"] - bbox["ymin"])
    level = F.lit(len(CELL_SIZES) - 1)
    for i in range(len(CELL_SIZES) - 2, -1, -1):
        level = F.when(longer <= CELL_SIZES[i], F.lit(i)).otherwise(level)
    return level


def _cells(df: DataFrame, bbox: str, levels: Column) -> DataFrame:
    """Rows repeated per grid cell they cover at each of the given levels."""
    sizes = F.array(*[F.lit(s) for s in CELL_SIZES])

    def cover(low: str, high: str) -> Column:
        first, last = (F.floor(F.col(bbox)[c] / F.col("_size")) for c in (low, high))
        return F.explode(F.sequence(first, last))

    return (
        df.withColumn("_at", F.explode(levels))
        .withColumn("_size", F.get(sizes, F.col("_at")))
        .withColumn("_cx", cover("xmin", "xmax"))
        .withColumn("_cy", cover("ymin", "ymax"))
        .drop("_size")
    )


def _levels_from(own: str, other: list[int]) -> Column:
    """Levels at which a feature can meet one whose level is in `other`: constants per own level."""
    choices = []
    for k in range(len(CELL_SIZES)):
        wanted = ([k] if any(level <= k for level in other) else []) + [level for level in other if level > k]
        choices.append(F.array(*[F.lit(level) for level in wanted]).cast("array<int>"))
    return F.get(F.array(*choices), F.col(own))


def box_pairs(
    left: DataFrame,
    right: DataFrame,
    left_box: str,
    right_box: str,
    left_key: list[str],
    rows_per_split: int = ROWS_PER_SPLIT,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """All pairs of rows whose boxes overlap (closed), once each, with the columns of both sides.

    The two sides must not share column names; `left_key` identifies the rows of the left side, which is the one that
    may have hot cells. Rows without a box have no partner.

    The right side is measured first (one aggregation: its levels, and a bound on its bytes once repeated per cell). A
    small one is entered at all coarser levels and broadcast, and the left rows are dealt evenly over tasks first; a large
    one is entered at the levels of the left side, and hot cells are dealt to a grid of salts: rows of the left side
    to its lines, rows of the right side to its columns, each repeated along the other direction only.
    """
    shared = set(left.columns) & set(right.columns)
    if shared:
        raise ValueError(f"both sides have columns {sorted(shared)}")

    def levelled(df: DataFrame, bbox: str, side: str) -> DataFrame:
        b = F.col(bbox)
        return df.where(b["xmin"].isNotNull() & b["ymin"].isNotNull()).withColumn(f"_level_{side}", _level(b))

    lefts, rights = levelled(left, left_box, "l"), levelled(right, right_box, "r")
    # Upper bound of the broadcast: four cells at the row's own level and at every coarser one.
    entries = 4 * (F.lit(len(CELL_SIZES)) - F.col("_level_r"))
    measured = rights.agg(
        F.sum(row_bytes(right) * entries).alias("bytes"), F.collect_set("_level_r").alias("levels")
    ).first()
    levels_right = sorted(measured.levels)
    on = ["_at", "_cx", "_cy"]
    if (measured.bytes or 0) <= broadcast_bytes:
        cells_left = _cells(spread(lefts, left_key), left_box, _levels_from("_level_l", levels_right))
        every = list(range(len(CELL_SIZES)))
        cells_right = _cells(rights, right_box, _levels_from("_level_r", every))
        joined = cells_left.join(F.broadcast(cells_right), on)
    else:
        cells_left = _cells(lefts, left_box, _levels_from("_level_l", levels_right))
        # An uncorrelated scalar subquery: at most one small array of levels.
        levels_left = lefts.agg(F.collect_set("_level_l")).scalar()
        every = F.sequence(F.lit(0), F.lit(len(CELL_SIZES) - 1))
        own = F.col("_level_r")
        wanted = F.filter(every, lambda k: (k == own) | ((k > own) & F.array_contains("_levels", k)))
        cells_right = _cells(rights.withColumn("_levels", levels_left), right_box, wanted).drop("_levels")
        joined = grid_joined(cells_left, cells_right, on, left_key, [right_box], rows_per_split)
    lb, rb = F.col(left_box), F.col(right_box)
    size = F.get(F.array(*[F.lit(s) for s in CELL_SIZES]), F.col("_at"))
    once = (
        (F.col("_at") == F.greatest("_level_l", "_level_r"))
        & (F.floor(F.greatest(lb["xmin"], rb["xmin"]) / size) == F.col("_cx"))
        & (F.floor(F.greatest(lb["ymin"], rb["ymin"]) / size) == F.col("_cy"))
    )
    return joined.where(boxes_overlap(lb, rb) & once).drop("_at", "_cx", "_cy", "_level_l", "_level_r")


def points_in_polygons(
    points: DataFrame,
    polygons: DataFrame,
    x: str,
    y: str,
    key: list[str],
    geom: str,
    bbox: str,
) -> DataFrame:
    """Pairs of points and the polygons that hold them (a boundary point lies in one polygon of a partition)."""
    at = points.withColumn("_point_box", G.box(F.col(x), F.col(y), F.col(x), F.col(y)))
    pairs = box_pairs(at, polygons, "_point_box", bbox, key)
    return pairs.where(G.contains_point(F.col(geom), F.col(x), F.col(y))).drop("_point_box")


def intersecting_pairs(
    left: DataFrame, right: DataFrame, left_geom: str, right_geom: str, left_box: str, right_box: str, key: list[str]
) -> DataFrame:
    """Pairs of rows whose geometries meet (touching counts)."""
    pairs = box_pairs(left, right, left_box, right_box, key)
    return pairs.where(G.intersects(F.col(left_geom), F.col(right_geom)))


def _common(a: Column, b: Column) -> Column:
    return G.box(F.greatest(a["xmin"], b["xmin"]), F.greatest(a["ymin"], b["ymin"]), F.least(a["xmax"], b["xmax"]), F.least(a["ymax"], b["ymax"]))


def _near_part(geom: str, box: str) -> Column:
    """The part of a geometry in the common box, where it has many sides of which some may lie outside; areas stay exact."""
    b, c = F.col(box), F.col("_common")
    outside = (b["xmin"] < c["xmin"]) | (b["ymin"] < c["ymin"]) | (b["xmax"] > c["xmax"]) | (b["ymax"] > c["ymax"])
    return F.when(outside & (G.vertex_count(F.col(geom)) > FEW_SIDES), G.clip_to_box(F.col(geom), c)).otherwise(F.col(geom))


def _side_of(ring: np.ndarray, axis: int, bound: float, below: bool) -> np.ndarray:
    """The part of an open ring on one side of a line along an axis."""
    off = ring[:, axis] - bound if below else bound - ring[:, axis]
    kept = off <= 0
    crosses = kept != np.roll(kept, -1)
    after, off_after = np.roll(ring, -1, axis=0)[crosses], np.roll(off, -1)[crosses]
    met = ring[crosses] + (off[crosses] / (off[crosses] - off_after))[:, None] * (after - ring[crosses])
    met[:, axis] = bound
    place = np.cumsum(kept.astype(int) + crosses)
    out = np.empty((place[-1] if len(place) else 0, 2))
    out[place[kept] - 1 - crosses[kept]] = ring[kept]
    out[place[crosses] - 1] = met
    return out


def _quartered(rings: list[np.ndarray], most: int) -> Iterator[list[np.ndarray]]:
    """Parts of a polygon (open rings, the outer one first) with at most `most` vertices, by cuts across its longer side."""
    todo = [(rings, 0)]
    while todo:
        part, depth = todo.pop()
        if sum(len(r) + 1 for r in part) <= most or depth >= MOST_CUTS:
            yield part
            continue
        low, high = part[0].min(axis=0), part[0].max(axis=0)
        axis = int(np.argmax(high - low))
        for below in (True, False):
            cut = [_side_of(r, axis, (low[axis] + high[axis]) / 2, below) for r in part]
            if len(cut[0]) >= 3:
                todo.append(([r for r in cut if len(r) >= 3], depth + 1))


def subdivided(df: DataFrame, key: list[str], geom: str, bbox: str, most: int = MOST_SIDES) -> DataFrame:
    """key, `geom` and `bbox` of the parts of each geometry, none with more than about `most` vertices.

    Geometries with more are cut at the middle of their longer side, again and again; parts of a geometry don't overlap and
    make up its area. So a large polygon is spread over many rows, and what meets it meets a few of its sides.
    Only large geometries go through Python, each in the task that has its row.
    """
    n = G.vertex_count(F.col(geom))
    rows = df.where(F.col(bbox).isNotNull()).select(*key, geom, bbox)
    large = rows.where(n > most).select(*key, geom)
    schema = large.schema
    kind = to_arrow_schema(schema).field(geom).type

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(geom)
            for row in range(batch.num_rows):
                parts = []
                for poly in batch.column(at)[row].as_py():
                    rings = [np.array([(p["x"], p["y"]) for p in ring[:-1]]) for ring in poly]
                    for part in _quartered([r for r in rings if len(r) >= 3], most) if rings and len(rings[0]) >= 3 else ():
                        parts.append([[[{"x": x, "y": y} for x, y in np.vstack([r, r[:1]]).tolist()] for r in part]])
                columns = [pa.array([batch.column(k)[row].as_py()] * len(parts), batch.schema.field(k).type) for k in range(batch.num_columns) if k != at]
                columns.insert(at, pa.array(parts, kind))
                yield pa.RecordBatch.from_arrays(columns, schema=batch.schema.set(at, pa.field(geom, kind)))

    parts = large.mapInArrow(cut, schema)
    parts = parts.where(G.area(F.col(geom)) > 0).withColumn(bbox, G.bbox_of(F.col(geom)))
    return rows.where(n <= most).unionByName(parts)


def overlap_shares_of_large(
    left: DataFrame, right: DataFrame, left_geom: str, right_geom: str, left_box: str, right_box: str, left_key: list[str], right_key: list[str],
    most: int = MOST_SIDES,
) -> DataFrame:
    """left_key, right_key, overlap_area and overlap_share (of the left geometry), for sides with large polygons.

    Both sides are subdivided, and the areas of the parts added up. The keys identify the rows and differ in name.
    """
    areas = left.select(*left_key, G.area(F.col(left_geom)).alias("_area"))
    parts_left = subdivided(left, left_key, left_geom, left_box, most).withColumn("_part", F.xxhash64(*left_key, left_box))
    parts_right = subdivided(right, right_key, right_geom, right_box, most)
    pairs = overlap_shares(parts_left, parts_right, left_geom, right_geom, left_box, right_box, ["_part"])
    summed = pairs.groupBy(*left_key, *right_key).agg(F.sum("overlap_area").alias("overlap_area"))
    return summed.join(areas, left_key).withColumn("overlap_share", F.col("overlap_area") / F.col("_area")).drop("_area")


def overlap_shares(
    left: DataFrame, right: DataFrame, left_geom: str, right_geom: str, left_box: str, right_box: str, key: list[str]
) -> DataFrame:
    """Pairs with a common area, and the share of the left geometry it makes up.

    The area is a sum with rounding errors, so pairs that only share an edge are told apart by SLIVER: a common part of
    less than that share of the smaller geometry is none.
    """
    pairs = box_pairs(left, right, left_box, right_box, key)
    held = pairs.withColumn("_common", _common(F.col(left_box), F.col(right_box)))
    # Generated columns are computed once: a filter on a projected one would be pushed below it and compute it again.
    measured = F.struct(
        G.overlap_area(_near_part(left_geom, left_box), _near_part(right_geom, right_box)).alias("overlap_area"),
        G.area(F.col(left_geom)).alias("_area"), G.area(F.col(right_geom)).alias("_other_area"),
    )
    shared = held.select(*pairs.columns, F.inline(F.array(measured)))
    least = F.lit(SLIVER) * F.least("_area", "_other_area")
    return shared.where(F.col("overlap_area") > least).withColumn("overlap_share", F.col("overlap_area") / F.col("_area")).drop("_area", "_other_area")


def contained_in(
    inner: DataFrame, outer: DataFrame, inner_geom: str, outer_geom: str, inner_box: str, outer_box: str, key: list[str]
) -> DataFrame:
    """Pairs where the inner geometry lies inside the outer one (buildings within parcels)."""
    ib, ob = F.col(inner_box), F.col(outer_box)
    slack = F.lit(G.SNAP)
    boxed = (
        (ib["xmin"] >= ob["xmin"] - slack) & (ib["xmax"] <= ob["xmax"] + slack)
        & (ib["ymin"] >= ob["ymin"] - slack) & (ib["ymax"] <= ob["ymax"] + slack)
    )
    pairs = box_pairs(inner, outer, inner_box, outer_box, key).where(boxed)
    return pairs.where(G.within(F.col(inner_geom), F.col(outer_geom)))


def touching(df: DataFrame, targets: DataFrame, geom: str = "geom", bbox: str = "bbox") -> DataFrame:
    """Rows of `df` that touch any of the target geometries (the neighbours of a parcel or of a set of parcels).

    Boundaries must meet and interiors must not; both are tested on a grid of 1e-9 degrees. Pairs are found on boxes and
    hashes of the shapes alone; the shapes themselves are fetched for the pairs that are left. Stacked copies are one shape
    on both sides until the result is joined back to all rows of `df`.
    """
    def named(rows: DataFrame, side: str) -> DataFrame:
        b, pad = F.col(bbox), F.lit(G.SNAP)
        padded = G.box(b["xmin"] - pad, b["ymin"] - pad, b["xmax"] + pad, b["ymax"] + pad)
        return rows.where(F.col(geom).isNotNull()).select(F.xxhash64(geom).alias(f"_{side}"), padded.alias(f"_box_{side}"))

    def shapes(rows: DataFrame, ids: DataFrame, side: str) -> DataFrame:
        # The hash only names a shape within the join; equal hashes of different shapes are kept apart by the shape.
        met = rows.select(F.xxhash64(geom).alias(f"_{side}"), F.col(geom).alias(f"_shape_{side}"))
        return met.join(ids.select(f"_{side}").distinct(), f"_{side}", "left_semi").dropDuplicates([f"_{side}", f"_shape_{side}"])

    near = stored(box_pairs(named(df, "a"), named(targets, "b"), "_box_a", "_box_b", ["_a"]).select("_a", "_b").distinct())
    pairs = near.join(shapes(df, near, "a"), "_a").join(shapes(targets, near, "b"), "_b")
    hits = (
        pairs.where(G.touches(G.snapped(F.col("_shape_a")), G.snapped(F.col("_shape_b"))))
        .select("_a", "_shape_a")
        .dropDuplicates(["_a", "_shape_a"])
    )
    # A crowded shape is one key of this join; the adaptive skew join splits it, as no row of `df` is repeated.
    keyed = df.withColumns({"_a": F.xxhash64(geom), "_shape_a": F.col(geom)})
    return keyed.join(hits, ["_a", "_shape_a"], "left_semi").drop("_a", "_shape_a")


def inside_any(
    df: DataFrame, polygons: DataFrame, key: list[str], geom: str, bbox: str, polygon: str, polygon_box: str
) -> DataFrame:
    """Rows that meet the union of a set of polygons: a row meets the union when it meets one of them."""
    pairs = intersecting_pairs(
        df.select(*key, geom, bbox), polygons.select(polygon, polygon_box), geom, polygon, bbox, polygon_box, key
    )
    return df.join(pairs.select(*key).distinct(), key, "left_semi")


def dissolved_boundary(df: DataFrame, *keys: str, geom: str = "geom") -> DataFrame:
    """Outer boundary of the union of each group's polygons, as one row per segment.

    Polygons of a group share whole edges (a coverage), so an edge between two of them occurs twice and drops out; no
    group is ever collected. Stacked copies count once. Edges are compared on the snapping grid.

    Shapes are dealt before copies are dropped, so no task gathers those of a whole file; `SHAPE_BYTES` of input make a task,
    or the session's shuffle partitions where these are more.
    """
    width = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), width_of(df, SHAPE_BYTES) or 0)
    shapes = df.select(*keys, geom).repartition(width, *keys, geom).dropDuplicates([*keys, geom])
    segments = shapes.select(*keys, F.explode(G.edges(G.snapped(F.col(geom)))).alias("e"))
    start = F.struct(F.col("e.x1").alias("x"), F.col("e.y1").alias("y"))
    end = F.struct(F.col("e.x2").alias("x"), F.col("e.y2").alias("y"))
    # One direction per edge, whichever way its polygon runs.
    return (
        segments.select(*keys, F.least(start, end).alias("p"), F.greatest(start, end).alias("q"))
        .where(F.col("p") != F.col("q"))
        .groupBy(*keys, "p", "q")
        .agg(F.count("*").alias("_n"))
        .where(F.col("_n") % 2 == 1)
        .select(
            *keys,
            *[(F.col(c) * F.lit(G.SNAP)).alias(n) for c, n in
              (("p.x", "x1"), ("p.y", "y1"), ("q.x", "x2"), ("q.y", "y2"))],
        )
    )
