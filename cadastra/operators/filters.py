"""Predicates. Box comparisons always come first so that they reach the Parquet scan."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadastra.functions import geometry as G
from cadastra.lookups import STATE_BOUNDS

Box = G.Box


def box_overlaps(bbox: Column, bounds: Box) -> Column:
    """Closed overlap of a feature's box with constant bounds: boxes only."""
    xmin, ymin, xmax, ymax = (float(v) for v in bounds)
    return (bbox["xmin"] <= xmax) & (bbox["xmax"] >= xmin) & (bbox["ymin"] <= ymax) & (bbox["ymax"] >= ymin)


def boxes_overlap(a: Column, b: Column) -> Column:
    """Closed overlap of two box structs."""
    return (
        (a["xmin"] <= b["xmax"]) & (a["xmax"] >= b["xmin"]) & (a["ymin"] <= b["ymax"]) & (a["ymax"] >= b["ymin"])
    )


def in_box(df: DataFrame, bounds: Box, bbox: str = "bbox") -> DataFrame:
    """Rows whose box overlaps the bounds."""
    return df.where(box_overlaps(F.col(bbox), bounds))


def intersecting_box(df: DataFrame, bounds: Box, geom: str = "geom", bbox: str = "bbox") -> DataFrame:
    """Rows whose geometry meets the bounds (touching counts): box test first, exact test on what is left."""
    exact = G.intersects_box(F.col(geom), G.box_literal(bounds))
    return in_box(df, bounds, bbox).where(exact)


def intersecting_polygon(df: DataFrame, coords: G.Coords, geom: str = "geom", bbox: str = "bbox") -> DataFrame:
    """Rows whose geometry meets a constant multipolygon given as nested (x, y) lists."""
    exact = G.intersects_constant(F.col(geom), coords)
    return in_box(df, G.bounds_of_coords(coords), bbox).where(exact)


def of_state(df: DataFrame, statefp: str, column: str = "statefp") -> DataFrame:
    """Rows of one state."""
    return df.where(F.col(column) == statefp)


def of_county(df: DataFrame, statefp: str, countyfp: str) -> DataFrame:
    """Rows of one county."""
    return df.where((F.col("statefp") == statefp) & (F.col("countyfp") == countyfp))


def state_extract(df: DataFrame, statefp: str, exact: bool = True) -> DataFrame:
    """Rows of a state that also meet its bounds: drops parcels across the border and stray coordinates.

    A state without bounds is filtered by its code alone.
    """
    rows = of_state(df, statefp)
    if statefp not in STATE_BOUNDS:
        return rows
    bounds = STATE_BOUNDS[statefp]
    return intersecting_box(rows, bounds) if exact else in_box(rows, bounds)


def matching(filters: Mapping[str, Any] | None) -> Column | None:
    """Conjunction of attribute filters.

    A list means IN, a pair (low, high) a closed range with None for an open end, any other value equality.
    """
    conditions = []
    for name, wanted in (filters or {}).items():
        column = F.col(name)
        if isinstance(wanted, tuple):
            low, high = wanted
            conditions += [column >= low] if low is not None else []
            conditions += [column <= high] if high is not None else []
        elif isinstance(wanted, (list, set, frozenset)):
            conditions.append(column.isin(sorted(wanted)))
        else:
            conditions.append(column == wanted)
    return G.all_of(conditions) if conditions else None


def with_box(df: DataFrame, geom: str = "geom", bbox: str = "bbox") -> DataFrame:
    """Add the covering box column where the table has none."""
    return df if bbox in df.columns else df.withColumn(bbox, G.bbox_of(F.col(geom)))
