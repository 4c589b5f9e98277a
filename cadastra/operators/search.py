"""Search functions: fuzzy text, box, polygon and key lookups."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadastra.functions.geometry import Box, Coords
from cadastra.functions.text import contains_ignore_case, trigram_similarity
from cadastra.operators.filters import in_box, intersecting_polygon, matching


def search_text(
    parcels: DataFrame, column: str, term: str, limit: int = 100, literal: bool = False
) -> DataFrame:
    """Rows whose text contains the term, most similar first.

    Similarity is only computed for rows that contain the term, and the top rows are kept per task before they
    are merged. Ties are ordered by parcel_id, then geoid.
    """
    found = parcels.where(contains_ignore_case(F.col(column), term, literal))
    scored = found.withColumn("similarity", trigram_similarity(F.col(column), F.lit(term)))
    return scored.orderBy(F.desc("similarity"), "parcel_id", "geoid").limit(limit)


def search_by_address(parcels: DataFrame, term: str, limit: int = 100) -> DataFrame:
    """Parcels by address."""
    return search_text(parcels, "parcel_address", term, limit)


def search_by_owner(parcels: DataFrame, term: str, limit: int = 100) -> DataFrame:
    """Parcels by owner name."""
    return search_text(parcels, "owner_name", term, limit)


def get_parcels_in_bbox(parcels: DataFrame, bounds: Box, limit: int = 1000) -> DataFrame:
    """Parcels whose box overlaps the bounds; the first `limit` by key, so repeated calls agree."""
    return in_box(parcels, bounds).orderBy("parcel_id", "geoid").limit(limit)


def parcel_bbox_query(
    parcels: DataFrame, bounds: Box, filters: Mapping[str, Any] | None = None, limit: int = 500
) -> DataFrame:
    """Box search with attribute filters, both evaluated in the scan."""
    rows = in_box(parcels, bounds)
    condition = matching(filters)
    if condition is not None:
        rows = rows.where(condition)
    return rows.orderBy("parcel_id", "geoid").limit(limit)


def parcel_geometry_stream(parcels: DataFrame, coords: Coords) -> DataFrame:
    """All parcels that meet a polygon."""
    return intersecting_polygon(parcels, coords)


def parcel_detail(full: DataFrame, parcel_id: str) -> DataFrame:
    """All rows of the joined view with a parcel id (ids repeat between counties)."""
    return full.where(F.col("parcel_id") == parcel_id)
