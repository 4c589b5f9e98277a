"""Top-k, samples and pages, all with a fixed order so that repeated runs agree."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_OFFSET = 100_000


def top_by(df: DataFrame, measure: str, limit: int, *ties: str) -> DataFrame:
    """Rows with the largest measure; nulls last, ties by the given columns."""
    return df.orderBy(F.col(measure).desc_nulls_last(), *ties).limit(limit)


def sample_rows(df: DataFrame, n: int, key: str, seed: int = 0, draw: Column | None = None) -> DataFrame:
    """Random sample of n rows: the n smallest seeded hashes of the key, kept per task before merging."""
    order = F.xxhash64(F.col(key), F.lit(seed)) if draw is None else draw
    return df.orderBy(order, key).limit(n)


def page(df: DataFrame, key: str, limit: int, offset: int = 0, after: object | None = None) -> DataFrame:
    """A page of rows in key order.

    `after` continues behind a key (a filter that reaches the scan, so deep pages cost no more than the first);
    `offset` skips rows. Rows that are skipped meet in one task, so an offset beyond MAX_OFFSET is an error.
    """
    if offset > MAX_OFFSET:
        raise ValueError(f"an offset over {MAX_OFFSET}: continue with `after` instead")
    rows = df if after is None else df.where(F.col(key) > F.lit(after))
    ordered = rows.orderBy(key)
    return (ordered.offset(offset) if offset else ordered).limit(limit)


def number_matched(df: DataFrame) -> DataFrame:
    """Number of rows of a collection."""
    return df.agg(F.count("*").alias("number_matched"))
