"""PostgreSQL tables over JDBC. Needs the PostgreSQL driver jar on the class path."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cadastra.sources.wkb import from_wkb, to_wkb


def read_table(
    spark: SparkSession, url: str, table: str, key: str, bounds: tuple[int, int], partitions: int,
    properties: dict[str, str] | None = None,
) -> DataFrame:
    """Read a table in parallel ranges of an integer key; geometry arrives as WKB and becomes nested arrays."""
    rows = spark.read.jdbc(
        url, table, column=key, lowerBound=bounds[0], upperBound=bounds[1], numPartitions=partitions,
        properties=properties or {},
    )
    return from_wkb(rows)


def write_table(
    df: DataFrame, url: str, table: str, mode: str = "append", batch: int = 10_000, connections: int = 16,
    properties: dict[str, str] | None = None,
) -> None:
    """Append to or overwrite a table; geometry goes out as WKB, other nested columns are left behind.

    Writing is not idempotent under task retries, so load into a staging table and swap it in.
    """
    if mode not in ("append", "overwrite"):
        raise ValueError(f"mode {mode!r}")
    flat = df.drop("bbox", "centroid", "surface_point")
    rows = to_wkb(flat) if "geom" in flat.columns else flat
    # A shuffle, not a coalesce: the work before it keeps its parallelism, only the connections are bounded.
    writer = rows.repartition(connections).write.mode(mode).option("batchsize", batch)
    if mode == "overwrite":
        writer = writer.option("truncate", "true")
    writer.jdbc(url, table, properties=properties or {})
