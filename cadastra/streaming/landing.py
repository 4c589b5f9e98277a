"""Append ingest into the landing table as a stream over newly arrived files.

New extracts are appended as they arrive; each file is appended exactly once (the checkpoint records what was read and
the Parquet sink commits per batch). The normalized table is a full refresh from the landing table, as in batch.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from cadastra.schemas import PARCEL_RAW


def append_arrivals(
    spark: SparkSession,
    arrivals: str,
    landing: str,
    checkpoint: str,
    schema: T.StructType = PARCEL_RAW,
    files_per_batch: int = 1000,
    once: bool = True,
) -> StreamingQuery:
    """Append Parquet files that arrive in a directory to the landing table.

    `once` handles everything that is there and stops; otherwise the stream keeps running.
    """
    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(arrivals)
    writer = rows.writeStream.format("parquet").option("checkpointLocation", checkpoint).outputMode("append")
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime="1 minute")).start(landing)
