"""Passes over bounded blocks of a query table, and their results gathered in one folder."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from cadastra.llm.common import written
from cadastra.session import shared_folder


def blocks(queries: DataFrame, key: str, nbytes: int, limit: int) -> Iterator[list[Row]]:
    """The rows of `queries`, dealt by a hash of `key` to as many blocks as `nbytes`, their size, has `limit`s.

    Rows with one key are in one block. Only one block at a time is on the driver.
    """
    count = max(1, -(-int(nbytes) // limit))
    dealt = written(queries.withColumn("_block", F.pmod(F.xxhash64(key), F.lit(count)).cast("int")))
    for n in range(count):
        rows = dealt.where(F.col("_block") == n).drop("_block").collect()
        if rows:
            yield rows


class Gathered:
    """Results of several passes, written beside each other and read as one table."""

    def __init__(self, spark: SparkSession, schema: str):
        self.spark, self.schema, self.folder, self.parts = spark, schema, shared_folder(spark), 0

    def add(self, result: DataFrame) -> None:
        result.write.parquet(f"{self.folder}/pass-{self.parts:06d}")
        self.parts += 1

    def table(self) -> DataFrame:
        if not self.parts:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(f"{self.folder}/pass-*")
