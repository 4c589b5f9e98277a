"""Tables between the steps of an iterative operator, in the folder that the driver and all executors share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadastra.session import shared_folder


def stored(df: DataFrame) -> DataFrame:
    """`df` written as Parquet and read again: cuts lineage, and a lost executor takes nothing along."""
    spark = df.sparkSession
    path = shared_folder(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete tables of `stored` that nothing reads any more."""
    for df in tables:
        spark = df.sparkSession
        for file in df.inputFiles()[:1]:
            folder = spark._jvm.org.apache.hadoop.fs.Path(file).getParent()
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def once(df: DataFrame, **columns: Column) -> DataFrame:
    """`df` with columns that are generated, so each is computed once.

    A column that is only projected is computed again by a filter on it and by each column made from it.
    """
    kept = [F.col(f"`{c}`") for c in df.columns if c not in columns]
    return df.select(*kept, F.inline(F.array(F.struct(*[v.alias(k) for k, v in columns.items()]))))
