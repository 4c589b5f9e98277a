"""Helpers shared by the corpus operators: tables in the shared folder, Arrow chunks, joins with hot keys, components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadastra.session import shared_folder

#: Text taken at a time by a Python worker; its arrays have about 60 times that size.
CHUNK_BYTES = 500_000
#: The same where distinct pieces of a chunk are looked up once: larger chunks look up fewer.
PIECE_BYTES = 2_000_000
#: A key is hot when it has over max(HOT_ROWS, all rows / HOT_KEYS) rows, so there are at most HOT_KEYS hot keys.
HOT_ROWS = 2_000
HOT_KEYS = 10_000
#: Setting under which Spark deletes the shuffle files of a query when it ends, not when the driver collects garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The Parquet table `name` of a data folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame) -> DataFrame:
    """`df` written as Parquet to the shared folder and read again: cuts lineage and survives lost executors.

    The shuffle files of the write are deleted with its end: nothing reads them again.
    """
    spark = df.sparkSession
    path = shared_folder(spark)
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def forget(*tables: DataFrame) -> None:
    """Delete tables of `written` that nothing reads any more."""
    for df in tables:
        spark = df.sparkSession
        hadoop = spark.sparkContext._jsc.hadoopConfiguration()
        for file in df.inputFiles()[:1]:
            folder = spark._jvm.org.apache.hadoop.fs.Path(file).getParent()
            folder.getFileSystem(hadoop).delete(folder, True)


def text_of(docs: DataFrame) -> DataFrame:
    """doc_id as long and text without nulls; every other column of `docs` is left out."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    )


def chunks(batches: Iterator[pa.RecordBatch], column: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches whose values of a binary or string column have about `limit` bytes together.

    A single longer value makes a slice of its own.
    """
    for batch in batches:
        if batch.num_rows == 0:
            continue
        _, offsets = buffers(batch.column(column))
        start = 0
        while start < batch.num_rows:
            stop = int(np.searchsorted(offsets, offsets[start] + limit, side="right")) - 1
            stop = min(max(stop, start + 1), batch.num_rows)
            yield batch.slice(start, stop - start)
            start = stop


def buffers(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all values of a string or binary array, and where each begins (one offset more than values).

    Nulls count as empty.
    """
    if values.null_count:
        values = values.fill_null("" if pa.types.is_string(values.type) or pa.types.is_large_string(values.type) else b"")
    large = pa.types.is_large_string(values.type) or pa.types.is_large_binary(values.type)
    _, offsets, data = values.buffers()
    if offsets is None or len(values) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(values) + 1, np.int64)
    kind = np.int64 if large else np.int32
    offsets = np.frombuffer(offsets, kind)[values.offset : values.offset + len(values) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def hot_keys(df: DataFrame, keys: list[str], rows: int = HOT_ROWS, counts: DataFrame | None = None) -> DataFrame:
    """Keys with many rows, and into how many parts to split each (`_parts`). At most HOT_KEYS rows.

    Nulls are not keys. A key is hot above `rows` and above 1 / HOT_KEYS of all rows: so the list is small whatever
    the size of `df`, and each key left out of it has a small share of all rows. `counts`, if given, has the keys with
    over `rows` rows already, with their number as `_n`.
    """
    if counts is None:
        counts = df.groupBy(*keys).agg(F.count("*").alias("_n"))
    bound = max(rows, -(-df.count() // HOT_KEYS))
    return counts.where(F.col("_n") > bound).select(*keys, F.ceil(F.col("_n") / F.lit(bound)).cast("int").alias("_parts"))


def spread_join(left: DataFrame, right: DataFrame, keys: list[str], spread_by: list[str], hot: DataFrame) -> DataFrame:
    """Inner join in which the hot keys of `left` are split by a hash of `spread_by` and `right` has a row per part.

    `hot` comes from `hot_keys`; its size is bounded there, so it is broadcast.
    """
    parts = F.coalesce(F.col("_parts"), F.lit(1))
    a = left.join(F.broadcast(hot), keys, "left")
    a = a.withColumn("_part", F.pmod(F.xxhash64(*spread_by), parts).cast("int")).drop("_parts")
    b = right.join(F.broadcast(hot), keys, "left")
    b = b.withColumn("_part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("_parts")
    return a.join(b, [*keys, "_part"]).drop("_part")


def components(edges: DataFrame) -> DataFrame:
    """Connected components of an edge list (a, b): node, component (its smallest node).

    Each round hooks every node to its smallest neighbour, follows these pointers to their roots, and goes on with
    the edges between different roots. The number of nodes at least halves in each round. Hooks are minima, combined
    before the shuffle; all tables between rounds are in the shared folder.
    """
    live = written(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    maps: list[DataFrame] = []
    while not live.isEmpty():
        both = live.select(F.col("a").alias("node"), F.col("b").alias("to")).union(live.select("b", "a"))
        parents = written(both.groupBy("node").agg(F.least(F.min("to"), F.first("node")).alias("root")))
        while True:  # pointer jumping: a root is its own parent
            up = parents.select(F.col("node").alias("root"), F.col("root").alias("top"))
            jumped = written(parents.join(up, "root").select("node", F.col("top").alias("root"), (F.col("top") != F.col("root")).alias("moved")))
            forget(parents)
            parents = jumped.drop("moved")
            if jumped.where("moved").isEmpty():
                break
        maps.append(parents)
        a, b = (parents.select(F.col("node").alias(x), F.col("root").alias(f"r{x}")) for x in "ab")
        rest = live.join(a, "a").join(b, "b").where("ra <> rb").select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct()
        before, live = live, written(rest)
        forget(before)
    if not maps:
        return edges.sparkSession.createDataFrame([], "node long, component long")
    done = maps[-1]
    for earlier in reversed(maps[:-1]):  # a node's root of one round is a node of the next, or final
        later = done.select(F.col("node").alias("root"), F.col("root").alias("next"))
        done = earlier.join(later, "root", "left").select("node", F.coalesce("next", "root").alias("root"))
    return done.select("node", F.col("root").alias("component"))
