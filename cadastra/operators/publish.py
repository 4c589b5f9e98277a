"""Publishing with a commit log: readers see whole runs or nothing of them.

A run writes its partitions to path/state=XX/county=YYY/run=ID and then, as one small table under path/_commits, an
entry for each of these partitions and no other. The rows of every partition are counted before the write and again in
its files; a run whose counts differ commits nothing. Readers take the entry in force of each partition, the one of
the latest commit, and read only the files of its run. What a dead run leaves behind is never read, and a
new version of a county replaces the old one in the moment its entry is there.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadastra.operators.layout import COUNTY_LAYOUT, ordered_in_groups, path_exists, with_partition_keys, write_parquet
from cadastra.operators.filters import with_box

COMMITS = "_commits"
KEYS = ["state", "county"]
RUN = "run"
_BOX = ("xmin", "ymin", "xmax", "ymax")
#: One entry: what a run holds of a partition. A partition that is gone has an entry without rows.
ENTRY = "state string, county string, run string, n bigint, fingerprint string, xmin double, ymin double, xmax double, ymax double"


class IncompleteRun(RuntimeError):
    """The files of a run don't hold the rows that it was to write."""


def fingerprint(columns: list[str]) -> Column:
    """Aggregate that names the content of a group whatever the order of its rows.

    Two sums of 64-bit row hashes with different seeds, as text. Every column counts, and which of them are null.
    """
    names = [F.col(f"`{c}`") for c in sorted(columns)]
    marks = [c.isNull() for c in names]

    def total(seed: int) -> Column:
        return F.sum(F.xxhash64(F.lit(seed), *names, *marks).cast("decimal(38,0)")).cast("string")

    return F.concat_ws(":", total(1), total(2))


def contents(rows: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """state, county, n, fingerprint and extent of the partitions of keyed rows, in one aggregation.

    One row for each partition: at most 101 * 1,001, as the keys are two- and three-digit codes or 'unassigned'.
    """
    b = F.col("bbox")
    extent = [f(b[c]).alias(c) for f, c in ((F.min, "xmin"), (F.min, "ymin"), (F.max, "xmax"), (F.max, "ymax"))]
    return rows.groupBy(*KEYS).agg(F.count("*").alias("n"), fingerprint(columns or rows.columns).alias("fingerprint"), *extent)


def new_run() -> str:
    return uuid.uuid4().hex


def write_run(rows: DataFrame, path: str, tie: tuple[str, ...], run: str, extents: DataFrame, partitions: int | None = None) -> None:
    """Write keyed rows under their run, sorted inside every county. Nothing is published yet."""
    ordered = ordered_in_groups(rows, KEYS, tie, extents, partitions)
    write_parquet(ordered.withColumn(RUN, F.lit(run)), path, **COUNTY_LAYOUT, partition_by=(*KEYS, RUN), mode="append")


def commit(entries: DataFrame, path: str, run: str) -> None:
    """Append the entries of a run as one commit; a commit whose write did not end has no _SUCCESS and doesn't count."""
    stamp = f"{time.time_ns():020d}-{run}"
    wanted = [f.strip().split(" ")[0] for f in ENTRY.split(",")]
    entries.withColumn(RUN, F.lit(run)).select(*wanted).coalesce(1).write.json(f"{path.rstrip('/')}/{COMMITS}/{stamp}")


def committed(spark: SparkSession, path: str) -> DataFrame | None:
    """The entry in force of each partition, those of partitions that are gone included; None before the first commit."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{COMMITS}/*/_SUCCESS")
    found = pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern)
    folders = [f.getPath().getParent().toString() for f in found or []]
    if not folders:
        return None
    stamp = F.element_at(F.split("_metadata.file_path", "/"), -2)
    entries = spark.read.schema(ENTRY).json(folders).withColumn("_stamp", stamp)
    values = F.struct(*[c for c in entries.columns if c not in (*KEYS, "_stamp")])
    return entries.groupBy(*KEYS).agg(F.max_by(values, "_stamp").alias("v")).select(*KEYS, "v.*")


def _folders(spark: SparkSession, path: str, where: Column | None) -> list[str]:
    entries = committed(spark, path)
    if entries is None:
        raise ValueError(f"nothing is published under {path}")
    live = entries.where("n > 0")
    live = live if where is None else live.where(where)
    root = path.rstrip("/")
    return [f"{root}/state={r.state}/county={r.county}/{RUN}={r.run}" for r in live.orderBy(*KEYS).collect()]


def read_published(spark: SparkSession, path: str, where: Column | None = None) -> DataFrame:
    """The committed rows with state and county as text.

    `where` is a condition on the entries (keys, n, extent): folders that it leaves out are not even listed. The number of
    folders is that of the partitions, at most 101 * 1,001.
    """
    folders = _folders(spark, path, where)
    if not folders:
        folders, nothing = _folders(spark, path, None)[:1], True
    else:
        nothing = False
    if not folders:
        raise ValueError(f"nothing is published under {path}")
    reader = spark.read.option("basePath", path)
    several = len({f.rsplit("=", 1)[1] for f in folders}) > 1  # runs may differ in their columns
    found = reader.option("mergeSchema", str(several).lower()).parquet(*folders).schema
    keys = {*KEYS, RUN}
    schema = T.StructType([T.StructField(f.name, T.StringType() if f.name in keys else f.dataType, f.nullable) for f in found])
    rows = spark.read.option("basePath", path).schema(schema).parquet(*folders).drop(RUN)
    return rows.where(F.lit(False)) if nothing else rows


def publish_counties(
    df: DataFrame, path: str, tie: tuple[str, ...] = ("parcel_id",), partitions: int | None = None, overwrite: bool = False
) -> str | None:
    """Publish the counties of a table that are not published yet, or all of them with `overwrite`.

    Returns the run, or None when there was nothing to do. The counting pass also finds the extents that the sort needs.
    """
    spark = df.sparkSession
    rows = with_partition_keys(with_box(df))
    done = None if overwrite else committed(spark, path)
    if done is not None:
        rows = rows.join(F.broadcast(done.where("n > 0").select(*KEYS)), KEYS, "left_anti")
    return publish_rows(rows, path, tie, partitions)


def publish_rows(
    rows: DataFrame, path: str, tie: tuple[str, ...], partitions: int | None = None, known: DataFrame | None = None, gone: DataFrame | None = None
) -> str | None:
    """Write keyed rows as one run, check it and commit it; None when there are no rows and nothing is gone.

    `known` has the `contents` of these rows, where the caller has them; `gone` the keys of partitions that are to vanish.
    """
    spark = rows.sparkSession
    schema = T._parse_datatype_string(ENTRY.replace("run string, ", ""))
    wanted = (contents(rows) if known is None else known).select(*schema.fieldNames()).collect()
    lost = [] if gone is None else [(r.state, r.county, 0, None, None, None, None, None) for r in gone.select(*KEYS).collect()]
    if not wanted and not lost:
        return None
    run = new_run()
    entries = spark.createDataFrame([*wanted, *lost], schema)
    if wanted:
        write_run(rows, path, tie, run, entries.where("n > 0"), partitions)
        check_run(spark, path, run, entries.where("n > 0"))
    commit(entries, path, run)
    return run


def check_run(spark: SparkSession, path: str, run: str, entries: DataFrame) -> None:
    """Compare the rows in a run's files with its entries; raises where they differ. Only the run's own files are read."""
    root = path.rstrip("/")
    stored = spark.read.option("basePath", path).schema(", ".join(f"{k} string" for k in (*KEYS, RUN))).parquet(f"{root}/state=*/county=*/{RUN}={run}")
    found = stored.groupBy(*KEYS).agg(F.count("*").alias("_stored"))
    wrong = entries.join(found, KEYS, "full").where(~F.col("n").eqNullSafe(F.col("_stored"))).limit(5).collect()
    if wrong:
        raise IncompleteRun(f"run {run}: {[(r.state, r.county, r.n, r._stored) for r in wrong]}")


def leftovers(spark: SparkSession, path: str, active: tuple[str, ...] = ()) -> list[str]:
    """Folders of runs that no entry in force names. `active` are runs that still write and are left out."""
    root = path.rstrip("/")
    if not path_exists(spark, f"{root}/state=*/county=*/{RUN}=*"):
        return []
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/state=*/county=*/{RUN}=*")
    store = pattern.getFileSystem(spark._jsc.hadoopConfiguration())
    entries = committed(spark, path)
    live = set() if entries is None else {(r.state, r.county, r.run) for r in entries.where("n > 0").collect()}
    out = []
    for status in store.globStatus(pattern):
        state, county, run = (part.split("=", 1)[1] for part in status.getPath().toString().rsplit("/", 3)[1:])
        if (state, county, run) not in live and run not in active:
            out.append(status.getPath().toString())
    return sorted(out)


def vacuum(spark: SparkSession, path: str, active: tuple[str, ...] = ()) -> int:
    """Delete what `leftovers` names. The caller lists the runs that still write."""
    found = leftovers(spark, path, active)
    for name in found:
        folder = spark._jvm.org.apache.hadoop.fs.Path(name)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    return len(found)
