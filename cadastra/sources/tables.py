"""Parquet scans, object-store settings, inventory and ad-hoc SQL."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadastra.operators.filters import in_box, intersecting_box, of_state
from cadastra.functions.geometry import Box

def read_file(spark: SparkSession, path: str) -> DataFrame:
    """One GeoParquet file or directory."""
    return spark.read.parquet(path)


def _directory_keys(spark: SparkSession, path: str) -> list[str]:
    """Names of the directory columns under a path, from the first branch of its tree."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    keys: list[str] = []
    while folder is not None:
        inner = [c.getPath() for c in store.listStatus(folder) if c.isDirectory() and "=" in c.getPath().getName()]
        folder = inner[0] if inner else None
        keys += [folder.getName().split("=")[0]] if inner else []
    return keys


def read_hive(spark: SparkSession, path: str) -> DataFrame:
    """Hive-partitioned dataset; directory values stay text, so state=01 is '01'.

    The directory columns are declared as text, so no setting of the session has to change.
    """
    keys = _directory_keys(spark, path)
    found = spark.read.parquet(path).schema
    kinds = [T.StructField(f.name, T.StringType() if f.name in keys else f.dataType, f.nullable) for f in found]
    return spark.read.schema(T.StructType(kinds)).parquet(path)


def read_flat(spark: SparkSession, directory: str) -> DataFrame:
    """Only the Parquet files directly in a directory."""
    return spark.read.parquet(f"{directory.rstrip('/')}/*.parquet")


def read_by_name(spark: SparkSession, *paths: str) -> DataFrame:
    """Many files with different columns: columns are matched by name, missing ones are null."""
    return spark.read.option("mergeSchema", "true").parquet(*paths)


def union_by_name(*tables: DataFrame) -> DataFrame:
    """All rows of several tables, columns matched by name, missing ones null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def append_rows(df: DataFrame, path: str) -> None:
    """Append to the landing table."""
    df.write.mode("append").parquet(path)


def extract_raw(spark: SparkSession, path: str, bounds: Box | None, statefp: str | None) -> DataFrame:
    """Rows of the landed raw layer that meet a box and name a state.

    The box comparison and the state reach the scan; geometries whose box only brushes the bounds are tested exactly.
    """
    rows = spark.read.parquet(path)
    if bounds is not None:
        rows = intersecting_box(rows, bounds) if "geom" in rows.columns else in_box(rows, bounds)
    return rows if statefp is None else of_state(rows, statefp)


def attributes_only(df: DataFrame, geom: str = "geom") -> DataFrame:
    """Lazy attribute table: the geometry columns are never read."""
    return df.drop(geom, "bbox")


def object_store_settings(
    endpoint: str, access_key: str, secret_key: str, secure: bool = True, path_style: bool = True
) -> dict[str, str]:
    """Session settings for s3a:// paths on an S3-compatible store (pass them when the session is built)."""
    return {
        "spark.hadoop.fs.s3a.endpoint": endpoint,
        "spark.hadoop.fs.s3a.access.key": access_key,
        "spark.hadoop.fs.s3a.secret.key": secret_key,
        "spark.hadoop.fs.s3a.connection.ssl.enabled": str(secure).lower(),
        "spark.hadoop.fs.s3a.path.style.access": str(path_style).lower(),
    }


def blob_path(account: str, container: str, path: str) -> str:
    """abfss:// path of a blob dataset."""
    return f"abfss://{container}@{account}.dfs.core.windows.net/{path.lstrip('/')}"


def inventory(dataset: DataFrame) -> DataFrame:
    """Published files: name, format, rows and size, from file metadata without reading a column."""
    path = F.col("_metadata.file_path")
    return (
        dataset.groupBy(path.alias("path"), F.col("_metadata.file_name").alias("name"),
                        F.col("_metadata.file_size").alias("bytes"))
        .agg(F.count("*").alias("n"))
        .select("path", "name", F.lower(F.regexp_extract("name", r"\.([A-Za-z0-9]+)$", 1)).alias("format"), "n",
                F.round(F.col("bytes") / 1024 / 1024, 2).alias("size_mb"))
    )


def extent_from_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Extent and rows of a dataset from its catalogue entries, without scanning it."""
    return spark.read.json(path).agg(
        F.min("xmin").alias("xmin"), F.min("ymin").alias("ymin"),
        F.max("xmax").alias("xmax"), F.max("ymax").alias("ymax"), F.sum("n").alias("n"),
    )


def query(dataset: DataFrame, sql: str) -> DataFrame:
    """Run SQL over the dataset as view `parcels`; `reports.fips_summary` is the usual first look."""
    dataset.createOrReplaceTempView("parcels")
    return dataset.sparkSession.sql(sql)
