"""Physical layout: Hilbert-sorted, row-group-bounded, Hive-partitioned Parquet with covering boxes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cadastra.functions import geometry as G
from cadastra.functions import mercator as M
from cadastra.functions.hilbert import hilbert_of_box
from cadastra.lookups import WORLD, bounds_of
from cadastra.operators.filters import with_box
from cadastra.operators.reports import extents_by
from cadastra.sources.tables import read_hive

# Compression level and rows per row group of the two published layouts.
STATE_LAYOUT = {"level": 3, "rows": 50_000}
COUNTY_LAYOUT = {"level": 9, "rows": 10_000}

UNASSIGNED = "unassigned"
TASK_BYTES = 256 * 1024 * 1024
FILE_ROWS = 5_000_000


def input_bytes(df: DataFrame) -> int:
    """Bytes on storage of the files that a table is read from (0 for a table without files)."""
    spark = df.sparkSession
    files = df.inputFiles()
    total = 0
    for name in {f.rsplit("/", 1)[0] for f in files}:
        folder = spark._jvm.org.apache.hadoop.fs.Path(name)
        total += folder.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(folder).getLength()
    return total


def width_of(df: DataFrame, task_bytes: int = TASK_BYTES) -> int | None:
    """Tasks for a sorted write of `df`: one for each `task_bytes` that it is read from.

    None where that is fewer than the session's shuffle partitions, which Spark then merges by their measured size.
    """
    wanted = -(-input_bytes(df) // task_bytes)
    return wanted if wanted > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) else None


def spread(df: DataFrame, by: list[str]) -> DataFrame:
    """Rows dealt over tasks by a hash of some columns, before work that multiplies them; dense files are evened out.

    The width is that of the session, or one task for each `TASK_BYTES` of input where that is more.
    """
    width = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), width_of(df) or 0)
    return df.repartition(width, F.xxhash64(*by))


def _sorted_by(df: DataFrame, keys: list[str], tie: list[str], partitions: int | None) -> DataFrame:
    """Range-partition and sort. The tie columns are part of the range, so equal positions split over tasks too.

    Without `partitions` the width follows the bytes of the input.
    """
    order = [F.col(c) for c in [*keys, *tie]]
    partitions = partitions or width_of(df)
    ranged = df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)
    return ranged.sortWithinPartitions(*order)


def hilbert_sorted(
    df: DataFrame, bounds: G.Box = WORLD, tie: tuple[str, ...] = ("parcel_id",), partitions: int | None = None
) -> DataFrame:
    """Rows in Hilbert order of their box centres inside the bounds: one range shuffle, then local sorts."""
    placed = with_box(df).withColumn("_hilbert", hilbert_of_box(F.col("bbox"), G.box_literal(bounds)))
    return _sorted_by(placed, ["_hilbert"], list(tie), partitions).drop("_hilbert")


def hilbert_sorted_state(df: DataFrame, statefp: str | None = None, **options) -> DataFrame:
    """As `hilbert_sorted` in the bounds of a state; the whole world when no state is given."""
    return hilbert_sorted(df, WORLD if statefp is None else bounds_of(statefp), **options)


def write_parquet(
    df: DataFrame, path: str, level: int = 3, rows: int = 50_000, partition_by: tuple[str, ...] = (),
    mode: str = "overwrite",
) -> None:
    """ZSTD Parquet with bounded row groups and files; rows stay in the order of the DataFrame."""
    writer = (
        df.write.mode(mode)
        .option("compression", "zstd")
        .option("parquet.compression.codec.zstd.level", level)
        .option("parquet.block.row.count.limit", rows)
        .option("maxRecordsPerFile", FILE_ROWS)
    )
    if partition_by:
        # An overwrite replaces the partitions it writes and leaves the others.
        writer = writer.partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)


def _directory_key(column: str, digits: int) -> Column:
    return F.when(F.col(column).rlike(f"^[0-9]{{{digits}}}$"), F.col(column)).otherwise(F.lit(UNASSIGNED))


def with_state_key(df: DataFrame) -> DataFrame:
    """Add the state directory key; codes that are not two digits go to 'unassigned'."""
    return df.withColumn("state", _directory_key("statefp", 2))


def with_partition_keys(df: DataFrame) -> DataFrame:
    """Add state and county directory keys; codes that are not two and three digits go to 'unassigned'."""
    return with_state_key(df).withColumn("county", _directory_key("countyfp", 3))


def by_state(df: DataFrame, tie: tuple[str, ...], partitions: int | None = None) -> DataFrame:
    """Rows of every state in Hilbert order of that state's data, all states in one job."""
    return _in_group_order(with_state_key(with_box(df)), ["state"], tie, partitions)


def by_county(df: DataFrame, tie: tuple[str, ...], partitions: int | None = None) -> DataFrame:
    """Rows of every county in Hilbert order of the county's own extent, all counties in one job."""
    return _in_group_order(with_partition_keys(with_box(df)), ["state", "county"], tie, partitions)


def _in_group_order(df: DataFrame, keys: list[str], tie: tuple[str, ...], partitions: int | None) -> DataFrame:
    return ordered_in_groups(df, keys, tie, extents_by(df, *keys), partitions)


def ordered_in_groups(df: DataFrame, keys: list[str], tie: tuple[str, ...], extents: DataFrame, partitions: int | None = None) -> DataFrame:
    """Rows in Hilbert order inside the extent of their group; `extents` has one row for each group."""
    # The keys are two- and three-digit codes or 'unassigned' (101 * 1,001 values at most), so the extents are a
    # bounded table and broadcasting them is safe.
    boxes = extents.select(*keys, F.struct("xmin", "ymin", "xmax", "ymax").alias("_extent"))
    placed = df.join(F.broadcast(boxes), keys).withColumn("_hilbert", hilbert_of_box(F.col("bbox"), F.col("_extent")))
    return _sorted_by(placed, [*keys, "_hilbert"], list(tie), partitions).drop("_hilbert", "_extent")


def write_by_state(df: DataFrame, path: str, tie: tuple[str, ...] = ("parcel_id",), partitions: int | None = None,
                   mode: str = "overwrite") -> None:
    """Publish path/state=XX/."""
    write_parquet(by_state(df, tie, partitions), path, **STATE_LAYOUT, partition_by=("state",), mode=mode)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether anything matches a path or glob, on whatever file system it names."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern)
    return found is not None and len(found) > 0


def write_by_raw_keys(df: DataFrame, path: str, tie: tuple[str, ...] = ("parcel_id",), partitions: int | None = None) -> None:
    """Publish path/statefp=XX/countyfp=YYY/ (the raw column names as directories)."""
    ordered = _sorted_by(df, ["statefp", "countyfp"], list(tie), partitions)
    write_parquet(ordered, path, partition_by=("statefp", "countyfp"))


def with_cell(df: DataFrame, zoom: int = 6) -> DataFrame:
    """Add a coarse spatial cell key 'x-y' from the tile grid, taken at the centre of the box."""
    b = F.col("bbox")
    x = M.tile_x((b["xmin"] + b["xmax"]) / 2, F.lit(zoom))
    y = M.tile_y((b["ymin"] + b["ymax"]) / 2, F.lit(zoom))
    return df.withColumn("cell", F.concat_ws("-", x, y))


def write_by_cell(
    df: DataFrame, path: str, zoom: int = 6, tie: tuple[str, ...] = ("parcel_id",), partitions: int | None = None
) -> None:
    """Publish path/cell=x-y/ instead of administrative directories."""
    celled = with_cell(with_box(df), zoom).withColumn(
        "_hilbert", hilbert_of_box(F.col("bbox"), G.box_literal(WORLD))
    )
    ordered = _sorted_by(celled, ["cell", "_hilbert"], list(tie), partitions).drop("_hilbert")
    write_parquet(ordered, path, partition_by=("cell",))


def manifest(dataset: DataFrame, keys: list[str]) -> DataFrame:
    """Catalogue entry per partition: rows, files, bytes and extent, from one scan of the box columns."""
    per_file = (
        dataset.groupBy(*keys, F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("bytes"))
        .agg(*[f(F.col(f"bbox.{c}")).alias(c) for f, c in
               ((F.min, "xmin"), (F.min, "ymin"), (F.max, "xmax"), (F.max, "ymax"))], F.count("*").alias("n"))
    )
    return per_file.groupBy(*keys).agg(
        F.sum("n").alias("n"), F.count("*").alias("files"), F.sum("bytes").alias("bytes"),
        F.min("xmin").alias("xmin"), F.min("ymin").alias("ymin"),
        F.max("xmax").alias("xmax"), F.max("ymax").alias("ymax"),
    )


def write_manifest(dataset: DataFrame, keys: list[str], path: str) -> None:
    """Write the catalogue entries as JSON lines next to the data."""
    manifest(dataset, keys).write.mode("overwrite").json(path)


def publish_version(df: DataFrame, root: str, version: str, view: str, **options) -> str:
    """Full refresh that readers never see half done: write a new version, then point the view at it."""
    path = f"{root.rstrip('/')}/version={version}"
    write_parquet(df, path, **options)
    create_view(df.sparkSession, view, path)
    return path


def create_view(spark: SparkSession, name: str, path: str) -> None:
    """Create or replace a temporary view over a Parquet dataset."""
    read_hive(spark, path).createOrReplaceTempView(name)


def layout_quality(dataset: DataFrame, rows: int) -> DataFrame:
    """How well a layout separates space: boxes of all row runs of `rows` rows against the whole extent.

    `mean_share` is the mean area of a run's box over the area of the dataset: small after a spatial sort, near one
    without it.
    """
    b = F.col("bbox")
    box = [F.min(b["xmin"]).alias("xmin"), F.min(b["ymin"]).alias("ymin"),
           F.max(b["xmax"]).alias("xmax"), F.max(b["ymax"]).alias("ymax")]
    runs = dataset.groupBy(
        F.col("_metadata.file_path").alias("file"), F.floor(F.col("_metadata.row_index") / rows).alias("run")
    ).agg(*box, F.count("*").alias("n"))
    size = (F.col("xmax") - F.col("xmin")) * (F.col("ymax") - F.col("ymin"))
    whole = (F.max("xmax") - F.min("xmin")) * (F.max("ymax") - F.min("ymin"))
    return runs.agg(
        F.count("*").alias("runs"), F.sum("n").alias("n"), (F.avg(size) / whole).alias("mean_share"),
    )
