"""Raw layer -> normalized parcel table, and the views on top of it."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import window as W

from cadastra import lookups
from cadastra.functions import geometry as G
from cadastra.operators.skew import few_groups
from cadastra.schemas import PARCEL_COLUMNS

SCORED = ["totalvalue", "yearbuilt", "parceladdr", "ownername"]


def resolved_id() -> Column:
    """First id a raw row has: parcelid, parcelid2, then its row number as text."""
    return F.coalesce(F.col("parcelid"), F.col("parcelid2"), F.col("lrid").cast("string"))


def coverage_score() -> Column:
    """How many of the four key attributes a raw row has."""
    return reduce(lambda a, b: a + b, [F.col(c).isNotNull().cast("int") for c in SCORED])


def deduplicate(raw: DataFrame, unique_lrid: bool = False) -> DataFrame:
    """Keep the best-covered raw row of each (geoid, resolved id), then the one with the highest lrid.

    `row_number() = 1` is planned as a group limit that runs before the shuffle as well, so every map task sends at
    most one row per key: a key holding a large part of the table costs no task more than that. Rows that tie on
    both criteria are ordered by a hash of their contents, so a recomputed task makes the same choice. With
    `unique_lrid` there are no such ties, and only the columns that are used later are read.
    """
    order = [F.desc("_score"), F.col("lrid").desc_nulls_first()]
    if not unique_lrid:
        order.append(F.desc("_content"))
    best_first = W.Window.partitionBy("geoid", "resolved_id").orderBy(*order)
    return (
        raw.where(F.col("geoid").isNotNull())
        .withColumn("resolved_id", resolved_id())
        .withColumn("_score", coverage_score())
        .withColumn("_content", F.xxhash64(*raw.columns))
        .withColumn("_rank", F.row_number().over(best_first))
        .where(F.col("_rank") == 1)
        .drop("_score", "_content", "_rank")
    )


def _to_multipolygon(raw: DataFrame, geom: str) -> Column:
    def depth(kind: T.DataType) -> int:
        return 1 + depth(kind.elementType) if isinstance(kind, T.ArrayType) else 0

    column = F.col(geom)
    return G.multi(column) if depth(raw.schema[geom].dataType) == 2 else column


def normalize(
    raw: DataFrame, strict: bool = True, clean_owner: bool = False, unique_lrid: bool = False
) -> DataFrame:
    """Typed, deduplicated parcel table from the raw layer.

    `strict` casts fail the job on a value out of range; otherwise such values become null and `cast_failures` lists
    them. `clean_owner` upper-cases and trims owner names, which are passed through by default.
    """
    rows = deduplicate(raw, unique_lrid)
    present = dict(raw.dtypes)

    def typed(source: str, kind: str) -> Column:
        if source not in present:
            return F.lit(None).cast(kind)
        column = F.col(source)
        if source == "ownername" and clean_owner:
            column = F.upper(F.trim(column))
        if present[source] == kind:
            return column
        return column.cast(kind) if strict else column.try_cast(kind)

    columns = [typed(source, kind).alias(target) for target, source, kind, _ in PARCEL_COLUMNS]
    geom = _to_multipolygon(raw, "geom") if "geom" in present else F.lit(None).cast("string")
    bbox = [F.col("bbox")] if "bbox" in present else ([G.bbox_of(geom).alias("bbox")] if "geom" in present else [])
    points = [
        G.point(F.col(x), F.col(y)).alias(name)
        for name, x, y in (("centroid", "centroidx", "centroidy"), ("surface_point", "surfpointx", "surfpointy"))
        if {x, y} <= set(present)
    ]
    return rows.select(
        F.xxhash64("geoid", "resolved_id").alias("id"),
        F.col("resolved_id").alias("parcel_id"),
        *columns,
        F.current_timestamp().alias("created_at"),
        *points,
        geom.alias("geom"),
        *bbox,
    )


def cast_failures(raw: DataFrame, key: str = "lrid") -> DataFrame:
    """Raw values that do not fit their normalized type: key, column, value."""
    checked = [
        F.struct(F.lit(source).alias("column"), F.col(source).cast("string").alias("value"),
                 (F.col(source).isNotNull() & F.col(source).try_cast(kind).isNull()).alias("bad"))
        for _, source, kind, _ in PARCEL_COLUMNS
        if source in raw.columns and kind != "string"
    ]
    return (
        raw.select(key, F.explode(F.filter(F.array(*checked), lambda c: c["bad"])).alias("f"))
        .select(key, "f.column", "f.value")
    )


def parcel_full(parcels: DataFrame, counties: DataFrame) -> DataFrame:
    """Parcels with state name and abbreviation (unknown states drop) and county name (may be null)."""
    spark: SparkSession = parcels.sparkSession
    states = F.broadcast(lookups.states(spark))
    names = F.broadcast(lookups.county_table(counties))
    return (
        parcels.withColumn("statefp", F.substring("geoid", 1, 2))
        .join(states, "statefp")
        .join(names, "geoid", "left")
        .select(*parcels.columns, "state_name", "state_abbr", "county_name")
    )


def land_use_codes(parcels: DataFrame, code: str = "use_code", description: str = "use_description") -> DataFrame:
    """Lookup of use codes: the most common description (ties: the first alphabetically) and its category.

    Descriptions are counted per code first, so a code with many rows is already reduced before it is compared.
    """
    counted = (
        parcels.where(F.col(code).isNotNull() & F.col(description).isNotNull())
        .groupBy(F.col(code).alias("use_code"), F.col(description).alias("use_description"))
        .agg(F.count("*").alias("n"))
    )
    best = counted.groupBy("use_code").agg(
        F.min_by("use_description", F.struct(-F.col("n"), F.col("use_description"))).alias("use_description"),
        F.max("n").alias("n_rows"),
    )
    return best.withColumn("use_category", lookups.land_use_category(F.col("use_description")))


def with_land_use(parcels: DataFrame, codes: DataFrame) -> DataFrame:
    """Add the lookup description and category of the use code; unknown codes stay null.

    The lookup has one short row per code and is broadcast when the codes are few; otherwise the adaptive skew join splits
    a popular code.
    """
    lookup = codes.select(
        "use_code", F.col("use_description").alias("code_description"), F.col("use_category")
    )
    if few_groups(parcels, ["use_code"]):
        lookup = F.broadcast(lookup)
    return parcels.join(lookup, "use_code", "left")
