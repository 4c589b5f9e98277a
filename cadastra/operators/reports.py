"""Aggregating reports. Every one is a single hash aggregation with a map-side partial step."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from cadastra import lookups
from cadastra.functions import geometry as G
from cadastra.functions.display import value_class
from cadastra.operators.skew import few_groups

# Column of the coverage report <- parcel column.
COVERAGE = {
    "pct_address": "parcel_address",
    "pct_owner": "owner_name",
    "pct_value": "total_value",
    "pct_yearbuilt": "year_built",
    "pct_usedesc": "use_description",
    "pct_saleamt": "sale_amount",
    "pct_bldgsqft": "building_sqft",
    "pct_zoning": "zoning_code",
    "pct_legal": "legal_description",
}


def coverage(parcels: DataFrame, counties: DataFrame) -> DataFrame:
    """Per county: number of parcels and the percentage of them that have each attribute.

    Counties of unknown states drop out. Parcels are aggregated by geoid before the names are joined, so the joins
    see one row per county.
    """
    spark = parcels.sparkSession
    counts = [F.count(source).alias(name) for name, source in COVERAGE.items()]
    per_county = parcels.groupBy("geoid").agg(F.count("*").alias("total_parcels"), *counts)
    percent = [
        F.round(F.lit(100.0).cast("decimal(4,1)") * F.col(name) / F.col("total_parcels"), 1).alias(name)
        for name in COVERAGE
    ]
    return (
        per_county.withColumn("statefp", F.substring("geoid", 1, 2))
        .withColumn("countyfp", F.substring("geoid", 3, 3))
        .join(F.broadcast(lookups.states(spark)), "statefp")
        .join(F.broadcast(lookups.county_table(counties)), "geoid", "left")
        .select("statefp", "countyfp", "geoid", "state_abbr", "county_name", "total_parcels", *percent)
        .orderBy("geoid")
    )


def fips_summary(raw: DataFrame) -> DataFrame:
    """Rows and non-null counts per state+county code; a missing part makes the code null."""
    return raw.groupBy(F.concat("statefp", "countyfp").alias("fips")).agg(
        F.count("*").alias("parcels"),
        F.count("parceladdr").alias("has_address"),
        F.count("totalvalue").alias("has_value"),
        F.count("ownername").alias("has_owner"),
    )


def counts_by(df: DataFrame, *keys: str, name: str = "parcels", largest_first: bool = False) -> DataFrame:
    """Rows per key, ordered by key or by count."""
    order = [F.desc(name), *keys] if largest_first else list(keys)
    return df.groupBy(*keys).agg(F.count("*").alias(name)).orderBy(*order)


def value_totals(raw: DataFrame, *keys: str, value: str = "totalvalue", limit: int | None = 10) -> DataFrame:
    """Rows and total value per key, largest groups first; nulls do not count towards the total."""
    totals = raw.groupBy(*keys).agg(F.count("*").alias("n"), F.sum(value).alias("total_assessed"))
    ordered = totals.orderBy(F.desc("n"), *keys)
    return ordered if limit is None else ordered.limit(limit)


def medians_by(df: DataFrame, keys: list[str], columns: list[str], accuracy: int = 10_000) -> DataFrame:
    """Exact medians per group without bringing any group into one task.

    A mergeable quantile sketch brackets the median of each group between two values that hold a share of about
    6/accuracy of its rows. A second pass counts the rows below the bracket and the distinct values inside it, and
    only that sliver is ranked. The bracket is checked: a median outside it fails the job instead of being wrong.
    """
    pairs = F.explode(
        F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("double").alias("value")) for c in columns])
    )
    long = df.select(*keys, pairs.alias("p")).select(*keys, "p.name", "p.value").where(F.col("value").isNotNull())
    group = [*keys, "name"]
    margin = 3.0 / accuracy
    bracket = F.percentile_approx("value", [0.5 - margin, 0.5 + margin], accuracy)
    sketch = (
        long.groupBy(*group)
        .agg(F.count("*").alias("_n"), bracket.alias("_q"))
        .select(*group, "_n", F.col("_q")[0].alias("_lo"), F.col("_q")[1].alias("_hi"))
    )
    # One short row per group: broadcast when the groups are few, so the table itself is not shuffled for the bracket.
    if few_groups(df, keys):
        sketch = F.broadcast(sketch)
    same_group = G.all_of([F.col(f"v.{c}").eqNullSafe(F.col(f"s.{c}")) for c in group])
    near = (
        long.alias("v")
        .join(sketch.alias("s"), same_group)
        .where(F.col("value") <= F.col("_hi"))
        .select(*[f"v.{c}" for c in group], "_n", F.when(F.col("value") >= F.col("_lo"), F.col("value")).alias("value"))
        .groupBy(*group, "_n", "value")
        .agg(F.count("*").alias("_rows"))
    )
    # Rows below the bracket are one entry with a null value, which sorts first.
    upto = W.Window.partitionBy(*group).orderBy(F.col("value").asc_nulls_first())
    ranked = near.withColumn("_end", F.sum("_rows").over(upto.rowsBetween(W.Window.unboundedPreceding, 0)))
    start, end = F.col("_end") - F.col("_rows"), F.col("_end")

    def at(rank: Column) -> Column:
        return F.max(F.when((start <= rank) & (rank < end), F.col("value")))

    n = F.col("_n")
    middle = ranked.groupBy(*group).agg(
        at(F.floor((n - 1) / 2)).alias("_low"), at(F.floor(n / 2)).alias("_high")
    )
    checked = F.when(
        F.col("_low").isNotNull() & F.col("_high").isNotNull(), (F.col("_low") + F.col("_high")) / 2
    ).otherwise(F.raise_error(F.lit("median outside its bracket: raise accuracy")).cast("double"))
    wide = (
        middle.select(*group, checked.alias("median"))
        .groupBy(*keys)
        .agg(*[F.max(F.when(F.col("name") == c, F.col("median"))).alias(f"median_{c}") for c in columns])
    )
    sizes = df.groupBy(*keys).agg(F.count("*").alias("n"))
    on = G.all_of([F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in keys])
    return sizes.alias("a").join(wide.alias("b"), on, "left").select(
        *[f"a.{c}" for c in keys], "n", *[f"median_{c}" for c in columns]
    )


def approximate_medians_by(df: DataFrame, keys: list[str], columns: list[str], accuracy: int = 10_000) -> DataFrame:
    """Medians within a rank error of 1/accuracy, in one pass."""
    return df.groupBy(*keys).agg(
        F.count("*").alias("n"),
        *[F.percentile_approx(F.col(c).cast("double"), 0.5, accuracy).alias(f"median_{c}") for c in columns],
    )


def _extent(bbox: Column) -> list[Column]:
    return [
        F.min(bbox["xmin"]).alias("xmin"), F.min(bbox["ymin"]).alias("ymin"),
        F.max(bbox["xmax"]).alias("xmax"), F.max(bbox["ymax"]).alias("ymax"), F.count("*").alias("n"),
    ]


def extents_by(df: DataFrame, *keys: str, bbox: str = "bbox") -> DataFrame:
    """Extent and rows per group, in one scan of the box columns."""
    return df.groupBy(*keys).agg(*_extent(F.col(bbox)))


def extent(df: DataFrame, bbox: str = "bbox") -> DataFrame:
    """Extent and rows of the whole table."""
    return df.agg(*_extent(F.col(bbox)))


def county_boxes(counties: DataFrame, statefp: str, geom: str = "geom") -> DataFrame:
    """Boxes of the counties of a state from the boundary table."""
    found = counties.where(F.col("STATEFP") == statefp).select("COUNTYFP", G.bbox_of(F.col(geom)).alias("b"))
    return found.select("COUNTYFP", "b.*")


def edge_profile(edges: DataFrame) -> DataFrame:
    """One-row profile of a boundary-edge table."""
    return edges.agg(
        F.count("*").alias("total_edges"),
        F.countDistinct("MTFCC").alias("mtfcc_types"),
        F.count_if(F.col("ROADFLG") == "Y").alias("road_edges"),
        F.concat(F.min("STATEFP"), F.min("COUNTYFP")).alias("fips"),
    )


def geometry_profile(df: DataFrame, geom: str = "geom", bbox: str = "bbox") -> DataFrame:
    """One-row encoding profile: type of the geometry column, rows and horizontal extent."""
    kind = F.typeof(F.any_value(F.col(geom), ignoreNulls=True))
    return df.agg(
        kind.alias("geom_type"), F.count("*").alias("n"),
        F.min(F.col(bbox)["xmin"]).alias("xmin"), F.max(F.col(bbox)["xmax"]).alias("xmax"),
    )


def column_profile(df: DataFrame) -> DataFrame:
    """Name, type, non-null count, min and max of every column, from one aggregation."""
    ordered = {"tinyint", "smallint", "int", "bigint", "float", "double", "string", "date", "timestamp",
               "timestamp_ntz", "boolean"}

    def comparable(kind: str) -> bool:
        return kind in ordered or kind.startswith("decimal")

    aggregates, entries = [], []
    for i, (name, kind) in enumerate(df.dtypes):
        column = F.col(f"`{name}`")
        aggregates.append(F.count(column).alias(f"c{i}"))
        low, high = F.lit(None).cast("string"), F.lit(None).cast("string")
        if comparable(kind):
            aggregates += [F.min(column).cast("string").alias(f"l{i}"), F.max(column).cast("string").alias(f"h{i}")]
            low, high = F.col(f"l{i}"), F.col(f"h{i}")
        entries.append(
            F.struct(
                F.lit(i + 1).alias("position"), F.lit(name).alias("column_name"), F.lit(kind).alias("column_type"),
                F.col(f"c{i}").alias("non_null"), low.alias("min_value"), high.alias("max_value"),
            )
        )
    return df.agg(*aggregates).select(F.explode(F.array(*entries)).alias("e")).select("e.*")


def vertex_profile(df: DataFrame, *keys: str, geom: str = "geom") -> DataFrame:
    """Rows and vertex statistics per group."""
    n = G.vertex_count(F.col(geom))
    return df.groupBy(*keys).agg(
        F.count("*").alias("n"), F.min(n).alias("min_vertices"), F.avg(n).alias("avg_vertices"),
        F.max(n).alias("max_vertices"),
    )


def cell_summary(df: DataFrame, x: Column, y: Column, size: float, value: str) -> DataFrame:
    """Rows, total and exact median of a value per square cell of `size` degrees."""
    cells = df.where(x.isNotNull() & y.isNotNull()).withColumns(
        {"cell_x": F.floor(x / F.lit(size)), "cell_y": F.floor(y / F.lit(size))}
    )
    totals = cells.groupBy("cell_x", "cell_y").agg(F.sum(value).alias(f"sum_{value}"))
    return medians_by(cells, ["cell_x", "cell_y"], [value]).join(totals, ["cell_x", "cell_y"])


def value_histogram(df: DataFrame, value: str, scale: str = "map") -> DataFrame:
    """Rows per value class of a colour scale; rows without a value form the null class."""
    return df.groupBy(value_class(F.col(value), scale).alias("class_from")).agg(F.count("*").alias("n"))


def status_report(tables: dict[str, DataFrame], bbox: str = "bbox") -> DataFrame:
    """Rows and extent of several datasets, one line each."""
    lines = []
    for name, df in tables.items():
        columns = _extent(F.col(bbox)) if bbox in df.columns else [
            *[F.lit(None).cast("double").alias(c) for c in ("xmin", "ymin", "xmax", "ymax")],
            F.count("*").alias("n"),
        ]
        lines.append(df.agg(*columns).withColumn("table_name", F.lit(name)))
    report = lines[0]
    for line in lines[1:]:
        report = report.unionByName(line)
    return report.select("table_name", "n", "xmin", "ymin", "xmax", "ymax")
