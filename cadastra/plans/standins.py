"""Land-record tables derived from the given order, customer, supplier, part and event tables.

Every row of the source tables takes part, so the work of a query grows with the data. The reference SQL in
`oracles` derives the same tables independently.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadastra.functions import geometry as G
from cadastra.lookups import STATE_BOUNDS

# State of each region key.
REGION_STATE = {0: "13", 1: "37", 2: "06", 3: "12", 4: "48"}
LOT = 0.0005  # side of a lattice lot in degrees
LOT_ORIGIN = (-84.5, 31.0)
LOT_COLUMNS, LOT_ROWS = 61, 50_000  # further lots go on in new columns to the east
ZONE = 0.25  # side of a zone in degrees
RASTER_ORIGIN, RASTER_PIXEL = (-125.0, 50.0), (1.5, 1.0)


_SCHEMAS: dict[str, T.StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables. Its schema is read from the files once per process, not once per query."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def _lookup(values: dict[int, object]) -> str:
    entries = ", ".join(f"{k}, {v}" for k, v in values.items())
    return f"element_at(map({entries}), n_regionkey)"


def _nations(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounds = [
        _lookup({k: f"{STATE_BOUNDS[s][i]}D" for k, s in REGION_STATE.items()}) + f" AS {name}"
        for i, name in enumerate(("x0", "y0", "x1", "y1"))
    ]
    return table(spark, sf_dir, "nation").selectExpr(
        "n_nationkey", "n_name", _lookup({k: f"'{s}'" for k, s in REGION_STATE.items()}) + " AS statefp",
        "lpad(cast(n_nationkey * 2 + 1 AS string), 3, '0') AS countyfp", *bounds,
    )


def parcel_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw parcels: one per order, placed in the state of the customer's region."""
    orders = table(spark, sf_dir, "orders")
    placed = (
        orders.join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(_nations(spark, sf_dir), F.col("c_nationkey") == F.col("n_nationkey"))
        .selectExpr(
            "*", "o_orderkey AS k",
            "x0 + (x1 - x0) * (cast((o_orderkey * 7919) % 10000 AS double) / 10000) AS centroidx",
            "y0 + (y1 - y0) * (cast((o_orderkey * 104729) % 10000 AS double) / 10000) AS centroidy",
            "0.0005D * (1 + o_orderkey % 5) AS half",
        )
    )
    rows = placed.selectExpr(
        "k AS lrid",
        "if(k % 11 != 0, concat('P', floor(k / 3)), null) AS parcelid",
        "if(k % 13 != 0, concat('A', floor(k / 3)), null) AS parcelid2",
        "statefp",
        "countyfp",
        "if(k % 97 != 0, concat(statefp, countyfp), null) AS geoid",
        "year(o_orderdate) AS taxyear",
        "concat('U', k % 12) AS usecode",
        "lower(c_mktsegment) AS usedesc",
        "if(k % 4 != 1, concat('Z', k % 6), null) AS zoningcode",
        "cast(k % 3 AS int) AS numbldgs",
        "if(k % 3 != 0, cast(year(o_orderdate) - k % 60 AS int), null) AS yearbuilt",
        "if(k % 5 != 0, cast(500 + k % 4000 AS int), null) AS bldgsqft",
        "if(k % 7 != 0, cast(floor(o_totalprice) AS bigint), null) AS totalvalue",
        "cast(k % 400 AS double) / 100 AS assdacres",
        "if(k % 4 != 0, cast(floor(o_totalprice / 2) AS bigint), null) AS saleamt",
        "o_orderdate AS saledate",
        "if(k % 17 != 0, c_name, null) AS ownername",
        "if(k % 19 != 0, concat(100 + k % 900, ' Peachtree St ', k % 40), null) AS parceladdr",
        "'Springfield' AS parcelcity",
        "if(k % 10 >= 7, concat('LOT ', k % 50), null) AS legaldesc",
        "o_orderdate AS updated",
        "'2026.1' AS lrversion",
        "centroidx",
        "centroidy",
        "if(k % 23 != 0, centroidx, null) AS surfpointx",
        "centroidy AS surfpointy",
        "struct(centroidx - half AS xmin, centroidy - half AS ymin, centroidx + half AS xmax, centroidy + half AS ymax) AS bbox",
    )
    return rows.withColumn("geom", G.box_polygon(F.col("bbox")))


def raw_multi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw parcels with the geometry already promoted to a multipolygon."""
    return parcel_raw(spark, sf_dir).withColumn("geom", G.multi(F.col("geom")))


def counties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """County lookup: one per nation, nation 7 left out so that some parcels have no county name."""
    return _nations(spark, sf_dir).where(F.col("n_nationkey") != 7).select(
        F.concat("statefp", "countyfp").alias("geoid"), "statefp", "countyfp", F.col("n_name").alias("county_name")
    )


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Square zones on a lattice in each state, one per lattice cell that has a supplier (a bounded table)."""
    s = F.col("s_suppkey")
    placed = (
        table(spark, sf_dir, "supplier")
        .join(_nations(spark, sf_dir), F.col("s_nationkey") == F.col("n_nationkey"))
        .select("s_suppkey", "x0", "y0", F.col("statefp").alias("zone_state"),
                (s % 17).alias("zone_col"), ((s * 7) % 13).alias("zone_row"))
    )
    cells = placed.groupBy("zone_state", "zone_col", "zone_row", "x0", "y0").agg(F.min("s_suppkey").alias("zone_id"))
    left = F.col("x0") + F.col("zone_col") * F.lit(ZONE)
    low = F.col("y0") + F.col("zone_row") * F.lit(ZONE)
    right = F.col("x0") + (F.col("zone_col") + 1) * F.lit(ZONE)
    top = F.col("y0") + (F.col("zone_row") + 1) * F.lit(ZONE)
    boxed = cells.select("zone_id", "zone_state", G.box(left, low, right, top).alias("zone_box"))
    return boxed.withColumn("zone_geom", F.array(G.box_polygon(F.col("zone_box"))))


def lots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lots on a lattice with shared edges, one per part."""
    p = F.col("p_partkey")
    placed = table(spark, sf_dir, "part").select(
        p.alias("lot_id"), "p_brand", "p_size",
        (p % LOT_COLUMNS + LOT_COLUMNS * F.floor(p / (LOT_COLUMNS * LOT_ROWS))).alias("lot_col"),
        (F.floor(p / LOT_COLUMNS) % LOT_ROWS).alias("lot_row"),
    )
    ox, oy = (F.lit(v) for v in LOT_ORIGIN)
    col, row, side = F.col("lot_col"), F.col("lot_row"), F.lit(LOT)
    boxed = placed.withColumn(
        "bbox", G.box(ox + col * side, oy + row * side, ox + (col + 1) * side, oy + (row + 1) * side)
    )
    return boxed.withColumn("geom", F.array(G.box_polygon(F.col("bbox"))))


def bent_lots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lots with a vertex in the middle of each side, off the line by LOT / 2 ** k, k from 2 to 17 by the place of the side."""
    col, row, side = F.col("lot_col"), F.col("lot_row"), F.lit(LOT)
    ox, oy = (F.lit(v) for v in LOT_ORIGIN)

    def corner(c: Column, r: Column) -> Column:
        return F.struct((ox + c * side).alias("x"), (oy + r * side).alias("y"))

    def bend(c: Column, r: Column, upright: bool) -> Column:
        k = 2 + (c * 7 + r * 3 + (5 if upright else 0)) % 16
        off = side / F.pow(F.lit(2.0), k)
        if upright:
            return F.struct((ox + c * side + off).alias("x"), (oy + (r + 0.5) * side).alias("y"))
        return F.struct((ox + (c + 0.5) * side).alias("x"), (oy + r * side + off).alias("y"))

    ring = F.array(
        corner(col, row), bend(col, row, False), corner(col + 1, row), bend(col + 1, row, True), corner(col + 1, row + 1),
        bend(col, row + 1, False), corner(col, row + 1), bend(col, row, True), corner(col, row),
    )
    return lots(spark, sf_dir).select("lot_id", "lot_col", "lot_row", F.array(F.array(ring)).alias("geom"))


def footprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Building footprints, one per part, some of them across the edge of their lot."""
    b, side = F.col("bbox"), F.lit(LOT)
    dx = ((F.col("lot_id") * 13) % 100).cast("double") / 100
    dy = ((F.col("lot_id") * 29) % 100).cast("double") / 100
    x, y = b["xmin"] + side * dx, b["ymin"] + side * dy
    boxed = lots(spark, sf_dir).select(
        F.col("lot_id").alias("building_id"),
        G.box(x, y, x + side * F.lit(0.305), y + side * F.lit(0.305)).alias("building_box"),
    )
    return boxed.withColumn("building_geom", F.array(G.box_polygon(F.col("building_box"))))


def pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raster as (row, col, value): events averaged per pixel; rows go on below the last parcel."""
    e = F.col("event_id")
    return (
        table(spark, sf_dir, "events")
        .groupBy((F.floor(e / 40)).alias("row"), (e % 40).alias("col"))
        .agg(F.round(F.avg("value"), 4).alias("value"))
    )


def properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Property records, one per customer, with an id for some and an untidy address for all."""
    c = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        c.alias("property_id"),
        F.when(c % 3 == 0, F.concat(F.lit("P"), (c * 2).cast("string"))).alias("parcel_ref"),
        F.concat(F.lit("  "), (100 + c % 900).cast("string"), F.lit(" PEACHTREE  St., "), (c % 40).cast("string"))
        .alias("address"),
    )


def sheared(x: Column, y: Column) -> tuple[Column, Column]:
    """A linear map: shapes become slanted, while what touches, holds or overlaps, and by which share, stays as it is."""
    return x + (y - 30.0) * 0.25, y + (x + 90.0) * 0.125


def sheared_shapes(df: DataFrame, geom: str = "geom", bbox: str = "bbox") -> DataFrame:
    """The table with slanted shapes and their boxes."""

    def move(p: Column) -> Column:
        x, y = sheared(p["x"], p["y"])
        return F.struct(x.alias("x"), y.alias("y"))

    return df.withColumn(geom, G.map_points(F.col(geom), move)).withColumn(bbox, G.bbox_of(F.col(geom)))


def misspelt_properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Property records with their county; three of four addresses are misspelt, longer or without the last number."""
    c = F.col("c_custkey")
    house, unit = (100 + c % 900).cast("string"), (c % 40).cast("string")
    spelt = (
        F.when(c % 4 == 1, F.concat(house, F.lit(" PEECHTREE St "), unit))
        .when(c % 4 == 2, F.concat(house, F.lit(" Peachtree Street, "), unit))
        .when(c % 4 == 3, F.concat(house, F.lit(" Peach Tree St")))
        .otherwise(F.concat(house, F.lit(" peachtree st #"), unit))
    )
    placed = table(spark, sf_dir, "customer").join(_nations(spark, sf_dir), F.col("c_nationkey") == F.col("n_nationkey"))
    return placed.select(c.alias("property_id"), F.when(c % 5 == 0, F.concat(F.lit("P"), (c * 2).cast("string"))).alias("parcel_ref"), spelt.alias("address"), "countyfp")


def edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boundary edges, one per event."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("TLID"),
        F.when(F.col("value") > 10, "Y").otherwise("N").alias("ROADFLG"),
        F.col("event_type").alias("MTFCC"),
        F.lit("13").alias("STATEFP"),
        F.lit("121").alias("COUNTYFP"),
    )
