"""GeoJSON in and out, parsed and built by Spark's own JSON functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cadastra.functions import geometry as G

_RING = "array<array<double>>"


def geometry_from_coordinates(kind: Column, coordinates: Column) -> Column:
    """Multipolygon from a GeoJSON geometry type and its coordinates as JSON text; other types give null."""
    def ring(r: Column) -> Column:
        return F.transform(r, lambda p: F.struct(F.get(p, 0).alias("x"), F.get(p, 1).alias("y")))

    def polygon(p: Column) -> Column:
        return F.transform(p, ring)

    single = F.from_json(coordinates, f"array<{_RING}>")
    several = F.from_json(coordinates, f"array<array<{_RING}>>")
    return F.when(kind == "Polygon", F.array(polygon(single))).when(
        kind == "MultiPolygon", F.transform(several, polygon)
    )


def _features(rows: DataFrame) -> DataFrame:
    geom = geometry_from_coordinates(F.col("geometry.type"), F.col("geometry.coordinates"))
    return rows.select("properties.*", geom.alias("geom")).withColumn("bbox", G.bbox_of(F.col("geom")))


def read_collection(spark: SparkSession, path: str, properties: str) -> DataFrame:
    """FeatureCollection files: one row per feature with its properties, geom and bbox.

    `properties` is a DDL schema. A collection is one JSON value, so a file is one task: use `read_lines` for large data.
    """
    schema = f"features array<struct<properties: struct<{_inner(properties)}>, " \
             "geometry: struct<type: string, coordinates: string>>>"
    rows = spark.read.schema(schema).json(path, multiLine=True).select(F.explode("features").alias("f")).select("f.*")
    return _features(rows)


def read_lines(spark: SparkSession, path: str, properties: str) -> DataFrame:
    """Newline-delimited features: splittable, so files of any size are read in parallel."""
    schema = f"properties struct<{_inner(properties)}>, geometry struct<type: string, coordinates: string>"
    return _features(spark.read.schema(schema).json(path))


def _inner(ddl: str) -> str:
    return ", ".join(f"{part.split(None, 1)[0]}: {part.split(None, 1)[1]}" for part in ddl.split(", "))


def to_features(df: DataFrame, properties: list[str], geom: str = "geom") -> DataFrame:
    """One GeoJSON feature per row in a text column `value`."""
    coordinates = F.transform(
        F.col(geom),
        lambda poly: F.transform(poly, lambda ring: F.transform(ring, lambda p: F.array(p["x"], p["y"]))),
    )
    geometry = F.when(
        F.col(geom).isNotNull(),
        F.struct(F.lit("MultiPolygon").alias("type"), coordinates.alias("coordinates")),
    )
    # Null properties are written out, as features of a collection all have the same members.
    feature = F.struct(
        F.lit("Feature").alias("type"), geometry.alias("geometry"), F.struct(*properties).alias("properties")
    )
    return df.select(F.to_json(feature, {"ignoreNullFields": "false"}).alias("value"))


def write_lines(df: DataFrame, path: str, properties: list[str], geom: str = "geom") -> None:
    """Write newline-delimited features."""
    to_features(df, properties, geom).write.mode("overwrite").text(path)
