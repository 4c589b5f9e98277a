"""Plain-Python checks the operators are compared with."""

from pyspark.sql import functions as F

from cadastra.functions import geometry as G


def square(x, y, side):
    return [[(x, y), (x + side, y), (x + side, y + side), (x, y + side), (x, y)]]


def frame(spark, rows, names="id long"):
    """DataFrame of (key..., multipolygon as nested (x, y) lists) with geom and bbox."""
    flat = [(*r[:-1], [[[(float(x), float(y)) for x, y in ring] for ring in poly] for poly in r[-1]]) for r in rows]
    schema = f"{names}, geom array<array<array<struct<x: double, y: double>>>>"
    return spark.createDataFrame(flat, schema).withColumn("bbox", G.bbox_of(F.col("geom")))


def inside(rings, x, y):
    """Even-odd rule."""
    result = False
    for ring in rings:
        for (x1, y1), (x2, y2) in zip(ring, ring[1:]):
            if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
                result = not result
    return result


def ring_area(ring):
    return abs(sum(x1 * y2 - x2 * y1 for (x1, y1), (x2, y2) in zip(ring, ring[1:]))) / 2


def plan(df):
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
