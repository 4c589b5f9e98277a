"""Predicates on shapes off the axes: shared slanted edges, T-junctions and true overlaps."""

import random

import pytest
from pyspark.sql import functions as F

from cadastra.functions import geometry as G
from cadastra.operators import spatial_join as J
from cadastra.operators.skew import salted
from cadastra.schemas import BOX, MULTIPOLYGON


def triangle(*points):
    return [[[*points, points[0]]]]


def box_of(shape):
    xs, ys = zip(*[(x, y) for poly in shape for ring in poly for x, y in ring])
    return (min(xs), min(ys), max(xs), max(ys))


def pairs(kind, count=150, seed=11):
    """Triangles on two sides of a slanted line, and how they meet."""
    draw = random.Random(seed)
    for k in range(count):
        x, y = -84 + draw.random(), 33 + draw.random()
        dx, dy = draw.uniform(1e-4, 1e-3), draw.uniform(1e-4, 1e-3)
        at = lambda t, off: (x + t * dx - off * dy, y + t * dy + off * dx)  # noqa: E731  along and beside the line
        a = triangle(at(0, 0), at(1, 0), at(draw.random(), 1))
        if kind == "edge":
            b = triangle(at(0, 0), at(1, 0), at(draw.random(), -1))
        elif kind == "part":
            b = triangle(at(draw.uniform(0.1, 0.4), 0), at(draw.uniform(0.6, 0.9), 0), at(draw.random(), -1))
        elif kind == "apart":
            b = triangle(at(0, -0.01), at(1, -0.01), at(draw.random(), -1))
        else:
            b = triangle(at(0, 0.1), at(1, 0.1), at(draw.random(), -1))
        yield k, a, b


@pytest.fixture(scope="module")
def frame(spark):
    def make(kind):
        def struct(shape):
            return [[[{"x": x, "y": y} for x, y in ring] for ring in poly] for poly in shape]

        rows = [(k, struct(a), box_of(a), struct(b), box_of(b)) for k, a, b in pairs(kind)]
        names = ("k bigint", "a", "a_box", "b", "b_box")
        kinds = ("", MULTIPOLYGON.simpleString(), BOX.simpleString(), MULTIPOLYGON.simpleString(), BOX.simpleString())
        return spark.createDataFrame(rows, ", ".join(f"{n} {t}".strip() for n, t in zip(names, kinds)))

    return make


@pytest.mark.parametrize(("kind", "touch"), [("edge", 150), ("part", 150), ("apart", 0), ("over", 0)])
def test_touches(frame, kind, touch):
    df = frame(kind)
    assert df.where(G.touches(G.snapped(F.col("a")), G.snapped(F.col("b")))).count() == touch
    assert df.where(G.touches(G.snapped(F.col("b")), G.snapped(F.col("a")))).count() == touch


@pytest.mark.parametrize(("kind", "overlap"), [("edge", 0), ("part", 0), ("apart", 0), ("over", 150)])
def test_overlap_shares(frame, kind, overlap):
    df = frame(kind)
    left, right = df.select("k", "a", "a_box"), df.select(F.col("k").alias("j"), "b", "b_box")
    found = J.overlap_shares(left, right, "a", "b", "a_box", "b_box", ["k"]).where("k = j")
    assert found.count() == overlap


def test_box_pairs_with_hot_cells_on_both_sides(spark):
    """The salted branch, with many stacked boxes on either side."""
    def boxes(n, name):
        box = F.struct(*[F.lit(v).alias(c) for v, c in ((0.1, "xmin"), (0.1, "ymin"), (0.1004, "xmax"), (0.1004, "ymax"))])
        return spark.range(n).select(F.col("id").alias(name), box.alias(f"{name}_box"))

    found = J.box_pairs(boxes(300, "l"), boxes(40, "r"), "l_box", "r_box", ["l"], rows_per_split=50, broadcast_bytes=0)
    assert found.count() == 12_000 and found.distinct().count() == 12_000


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_joins_equal_plain_joins(spark, how):
    left = spark.range(600).select(F.when(F.col("id") % 3 > 0, F.col("id") % 2).alias("k"), F.col("id").alias("x"))
    right = spark.createDataFrame([(0, "a"), (0, "b"), (5, "c"), (None, "d")], "k bigint, y string")
    got = salted(left, right, ["k"], ["x"], how, 50)
    want = left.join(right, ["k"], how)
    assert got.columns == want.columns and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_null_keys_of_a_left_join_stay_spread(spark):
    """Without adaptive plans the null rows must not meet in one task."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        left = spark.range(0, 4_000, 1, 8).select(F.lit(None).cast("bigint").alias("k"), F.col("id").alias("x"))
        right = spark.range(10).select(F.col("id").alias("k"), F.lit("y").alias("y"))
        parts = salted(left, right, ["k"], ["x"], "left", 100).groupBy(F.spark_partition_id()).count().collect()
        assert max(r["count"] for r in parts) < 1_000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


@pytest.mark.parametrize("kind", ["edge", "over"])
def test_clipped_parts_make_up_the_area(frame, kind):
    """Cut a shape at a point inside its box into four boxes: the parts' areas add up, and each part stays inside."""
    df = frame(kind).select("k", "a", "a_box")
    b = F.col("a_box")
    x, y = b["xmin"] + (b["xmax"] - b["xmin"]) * 0.4, b["ymin"] + (b["ymax"] - b["ymin"]) * 0.55
    quarters = [(b["xmin"], b["ymin"], x, y), (x, b["ymin"], b["xmax"], y), (b["xmin"], y, x, b["ymax"]), (x, y, b["xmax"], b["ymax"])]
    cut = df.select("k", G.area(F.col("a")).alias("whole"), *[G.clip_to_box(F.col("a"), G.box(*q)).alias(f"q{i}") for i, q in enumerate(quarters)])
    total = sum((G.area(F.col(f"q{i}")) for i in range(1, 4)), G.area(F.col("q0")))
    assert cut.where(F.abs(total - F.col("whole")) > F.col("whole") * 1e-6).count() == 0
    away = df.select(G.clip_to_box(F.col("a"), G.box(b["xmax"] + 1, b["ymin"], b["xmax"] + 2, b["ymax"])).alias("c"))
    assert away.where(F.size("c") > 0).count() == 0
