import math
import random

from pyspark.sql import functions as F

from cadastra.functions import geometry as G
from cadastra.functions import mercator as M
from cadastra.functions.hilbert import hilbert_of_cell
from tests.helpers import frame, inside, ring_area, square

CONCAVE = [[(0, 0), (4, 0), (4, 4), (2, 1), (0, 4), (0, 0)]]
HOLED = [[(0, 0), (10, 0), (10, 10), (0, 10), (0, 0)], [(3, 3), (3, 7), (7, 7), (7, 3), (3, 3)]]


def one(spark, geom, expression):
    return frame(spark, [(1, geom)]).select(expression.alias("v")).first().v


def pair(spark, a, b, function):
    left = frame(spark, [(1, a)]).select("id", F.col("geom").alias("a"))
    right = frame(spark, [(1, b)]).select("id", F.col("geom").alias("b"))
    return left.join(right, "id").select(function(F.col("a"), F.col("b")).alias("v")).first().v


def test_area_and_holes(spark):
    assert one(spark, [CONCAVE], G.area(F.col("geom"))) == ring_area(CONCAVE[0])
    assert one(spark, [HOLED], G.area(F.col("geom"))) == 84.0
    assert one(spark, [HOLED, [[(20, 0), (21, 0), (21, 1), (20, 1), (20, 0)]]], G.area(F.col("geom"))) == 85.0


def test_centroid(spark):
    c = one(spark, [HOLED], G.centroid(F.col("geom")))
    assert (c.x, c.y) == (5.0, 5.0)
    triangle = one(spark, [[[(0, 0), (3, 0), (0, 3), (0, 0)]]], G.centroid(F.col("geom")))
    assert math.isclose(triangle.x, 1.0) and math.isclose(triangle.y, 1.0)
    line = one(spark, [[[(0, 0), (2, 0), (0, 0)]]], G.centroid(F.col("geom")))
    assert math.isclose(line.x, 2 / 3) and line.y == 0.0


def test_contains_point_matches_even_odd_rule(spark):
    rng = random.Random(1)
    points = [(rng.uniform(-1, 11), rng.uniform(-1, 11)) for _ in range(300)]
    for shape in (CONCAVE, HOLED):
        df = spark.createDataFrame(points, "x double, y double")
        literal = G.polygon_literal([shape])
        got = df.select("x", "y", G.contains_point(literal, F.col("x"), F.col("y")).alias("v")).collect()
        assert all(r.v == inside(shape, r.x, r.y) for r in got)


def test_each_boundary_point_of_a_partition_is_in_one_square(spark):
    squares = [(i * 3 + j, [square(i, j, 1)]) for i in range(3) for j in range(3)]
    points = [(x / 2, y / 2) for x in range(6) for y in range(6)]
    df = spark.createDataFrame(points, "x double, y double")
    hits = [df.where(G.contains_point(G.polygon_literal(g), F.col("x"), F.col("y"))).count() for _, g in squares]
    assert sum(hits) == len(points)


def test_intersects_box(spark):
    cases = [
        ((4.0, 0.0, 5.0, 1.0), True), ((4.1, 0.0, 5.0, 1.0), False), ((1.8, 2.0, 2.2, 3.0), False),
        ((-1, -1, 5, 5), True), ((1.0, 0.5, 1.1, 0.6), True), ((2.0, 1.0, 2.1, 3.0), True),
    ]
    for box, expected in cases:
        assert one(spark, [CONCAVE], G.intersects_box(F.col("geom"), G.box_literal(box))) is expected, box
    assert one(spark, [HOLED], G.intersects_box(F.col("geom"), G.box_literal((4, 4, 5, 5)))) is False
    assert one(spark, [HOLED], G.intersects_box(F.col("geom"), G.box_literal((2.5, 4, 5, 5)))) is True


def test_intersects(spark):
    assert pair(spark, [square(0, 0, 1)], [square(1, 1, 1)], G.intersects)
    assert not pair(spark, [square(0, 0, 1)], [square(1.01, 1, 1)], G.intersects)
    assert pair(spark, [square(0, 0, 10)], [square(4, 4, 1)], G.intersects)
    assert pair(spark, [square(4, 4, 1)], [square(0, 0, 10)], G.intersects)
    assert not pair(spark, [HOLED], [square(4, 4, 1)], G.intersects)
    # A second part lies inside although the first one is far away.
    assert pair(spark, [square(50, 50, 1), square(4, 4, 1)], [square(0, 0, 10)], G.intersects)


def test_overlap_area_is_exact_for_concave_shapes_and_holes(spark):
    assert math.isclose(pair(spark, [square(0, 0, 2)], [square(1, 1, 2)], G.overlap_area), 1.0)
    assert pair(spark, [square(0, 0, 1)], [square(1, 0, 1)], G.overlap_area) == 0.0
    assert math.isclose(pair(spark, [HOLED], [square(2, 2, 4)], G.overlap_area), 16 - 9)
    assert math.isclose(pair(spark, [CONCAVE], [CONCAVE], G.overlap_area), ring_area(CONCAVE[0]))
    backwards = [[list(reversed(CONCAVE[0]))]]
    assert math.isclose(pair(spark, backwards[0] and [backwards[0]], [square(-1, -1, 6)], G.overlap_area), 10.0)


def test_overlap_area_against_sampling(spark):
    rng = random.Random(5)

    def star(cx, cy):
        angles = sorted(rng.uniform(0, 2 * math.pi) for _ in range(9))
        ring = [(cx + rng.uniform(1, 3) * math.cos(t), cy + rng.uniform(1, 3) * math.sin(t)) for t in angles]
        return [ring + ring[:1]]

    a, b = star(0, 0), star(1, 0.5)
    steps, lo, hi = 400, -4.0, 5.0
    cell = (hi - lo) / steps
    centres = [lo + (i + 0.5) * cell for i in range(steps)]
    sampled = sum(inside(a, x, y) and inside(b, x, y) for x in centres for y in centres) * cell * cell
    assert abs(pair(spark, [a], [b], G.overlap_area) - sampled) < 0.03


def test_touches_and_within(spark):
    def touch(a, b):
        return G.touches(G.snapped(a), G.snapped(b))

    s = 0.001
    assert pair(spark, [square(-84.389, 33.751, s)], [square(-84.388, 33.751, s)], touch)
    assert pair(spark, [square(-84.389, 33.751, s)], [square(-84.388, 33.750, s)], touch)
    assert not pair(spark, [square(-84.389, 33.751, s)], [square(-84.3885, 33.751, s)], touch)
    assert not pair(spark, [square(-84.389, 33.751, s)], [square(-84.3879, 33.751, s)], touch)
    assert not pair(spark, [square(-84.389, 33.751, s)], [square(-84.389, 33.751, s)], touch)
    assert pair(spark, [square(1, 1, 1)], [square(0, 0, 3)], G.within)
    assert pair(spark, [square(0, 0, 1)], [square(0, 0, 3)], G.within)
    assert not pair(spark, [square(2.5, 1, 1)], [square(0, 0, 3)], G.within)
    assert not pair(spark, [square(4, 4, 1)], [HOLED], G.within)


def test_wkt_and_bbox(spark):
    assert one(spark, [square(0, 0, 1)], G.to_wkt(F.col("geom"), 0)) == "MULTIPOLYGON (((0 0, 1 0, 1 1, 0 1, 0 0)))"
    b = one(spark, [HOLED], F.col("bbox"))
    assert tuple(b) == (0.0, 0.0, 10.0, 10.0)


def _walk(n, x, y):
    d, s = 0, n // 2
    while s:
        rx, ry = int(x & s > 0), int(y & s > 0)
        d += s * s * ((3 * rx) ^ ry)
        if ry == 0:
            if rx:
                x, y = n - 1 - x, n - 1 - y
            x, y = y, x
        s //= 2
    return d


def test_hilbert_equals_the_bitwise_walk_and_is_contiguous(spark):
    rng = random.Random(2)
    cells = [(rng.randrange(65536), rng.randrange(65536)) for _ in range(500)] + [(0, 0), (65535, 65535), (65535, 0)]
    df = spark.createDataFrame(cells, "x int, y int")
    for r in df.select("x", "y", hilbert_of_cell(F.col("x"), F.col("y")).alias("h")).collect():
        assert r.h == _walk(65536, r.x, r.y)
    grid = spark.range(32 * 32).select((F.col("id") % 32).cast("int").alias("x"), (F.col("id") / 32).cast("int").alias("y"))
    order = grid.select("x", "y", hilbert_of_cell(F.col("x"), F.col("y")).alias("h")).orderBy("h").collect()
    assert len({r.h for r in order}) == 1024
    assert all(abs(a.x - b.x) + abs(a.y - b.y) == 1 for a, b in zip(order, order[1:]))


def test_tiles_and_reprojection(spark):
    df = spark.createDataFrame([(-84.39, 33.75), (0.0, 0.0), (179.999, -85.0)], "x double, y double")
    for r in df.select("x", "y", M.tile_x(F.col("x"), F.lit(14)).alias("tx"), M.tile_y(F.col("y"), F.lit(14)).alias("ty"),
                       M.tile_box(F.lit(14), M.tile_x(F.col("x"), F.lit(14)), M.tile_y(F.col("y"), F.lit(14))).alias("b"),
                       ).collect():
        assert r.tx == int((r.x + 180) / 360 * 2**14)
        assert r.b.xmin <= r.x <= r.b.xmax and r.b.ymin <= r.y <= r.b.ymax
    there = frame(spark, [(1, [square(-84.39, 33.75, 0.001)])]).select(
        M.reproject(M.reproject(F.col("geom"), "EPSG:4326", "EPSG:3857"), "EPSG:3857").alias("g"), "geom"
    ).first()
    for p, q in zip(there.g[0][0], there.geom[0][0]):
        assert math.isclose(p.x, q.x, abs_tol=1e-9) and math.isclose(p.y, q.y, abs_tol=1e-9)
