"""Large polygons, hot cells on both sides and shapes fetched late."""

import math
import random
import time

import pytest
from pyspark.sql import functions as F

from cadastra.functions import geometry as G
from cadastra.operators import skew
from cadastra.operators import spatial_join as J
from tests.helpers import frame, plan, square


def star(n, x, y, size, notch=0.4):
    """A closed ring with notches."""
    radii = (size * (1 - notch), size)
    ring = [(x + radii[k % 2] * math.cos(2 * math.pi * k / n), y + radii[k % 2] * math.sin(2 * math.pi * k / n)) for k in range(n)]
    return [[*ring, ring[0]]]


def renamed(df):
    return df.select(F.col("id").alias("rid"), F.col("geom").alias("rgeom"), F.col("bbox").alias("rbox"))


def test_parts_make_up_the_whole(spark):
    df = frame(spark, [(1, [star(3_000, 0, 0, 2.0)]), (2, [square(5, 5, 1)]), (3, [square(0, 9, 1), star(900, 9, 9, 1.0)])])
    parts = J.subdivided(df, ["id"], "geom", "bbox", 64)
    whole = {r.id: r.a for r in df.select("id", G.area(F.col("geom")).alias("a")).collect()}
    rows = parts.select("id", G.area(F.col("geom")).alias("a"), G.vertex_count(F.col("geom")).alias("n")).collect()
    assert max(r.n for r in rows) <= 64 and len(rows) > 60
    for k, area in whole.items():
        assert sum(r.a for r in rows if r.id == k) == pytest.approx(area, rel=1e-9)
    assert J.subdivided(df.where("false"), ["id"], "geom", "bbox").count() == 0


def test_shares_of_large_polygons_equal_direct_ones(spark):
    rng = random.Random(1)
    left = frame(spark, [(k, [star(rng.choice([8, 100]), rng.uniform(-2, 2), rng.uniform(-2, 2), 0.5)]) for k in range(12)])
    right = renamed(frame(spark, [(100, [star(200, 0, 0, 2.0)]), (101, [square(0, 0, 2)])]))
    direct = J.overlap_shares(left, right, "geom", "rgeom", "bbox", "rbox", ["id"])
    parted = J.overlap_shares_of_large(left, right, "geom", "rgeom", "bbox", "rbox", ["id"], ["rid"], most=40)
    a = {(r.id, r.rid): r.overlap_share for r in direct.collect()}
    b = {(r.id, r.rid): r.overlap_share for r in parted.collect()}
    assert a.keys() == b.keys() and all(a[k] == pytest.approx(b[k], abs=1e-9) for k in a)


def test_a_polygon_of_100_000_vertices_against_10_000_parcels(spark):
    side = 0.02
    cells = [(k, [square(-1 + side * (k % 100), -1 + side * (k // 100), side)]) for k in range(10_000)]
    large = frame(spark, [(0, [star(100_000, 0, 0, 1.3, 1e-4)])])
    started = time.perf_counter()
    found = J.overlap_shares_of_large(frame(spark, cells), renamed(large), "geom", "rgeom", "bbox", "rbox", ["id"], ["rid"])
    total = found.agg(F.sum("overlap_area"), F.count("*")).first()
    assert time.perf_counter() - started < 60
    clipped = large.select(G.area(G.clip_to_box(F.col("geom"), G.box_literal((-1, -1, 1, 1))))).first()[0]
    assert total[0] == pytest.approx(clipped, rel=1e-6) and 9_000 < total[1] < 10_000


@pytest.mark.parametrize("rows_per_split", [3, 10, 1_000])
def test_keys_that_are_hot_on_both_sides(spark, rows_per_split):
    rng = random.Random(2)
    a = [(rng.choice([1, 1, 1, 2, 3, None]), k) for k in range(80)]
    b = [(rng.choice([1, 1, 2, 2, 4, None]), k) for k in range(60)]
    left, right = spark.createDataFrame(a, "k int, x long"), spark.createDataFrame(b, "k int, y long")
    got = skew.grid_joined(left, right, ["k"], ["x"], ["y"], rows_per_split).collect()
    assert sorted(map(tuple, got)) == sorted((k, x, y) for k, x in a for m, y in b if k is not None and k == m)


def test_pairs_with_hot_cells_are_the_same(spark):
    rng = random.Random(3)
    left = frame(spark, [(k, [square(rng.uniform(0, 0.002), rng.uniform(0, 0.002), 0.0004)]) for k in range(60)])
    right = renamed(frame(spark, [(k, [square(rng.uniform(0, 0.002), rng.uniform(0, 0.002), 0.0004)]) for k in range(50)]))
    plain = {(r.id, r.rid) for r in J.box_pairs(left, right, "bbox", "rbox", ["id"]).collect()}
    split = [(r.id, r.rid) for r in J.box_pairs(left, right, "bbox", "rbox", ["id"], rows_per_split=5, broadcast_bytes=0).collect()]
    assert set(split) == plain and len(split) == len(plain) > 50


def test_neighbours_are_found_without_their_shapes(spark, monkeypatch):
    df = frame(spark, [(k, [square(k % 5, k // 5, 1)]) for k in range(25)])
    seen = []
    inner = J.box_pairs
    monkeypatch.setattr(J, "box_pairs", lambda left, right, *rest, **named: seen.append((left.columns, right.columns)) or inner(left, right, *rest, **named))
    found = J.touching(df, df.where("id = 0"))
    assert {r.id for r in found.collect()} == {1, 5, 6} and found.columns == df.columns
    assert seen == [(["_a", "_box_a"], ["_b", "_box_b"])]
    assert J.touching(df, df.where("false")).count() == 0 and "CartesianProduct" not in plan(found)
