import random

import pytest
from pyspark.sql import functions as F

from cadastra.functions import geometry as G
from cadastra.operators import filters, skew, tiling
from cadastra.operators import spatial_join as J
from cadastra.operators.simplify import simplify
from tests.helpers import frame, plan, square


def _squares(seed, n, longest):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        side = longest * rng.random() ** 4
        rows.append((i, [square(rng.uniform(-85, -84), rng.uniform(33, 34), side)]))
    return rows


def _box(geom):
    xs = [p[0] for poly in geom for ring in poly for p in ring]
    ys = [p[1] for poly in geom for ring in poly for p in ring]
    return min(xs), min(ys), max(xs), max(ys)


def _sides(spark, a, b):
    left = frame(spark, a, "a long").select("a", F.col("geom").alias("geom_a"), F.col("bbox").alias("box_a"))
    right = frame(spark, b, "b long").select("b", F.col("geom").alias("geom_b"), F.col("bbox").alias("box_b"))
    return left, right


# A hot spot of stacked and crowded small squares plus features of every size up to many cells.
A = _squares(1, 150, 0.9) + [(1000 + i, [square(-84.5, 33.5, 0.0004)]) for i in range(60)]
B = _squares(2, 80, 1.5) + [(1000 + i, [square(-84.5 + i * 0.0001, 33.5, 0.0003)]) for i in range(20)] + [(7777, [square(-100, 20, 30)])]


@pytest.mark.parametrize("broadcast_bytes,rows_per_split", [(1 << 30, 10**6), (0, 10**6), (0, 20)])
def test_box_pairs_equal_brute_force(spark, broadcast_bytes, rows_per_split):
    left, right = _sides(spark, A, B)
    want = set()
    for a, ga in A:
        x0, y0, x1, y1 = _box(ga)
        for b, gb in B:
            u0, v0, u1, v1 = _box(gb)
            if x0 <= u1 and x1 >= u0 and y0 <= v1 and y1 >= v0:
                want.add((a, b))
    pairs = J.box_pairs(left, right, "box_a", "box_b", ["a"], rows_per_split, broadcast_bytes)
    got = [(r.a, r.b) for r in pairs.select("a", "b").collect()]
    assert len(got) == len(set(got)) and set(got) == want
    text = plan(pairs)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_overlaps_and_members_equal_brute_force(spark):
    left, right = _sides(spark, A, B)
    shares = J.overlap_shares(left, right, "geom_a", "geom_b", "box_a", "box_b", ["a"])
    got = {(r.a, r.b): r.overlap_area for r in shares.select("a", "b", "overlap_area").collect()}
    for a, ga in A:
        x0, y0, x1, y1 = _box(ga)
        for b, gb in B:
            u0, v0, u1, v1 = _box(gb)
            area = max(0.0, min(x1, u1) - max(x0, u0)) * max(0.0, min(y1, v1) - max(y0, v0))
            if area > 1e-12:
                assert got[(a, b)] == pytest.approx(area, rel=1e-6, abs=1e-11)
    members = J.inside_any(left, right, ["a"], "geom_a", "box_a", "geom_b", "box_b")
    assert members.count() >= len({a for a, _ in got})


def test_touching_with_stacked_copies(spark):
    s = 0.001
    grid = {(i, j): square(-84.389 + i * s, 33.75 + j * s, s) for i in range(5) for j in range(5)}
    rows, n = [], 0
    for cell, ring in grid.items():
        for _ in range(4 if cell == (1, 2) else 1):
            rows.append((n, cell[0], cell[1], [ring]))
            n += 1
    df = frame(spark, rows, "id long, i int, j int")
    targets = df.where("i = 2 and j = 2")
    got = sorted((r.i, r.j) for r in J.touching(df, targets).collect())
    want = sorted(
        (r[1], r[2]) for r in rows if max(abs(r[1] - 2), abs(r[2] - 2)) == 1
    )
    assert got == want


def test_dissolved_boundary(spark):
    rows = [(1, [square(0, 0, 1)]), (1, [square(1, 0, 1)]), (1, [square(0, 0, 1)]), (2, [square(5, 5, 1)])]
    segments = J.dissolved_boundary(frame(spark, rows, "g long"), "g").collect()
    assert sum(r.g == 1 for r in segments) == 6 and sum(r.g == 2 for r in segments) == 4
    length = sum(abs(r.x1 - r.x2) + abs(r.y1 - r.y2) for r in segments if r.g == 1)
    assert length == pytest.approx(6.0)


def test_box_filter_is_pushed_to_the_scan(spark, tmp_path):
    frame(spark, A, "a long").write.parquet(str(tmp_path / "t"))
    text = plan(filters.intersecting_box(spark.read.parquet(str(tmp_path / "t")), (-84.5, 33.2, -84.2, 33.4)))
    assert "LessThanOrEqual(bbox.xmin,-84.2)" in text and "GreaterThanOrEqual(bbox.ymax,33.2)" in text


def test_tiles_cover_features_once_and_thinning_is_nested(spark):
    df = frame(spark, A, "id long")
    tiles = tiling.tile_features(df, 10, 12)
    assert tiles.count() == tiles.select("id", "z", "x", "y").distinct().count()
    assert tiles.where("z = 12").select("id").distinct().count() == len(A)
    thinned = tiling.pyramid(df, "state")
    kept = {z: {r.id for r in thinned.where(F.col("z") == z).select("id").distinct().collect()} for z in range(10, 17)}
    assert len(kept[16]) == len(A)
    assert all(kept[z] <= kept[z + 1] for z in range(10, 16))


def test_tiles_of_a_large_concave_feature_are_exact(spark):
    ring = [(-85, 30), (-80, 30), (-80, 35), (-80.01, 30.01), (-85, 30.01), (-85, 30)]
    df = frame(spark, [(1, [[ring]])], "id long")
    boxed = tiling.tile_features(df, 8, 8, geom=None).count()
    assert 0 < tiling.tile_features(df, 8, 8).count() < boxed


def test_largest_features_per_tile(spark):
    df = frame(spark, A, "id long").withColumn("size", G.area(F.col("geom")))
    tiles = tiling.tile_features(df, 9, 9)
    kept = tiling.keep_largest(tiles, F.col("size"), ["id"], 5, salts=7)
    per_tile = {}
    for r in tiles.select("x", "y", "id", "size").collect():
        per_tile.setdefault((r.x, r.y), []).append((-r["size"], r.id))
    want = {(t, i) for t, v in per_tile.items() for _, i in sorted(v)[:5]}
    assert {((r.x, r.y), r.id) for r in kept.collect()} == want


def test_packed_tiles_keep_every_feature(spark):
    tiles = tiling.tile_features(frame(spark, A, "id long"), 8, 8).select("z", "x", "y", "id")
    packed = tiling.pack_tiles(tiles, ["id"], 10).collect()
    flat = sorted((r.x, r.y, f.id) for r in packed for f in r.features)
    assert flat == sorted((r.x, r.y, r.id) for r in tiles.collect())
    assert max(len(r.features) for r in packed) < 40


def test_simplify(spark):
    wiggly = [[(0, 0), (1, 0.0001), (2, 0), (3, -0.0001), (4, 0), (4, 4), (2, 4.5), (0, 4), (0, 0)]]
    tiny = [[(0, 0), (1e-9, 0), (1e-9, 1e-9), (0, 1e-9), (0, 0)]]
    triangle = [[(0, 0), (0.5, 1e-6), (1, 0), (0, 1), (0, 0)]]
    df = frame(spark, [(1, [wiggly, tiny]), (2, [triangle])]).unionByName(
        spark.createDataFrame([(3, None)], "id long, geom array<array<array<struct<x: double, y: double>>>>")
        .withColumn("bbox", G.bbox_of(F.col("geom")))
    )
    got = {r.id: r.geom for r in simplify(df, 0.01).collect()}
    assert [tuple(p) for p in got[1][0][0]] == [(0, 0), (4, 0), (4, 4), (2, 4.5), (0, 4), (0, 0)]
    assert len(got[1][1][0]) == 4 and got[1][1][0][0] == got[1][1][0][-1]
    assert [tuple(p) for p in got[2][0][0]] == [(0, 0), (1, 0), (0, 1), (0, 0)]
    assert got[3] is None


def test_a_side_that_was_measured_large_is_not_broadcast(spark, tmp_path):
    """Small files may hold rows that become many: Spark's estimate from their size does not count."""
    for name in "ab":
        spark.range(100).select(F.col("id").alias("k"), F.col("id").alias(name)).write.parquet(f"{tmp_path}/{name}")
    a, b = (spark.read.parquet(f"{tmp_path}/{name}") for name in "ab")
    joined = skew.grid_joined(a, b, ["k"], ["a"], ["b"], 1000)
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=merge" in plan.split("Join Inner")[1].splitlines()[0]
    assert joined.count() == 100


def test_shapes_are_dealt_before_copies_are_dropped(spark):
    """No task gathers the shapes of a whole file to drop copies."""
    squares = spark.range(20).select((F.col("id") % 2).alias("odd"), F.array(G.box_polygon(G.box(F.col("id") % 5, F.lit(0.0), F.col("id") % 5 + 1, F.lit(1.0)))).alias("geom"))
    found = J.dissolved_boundary(squares, "odd")
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression" in plan.split("Aggregate")[-1]
    assert found.count() > 0
