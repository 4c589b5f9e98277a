"""Pyramids by descent, written tiles and weights of vertices."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cadastra.functions import cutting as C
from cadastra.functions import geometry as G
from cadastra.functions import mercator as M
from cadastra.operators import descent, generalize, tiling
from cadastra.operators import spatial_join as J
from cadastra.plans import jobs
from cadastra.plans import standins as S
from tests.helpers import frame, square


def blob(rng, x, y, size, n=24):
    """A concave ring around a point."""
    angles = sorted(rng.uniform(0, 2 * math.pi) for _ in range(n))
    ring = [(x + size * rng.uniform(0.3, 1) * math.cos(a), y + size * rng.uniform(0.3, 1) * math.sin(a)) for a in angles]
    return [[*ring, ring[0]]]


@pytest.fixture(scope="module")
def shapes(spark):
    rng = random.Random(1)
    rows = [(i, [blob(rng, rng.uniform(-100, -80), rng.uniform(25, 45), rng.choice([0.01, 0.3, 4.0]))]) for i in range(60)]
    rows.append((100, [square(-90, 30, 0.5), square(-85, 30, 0.5)]))  # two parts in one row of tiles, none between
    return frame(spark, rows)


def members(tiles):
    return {(r.id, r.z, r.x, r.y) for r in tiles.select("id", "z", "x", "y").collect()}


def direct(df, low, high):
    """Every tile of the box cover of each zoom, tested with the whole geometry."""
    rows = df.withColumn("z", F.explode(F.sequence(F.lit(low), F.lit(high))))
    b, z = F.col("bbox"), F.col("z")
    rows = rows.withColumn("x", F.explode(F.sequence(M.tile_x(b["xmin"], z), M.tile_x(b["xmax"], z))))
    rows = rows.withColumn("y", F.explode(F.sequence(M.tile_y(b["ymax"], z), M.tile_y(b["ymin"], z))))
    return rows.where(G.intersects_box(F.col("geom"), M.tile_box(z, F.col("x"), F.col("y"))))


def test_tiles_of_all_zooms_from_one_cover(spark, shapes):
    assert members(tiling.tile_features(shapes, 3, 9)) == members(direct(shapes, 3, 9))


def test_descent_meets_the_same_tiles(spark, shapes):
    want = direct(shapes, 3, 9).withColumn("a", G.area(G.clip_to_box(F.col("geom"), M.tile_box(F.col("z"), F.col("x"), F.col("y")))))
    areas = {(r.id, r.z, r.x, r.y): r.a for r in want.select("id", "z", "x", "y", "a").collect()}
    found = descent.levels(shapes, 3, 9, buffer=0.0)
    got = {(r.id, r.z, r.x, r.y): r.a for level in found for r in level.select("id", "z", "x", "y", G.area(F.col("geom")).alias("a")).collect()}
    assert got.keys() == areas.keys()
    assert all(got[k] == pytest.approx(areas[k], abs=1e-9) for k in got)


def test_pieces_with_a_buffer_come_from_the_parent(spark, shapes):
    """A piece is what a cut of the whole feature with the buffer of its tile gives."""
    found = descent.levels(shapes, 5, 8)
    whole = tiling.clipped(shapes.select("id", F.col("geom"), "bbox").join(found[-1].select("id", "z", "x", "y"), "id"))
    a = {(r.id, r.x, r.y): r.a for r in whole.select("id", "x", "y", G.area(F.col("geom")).alias("a")).collect()}
    b = {(r.id, r.x, r.y): r.a for r in found[-1].select("id", "x", "y", G.area(F.col("geom")).alias("a")).collect()}
    assert a.keys() == b.keys() and all(a[k] == pytest.approx(b[k], abs=1e-9) for k in a)


def test_no_box_cover_below_the_first_zoom(spark, shapes, monkeypatch):
    covered = []
    cover = tiling.tile_features
    monkeypatch.setattr(tiling, "tile_features", lambda df, low, high, **rest: covered.append((low, high)) or cover(df, low, high, **rest))
    descent.levels(shapes, 4, 8)
    assert covered == [(4, 4)]


def test_thinning_is_nested_and_descends_through_dropped_features(spark, shapes, tmp_path):
    path = str(tmp_path / "t")
    descent.write_pyramid(shapes, path, ("id",), 3, 8, base_zoom=8, drop_rate=2.5)
    kept = {}
    for r in descent.read_tiles(spark, path).select("z", "id").distinct().collect():
        kept.setdefault(r.z, set()).add(r.id)
    assert len(kept[8]) == 61 and all(kept.get(z, set()) <= kept.get(z + 1, set()) for z in range(3, 8)) and len(kept.get(4, set())) < 20
    assert "_draw" not in descent.read_tiles(spark, path).columns


def test_state_pyramids_merge_across_the_border(spark, tmp_path):
    rows = [(1, "13", [square(-84.0, 33.0, 0.4)]), (2, "37", [square(-83.9, 33.1, 0.4)]), (3, "37", [square(-80.0, 35.0, 0.1)])]
    df = frame(spark, rows, "lrid long, statefp string")
    twice = df.unionByName(df.where("lrid = 1").withColumn("statefp", F.lit("37")))  # one feature in the extracts of both
    path = jobs.national_tiles(twice, str(tmp_path), buffer=0.0, draw=F.lit(0.0))
    tiles = descent.read_tiles(spark, path)
    assert tiles.groupBy("z", "x", "y", "lrid").count().where("count > 1").count() == 0
    assert {r.state for r in tiles.where("lrid = 1").select("state").distinct().collect()} == {"13"}
    shared = tiles.groupBy("z", "x", "y").agg(F.countDistinct("state").alias("n")).where("n = 2")
    assert shared.count() > 0
    area = tiles.groupBy("lrid", "z").agg(F.sum(G.area(F.col("geom"))).alias("a")).collect()
    side = {1: 0.16, 2: 0.16, 3: 0.01}
    assert all(r.a == pytest.approx(side[r.lrid], abs=1e-9) for r in area) and len(area) == 21


# --- weights


def removed_by_hand(points, fixed):
    """Smallest triangle first among those smaller than both neighbours, round by round, in plain Python."""
    alive, weight, gone = list(range(len(points))), {}, dict.fromkeys(range(len(points)), 0.0)

    def area(a, b, c):
        (x1, y1), (x2, y2), (x3, y3) = points[a], points[b], points[c]
        return abs((x2 - x1) * (y3 - y1) - (x3 - x1) * (y2 - y1)) / 2

    while any(v not in fixed for v in alive):
        n = len(alive)
        size = {v: (math.inf if v in fixed else max(gone[v], area(alive[k - 1], v, alive[(k + 1) % n])), points[v]) for k, v in enumerate(alive)}
        out = [v for k, v in enumerate(alive) if v not in fixed and size[v] < size[alive[k - 1]] and size[v] < size[alive[(k + 1) % n]]]
        for v in out:
            k = alive.index(v)
            weight[v] = size[v][0]
            for u in (alive[k - 1], alive[(k + 1) % len(alive)]):
                gone[u] = max(gone[u], weight[v])
        alive = [v for v in alive if v not in out]
    return weight


@pytest.mark.parametrize("seed", range(5))
def test_weights_of_a_ring(seed):
    rng = random.Random(seed)
    points = [(rng.random(), rng.random()) for _ in range(30)]
    fixed = set(rng.sample(range(30), 3))
    want = removed_by_hand(points, fixed)
    x, y = np.array(points).T
    flags = np.array([k in fixed for k in range(30)])
    got = generalize.ring_weights(x, y, flags, np.array([30]))
    assert all(math.isinf(got[k]) if k in fixed else got[k] == pytest.approx(want[k]) for k in range(30))
    back = generalize.ring_weights(x[::-1].copy(), y[::-1].copy(), flags[::-1].copy(), np.array([30]))[::-1]
    turned = np.roll(generalize.ring_weights(np.roll(x, 7), np.roll(y, 7), np.roll(flags, 7), np.array([30])), -7)
    assert np.allclose(got[~flags], back[~flags]) and np.allclose(got[~flags], turned[~flags])


def test_small_and_empty_rings():
    x, y = np.array([0.0, 1, 1, 0, 1, 0.5]), np.array([0.0, 0, 1, 0, 0, 1])
    assert np.isinf(generalize.ring_weights(x, y, np.zeros(6, bool), np.array([0, 3, 0, 3]))).all()
    assert len(generalize.ring_weights(x[:0], y[:0], np.zeros(0, bool), np.array([0]))) == 0


def test_neighbours_have_no_gaps_at_any_zoom(spark):
    """Irregular borders on a grid of cells: the union has the area of the cells, whatever is left out."""
    rng = random.Random(7)
    n, parts = 5, 6

    def line(a, b, inner):
        if not inner:
            return [a, b]
        out = [a]
        for k in range(1, parts):
            t = k / parts
            out.append((a[0] + (b[0] - a[0]) * t + rng.uniform(-0.05, 0.05), a[1] + (b[1] - a[1]) * t + rng.uniform(-0.05, 0.05)))
        return [*out, b]

    flat = {(x, y): line((x, y), (x + 1, y), 0 < y < n) for x in range(n) for y in range(n + 1)}
    upright = {(x, y): line((x, y), (x, y + 1), 0 < x < n) for x in range(n + 1) for y in range(n)}
    rows = []
    for x in range(n):
        for y in range(n):
            ring = flat[x, y][:-1] + upright[x + 1, y][:-1] + flat[x, y + 1][:0:-1] + upright[x, y][:0:-1]
            ring = ring if (x + y) % 2 else ring[::-1]
            ring = ring[3:] + ring[:3]
            rows.append((x * n + y, [[[*ring, ring[0]]]]))
    df = frame(spark, rows)
    weighted = generalize.with_weights(df, ["id"])
    assert weighted.columns == df.columns and weighted.count() == n * n
    counts = []
    for least in (0.0, 0.002, 0.01, 0.05, 10.0):
        shown = weighted.select("id", generalize.at_threshold(F.col("geom"), F.lit(least)).alias("geom"))
        rim = J.dissolved_boundary(shown)
        corners = 4 if least > 0.5 else 0  # the four corners of the whole lie between two sides only
        assert rim.count() == 4 * n - corners
        assert shown.agg(F.sum(G.area(F.col("geom")))).first()[0] == pytest.approx(n * n - corners / 2)
        counts.append(shown.agg(F.sum(G.vertex_count(F.col("geom")))).first()[0])
    assert counts == sorted(counts, reverse=True) and counts[0] == df.agg(F.sum(G.vertex_count(F.col("geom")))).first()[0] and counts[-1] < counts[0] / 3


def test_weights_keep_nulls_holes_and_parts(spark):
    hole = [*square(0, 0, 9), list(reversed(square(3, 3, 1)[0]))]
    df = frame(spark, [(1, [hole, square(20, 0, 1)]), (2, [square(3, 3, 1)])])
    df = df.unionByName(df.where("id = 2").withColumns({"id": F.lit(3).cast("long"), "geom": F.lit(None).cast(df.schema["geom"].dataType)}))
    df = df.unionByName(df.where("id = 2").withColumns({"id": F.lit(4).cast("long"), "geom": F.array().cast(df.schema["geom"].dataType)}))
    found = generalize.with_weights(df, ["id"])
    rows = {r.id: r.geom for r in found.select("id", generalize.at_threshold(F.col("geom"), F.lit(0.0)).alias("geom")).collect()}
    assert rows[3] is None and rows[4] == [] and [len(p) for p in rows[1]] == [2, 1]
    whole = {r.id: r.geom for r in df.collect()}
    assert rows[1] == whole[1] and rows[2] == whole[2]


def test_weighted_tiles(spark, sf_dir, tmp_path):
    lots = S.bent_lots(spark, sf_dir)
    weighted = generalize.with_weights(lots, ["lot_id"])
    descent.write_pyramid(weighted, str(tmp_path / "w"), ("lot_id",), 9, 14, weighted=True, buffer=0.0)
    tiles = descent.read_tiles(spark, str(tmp_path / "w"))
    assert tiles.schema["geom"].dataType.simpleString() == "array<array<array<struct<x:double,y:double>>>>"
    totals = {r.z: (r.v, r.a) for r in tiles.groupBy("z").agg(F.sum(G.vertex_count(F.col("geom"))).alias("v"), F.sum(G.area(F.col("geom"))).alias("a")).collect()}
    one = {z: tiles.where(f"z = {z}").groupBy("lot_id").count().where("count = 1").count() for z in (9, 14)}
    assert totals[9][0] < totals[14][0] and one[9] >= one[14]
    area = lots.agg(F.sum(G.area(F.col("geom")))).first()[0]
    assert totals[14][1] == pytest.approx(area, rel=0.01)


def test_pieces_are_stored_once_for_all_zooms_in_one_tile(spark):
    # well inside one tile of zoom 8, and over a corner of tiles from zoom 1 on
    df = frame(spark, [(1, [square(-84.05, 33.05, 0.01)]), (2, [square(-0.5, -0.5, 1.0)])], "id long")
    stored = [{r["id"]: r["count"] for r in t.groupBy("id").count().collect()} for t in descent._pieces(df, 3, 8, 0.0, False, "geom")]
    assert [s.get(1, 0) for s in stored] == [1, 0, 0, 0, 0, 0]
    assert stored[0][2] == 4
    assert all(zoom.where("id = 1").count() == 1 for zoom in descent.levels(df, 3, 8, 0.0))


def test_cuts_of_batches_are_those_of_expressions(spark):
    bent = [[(0, 0), (4, 0), (4, 4), (2, 1), (0, 4), (0, 0)]]  # concave
    holed = [[(0, 0), (3, 0), (3, 3), (0, 3), (0, 0)], [(1, 1), (1, 2), (2, 2), (2, 1), (1, 1)]]
    rows = [(1, [bent]), (2, [holed, [[(x + 10, y) for x, y in r] for r in bent]]), (3, []), (4, [])]
    df = frame(spark, rows, "id long").withColumn("geom", F.when(F.col("id") != 4, F.col("geom")))
    for box in ((0.5, 0.5, 2.5, 3.25), (-1, -1, 20, 20), (1, 1, 2, 2), (8, 2, 12, 3), (50, 50, 51, 51)):
        b = G.box_literal(box)
        want = G.clip_to_box(F.col("geom"), b)
        piece = C.cut_to_box(F.col("geom"), b["xmin"], b["ymin"], b["xmax"], b["ymax"])
        both = df.select("id", want.alias("w"), G.bbox_of(want).alias("wb"), G.area(want).alias("wa"), piece.alias("p"), C.area_of(F.col("geom")).alias("a"), G.area(F.col("geom")).alias("ga"))
        for r in both.collect():
            if r.w is None:
                assert r.p["geom"] is None and r.a is None
                continue
            assert r.p["geom"] == r.w and r.p["bbox"] == r.wb and r.p["area"] == r.wa and r.a == r.ga
