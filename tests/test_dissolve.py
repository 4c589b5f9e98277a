"""Dissolving to polygons: ring assembly, holes, corners on sides."""

import math
import random

import pytest
from pyspark.sql import functions as F

from cadastra.functions import geometry as G
from cadastra.operators import dissolve, steps
from tests.helpers import frame, ring_area, square


def polygons(spark, shapes, **keys):
    rows = [(i, [s] if not isinstance(s[0][0], list) else s) for i, s in enumerate(shapes)]
    found = dissolve.dissolved_polygons(frame(spark, rows))
    out = []
    for (poly,) in (r.geom for r in found.collect()):
        out.append([[(round(p.x, 7), round(p.y, 7)) for p in ring] for ring in poly])
    return sorted(out)


def areas(found):
    return sorted(round(sum(ring_area(r) * (1 if k == 0 else -1) for k, r in enumerate(poly)), 6) for poly in found)


def signed(ring):
    return sum(x1 * y2 - x2 * y1 for (x1, y1), (x2, y2) in zip(ring, ring[1:]))


@pytest.mark.parametrize("seed", [1, 2])
def test_cycles_are_ranked(spark, seed):
    rng = random.Random(seed)
    ids = rng.sample(range(10_000), 400)
    follow, start, cycles = {}, 0, []
    for size in (1, 2, 3, 7, 64, 130, 193):
        part = ids[start : start + size]
        start += size
        cycles.append(part)
        follow.update(zip(part, part[1:] + part[:1], strict=True))
    rows = spark.createDataFrame(list(follow.items()), "id long, next long")
    got = {r.id: (r.ring, r.place) for r in dissolve.ranked_rings(rows).collect()}
    for part in cycles:
        at = part.index(min(part))
        for k, v in enumerate(part[at:] + part[:at]):
            assert got[v] == (min(part), k)
    assert dissolve.ranked_rings(rows.where("false")).count() == 0


def test_shared_sides_and_straight_corners_vanish(spark):
    found = polygons(spark, [square(0, 0, 1), square(1, 0, 1), square(2, 0, 1)])
    assert len(found) == 1 and set(found[0][0]) == {(0, 0), (3, 0), (3, 1), (0, 1)} and len(found[0][0]) == 5


def test_corners_on_the_side_of_another(spark):
    """A slanted strip: two small pieces against one long side, with corners that snapping moves off it."""
    turn = math.radians(17.3)

    def place(x, y):
        return (x * math.cos(turn) - y * math.sin(turn), x * math.sin(turn) + y * math.cos(turn))

    def quad(x0, y0, x1, y1):
        return [[place(x, y) for x, y in ((x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0))]]

    found = polygons(spark, [quad(0, 0, 3, 1), quad(0, 1, 1.1, 2), quad(1.1, 1, 3, 2)])
    assert len(found) == 1 and len(found[0]) == 1
    assert areas(found)[0] == pytest.approx(6.0, abs=1e-6)


def test_parts_that_meet_in_a_corner_stay_apart(spark):
    found = polygons(spark, [square(0, 0, 1), square(1, 1, 1)])
    assert len(found) == 2 and areas(found) == [1.0, 1.0]


def test_holes_and_islands(spark):
    cells = [(x, y) for x in range(5) for y in range(5) if not (1 <= x <= 3 and 1 <= y <= 3)] + [(2, 2)]
    found = polygons(spark, [square(x, y, 1) for x, y in cells])
    assert sorted(map(len, found)) == [1, 2] and areas(found) == [1.0, 16.0]
    outer = max(found, key=len)
    assert signed(outer[0]) > 0 > signed(outer[1])


def test_a_hole_at_the_rim_and_holes_that_meet_are_rings_of_their_own(spark):
    # a hole that meets the outer ring in a corner, and two holes that meet in one
    cells = {(x, y) for x in range(6) for y in range(6)} - {(0, 0), (1, 1), (3, 3), (4, 4)}
    found = polygons(spark, [square(x, y, 1) for x, y in sorted(cells)])
    assert [len(p) for p in found] == [4] and areas(found) == [32.0]
    for ring in found[0]:
        assert len(set(ring[:-1])) == len(ring) - 1


def test_input_rings_of_any_direction_with_holes_and_copies(spark):
    frame_ = [*square(0, 0, 3), list(reversed(square(1, 1, 1)[0]))]
    other = [list(reversed(square(3, 0, 1)[0]))]
    found = polygons(spark, [[frame_], [frame_], [other]])
    assert len(found) == 1 and areas(found) == [9.0] and len(found[0]) == 2
    filled = polygons(spark, [[frame_], [other], [square(1, 1, 1)]])
    assert areas(filled) == [10.0] and len(filled[0]) == 1


def test_groups_nulls_and_empty_tables(spark):
    rows = [("a", square(0, 0, 1)), ("a", square(1, 0, 1)), (None, square(2, 0, 1)), (None, square(3, 0, 1))]
    df = frame(spark, [(k, [s]) for k, s in rows], "name string")
    df = df.unionByName(df.limit(1).withColumn("geom", F.lit(None).cast(df.schema["geom"].dataType)))
    found = dissolve.dissolved_polygons(df, "name").select("name", F.round(G.area(F.col("geom")), 6)).collect()
    assert sorted(map(tuple, found), key=repr) == [("a", 2.0), (None, 2.0)]
    assert dissolve.dissolved_polygons(df.where("false"), "name").count() == 0


@pytest.mark.parametrize("seed", [3, 4])
def test_random_cells_keep_their_area(spark, seed):
    rng = random.Random(seed)
    cells = [(x, y) for x in range(14) for y in range(14) if rng.random() < 0.55]
    shapes = []
    for x, y in cells:
        if rng.random() < 0.3:  # a cell in two unequal parts
            shapes += [[[(x, y), (x + 0.25, y), (x + 0.25, y + 1), (x, y + 1), (x, y)]], [[(x + 0.25, y), (x + 1, y), (x + 1, y + 1), (x + 0.25, y + 1), (x + 0.25, y)]]]
        else:
            shapes.append(square(x, y, 1))
    found = polygons(spark, shapes)
    assert sum(areas(found)) == pytest.approx(len(cells))
    part, left = 0, set(cells)
    while left:
        part, todo = part + 1, [left.pop()]
        while todo:
            x, y = todo.pop()
            for n in ((x + 1, y), (x - 1, y), (x, y + 1), (x, y - 1)):
                if n in left:
                    left.remove(n)
                    todo.append(n)
    assert len(found) == part
    for poly in found:
        assert signed(poly[0]) > 0 and all(signed(r) < 0 for r in poly[1:])
        assert all(len(set(r[:-1])) == len(r) - 1 for r in poly)


def test_finished_rings_leave_the_ranking(spark, monkeypatch):
    """Many short rings and a long one: a round stores the rings that are not closed yet, not all of them."""
    links = [(k, k + 1 if k % 4 < 3 else k - 3) for k in range(4000)] + [(5000 + k, 5000 + (k + 1) % 600) for k in range(600)]
    written = []

    def counted(df):
        written.append(steps.stored(df))
        return written[-1]

    monkeypatch.setattr(dissolve, "stored", counted)
    got = {r.id: (r.ring, r.place) for r in dissolve.ranked_rings(spark.createDataFrame(links, "id long, next long")).collect()}
    assert got == {**{k: (k - k % 4, k % 4) for k in range(4000)}, **{5000 + k: (5000, k) for k in range(600)}}
    assert sum(df.count() for df in written[4:]) <= 600 * len(written[4:])
