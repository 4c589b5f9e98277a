"""Tile pyramids by descent: the features of a tile come from the clipped ones of its parent.

The tiles of the smallest zoom are covered once; from there every piece goes to those of its four children that it meets,
cut to them. So a large polygon is never tested as a whole against a small tile, and only a piece over several children is
tested at all. Thinned-out features descend too, as deeper zooms need them; they are left out where a zoom is written.
Descending is row by row, without a shuffle. A piece is stored once for all zooms at which it lies in one tile; only pieces
that go over several children of their tile are cut and stored again. From these tables the rows of every zoom are made.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cadastra.functions import cutting as C
from cadastra.functions import geometry as G
from cadastra.functions import mercator as M
from cadastra.operators import generalize, layout, tiling
from cadastra.operators.filters import with_box
from cadastra.operators.steps import discard, once, stored
from cadastra.sources.tables import read_hive


def _widened(z: Column, x: Column, y: Column, buffer: float) -> Column:
    """Box of a tile, wider on each side by `buffer` of its size."""

    def wider(v: Column) -> Column:
        dx, dy = (v["xmax"] - v["xmin"]) * F.lit(buffer), (v["ymax"] - v["ymin"]) * F.lit(buffer)
        return G.box(v["xmin"] - dx, v["ymin"] - dy, v["xmax"] + dx, v["ymax"] + dy)

    return G.let(M.tile_box(z, x, y), wider)


class _Step:
    """Expressions of one step down, built once for all zooms."""

    def __init__(self, geom: str, buffer: float, weighted: bool, flat: bool):
        self.geom, self.flat = geom, flat
        b, t, z = F.col("bbox"), F.col("_tile"), F.col("z") + 1
        self.tile = _widened(F.col("z"), F.col("x"), F.col("y"), buffer)
        self.inside = (b["xmin"] >= t["xmin"]) & (b["xmax"] <= t["xmax"]) & (b["ymin"] >= t["ymin"]) & (b["ymax"] <= t["ymax"])
        self.piece = F.when(F.col("_inside"), F.col(geom)).otherwise(G.clip_to_box(F.col(geom), t, weighted, b))
        self.box = F.when(F.col("_inside"), b).otherwise(G.bbox_of(F.col(geom)))
        self.beyond = F.when(~F.coalesce(F.col("_inside"), F.lit(False)), F.col(geom))
        self.beside = F.when(~F.coalesce(F.col("_inside") & F.col("_one"), F.lit(False)), F.col(geom))

        def of_two(low: Column, high: Column, parent: Column) -> Column:
            return F.sequence(F.greatest(parent * 2, low), F.least(parent * 2 + 1, high))

        self.columns = of_two(M.tile_x(b["xmin"], z), M.tile_x(b["xmax"], z), F.col("x"))
        self.rows = of_two(M.tile_y(b["ymax"], z), M.tile_y(b["ymin"], z), F.col("y"))
        # A concave ring that is cut keeps sides along the cut. They lie outside all children when there is a buffer; without
        # one they lie on the rim of children, so a piece of some area counts only where some area is left of it.
        if buffer > 0:
            self.met, self.left = F.col("_one") | G.intersects_box(F.col(geom), M.tile_box(z, F.col("_x"), F.col("_y"))), F.lit(True)
        else:
            whole = C.area_of if flat else G.area
            thin = (whole(F.col(geom)) == 0) & G.intersects_box(F.col(geom), M.tile_box(z, F.col("_x"), F.col("_y")))
            self.met, self.left = F.lit(True), F.col("_one") | F.col("_thin") | (F.col("_area") > 0)
            self.thin = thin
        self.buffered = buffer > 0

    def cut(self, rows: DataFrame, measured: bool = False) -> DataFrame:
        """Pieces cut to their tiles; a piece inside its tile is left as it is. With `measured` also `_area`, of pieces beside others."""
        kept = [*rows.columns, "_area"] if measured else rows.columns
        held = once(once(rows, _tile=self.tile), _inside=self.inside)
        if not self.flat:
            # the box of a piece is made from the piece, that of a whole feature is kept
            cut = once(once(held, **{self.geom: self.piece}), bbox=self.box)
            return once(cut, _area=G.area(F.col(self.geom))).select(*kept) if measured else cut.select(*kept)
        t = F.col("_tile")
        cut = held.withColumn("_piece", C.cut_to_box(self.beside if measured else self.beyond, t["xmin"], t["ymin"], t["xmax"], t["ymax"]))
        inside = F.col("_inside")
        piece = {
            self.geom: F.when(inside, F.col(self.geom)).otherwise(F.col("_piece.geom")),
            "bbox": F.when(inside, F.col("bbox")).otherwise(F.col("_piece.bbox")), "_area": F.col("_piece.area"),
        }
        return cut.withColumns(piece).select(*kept)

    def children(self, pieces: DataFrame) -> DataFrame:
        """Pieces in the children of their tiles that they meet, cut to them."""
        grid = pieces.where(F.col("bbox").isNotNull()).withColumns({"_xs": self.columns, "_ys": self.rows})
        single = (F.size("_xs") == 1) & (F.size("_ys") == 1)
        spread = grid.withColumn("_one", single).withColumn("_x", F.explode("_xs")).withColumn("_y", F.explode("_ys"))
        if not self.buffered:
            spread = spread.withColumn("_thin", self.thin)
        moved = {"z": F.col("z") + 1, "x": F.col("_x"), "y": F.col("_y")}
        cut = self.cut(spread.where(self.met).withColumns(moved), measured=not self.buffered).where(self.left)
        return cut.select(*pieces.columns)


def _settled(pieces: DataFrame, zoom: int, max_zoom: int, buffer: float) -> DataFrame:
    """Pieces at a zoom with `_last`, the deepest zoom down to which they lie in one tile, and that tile (`_lx`, `_ly`).

    In the children on that way nothing would be cut off, so down to there the piece and its box stay as they are.
    """
    b, deep = F.col("bbox"), max_zoom - zoom

    def below(low: Column, high: Column, parent: str) -> tuple[Column, Column]:
        first = F.shiftleft(F.col(parent), deep)
        return F.greatest(first, low), F.least(first + ((1 << deep) - 1), high)

    z = F.lit(max_zoom)
    x0, x1 = below(M.tile_x(b["xmin"], z), M.tile_x(b["xmax"], z), "x")
    y0, y1 = below(M.tile_y(b["ymax"], z), M.tile_y(b["ymin"], z), "y")
    ends = once(pieces, _x0=x0, _x1=x1, _y0=y0, _y1=y1)

    def up(c: str, levels: int) -> Column:
        return F.shiftright(F.col(c), levels)

    one = [F.when((up("_x0", max_zoom - k) == up("_x1", max_zoom - k)) & (up("_y0", max_zoom - k) == up("_y1", max_zoom - k)), F.lit(k)) for k in range(max_zoom, zoom, -1)]
    found = once(ends, _z=F.coalesce(*one, F.lit(zoom)))
    at = [F.call_function("shiftright", F.col(c), max_zoom - F.col("_z")) for c in ("_x0", "_y0")]
    placed = once(found, _lx=at[0], _ly=at[1])
    t = once(placed, _tile=_widened(F.col("_z"), F.col("_lx"), F.col("_ly"), buffer))
    w = F.col("_tile")
    inside = F.coalesce((F.col("_z") > zoom) & (b["xmin"] >= w["xmin"]) & (b["xmax"] <= w["xmax"]) & (b["ymin"] >= w["ymin"]) & (b["ymax"] <= w["ymax"]), F.lit(False))
    last = {"_last": F.when(inside, F.col("_z")).otherwise(F.lit(zoom)), "_lx": F.when(inside, F.col("_lx")).otherwise(F.col("x")), "_ly": F.when(inside, F.col("_ly")).otherwise(F.col("y"))}
    return t.select(*[c for c in pieces.columns if c not in ("x", "y")], *[v.alias(k) for k, v in last.items()])


def _pieces(features: DataFrame, min_zoom: int, max_zoom: int, buffer: float, weighted: bool, geom: str) -> list[DataFrame]:
    """Tables of the pieces that begin at each zoom (`z`), each with the last zoom it stands for and its tile there."""
    step = _Step(geom, buffer, weighted, not weighted and C.cuttable(features.schema[geom].dataType))
    first = step.cut(tiling.tile_features(with_box(features, geom), min_zoom, min_zoom, geom=geom))
    found = [stored(_settled(first, min_zoom, max_zoom, buffer))]
    for zoom in range(min_zoom, max_zoom):
        split = reduce(lambda a, b: a.unionAll(b), [t.where(F.col("_last") == zoom) for t in found])
        parents = split.withColumn("z", F.lit(zoom)).withColumnsRenamed({"_lx": "x", "_ly": "y"}).drop("_last")
        found.append(stored(_settled(step.children(parents), zoom + 1, max_zoom, buffer)))
    return found


def _shown(pieces: DataFrame, zooms: Column) -> DataFrame:
    """Rows of pieces in their tiles, at those of some zooms that they stand for."""
    inside = F.filter(zooms, lambda k: (k >= F.col("z")) & (k <= F.col("_last")))
    rows = pieces.withColumn("_zoom", F.explode(inside))
    up = F.col("_last") - F.col("_zoom")
    x, y = (F.call_function("shiftright", F.col(c), up) for c in ("_lx", "_ly"))
    return rows.withColumns({"z": F.col("_zoom"), "x": x, "y": y}).drop("_zoom", "_last", "_lx", "_ly")


def levels(features: DataFrame, min_zoom: int, max_zoom: int, buffer: float = tiling.BUFFER, weighted: bool = False, geom: str = "geom") -> list[DataFrame]:
    """The pieces of all features at each zoom: the columns of `features` with `geom` and bbox of the piece, z, x and y."""
    found = _pieces(features, min_zoom, max_zoom, buffer, weighted, geom)
    return [reduce(lambda a, b: a.unionAll(b), [_shown(t, F.array(F.lit(zoom))) for t in found[: zoom - min_zoom + 1]]) for zoom in range(min_zoom, max_zoom + 1)]


def write_pyramid(
    features: DataFrame,
    path: str,
    key: tuple[str, ...],
    min_zoom: int,
    max_zoom: int,
    base_zoom: int | None = None,
    drop_rate: float | None = None,
    draw: Column | None = None,
    buffer: float = tiling.BUFFER,
    weighted: bool = False,
    units: float = 1.0,
    geom: str = "geom",
    partition_by: tuple[str, ...] = ("z",),
    files: dict[str, int] = layout.STATE_LAYOUT,
) -> None:
    """Write the tile rows of all zooms under path/z=N (or other partition columns), sorted by tile.

    With `drop_rate` features are thinned by `draw`, by default a hash of `key`, nested over the zooms. With `weighted`
    (from `generalize.with_weights`) each zoom keeps the vertices that it can show. The width of the write follows the
    bytes of the pieces, not those of the features.
    """
    if drop_rate is not None:
        features = features.withColumn("_draw", tiling.draw_of(*key) if draw is None else draw)
    found = _pieces(features, min_zoom, max_zoom, buffer, weighted, geom)
    zooms = tiling.kept_zooms(min_zoom, max_zoom, max_zoom if base_zoom is None else base_zoom, drop_rate, None if drop_rate is None else F.col("_draw"))
    tiles = reduce(lambda a, b: a.unionAll(b), [_shown(t, zooms) for t in found]).drop("_draw")
    if weighted:
        tiles = tiles.withColumn(geom, generalize.at_zoom(F.col(geom), F.col("z"), units))
    width = layout.width_of(tiles, layout.TASK_BYTES // len(found))  # a stored piece makes a row for each of its zooms
    layout.write_parquet(in_tile_order(tiles, [*[c for c in partition_by if c != "z"], "z", "x", "y"], key, width), path, **files, partition_by=partition_by)
    discard(*found)


def in_tile_order(tiles: DataFrame, order: list[str], key: tuple[str, ...], width: int | None = None) -> DataFrame:
    """Tile rows sorted by tile. A hash of the key splits crowded tiles over tasks."""
    by = [*order, F.xxhash64(*key), *key]
    ranged = tiles.repartitionByRange(width, *by) if width else tiles.repartitionByRange(*by)
    return ranged.sortWithinPartitions(*by)


def merge_pyramids(spark: SparkSession, path: str, merged: str, key: tuple[str, ...]) -> None:
    """One pyramid from those under path/state=XX/z=N: tiles on a border get the features of all states beside it.

    A feature that several states have (their extracts may overlap) comes once in a tile, from the smallest state code.
    Rows that may be such are found by a hash of tile and key alone; only these are grouped, whole rows and exact keys.
    """
    tiles = read_hive(spark, path)
    tiles = tiles.withColumn("z", F.col("z").cast("int"))
    names = [c for c in tiles.columns if c not in {"z", "x", "y", "state", *key}]
    mark = F.xxhash64("z", "x", "y", *key)
    several = stored(tiles.groupBy(mark.alias("_mark")).agg(F.count("*").alias("_n")).where("_n > 1").select("_mark"))
    marked = tiles.withColumn("_mark", mark)
    alike = marked.join(several, "_mark", "left_semi").groupBy("z", "x", "y", *key).agg(F.min_by(F.struct("state", *names), "state").alias("_v"))
    alone = marked.join(several, "_mark", "left_anti").select("z", "x", "y", *key, "state", *names)
    merged_rows = alone.unionAll(alike.select("z", "x", "y", *key, "_v.*"))
    layout.write_parquet(in_tile_order(merged_rows, ["z", "x", "y"], key, layout.width_of(tiles)), merged, partition_by=("z",))
    discard(several)


def read_tiles(spark: SparkSession, path: str) -> DataFrame:
    """The tile rows of a written pyramid, z as int."""
    return read_hive(spark, path).withColumn("z", F.col("z").cast("int"))
