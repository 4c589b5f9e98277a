"""Zoom pyramids as tables: one row per feature and tile it meets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from cadastra.functions import cutting as C
from cadastra.functions import geometry as G
from cadastra.functions import mercator as M
from cadastra.operators.filters import boxes_overlap
from cadastra.operators.layout import spread
from cadastra.operators.steps import once
from cadastra.schemas import TILE_PROPERTIES

# Zoom ranges of the pyramids and, where features are thinned, their drop rate.
PRESETS = {
    "state": {"min_zoom": 10, "max_zoom": 16, "base_zoom": 16, "drop_rate": 2.5},
    "county": {"min_zoom": 12, "max_zoom": 16},
    "large": {"min_zoom": 8, "max_zoom": 14},
    "boundary": {"min_zoom": 0, "max_zoom": 12},
    "export": {"min_zoom": 12, "max_zoom": 16},
    "extract": {"min_zoom": 8, "max_zoom": 16},
}

# Zooms at which each representation is shown (from, below).
DETAIL = {
    "state-boundaries": (3, 10),
    "county-boundaries": (4, 12),
    "centroids": (8, 12),
    "polygons": (12, 23),
    "labels": (17, 23),
}

FEW_CELLS = 64  # tiles of the largest zoom up to which a feature's tiles are one array
_BUCKETS = 1_000_000_000
BUFFER = 1 / 64  # of a tile's size, on each side


def draw_of(*key: str) -> Column:
    """Fixed pseudo-random number in [0, 1) per feature."""
    return F.pmod(F.xxhash64(*key), F.lit(_BUCKETS)) / F.lit(float(_BUCKETS))


def kept_zooms(min_zoom: int, max_zoom: int, base_zoom: int, drop_rate: float | None, draw: Column | None) -> Column:
    """Zooms a feature is kept at. Its draw is the same at every zoom, so a feature kept at one zoom is kept below."""
    if drop_rate is None:
        return F.sequence(F.lit(min_zoom), F.lit(max_zoom))
    kept = []
    for zoom in range(min_zoom, max_zoom + 1):
        share = min(1.0, float(drop_rate) ** -(base_zoom - zoom))
        kept.append(F.when(draw < F.lit(share), F.lit(zoom)))
    return F.array_compact(F.array(*kept))


def _met_cells(b: Column, geom: Column | None, zoom: int) -> Column:
    """Tiles (x, y) of one zoom that a feature meets, as an array.

    A box over one tile, or a single polygon whose box stays in one row or column of tiles, meets all tiles of its box;
    only others are tested exactly.
    """
    z = F.lit(zoom)
    cover = F.struct(
        M.tile_x(b["xmin"], z).alias("x0"), M.tile_x(b["xmax"], z).alias("x1"), M.tile_y(b["ymax"], z).alias("y0"), M.tile_y(b["ymin"], z).alias("y1")
    )

    def cells(c: Column) -> Column:
        columns = F.sequence(c["x0"], c["x1"])
        grid = F.flatten(F.transform(columns, lambda x: F.transform(F.sequence(c["y0"], c["y1"]), lambda y: F.struct(x.alias("x"), y.alias("y")))))
        one = F.array(F.struct(c["x0"].alias("x"), c["y0"].alias("y")))
        single = (c["x0"] == c["x1"]) & (c["y0"] == c["y1"])
        if geom is None:
            return F.when(single, one).otherwise(grid)
        line = ((c["x0"] == c["x1"]) | (c["y0"] == c["y1"])) & (F.size(geom) == 1)
        met = F.filter(grid, lambda t: G.intersects_box(geom, M.tile_box(z, t["x"], t["y"])))
        return F.when(single, one).when(line, grid).otherwise(met)

    return G.let(cover, cells)


def tile_features(
    df: DataFrame,
    min_zoom: int,
    max_zoom: int,
    base_zoom: int | None = None,
    drop_rate: float | None = None,
    draw: Column | None = None,
    bbox: str = "bbox",
    geom: str | None = "geom",
) -> DataFrame:
    """One row per feature, zoom and tile, with z, x, y added.

    The tiles of a feature are found once, at the largest zoom; a tile further up is met when one of its children is. So
    nothing is tested again there, and a feature is repeated only for the tiles of the zooms that it is kept at. Features
    over more than `FEW_CELLS` tiles at the largest zoom are spread over the tiles of each zoom, row by row.
    """
    zooms = kept_zooms(min_zoom, max_zoom, max_zoom if base_zoom is None else base_zoom, drop_rate, draw)
    shape = F.col(geom) if geom is not None and geom in df.columns else None

    def ancestors(cells: Column) -> Column:
        def at(z: Column) -> Column:
            up = F.lit(max_zoom) - z
            moved = F.transform(cells, lambda c: F.struct(F.call_function("shiftright", c["x"], up).alias("x"), F.call_function("shiftright", c["y"], up).alias("y")))
            return F.transform(F.array_distinct(moved), lambda t: F.struct(z.alias("z"), t["x"].alias("x"), t["y"].alias("y")))

        return F.flatten(F.transform(F.col("_zooms"), at))

    rows = spread(df.where(F.col(bbox)["xmin"].isNotNull()), df.columns).withColumn("_zooms", zooms)
    tiles = G.let(_met_cells(F.col(bbox), shape, max_zoom), ancestors)
    b = F.col(bbox)

    def covered(z: Column) -> dict[str, Column]:
        return {"_x0": M.tile_x(b["xmin"], z), "_x1": M.tile_x(b["xmax"], z), "_y0": M.tile_y(b["ymax"], z), "_y1": M.tile_y(b["ymin"], z)}

    c = covered(F.lit(max_zoom))
    cells = (c["_x1"] - c["_x0"] + 1).cast("long") * (c["_y1"] - c["_y0"] + 1)
    found = rows.where(cells <= FEW_CELLS).withColumn("_tile", F.explode(tiles)).select(*df.columns, "_tile.z", "_tile.x", "_tile.y")
    large = rows.where(cells > FEW_CELLS).withColumn("z", F.explode("_zooms")).withColumns(covered(F.col("z")))
    large = large.withColumn("x", F.explode(F.sequence("_x0", "_x1"))).withColumn("y", F.explode(F.sequence("_y0", "_y1")))
    if shape is not None:
        single = (F.col("_x0") == F.col("_x1")) & (F.col("_y0") == F.col("_y1"))
        large = large.where(single | G.intersects_box(shape, M.tile_box(F.col("z"), F.col("x"), F.col("y"))))
    return found.unionAll(large.select(*df.columns, "z", "x", "y"))


def clipped(tiles: DataFrame, buffer: float = BUFFER, geom: str = "geom", bbox: str = "bbox") -> DataFrame:
    """Tile rows with each geometry cut to its tile, widened on each side by `buffer` of the tile's size.

    A feature inside one tile is left as it is, and the others are cut at the sides that their box (`bbox`, where the rows
    have one) reaches beyond. Neighbouring tiles share the buffer, so seams can be drawn over.
    """
    b = M.tile_box(F.col("z"), F.col("x"), F.col("y"))

    def widened(v: Column) -> Column:
        dx, dy = (v["xmax"] - v["xmin"]) * F.lit(buffer), (v["ymax"] - v["ymin"]) * F.lit(buffer)
        return G.box(v["xmin"] - dx, v["ymin"] - dy, v["xmax"] + dx, v["ymax"] + dy)

    held = once(tiles, _tile=G.let(b, widened))
    t = F.col("_tile")
    if bbox not in tiles.columns:
        return held.withColumn(geom, G.clip_to_box(F.col(geom), t)).select(*tiles.columns)
    own = F.col(bbox)
    inside = (own["xmin"] >= t["xmin"]) & (own["xmax"] <= t["xmax"]) & (own["ymin"] >= t["ymin"]) & (own["ymax"] <= t["ymax"])
    if not C.cuttable(tiles.schema[geom].dataType):
        return held.withColumn(geom, F.when(inside, F.col(geom)).otherwise(G.clip_to_box(F.col(geom), t, bbox=own))).select(*tiles.columns)
    beyond = F.when(~F.coalesce(inside, F.lit(False)), F.col(geom))
    cut = held.withColumn("_piece", C.cut_to_box(beyond, t["xmin"], t["ymin"], t["xmax"], t["ymax"]))
    return cut.withColumn(geom, F.when(inside, F.col(geom)).otherwise(F.col("_piece.geom"))).select(*tiles.columns)


def pyramid(
    df: DataFrame, preset: str, draw: Column | None = None, key: tuple[str, ...] = ("id",), **columns: str
) -> DataFrame:
    """Tile rows with one of the presets. Thinning draws by `key`, the columns that name a feature, unless `draw` is given."""
    settings = PRESETS[preset]
    if "drop_rate" in settings and draw is None:
        draw = draw_of(*key)
    return tile_features(df, draw=draw, **settings, **columns)


def point_tiles(df: DataFrame, x: str, y: str, min_zoom: int, max_zoom: int) -> DataFrame:
    """Tile rows of a point layer: one tile per zoom."""
    zooms = F.sequence(F.lit(min_zoom), F.lit(max_zoom))
    return (
        df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
        .withColumn("z", F.explode(zooms))
        .withColumns({"x": M.tile_x(F.col(x), F.col("z")), "y": M.tile_y(F.col(y), F.col("z"))})
    )


def tile_counts(tiles: DataFrame) -> DataFrame:
    """Features per tile."""
    return tiles.groupBy("z", "x", "y").agg(F.count("*").alias("features"))


def tile_stats(tiles: DataFrame) -> DataFrame:
    """Tiles and features per tile, per zoom, with the median and the 95th percentile."""
    return tile_counts(tiles).groupBy("z").agg(
        F.count("*").alias("tiles"), F.sum("features").alias("features"),
        F.avg("features").alias("avg_features"), F.max("features").alias("max_features"),
        F.percentile("features", 0.5).alias("median_features"), F.percentile("features", 0.95).alias("p95_features"),
    )


def keep_largest(tiles: DataFrame, size: Column, key: list[str], cap: int, salts: int = 64) -> DataFrame:
    """The `cap` largest features of every tile (the densest tiles lose their smallest features).

    Features are ranked within a salt of the tile first, so a crowded low-zoom tile is never sorted by one task: at
    most salts * cap of its features reach the final ranking.
    """
    tile = ["z", "x", "y"]
    order = [F.desc("_size"), *key]
    salted = tiles.withColumn("_size", size).withColumn("_salt", F.pmod(F.xxhash64(*key), F.lit(salts)))
    per_salt = F.row_number().over(W.Window.partitionBy(*tile, "_salt").orderBy(*order))
    overall = F.row_number().over(W.Window.partitionBy(*tile).orderBy(*order))
    return (
        salted.withColumn("_rank", per_salt)
        .where(F.col("_rank") <= cap)
        .withColumn("_rank", overall)
        .where(F.col("_rank") <= cap)
        .drop("_size", "_salt", "_rank")
    )


def with_properties(tiles: DataFrame, layer: str) -> DataFrame:
    """Tile rows with the published properties of a layer in a struct."""
    names = [c for c in TILE_PROPERTIES[layer] if c in tiles.columns]
    return tiles.select(F.lit(layer).alias("layer"), "z", "x", "y", F.struct(*names).alias("properties"),
                        *[c for c in ("id", "geom") if c in tiles.columns])


def pack_tiles(tiles: DataFrame, key: list[str], features_per_part: int = 10_000) -> DataFrame:
    """Tile table with the features of a tile as arrays, in parts of about `features_per_part` features.

    A tile that holds more is written as several parts, so no task ever gathers a crowded tile whole. A tile is read
    back as the union of its parts.
    """
    tile = ["z", "x", "y"]
    crowded = (
        tile_counts(tiles)
        .where(F.col("features") > features_per_part)
        .select(*tile, F.ceil(F.col("features") / features_per_part).alias("_parts"))
    )
    content = [c for c in tiles.columns if c not in tile]
    # The crowded tiles are few; the join turns into a broadcast at run time when they fit, and hot tiles are split
    # by the adaptive skew join when they do not.
    parts = tiles.join(crowded, tile, "left").withColumn(
        "part", F.pmod(F.xxhash64(*key), F.coalesce("_parts", F.lit(1).cast("bigint"))).cast("int")
    )
    return parts.groupBy(*tile, "part").agg(F.collect_list(F.struct(*content)).alias("features"))


def tile_request(df: DataFrame, z: int, x: int, y: int, layer: str = "parcels") -> DataFrame:
    """Features of one tile: box filter on the tile's bounds, then the layer's properties."""
    bounds = M.tile_box(F.lit(z), F.lit(x), F.lit(y))
    names = [F.col(c) for c in TILE_PROPERTIES[layer] if c in df.columns]
    if layer == "parcel-centroids":
        p = F.col("centroid")
        inside = (
            (p["x"] >= bounds["xmin"]) & (p["x"] <= bounds["xmax"])
            & (p["y"] >= bounds["ymin"]) & (p["y"] <= bounds["ymax"])
        )
        return df.where(inside).select(*names, "centroid")
    return df.where(boxes_overlap(F.col("bbox"), bounds)).select(*names, "geom")


def shown_at(zoom: int) -> list[str]:
    """Representations shown at a zoom."""
    return [name for name, (low, high) in DETAIL.items() if low <= zoom < high]


def level_of_detail(layers: dict[str, DataFrame], min_zoom: int, max_zoom: int) -> DataFrame:
    """Tile rows (layer, z, x, y, key) of several representations, each at the zooms where it is shown.

    Every layer needs a string column key and a box; centroids are layers with a degenerate box.
    """
    result = None
    for name, df in layers.items():
        low, high = DETAIL[name]
        first, last = max(low, min_zoom), min(high - 1, max_zoom)
        if first > last:
            continue
        tiles = tile_features(df, first, last).select(F.lit(name).alias("layer"), "z", "x", "y", "key")
        result = tiles if result is None else result.unionByName(tiles)
    if result is None:
        raise ValueError("no layer is shown at these zooms")
    return result
