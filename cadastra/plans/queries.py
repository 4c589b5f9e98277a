"""Registered queries: every operator run over the given tables (name -> function of session and data directory)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cadastra import lookups
from cadastra.functions import cutting as C
from cadastra.functions import display as D
from cadastra.functions import geometry as G
from cadastra.functions import mercator as M
from cadastra.functions.hilbert import hilbert_of_box
from cadastra.operators import descent, dissolve, enrich, filters, generalize, layout, normalize, publish, quality, reports, sampling, search, simplify
from cadastra.operators import spatial_join as J
from cadastra.operators import tiling
from cadastra.operators.steps import stored
from cadastra.plans import jobs, rebuild
from cadastra.plans import standins as S
from cadastra.session import shared_folder
from cadastra.sources import geojson, tables, wkb

Query = Callable[[SparkSession, str], DataFrame]

# Parameters of the queries; the reference SQL uses the same values.
METRO_BOX = (-84.5, 33.6, -84.2, 33.9)
SEARCH_BOX = (-84.9, 31.5, -82.9, 33.9)
L_SHAPE = [[[(-84.5, 31.0), (-81.0, 31.0), (-81.0, 32.0), (-83.0, 32.0), (-83.0, 34.0), (-84.5, 34.0), (-84.5, 31.0)]]]
TARGET_BRAND = "Brand#13"
SIMPLIFY_TOLERANCE = 1e-6


def _parcels(spark: SparkSession, sf_dir: str, *, geometry: bool = False) -> DataFrame:
    raw = S.parcel_raw(spark, sf_dir)
    return normalize.normalize(raw if geometry else raw.drop("geom"), unique_lrid=True)


def _box_columns(bbox: str = "bbox", digits: int = 6) -> list[Column]:
    return [F.round(F.col(bbox)[c], digits).alias(c) for c in ("xmin", "ymin", "xmax", "ymax")]


def _draw(key: str) -> Column:
    """Pseudo-random draw in [0, 1) that any SQL engine can repeat."""
    return ((F.col(key) % 1000003) * 7919) % 1000003 / F.lit(1000003.0)


def normalize_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _parcels(spark, sf_dir)
    return p.select(
        "parcel_id", "parcel_id_alt", "geoid", "tax_year", "use_code", "use_description", "zoning_code",
        "num_buildings", "year_built", "building_sqft", "total_value",
        F.col("assessed_acres").cast("double").alias("assessed_acres"), "sale_amount",
        F.col("sale_date").cast("string").alias("sale_date"), "owner_name", "parcel_address", "parcel_city",
        "legal_description", F.col("source_updated").cast("string").alias("source_updated"), "source_version",
        F.round("centroid.x", 6).alias("lon"), F.round("centroid.y", 6).alias("lat"),
        F.round("surface_point.x", 6).alias("surface_lon"), F.round("surface_point.y", 6).alias("surface_lat"),
    )


def parcel_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    full = normalize.parcel_full(_parcels(spark, sf_dir), S.counties(spark, sf_dir))
    return full.select("parcel_id", "geoid", "total_value", "state_name", "state_abbr", "county_name")


def parcel_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = reports.coverage(_parcels(spark, sf_dir), S.counties(spark, sf_dir))
    return report.select(*[
        F.col(c).cast("double").alias(c) if c.startswith("pct_") else F.col(c) for c in report.columns
    ])


def cast_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("lrid")
    date = F.when(k % 10 == 3, F.concat(F.lit("day "), k.cast("string"))).otherwise(F.col("saledate").cast("string"))
    raw = S.parcel_raw(spark, sf_dir).withColumns({"numunits": ((k * 7) % 100000).cast("int"), "saledate": date})
    return normalize.cast_failures(raw)


def fips_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.fips_summary(S.parcel_raw(spark, sf_dir))


def ad_hoc_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.query(
        S.parcel_raw(spark, sf_dir),
        "SELECT usedesc, COUNT(*) AS parcels, MAX(totalvalue) AS max_value FROM parcels GROUP BY usedesc",
    )


def state_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = S.parcel_raw(spark, sf_dir).withColumnRenamed("statefp", "state")
    return reports.counts_by(raw, "state")


def county_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = S.parcel_raw(spark, sf_dir).withColumnRenamed("countyfp", "county")
    return reports.counts_by(raw, "county", name="n", largest_first=True)


def county_value_top10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.value_totals(S.parcel_raw(spark, sf_dir), "countyfp")


def state_value_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.value_totals(S.parcel_raw(spark, sf_dir), "statefp", limit=None)


def county_medians(spark: SparkSession, sf_dir: str) -> DataFrame:
    medians = reports.medians_by(S.parcel_raw(spark, sf_dir), ["countyfp"], ["totalvalue", "assdacres"])
    return medians.select(
        "countyfp", "n", F.round("median_totalvalue", 4).alias("median_totalvalue"),
        F.round("median_assdacres", 4).alias("median_assdacres"),
    )


def county_extents(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = reports.extents_by(S.parcel_raw(spark, sf_dir), "statefp", "countyfp")
    return found.select("statefp", "countyfp", *[F.round(c, 6).alias(c) for c in ("xmin", "ymin", "xmax", "ymax")], "n")


def table_extent(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = reports.extent(S.parcel_raw(spark, sf_dir))
    return found.select(
        *[F.round(c, 6).alias(c) for c in ("xmin", "ymin", "xmax", "ymax")], "n",
        D.extent_text(F.struct("xmin", "ymin", "xmax", "ymax")).alias("extent"),
    )


def bbox_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = filters.of_state(S.raw_multi(spark, sf_dir), "13")
    return filters.intersecting_box(raw, METRO_BOX).agg(F.count("*").alias("parcels"))


def bbox_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = search.get_parcels_in_bbox(_parcels(spark, sf_dir), SEARCH_BOX)
    return found.select("parcel_id", "geoid", "total_value", *_box_columns())


def bbox_filter_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = {"use_description": ["building", "household"], "total_value": (100000, 300000), "parcel_city": "Springfield"}
    found = search.parcel_bbox_query(_parcels(spark, sf_dir), SEARCH_BOX, wanted)
    return found.select("parcel_id", "geoid", "use_description", "total_value")


def polygon_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = search.parcel_geometry_stream(_parcels(spark, sf_dir, geometry=True), L_SHAPE)
    return found.select("parcel_id", "geoid")


def parcel_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    full = normalize.parcel_full(_parcels(spark, sf_dir), S.counties(spark, sf_dir))
    return search.parcel_detail(full, "P42").select("parcel_id", "geoid", "owner_name", "state_abbr", "county_name")


def search_address(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = search.search_by_address(_parcels(spark, sf_dir), "peachtree st 1")
    return found.select("parcel_id", "geoid", "parcel_address", F.round("similarity", 6).alias("similarity"))


def search_owner(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = search.search_by_owner(_parcels(spark, sf_dir), "customer#%001")
    return found.select("parcel_id", "geoid", "owner_name", F.round("similarity", 6).alias("similarity"))


def cross_border_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = filters.state_extract(S.raw_multi(spark, sf_dir), "37")
    return found.select("lrid", "statefp", "countyfp")


def all_states_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    code = F.when(F.col("lrid") % 9 == 4, "02").otherwise(F.col("statefp"))  # a state without bounds
    found = jobs.states_extract(S.raw_multi(spark, sf_dir).withColumn("statefp", code))
    return reports.counts_by(found, "statefp", "countyfp", name="n")


def box_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.intersecting_box(S.raw_multi(spark, sf_dir), SEARCH_BOX).select("lrid", "statefp")


def county_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.of_county(S.parcel_raw(spark, sf_dir), "13", "001").select("lrid", "parcelid", "totalvalue")


def high_value_metro(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = S.raw_multi(spark, sf_dir)
    wanted = filters.matching({"countyfp": ["001", "011", "021", "031", "041"]})
    rich = raw.where(wanted & (F.col("totalvalue") > 300000))
    top = sampling.top_by(rich, "totalvalue", 1000, "lrid").withColumn("c", G.centroid(F.col("geom")))
    return top.select(
        "lrid", "parcelid", "parceladdr", "totalvalue", "yearbuilt", "usedesc",
        F.round("c.x", 6).alias("lon"), F.round("c.y", 6).alias("lat"),
    )


def _large(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = S.raw_multi(spark, sf_dir)
    return raw.where(F.col("assdacres").isNotNull() & (F.col("assdacres") > 1.0)).select(
        "lrid", "geom", "bbox", "parcelid", "statefp", "countyfp", "usedesc",
        F.col("assdacres").cast("double").alias("acres"), F.col("totalvalue").cast("bigint").alias("totalvalue"),
    )


def large_parcels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _large(spark, sf_dir).drop("geom", "bbox")


def sale_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _parcels(spark, sf_dir).where(
        F.col("sale_date").between("1996-01-01", "1996-12-31") & F.col("year_built").isNotNull()
        & (F.col("year_built") < 1960)
    )
    return p.select("parcel_id", "geoid", "year_built", F.col("sale_date").cast("string").alias("sale_date"))


def edge_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.edge_profile(S.edges(spark, sf_dir))


def encoding_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    profile = reports.geometry_profile(S.raw_multi(spark, sf_dir))
    return profile.select("n", F.round("xmin", 6).alias("xmin"), F.round("xmax", 6).alias("xmax"))


def hilbert_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = G.box_literal(lookups.WORLD)
    return S.parcel_raw(spark, sf_dir).select("lrid", hilbert_of_box(F.col("bbox"), b).alias("hilbert"))


def union_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = S.parcel_raw(spark, sf_dir)
    parts = [
        *[filters.of_state(raw, s).select("lrid", "statefp", "totalvalue") for s in ("12", "13", "48")],
        filters.of_state(raw, "37").select("statefp", "lrid", "yearbuilt"),
        filters.of_state(raw, "06").select("lrid", "statefp", "yearbuilt", "totalvalue"),
    ]
    return tables.union_by_name(*parts)


def pip_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = S.parcel_raw(spark, sf_dir).select("lrid", "centroidx", "centroidy")
    pairs = J.points_in_polygons(
        points, S.zones(spark, sf_dir), "centroidx", "centroidy", ["lrid"], "zone_geom", "zone_box"
    )
    return pairs.select("lrid", "zone_id")


def overlap_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = S.raw_multi(spark, sf_dir).select("lrid", "geom", "bbox")
    pairs = J.overlap_shares(raw, S.zones(spark, sf_dir), "geom", "zone_geom", "bbox", "zone_box", ["lrid"])
    return pairs.select("lrid", "zone_id", F.round("overlap_share", 5).alias("share"))


def sheared_pip(spark: SparkSession, sf_dir: str) -> DataFrame:
    x, y = S.sheared(F.col("centroidx") + 0.0000137, F.col("centroidy") + 0.0000191)  # no point on a side
    points = S.parcel_raw(spark, sf_dir).select("lrid", x.alias("px"), y.alias("py"))
    zones = S.sheared_shapes(S.zones(spark, sf_dir), "zone_geom", "zone_box")
    return J.points_in_polygons(points, zones, "px", "py", ["lrid"], "zone_geom", "zone_box").select("lrid", "zone_id")


def sheared_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = S.sheared_shapes(S.raw_multi(spark, sf_dir).select("lrid", "geom", "bbox"))
    zones = S.sheared_shapes(S.zones(spark, sf_dir), "zone_geom", "zone_box")
    pairs = J.overlap_shares(raw, zones, "geom", "zone_geom", "bbox", "zone_box", ["lrid"])
    return pairs.select("lrid", "zone_id", F.round("overlap_share", 5).alias("share"))


def sheared_adjacency(spark: SparkSession, sf_dir: str) -> DataFrame:
    lots = S.sheared_shapes(S.lots(spark, sf_dir))
    return J.touching(lots, lots.where(F.col("p_brand") == TARGET_BRAND)).select("lot_id", "p_brand")


def zone_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = S.raw_multi(spark, sf_dir).select("lrid", "statefp", "geom", "bbox")
    zones = S.zones(spark, sf_dir)
    return J.inside_any(raw, zones, ["lrid"], "geom", "bbox", "zone_geom", "zone_box").select("lrid", "statefp")


def adjacent_parcels(spark: SparkSession, sf_dir: str) -> DataFrame:
    lots = S.lots(spark, sf_dir)
    targets = lots.where(F.col("p_brand") == TARGET_BRAND)
    return J.touching(lots, targets).select("lot_id", "p_brand")


def footprint_containment(spark: SparkSession, sf_dir: str) -> DataFrame:
    lots = S.lots(spark, sf_dir).select("lot_id", "geom", "bbox")
    pairs = J.contained_in(
        S.footprints(spark, sf_dir), lots, "building_geom", "geom", "building_box", "bbox", ["building_id"]
    )
    return pairs.select("building_id", "lot_id")


def dissolved_boundary(spark: SparkSession, sf_dir: str) -> DataFrame:
    segments = J.dissolved_boundary(S.lots(spark, sf_dir), "p_brand")
    return segments.select("p_brand", *[F.round(c, 5).alias(c) for c in ("x1", "y1", "x2", "y2")])


def dissolved_polygons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lots of odd and of even size as polygons with holes. Every third lot comes in two halves, so corners lie on sides."""
    lots = S.lots(spark, sf_dir).select("lot_id", (F.col("p_size") % 2).alias("odd"), "bbox")
    b = F.col("bbox")
    middle = (b["xmin"] + b["xmax"]) / 2
    halves = F.array(G.box(b["xmin"], b["ymin"], middle, b["ymax"]), G.box(middle, b["ymin"], b["xmax"], b["ymax"]))
    parts = lots.select("odd", F.explode(F.when(F.col("lot_id") % 3 == 0, halves).otherwise(F.array(b))).alias("part"))
    shapes = parts.select("odd", F.array(G.box_polygon(F.col("part"))).alias("geom"))
    g = F.col("geom")
    found = dissolve.dissolved_polygons(shapes, "odd")
    return found.select(
        "odd", F.round(G.bbox_of(g)["xmin"], 5).alias("xmin"), F.round(G.bbox_of(g)["ymin"], 5).alias("ymin"),
        F.round(G.area(g) / (S.LOT * S.LOT), 2).alias("lots"), F.size(g[0]).alias("rings"), (G.vertex_count(g) - F.size(g[0])).alias("corners"),
    )


def raster_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = S.parcel_raw(spark, sf_dir).select("lrid", "centroidx", "centroidy")
    sampled = enrich.sample_raster(
        points, S.pixels(spark, sf_dir), "centroidx", "centroidy", ["lrid"], S.RASTER_ORIGIN, S.RASTER_PIXEL
    )
    return sampled.select("lrid", "row", "col", F.round("value", 3).alias("value"))


def property_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = S.parcel_raw(spark, sf_dir).select("lrid", "parcelid", "parceladdr")
    return enrich.match_properties(raw, S.properties(spark, sf_dir), ["lrid"], "parcelid", "parceladdr")


def property_match_fuzzy(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = S.parcel_raw(spark, sf_dir).select("lrid", "countyfp", "parcelid", "parceladdr")
    found = enrich.match_properties_fuzzy(raw, S.misspelt_properties(spark, sf_dir), ["lrid"], "parcelid", "parceladdr", 55, ("countyfp",))
    return found.withColumn("similarity", F.round("similarity", 6))


def use_code_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize.land_use_codes(_parcels(spark, sf_dir))


def land_use_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _parcels(spark, sf_dir).select("use_code", "use_description", "total_value")
    known = normalize.with_land_use(p, normalize.land_use_codes(p))
    per_category = known.groupBy(F.col("use_category").alias("category_name")).agg(
        F.count("*").alias("n"), F.sum("total_value").alias("total_value")
    )
    return per_category.join(F.broadcast(lookups.land_use_categories(spark)), "category_name")


def _tiles(spark: SparkSession, sf_dir: str, preset: str, thinned: bool = False) -> DataFrame:
    raw = S.raw_multi(spark, sf_dir).select("lrid", "bbox", "geom")
    return tiling.pyramid(raw, preset, draw=_draw("lrid") if thinned else None)


def tile_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = S.parcel_raw(spark, sf_dir)
    tiles = tiling.point_tiles(raw.select("lrid", "centroidx", "centroidy"), "centroidx", "centroidy", 16, 16)
    return tiles.select("lrid", "z", "x", "y")


def tile_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tiling.tile_counts(_tiles(spark, sf_dir, "county"))


def tile_thinned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tiles(spark, sf_dir, "state", thinned=True).select("lrid", "z", "x", "y")


def tile_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = tiling.tile_stats(_tiles(spark, sf_dir, "state", thinned=True))
    return stats.withColumns({c: F.round(c, 6) for c in ("avg_features", "median_features", "p95_features")})


def tile_clipped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The parts of a feature in all its tiles of a zoom make up its area."""
    parts = tiling.clipped(_tiles(spark, sf_dir, "county"), 0.0).withColumn("part", C.area_of(F.col("geom")) * 1e6)
    return parts.groupBy("lrid", "z").agg(F.round(F.sum("part"), 4).alias("area_e6"))


def national_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pyramids of all states, merged: features and their area in each tile of all zooms."""
    raw = S.raw_multi(spark, sf_dir).select("lrid", "statefp", "bbox", "geom")
    tiles = descent.read_tiles(spark, jobs.national_tiles(raw, shared_folder(spark), ("lrid",), draw=_draw("lrid"), buffer=0.0))
    return tiles.groupBy("z", "x", "y").agg(
        F.count("*").alias("features"), F.countDistinct("state").alias("states"), F.round(F.sum(C.area_of(F.col("geom")) * 1e6), 3).alias("area_e6")
    )


def tile_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A written pyramid of zones at all zooms of boundaries, read back: the area of each zone in each tile."""
    path = f"{shared_folder(spark)}/boundaries"
    zones = S.zones(spark, sf_dir).select("zone_id", F.col("zone_geom").alias("geom"), F.col("zone_box").alias("bbox"))
    descent.write_pyramid(zones, path, ("zone_id",), **tiling.PRESETS["boundary"], buffer=0.0)
    tiles = descent.read_tiles(spark, path)
    return tiles.select("z", "x", "y", "zone_id", F.round(G.area(F.col("geom")), 7).alias("area"))


def tile_generalized(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lots with a bend in the middle of each side, by zoom: vertices, and sides that no second lot shares.

    A bend stays where its triangle can be seen; both lots beside a side decide alike, so no inner side is left open.
    """
    weighted = stored(generalize.with_weights(S.bent_lots(spark, sf_dir), ["lot_id"]))
    zooms = weighted.select("lot_id", F.explode(F.sequence(F.lit(9), F.lit(16))).alias("z"), "geom")
    shown = zooms.select("lot_id", "z", generalize.at_zoom(F.col("geom"), F.col("z")).alias("geom"))
    vertices = shown.groupBy("z").agg(F.count("*").alias("lots"), F.sum(G.vertex_count(F.col("geom")) - 1).alias("vertices"))
    rim = J.dissolved_boundary(shown, "z").groupBy("z").agg(F.count("*").alias("rim_sides"))
    return vertices.join(rim, "z")


def tile_largest(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = S.raw_multi(spark, sf_dir).select("lrid", "bbox", "geom", "assdacres")
    tiles = tiling.tile_features(raw, 7, 9)
    kept = tiling.keep_largest(tiles, F.col("assdacres"), ["lrid"], 3)
    return kept.select("z", "x", "y", "lrid", "assdacres")


def large_parcel_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tiling.tile_counts(tiling.pyramid(_large(spark, sf_dir), "large"))


def boundary_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    zones = S.zones(spark, sf_dir)
    tiles = tiling.pyramid(zones, "boundary", bbox="zone_box", geom="zone_geom")
    return tiling.tile_counts(tiles)


def tile_layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = S.raw_multi(spark, sf_dir)
    key = F.col("lrid").cast("string").alias("key")
    x, y = F.col("centroidx"), F.col("centroidy")
    centroid = p.select(key, G.box(x, y, x, y).alias("bbox"))
    zones = S.zones(spark, sf_dir).select(
        F.col("zone_id").cast("string").alias("key"), F.col("zone_box").alias("bbox"), F.col("zone_geom").alias("geom")
    )
    layers = {"county-boundaries": zones, "centroids": centroid, "polygons": p.select(key, "bbox", "geom")}
    shown = tiling.level_of_detail(layers, 10, 13)
    return shown.groupBy("layer", "z").agg(F.count("*").alias("n"), F.countDistinct("x", "y").alias("tiles"))


def tile_request(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = tiling.tile_request(_parcels(spark, sf_dir, geometry=True), 8, 68, 103)
    return found.select("parcel_id", "geoid", "total_value", "year_built")


def centroid_request(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = tiling.tile_request(_parcels(spark, sf_dir), 8, 68, 103, "parcel-centroids")
    return found.select("parcel_id", "geoid", "total_value", F.round("centroid.x", 6).alias("lon"),
                        F.round("centroid.y", 6).alias("lat"))


def packed_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = S.raw_multi(spark, sf_dir).select("lrid", "bbox", "geom", "totalvalue")
    packed = tiling.pack_tiles(tiling.tile_features(raw, 8, 10).select("z", "x", "y", "lrid", "totalvalue"), ["lrid"], 20)
    return packed.select("z", "x", "y", F.explode("features").alias("f")).select("z", "x", "y", "f.lrid", "f.totalvalue")


def cell_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = reports.cell_summary(
        S.parcel_raw(spark, sf_dir), F.col("centroidx"), F.col("centroidy"), 0.5, "totalvalue"
    )
    return found.select("cell_x", "cell_y", "n", "sum_totalvalue", F.round("median_totalvalue", 4).alias("median"))


def cell_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.counts_by(layout.with_cell(S.parcel_raw(spark, sf_dir)), "cell", name="n")


def value_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.value_histogram(S.parcel_raw(spark, sf_dir), "totalvalue")


def value_colors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.parcel_raw(spark, sf_dir).select("lrid", D.value_color(F.col("totalvalue")).alias("color"))


def popup_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    none = F.lit(None).cast("string")
    return S.parcel_raw(spark, sf_dir).select(
        "lrid", D.text_or("No address", F.col("parceladdr"), none).alias("address"),
        D.text_or("Unknown", F.col("ownername")).alias("owner"), D.money_or_na(F.col("totalvalue")).alias("value"),
        D.text_or("N/A", F.col("usedesc")).alias("use"), D.label(F.col("parceladdr")).alias("label"),
    )


def geometry_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = F.col("geom")
    rows = S.raw_multi(spark, sf_dir).select("lrid", g).withColumn("c", G.centroid(g))
    return rows.select(
        "lrid", F.round(G.area(g) * 1e6, 4).alias("area_e6"), F.round("c.x", 6).alias("lon"),
        F.round("c.y", 6).alias("lat"), G.vertex_count(g).alias("vertices"), G.to_wkt(g).alias("wkt"),
    )


def vertex_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.vertex_profile(S.raw_multi(spark, sf_dir), "statefp")


def reprojected(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = M.reproject(F.col("geom"), "EPSG:4326", "EPSG:3857")
    rows = S.raw_multi(spark, sf_dir).select("lrid", moved.alias("geom"))
    back = M.reproject(F.col("geom"), "EPSG:3857")
    points = rows.select("lrid", F.posexplode(F.arrays_zip(G.vertices(F.col("geom")).alias("m"), G.vertices(back).alias("g"))).alias("vertex", "p"))
    return points.select(
        "lrid", "vertex", F.round("p.m.x", 2).alias("mx"), F.round("p.m.y", 2).alias("my"), F.round("p.g.x", 6).alias("lon"),
        F.round("p.g.y", 6).alias("lat"),
    )


def simplified(spark: SparkSession, sf_dir: str) -> DataFrame:
    b, half = F.col("bbox"), F.col("bbox")["xmax"] - F.col("bbox")["xmin"]
    mid_x, mid_y = (b["xmin"] + b["xmax"]) / 2, (b["ymin"] + b["ymax"]) / 2
    bump = F.when(F.col("lrid") % 2 == 0, half * 0.1).otherwise(0.0)
    points = [
        (b["xmin"], b["ymin"]), (mid_x, b["ymin"] - bump), (b["xmax"], b["ymin"]), (b["xmax"], mid_y),
        (b["xmax"], b["ymax"]), (mid_x, b["ymax"]), (b["xmin"], b["ymax"]), (b["xmin"], mid_y), (b["xmin"], b["ymin"]),
    ]
    ring = F.array(*[F.struct(x.alias("x"), y.alias("y")) for x, y in points])
    rows = S.parcel_raw(spark, sf_dir).select("lrid", F.array(F.array(ring)).alias("geom"))
    done = simplify.simplify(rows, SIMPLIFY_TOLERANCE)
    g = F.col("geom")
    return done.select("lrid", G.vertex_count(g).alias("vertices"), F.round(G.area(g) * 1e6, 4).alias("area_e6"))


def wkb_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = S.raw_multi(spark, sf_dir).select("lrid", "geom")
    g = F.col("geom")
    back = wkb.from_wkb(wkb.to_wkb(rows)).withColumn("bbox", G.bbox_of(g))
    return back.select("lrid", G.vertex_count(g).alias("vertices"), *_box_columns())


def geojson_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_folder(spark)}/features"
    geojson.write_lines(S.raw_multi(spark, sf_dir), path, ["lrid", "parceladdr", "totalvalue"])
    back = geojson.read_lines(spark, path, "lrid long, parceladdr string, totalvalue long")
    return back.select("lrid", "parceladdr", "totalvalue", *_box_columns())


def layout_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_folder(spark)}/by_county"
    publish.publish_counties(S.raw_multi(spark, sf_dir), path, ("lrid",), overwrite=True)
    return publish.read_published(spark, path).select("state", "county", "lrid", "totalvalue", *_box_columns())


def _dead_run(rows: DataFrame, path: str) -> None:
    """What a run leaves that died before its commit."""
    keyed = layout.with_partition_keys(filters.with_box(rows))
    publish.write_run(keyed, path, ("lrid",), publish.new_run(), publish.contents(keyed))


def incremental_counties(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_folder(spark)}/by_county"
    raw = S.raw_multi(spark, sf_dir).select("lrid", "statefp", "countyfp", "bbox")
    publish.publish_counties(filters.of_state(raw, "13"), path, ("lrid",))
    _dead_run(filters.of_state(raw, "37").where(F.col("lrid") % 3 == 0), path)
    publish.publish_counties(raw, path, ("lrid",))
    return reports.counts_by(publish.read_published(spark, path), "state", "county", name="n")


def recovered_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run dies over state 37; state 13 is published alone, then everything, then county 011 of 37 once more."""
    path = f"{shared_folder(spark)}/by_county"
    raw = S.raw_multi(spark, sf_dir).select("lrid", "statefp", "countyfp", "totalvalue", "bbox")
    _dead_run(filters.of_state(raw, "37").where(F.col("lrid") % 2 == 0), path)
    publish.publish_counties(filters.of_state(raw, "13"), path, ("lrid",))
    publish.publish_counties(raw, path, ("lrid",))
    _dead_run(raw.where(F.col("lrid") % 5 == 0), path)
    publish.publish_counties(filters.of_county(raw, "37", "013"), path, ("lrid",), overwrite=True)
    publish.vacuum(spark, path)
    found = publish.read_published(spark, path)
    return found.groupBy("state", "county").agg(F.count("*").alias("n"), F.sum("totalvalue").alias("total"), F.sum("lrid").alias("keys"))


def county_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of each published county, and how many lie in the Hilbert order of the county's own extent."""
    path = f"{shared_folder(spark)}/by_county"
    publish.publish_counties(S.raw_multi(spark, sf_dir).select("lrid", "statefp", "countyfp", "bbox"), path, ("lrid",))
    rows = publish.read_published(spark, path)
    box = F.struct(*[F.col(c) for c in ("xmin", "ymin", "xmax", "ymax")]).alias("e")
    place = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at")]
    placed = rows.select("state", "county", "bbox", *place).join(publish.committed(spark, path).select("state", "county", box), ["state", "county"])
    placed = placed.withColumn("h", hilbert_of_box(F.col("bbox"), F.col("e")))
    before = F.lag("h").over(Window.partitionBy("file").orderBy("at"))
    ordered = placed.withColumn("ok", F.coalesce(before <= F.col("h"), F.lit(True)))
    return ordered.groupBy("state", "county").agg(F.count("*").alias("n"), F.count_if("ok").alias("in_order"))


def incremental_rebuild(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A state is built, one of its counties changes and one goes; what was built at the second run, and what is there."""
    root = shared_folder(spark)
    raw = S.raw_multi(spark, sf_dir)
    rebuild.rebuild_state(raw, "37", root, ("lrid",))
    changed = raw.where(F.col("countyfp") != "023").withColumn("totalvalue", F.when(F.col("countyfp") == "013", 1).otherwise(F.col("totalvalue")).cast("long"))
    done = rebuild.rebuild_state(changed, "37", root, ("lrid",))
    again = rebuild.rebuild_state(changed, "37", root, ("lrid",))
    marks = [(c, name) for name, keys in done.items() for _, c in keys if c] + [("", name) for name, keys in again.items() if keys]
    built = spark.createDataFrame(marks, "county string, name string").groupBy("county").agg(F.array_join(F.sort_array(F.collect_list("name")), ",").alias("rebuilt"))
    stored = publish.read_published(spark, f"{root}/by_county").groupBy("county").agg(F.count("*").alias("n"), F.sum("totalvalue").alias("total"))
    tiles = publish.read_published(spark, f"{root}/tiles").groupBy("county").agg(F.count("*").alias("tile_rows"))
    return stored.join(tiles, "county", "full").join(built, "county", "full")


def partition_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_folder(spark)}/by_state"
    layout.write_by_state(S.raw_multi(spark, sf_dir).select("lrid", "statefp", "countyfp", "bbox"), path, ("lrid",))
    entries = layout.manifest(tables.read_hive(spark, path), ["state"])
    return entries.select("state", "n", *[F.round(c, 6).alias(c) for c in ("xmin", "ymin", "xmax", "ymax")])


def layout_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = S.raw_multi(spark, sf_dir).select("lrid", "bbox")
    found = []
    for name, df in (("sorted", layout.hilbert_sorted(raw, tie=("lrid",))), ("plain", raw)):
        path = f"{shared_folder(spark)}/{name}"
        layout.write_parquet(df, path)
        found.append(layout.layout_quality(spark.read.parquet(path), 100).select("n", F.col("mean_share").alias(name)))
    return found[0].join(found[1], "n").select(
        "n", (F.col("sorted") < 0.15).alias("sorted_is_tight"), (F.col("plain") > 0.3).alias("unsorted_is_wide")
    )


def raw_key_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_folder(spark)}/by_raw_keys"
    layout.write_by_raw_keys(S.raw_multi(spark, sf_dir), path, ("lrid",))
    return tables.read_hive(spark, path).select("statefp", "countyfp", "lrid", "totalvalue")


def cell_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_folder(spark)}/by_cell"
    layout.write_by_cell(S.raw_multi(spark, sf_dir), path, tie=("lrid",))
    return tables.read_hive(spark, path).select("lrid", *_box_columns())


def box_extract_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_folder(spark)}/box"
    jobs.extract_box(S.raw_multi(spark, sf_dir), SEARCH_BOX, path)
    return spark.read.parquet(path).select("lrid", "statefp")


def county_parallel_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_folder(spark)}/counties"
    jobs.county_parallel_extract(S.raw_multi(spark, sf_dir), "48", path)
    return spark.read.parquet(path).select("lrid", "countyfp")


def published_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_folder(spark)}/states"
    jobs.publish_all_states(S.raw_multi(spark, sf_dir), path)
    return tables.read_hive(spark, path).select("state", "lrid")


def incremental_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = shared_folder(spark)
    for _ in range(2):  # the second run finds everything published
        paths = jobs.incremental_state(S.raw_multi(spark, sf_dir), "37", root)
    found = publish.read_published(spark, paths["counties"], F.col("state") == "37")
    return reports.counts_by(found, "county", name="n")


def owners_cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    parcels = normalize.normalize(S.parcel_raw(spark, sf_dir), clean_owner=True, unique_lrid=True)
    return parcels.select("parcel_id", "geoid", "owner_name")


def created_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _parcels(spark, sf_dir).groupBy("geoid").agg(F.count("*").alias("n"), F.count("created_at").alias("with_time"))


def attribute_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.attributes_only(S.raw_multi(spark, sf_dir)).select("lrid", "statefp", "usedesc", "assdacres")


def manifest_extent(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = shared_folder(spark)
    layout.write_by_state(S.raw_multi(spark, sf_dir).select("lrid", "statefp", "countyfp", "bbox"), f"{root}/data", ("lrid",))
    layout.write_manifest(tables.read_hive(spark, f"{root}/data"), ["state"], f"{root}/catalogue")
    found = tables.extent_from_manifest(spark, f"{root}/catalogue")
    return found.select(*[F.round(c, 6).alias(c) for c in ("xmin", "ymin", "xmax", "ymax")], "n")


def refreshed_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    jobs.refresh_parcels(S.parcel_raw(spark, sf_dir), shared_folder(spark), "1", "parcel")
    return spark.sql("SELECT geoid, COUNT(*) AS n, SUM(total_value) AS total_value FROM parcel GROUP BY geoid")


def dataset_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = (
        "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
    ).split()
    found = tables.union_by_name(*[tables.inventory(S.table(spark, sf_dir, n)) for n in names])
    return found.select("name", "format", "n")


def column_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the text form of a double differs between engines, so its smallest and largest value are left out of the comparison
    fractional = F.col("column_type") == "double"
    found = reports.column_profile(S.parcel_raw(spark, sf_dir))
    return found.withColumns({c: F.when(~fractional, F.col(c)) for c in ("min_value", "max_value")}).withColumn(
        "column_type", F.element_at(F.split("column_type", "<"), 1)
    )


def status_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = jobs.status({
        "parcel_raw": S.parcel_raw(spark, sf_dir), "parcel": _parcels(spark, sf_dir),
        "counties": S.counties(spark, sf_dir), "lots": S.lots(spark, sf_dir),
    })
    return report.select("table_name", "n", *[F.round(c, 6).alias(c) for c in ("xmin", "ymin", "xmax", "ymax")])


def quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(_parcels(spark, sf_dir), S.counties(spark, sf_dir))


def duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.duplicate_keys(S.parcel_raw(spark, sf_dir), "geoid", "parcelid")


def unknown_counties(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.unknown_counties(_parcels(spark, sf_dir), S.counties(spark, sf_dir))


def random_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.sample_rows(S.parcel_raw(spark, sf_dir), 500, "lrid", draw=_draw("lrid")).select("lrid", "statefp")


def page_of_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.page(S.parcel_raw(spark, sf_dir).select("lrid", "geoid"), "lrid", 200, offset=400)


def page_after_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.page(S.parcel_raw(spark, sf_dir).select("lrid", "geoid"), "lrid", 200, after=1000)


def number_matched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.number_matched(_parcels(spark, sf_dir))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        normalize_dedup, parcel_full, parcel_coverage, cast_failures, fips_summary, ad_hoc_sql, state_counts,
        county_counts, county_value_top10, state_value_totals, county_medians, county_extents, table_extent, bbox_count,
        bbox_search, bbox_filter_query, polygon_filter, parcel_detail, search_address, search_owner,
        cross_border_filter, all_states_extract, box_extract, county_selection, high_value_metro, large_parcels,
        sale_range, edge_profile, encoding_profile, hilbert_order, union_by_name, pip_enrich, sheared_pip, sheared_overlap, sheared_adjacency, overlap_share,
        zone_members, adjacent_parcels, footprint_containment, dissolved_boundary, dissolved_polygons, raster_sample, property_match, property_match_fuzzy,
        use_code_lookup, land_use_summary, tile_assign, tile_counts, tile_thinned, tile_stats, tile_clipped, national_tiles, tile_files, tile_generalized, tile_largest,
        large_parcel_tiles, boundary_tiles, tile_layers, tile_request, centroid_request, packed_tiles, cell_summary,
        cell_partitions, value_classes, value_colors, popup_fields, geometry_measures, vertex_profile, reprojected,
        simplified, wkb_roundtrip, geojson_features, layout_roundtrip, incremental_counties, recovered_states, county_order, incremental_rebuild, partition_manifest,
        layout_overlap, raw_key_layout, cell_layout, box_extract_files, county_parallel_state, published_states,
        incremental_state, owners_cleaned, created_rows, attribute_rows, manifest_extent, refreshed_version, dataset_inventory, column_profile, status_report, quality_report,
        duplicate_keys, unknown_counties, random_sample, page_of_rows, page_after_key, number_matched,
    )
}
