import glob
import json
import struct

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from cadastra.functions import geometry as G
from cadastra.functions.hilbert import hilbert_of_box
from cadastra.operators import filters, layout, publish, quality, reports
from cadastra.plans import jobs
from cadastra.plans import standins as S
from cadastra.schemas import PARCEL_RAW
from cadastra.sources import geojson, tables, wkb
from cadastra.streaming.landing import append_arrivals
from tests.helpers import frame, plan, square


def raw(spark, sf_dir):
    return S.raw_multi(spark, sf_dir)


def test_sorted_files_have_bounded_row_groups_in_order(spark, sf_dir, tmp_path):
    path = str(tmp_path / "t")
    layout.write_parquet(layout.hilbert_sorted(raw(spark, sf_dir), tie=("lrid",), partitions=2), path, rows=200)
    files = sorted(glob.glob(f"{path}/*.parquet"))
    for file in files:
        meta = pq.ParquetFile(file).metadata
        assert meta.row_group(0).column(0).compression == "ZSTD"
        assert all(meta.row_group(g).num_rows <= 200 for g in range(meta.num_row_groups))
    world = G.box_literal((-180.0, -90.0, 180.0, 90.0))
    rows = spark.read.parquet(path).select(
        "_metadata.file_path", "_metadata.row_index", hilbert_of_box(F.col("bbox"), world).alias("h")
    ).collect()
    assert len(rows) == 1500
    for file in {r.file_path for r in rows}:
        h = [r.h for r in sorted((r for r in rows if r.file_path == file), key=lambda r: r.row_index)]
        assert h == sorted(h)


def test_county_layout(spark, sf_dir, tmp_path):
    path = str(tmp_path / "c")
    source = raw(spark, sf_dir).withColumn("countyfp", F.when(F.col("lrid") != 5, F.col("countyfp")))
    publish.publish_counties(source, path, ("lrid",), overwrite=True)
    back = publish.read_published(spark, path)
    assert dict(back.dtypes)["state"] == dict(back.dtypes)["county"] == "string"
    assert back.count() == 1500
    assert [r.lrid for r in back.where("county = 'unassigned'").collect()] == [5]
    assert back.where("state = '06'").count() == source.where("statefp = '06'").count()
    text = plan(back.where("state = '06' AND county = '005'").select("lrid"))
    assert "PartitionFilters: [isnotnull(state" in text
    # Rows of a county lie in the Hilbert order of the county's own extent.
    extent = back.groupBy("state", "county").agg(
        F.struct(F.min("bbox.xmin").alias("xmin"), F.min("bbox.ymin").alias("ymin"),
                 F.max("bbox.xmax").alias("xmax"), F.max("bbox.ymax").alias("ymax")).alias("e"))
    rows = (
        back.select("state", "county", "bbox", F.col("_metadata.file_path").alias("f"), F.col("_metadata.row_index").alias("i"))
        .join(extent, ["state", "county"])
        .select("f", "i", hilbert_of_box(F.col("bbox"), F.col("e")).alias("h")).collect()
    )
    for file in {r.f for r in rows}:
        h = [r.h for r in sorted((r for r in rows if r.f == file), key=lambda r: r.i)]
        assert h == sorted(h)


def test_other_layouts_and_catalogue(spark, sf_dir, tmp_path):
    source = raw(spark, sf_dir).select("lrid", "statefp", "countyfp", "totalvalue", "bbox")
    layout.write_by_cell(source, str(tmp_path / "cell"), tie=("lrid",))
    layout.write_by_raw_keys(source, str(tmp_path / "rawkeys"), tie=("lrid",))
    assert tables.read_hive(spark, str(tmp_path / "cell")).count() == 1500
    assert tables.read_hive(spark, str(tmp_path / "rawkeys")).where("statefp = '06'").count() > 0
    dataset = tables.read_hive(spark, str(tmp_path / "cell"))
    layout.write_manifest(dataset, ["cell"], str(tmp_path / "m"))
    quick = tables.extent_from_manifest(spark, str(tmp_path / "m")).first()
    full = dataset.agg(F.min("bbox.xmin"), F.max("bbox.ymax"), F.count("*")).first()
    assert (quick.xmin, quick.ymax, quick.n) == tuple(full)
    assert quality.small_artifacts(tables.inventory(dataset), 1e9).count() == tables.inventory(dataset).count()


def test_sorting_separates_row_groups(spark, sf_dir, tmp_path):
    source = raw(spark, sf_dir).select("lrid", "bbox")
    layout.write_parquet(source.coalesce(1), str(tmp_path / "a"))
    layout.write_parquet(layout.hilbert_sorted(source, tie=("lrid",), partitions=1), str(tmp_path / "b"))
    plain = layout.layout_quality(spark.read.parquet(str(tmp_path / "a")), 100).first()
    ordered = layout.layout_quality(spark.read.parquet(str(tmp_path / "b")), 100).first()
    assert plain.n == ordered.n == 1500
    assert ordered.mean_share < plain.mean_share / 5


def test_jobs(spark, sf_dir, tmp_path):
    source = raw(spark, sf_dir)
    root = str(tmp_path)
    done = jobs.incremental_state(source, "13", root)
    again = jobs.incremental_state(source, "13", root)
    assert done == again
    georgia = source.where("statefp = '13'").count()
    assert publish.read_published(spark, done["counties"]).count() == georgia
    jobs.publish_all_states(source, f"{root}/all")
    assert tables.read_hive(spark, f"{root}/all").count() == 1500
    jobs.county_parallel_extract(source, "37", f"{root}/nc")
    assert spark.read.parquet(f"{root}/nc").count() == source.where("statefp = '37'").count()
    request = jobs.ExtractRequest("box", (-85.0, 31.0, -82.0, 34.0), ["parquet", "geojson", "tiles"], simplify=1e-6)
    written = jobs.run_extract(source, request, root)
    expected = filters.intersecting_box(source, request.bounds).count()
    assert spark.read.parquet(written[0]).count() == expected == spark.read.text(written[1]).count()
    assert tables.read_hive(spark, written[2]).select("lrid").distinct().count() == expected
    jobs.tile_counties(source, f"{root}/ct")
    assert tables.read_hive(spark, f"{root}/ct").where("z = 16").select("lrid").distinct().count() == 1500
    path = jobs.publish(filters.of_state(source, "13"), root, "parcels", "13")
    assert path.endswith("parcels/state=13")
    with pytest.raises(ValueError):
        jobs.run_extract(source, jobs.ExtractRequest("x", (0, 0, 1, 1), ["shp"]), root)


def test_refresh_keeps_old_version_and_moves_the_view(spark, sf_dir, tmp_path):
    source = raw(spark, sf_dir)
    jobs.refresh_parcels(source.where("lrid < 700"), str(tmp_path), "1", "parcel_v")
    n1 = spark.table("parcel_v").count()
    jobs.refresh_parcels(source, str(tmp_path), "2", "parcel_v")
    assert spark.table("parcel_v").count() > n1
    assert spark.read.parquet(str(tmp_path / "version=1")).count() == n1


def _ewkb(order, rings, srid=None, z=False):
    e = "<" if order else ">"
    code = 3 | (0x20000000 if srid else 0) | (0x80000000 if z else 0)
    out = struct.pack(e + "BI", order, code) + (struct.pack(e + "I", srid) if srid else b"") + struct.pack(e + "I", len(rings))
    for ring in rings:
        out += struct.pack(e + "I", len(ring)) + b"".join(struct.pack(e + "dd" + "d" * z, *p, *([9.0] * z)) for p in ring)
    return out


def test_wkb_import_and_export(spark):
    ring = square(0, 0, 1)[0]
    rows = [(1, _ewkb(1, [ring])), (2, _ewkb(0, [ring, ring])), (3, _ewkb(1, [ring], 4326, True)), (4, None)]
    df = spark.createDataFrame(rows, "id long, the_geom binary")
    assert wkb.geometry_column(df) == "the_geom"
    got = {r.id: r.geom for r in wkb.from_wkb(df).collect()}
    assert [tuple(p) for p in got[1][0][0]] == ring
    assert len(got[2][0]) == 2 and [tuple(p) for p in got[3][0][0]] == ring and got[4] is None
    again = {r.id: r.geom for r in wkb.from_wkb(wkb.to_wkb(wkb.from_wkb(df))).collect()}
    assert again == got
    with pytest.raises(ValueError):
        wkb.geometry_column(spark.range(1))


def _showcase():
    places = [(-84.389, 33.751), (-84.388, 33.751), (-84.387, 33.751), (-84.389, 33.750), (-84.388, 33.750)]
    values = [450000, 320000, 180000, 890000, 210000]
    features = []
    for i, ((x, y), value) in enumerate(zip(places, values)):
        ring = [[round(a, 3), round(b, 3)] for a, b in square(x, y, 0.001)[0]]
        features.append({
            "type": "Feature", "properties": {"parcel_id": f"S-{i}", "geoid": "13121", "total_value": value},
            "geometry": {"type": "Polygon", "coordinates": [ring]},
        })
    return {"type": "FeatureCollection", "features": features}


def test_geojson_showcase(spark, tmp_path):
    source = tmp_path / "showcase.geojson"
    source.write_text(json.dumps(_showcase(), indent=1))
    properties = "parcel_id string, geoid string, total_value long"
    features = geojson.read_collection(spark, str(source), properties)
    assert features.agg(F.sum("total_value")).first()[0] == 2050000
    assert filters.intersecting_box(features, (-84.39, 33.75, -84.386, 33.753)).count() == 5
    geojson.write_lines(features, str(tmp_path / "lines"), ["parcel_id", "geoid", "total_value"])
    back = geojson.read_lines(spark, str(tmp_path / "lines"), properties)
    assert sorted(back.collect()) == sorted(features.collect())
    checked = jobs.showcase(spark, str(source), properties, str(tmp_path / "out"))
    assert checked["parcels"] == 5


def test_union_by_name_and_flat_scan(spark, tmp_path):
    spark.range(3).select(F.col("id").alias("a"), F.lit("x").alias("b")).write.parquet(str(tmp_path / "d"))
    spark.range(2).select(F.col("id").alias("a"), F.lit(1).alias("c")).write.mode("append").parquet(str(tmp_path / "d"))
    df = tables.read_by_name(spark, str(tmp_path / "d"))
    assert sorted(df.columns) == ["a", "b", "c"] and df.count() == 5
    assert tables.read_flat(spark, str(tmp_path / "d")).count() == 5


def test_stream_appends_each_file_once(spark, sf_dir, tmp_path):
    columns = [F.col(f.name).cast(f.dataType).alias(f.name) for f in PARCEL_RAW.fields]
    source = S.parcel_raw(spark, sf_dir)
    missing = {f.name: F.lit(None) for f in PARCEL_RAW.fields if f.name not in source.columns}
    rows = source.withColumns(missing).select(*columns)
    arrivals, landing, checkpoint = (str(tmp_path / n) for n in ("in", "landing", "checkpoint"))
    rows.where("lrid < 500").write.parquet(arrivals)
    append_arrivals(spark, arrivals, landing, checkpoint).awaitTermination()
    rows.where("lrid >= 500").write.mode("append").parquet(arrivals)
    append_arrivals(spark, arrivals, landing, checkpoint).awaitTermination()
    append_arrivals(spark, arrivals, landing, checkpoint).awaitTermination()
    assert spark.read.parquet(landing).count() == 1500


def test_column_pruning(spark, sf_dir, tmp_path):
    layout.write_parquet(raw(spark, sf_dir), str(tmp_path / "t"))
    text = plan(tables.attributes_only(spark.read.parquet(str(tmp_path / "t"))).select("countyfp", "totalvalue"))
    assert "ReadSchema: struct<countyfp:string,totalvalue:bigint>" in text


def test_geometry_frame_helper(spark):
    assert frame(spark, [(1, [square(0, 0, 1)])]).count() == 1


def test_boundary_sources(spark):
    counties = frame(spark, [("13", "121", [square(-84.5, 33.5, 0.5)]), ("37", "001", [square(0, 0, 1)])],
                     "STATEFP string, COUNTYFP string")
    box = reports.county_boxes(counties, "13").collect()
    assert [tuple(r) for r in box] == [("121", -84.5, 33.5, -84.0, 34.0)]
    edges = wkb.edges_source(counties.withColumnRenamed("COUNTYFP", "MTFCC"), ["STATEFP", "MTFCC"])
    assert edges.columns == ["STATEFP", "MTFCC", "geom"]


def test_query_and_settings(spark, sf_dir):
    assert tables.query(raw(spark, sf_dir), "SELECT COUNT(*) AS n FROM parcels").first()[0] == 1500
    settings = tables.object_store_settings("localhost:9000", "key", "secret", secure=False)
    assert settings["spark.hadoop.fs.s3a.path.style.access"] == "true"
    assert tables.blob_path("acct", "parcels", "/x") == "abfss://parcels@acct.dfs.core.windows.net/x"


def test_landed_extract_and_append(spark, sf_dir, tmp_path):
    path = str(tmp_path / "landed")
    source = raw(spark, sf_dir)
    tables.append_rows(filters.of_state(source, "13"), path)
    tables.append_rows(filters.of_state(source, "37"), path)
    box = (-90.0, 30.0, -70.0, 40.0)
    found = tables.extract_raw(spark, path, box, "37")
    assert found.count() == source.where("statefp = '37'").count()
    assert "EqualTo(statefp,37)" in plan(found)


def test_width_of_a_sorted_write_follows_the_bytes(spark, sf_dir):
    source = spark.read.parquet(f"{sf_dir}/orders.parquet")
    size = layout.input_bytes(source)
    assert size > 0 and layout.width_of(source) is None
    assert layout.width_of(source, size // 10) in (10, 11) and layout.width_of(source, size // 20) in (20, 21)


def test_thinning_draws_by_the_given_key(spark, sf_dir, tmp_path):
    jobs.tile_state(raw(spark, sf_dir), "13", str(tmp_path / "tiles"))
    tiles = spark.read.parquet(str(tmp_path / "tiles"))
    per_zoom = {int(r["z"]): r["n"] for r in tiles.groupBy("z").agg(F.countDistinct("lrid").alias("n")).collect()}
    assert max(per_zoom) == 16 and all(per_zoom[z] <= per_zoom[z + 1] for z in per_zoom if z + 1 in per_zoom)


def test_shared_folder_needs_a_named_place_on_a_cluster(spark, monkeypatch):
    from types import SimpleNamespace

    from cadastra.session import shared_folder

    away = SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default="": ""),
        sparkContext=SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None),
    )
    with pytest.raises(ValueError):
        shared_folder(away)


def test_deep_offsets_are_refused(spark, sf_dir):
    from cadastra.operators import sampling

    with pytest.raises(ValueError):
        sampling.page(raw(spark, sf_dir), "lrid", 10, offset=10_000_000)


def test_extract_raw_is_exact(spark, tmp_path):
    corner = [[[{"x": 0.0, "y": 0.0}, {"x": 1.0, "y": 0.0}, {"x": 0.0, "y": 1.0}, {"x": 0.0, "y": 0.0}]]]
    rows = [("13", corner, (0.0, 0.0, 1.0, 1.0))]
    schema = f"statefp string, geom {PARCEL_GEOM}, bbox struct<xmin: double, ymin: double, xmax: double, ymax: double>"
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "raw"))
    assert tables.extract_raw(spark, str(tmp_path / "raw"), (0.8, 0.8, 2.0, 2.0), "13").count() == 0
    assert tables.extract_raw(spark, str(tmp_path / "raw"), (0.4, 0.4, 2.0, 2.0), None).count() == 1


PARCEL_GEOM = "array<array<array<struct<x: double, y: double>>>>"
