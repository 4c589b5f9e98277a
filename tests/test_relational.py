import random
import statistics

import pytest
from pyspark.sql import functions as F

from cadastra import lookups
from cadastra.functions import display as D
from cadastra.functions.text import trigram_similarity
from cadastra.operators import enrich, normalize, quality, reports, sampling, search
from cadastra.operators.skew import salted
from cadastra.plans import standins as S
from tests.helpers import plan


def test_lookups(spark):
    assert lookups.states(spark).count() == 56
    assert lookups.state_bounds(spark).count() == 31
    assert lookups.land_use_categories(spark).count() == 8
    with pytest.raises(ValueError):
        lookups.bounds_of("99")


RAW = "lrid long, parcelid string, parcelid2 string, geoid string, totalvalue long, yearbuilt int, parceladdr string, ownername string"


def test_dedup_keeps_the_best_covered_row(spark):
    rows = [
        (1, "A", None, "13121", 5, None, None, None), (2, "A", None, "13121", 5, 1990, None, None),
        (3, "A", None, "13121", 5, 1990, None, None), (4, None, "B", "13121", None, None, None, None),
        (5, None, None, "13121", None, None, None, None), (6, "A", None, None, 1, 1, "x", "y"),
        (None, "C", None, "13121", 1, None, None, None), (9, "C", None, "13121", 1, None, None, None),
    ]
    kept = normalize.deduplicate(spark.createDataFrame(rows, RAW)).collect()
    assert {(r.resolved_id, r.lrid) for r in kept} == {("A", 3), ("B", 4), ("5", 5), ("C", None)}


def test_dedup_is_idempotent_and_limits_groups_before_the_shuffle(spark, sf_dir):
    raw = S.parcel_raw(spark, sf_dir).drop("geom")
    once = normalize.deduplicate(raw)
    twice = normalize.deduplicate(once.drop("resolved_id"))
    assert once.count() == twice.count() == once.select("geoid", "resolved_id").distinct().count()
    text = plan(once)
    assert text.count("WindowGroupLimit") >= 2 and "Partial" in text


def test_normalize_casts(spark):
    raw = spark.createDataFrame([(1, "A", "13121", 99999)], "lrid long, parcelid string, geoid string, numunits int")
    raw = raw.withColumns({c: F.lit(None).cast("string") for c in ("parcelid2", "totalvalue", "yearbuilt", "parceladdr")})
    raw = raw.withColumn("ownername", F.lit("  ann lee "))
    with pytest.raises(Exception, match="CAST_OVERFLOW"):
        normalize.normalize(raw).select("num_units").collect()
    row = normalize.normalize(raw, strict=False, clean_owner=True).select("num_units", "owner_name").first()
    assert row.num_units is None and row.owner_name == "ANN LEE"
    bad = normalize.cast_failures(raw).collect()
    assert [(r.lrid, r.column, r.value) for r in bad] == [(1, "numunits", "99999")]


def test_medians_equal_sorting(spark):
    rng = random.Random(3)
    rows = [(k, rng.choice([None, rng.randrange(50), rng.random() * 1e6])) for k in ("a", "b", None) for _ in range(501)]
    rows += [("hot", float(i % 7)) for i in range(5000)] + [("none", None)]
    rows = [(k, None if v is None else float(v)) for k, v in rows]
    df = spark.createDataFrame(rows, "k string, v double").repartition(7)
    for accuracy in (10_000, 50):
        got = {r.k: (r.n, r.median_v) for r in reports.medians_by(df, ["k"], ["v"], accuracy).collect()}
        for key in {k for k, _ in rows}:
            values = [v for k, v in rows if k == key and v is not None]
            want = statistics.median(values) if values else None
            assert got[key] == (sum(k == key for k, _ in rows), want)


def test_medians_without_broadcast_and_approximate(spark, monkeypatch):
    df = spark.range(2000).select((F.col("id") % 3).alias("k"), (F.col("id") * 7 % 501).cast("double").alias("v"))
    want = sorted(reports.medians_by(df, ["k"], ["v"]).collect())
    monkeypatch.setattr(reports, "few_groups", lambda df, keys: False)
    assert sorted(reports.medians_by(df, ["k"], ["v"]).collect()) == want
    near = {r.k: r.median_v for r in reports.approximate_medians_by(df, ["k"], ["v"]).collect()}
    assert all(abs(near[r.k] - r.median_v) <= 2 for r in want)


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_plain_join(spark, how):
    left = spark.range(3000).select(F.col("id").alias("a"), F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 11).alias("k"))
    right = spark.range(40).select((F.col("id") % 9).alias("k"), F.col("id").alias("b"))
    got = salted(left, right, ["k"], ["a"], how, 100)
    assert sorted(got.collect()) == sorted(left.join(right, ["k"], how).collect())


def test_trigram_similarity(spark):
    def sim(a, b):
        return spark.range(1).select(trigram_similarity(F.lit(a), F.lit(b)).alias("s")).first().s

    assert sim("Peachtree", "peachtree") == 1.0
    assert sim("word", "two words") == pytest.approx(4 / 11)
    assert sim("abc", "xyz") == 0.0 and sim("", "abc") == 0.0
    assert sim("main st", "st main oak") == sim("st main oak", "main st")


def test_search_wildcards_and_ties(spark):
    rows = [("2", "13121", "100 Oak_St"), ("1", "13121", "100 OakXSt"), ("3", "13121", "9 Elm"), ("4", "13121", None)]
    df = spark.createDataFrame(rows, "parcel_id string, geoid string, parcel_address string")
    assert {r.parcel_id for r in search.search_by_address(df, "oak_st").collect()} == {"1", "2"}
    assert [r.parcel_id for r in search.search_text(df, "parcel_address", "oak_st", literal=True).collect()] == ["2"]
    assert search.search_by_address(df, "oak", limit=1).count() == 1


def test_property_match_prefers_ids(spark):
    parcels = spark.createDataFrame([(1, "P1", "1 Main St."), (2, None, "1 MAIN st"), (3, "P9", None)],
                                    "k long, parcel_id string, parcel_address string")
    records = spark.createDataFrame([(7, "P1", "5 Oak"), (8, None, "1  main, st"), (6, None, "1 Main St")],
                                    "property_id long, parcel_ref string, address string")
    got = {r.k: (r.property_id, r.match_kind, r.candidates) for r in enrich.match_properties(parcels, records, ["k"]).collect()}
    assert got == {1: (7, "id", 1), 2: (6, "address", 2), 3: (None, None, None)}


def test_sampling_and_pages(spark):
    df = spark.range(1000)
    a = [r.id for r in sampling.sample_rows(df, 50, "id", seed=1).collect()]
    assert a == [r.id for r in sampling.sample_rows(df.repartition(9), 50, "id", seed=1).collect()]
    assert a != [r.id for r in sampling.sample_rows(df, 50, "id", seed=2).collect()]
    assert [r.id for r in sampling.page(df, "id", 3, offset=10).collect()] == [10, 11, 12]
    assert [r.id for r in sampling.page(df, "id", 3, after=500).collect()] == [501, 502, 503]


def test_display(spark):
    row = spark.range(1).select(
        D.value_color(F.lit(0)).alias("low"), D.value_color(F.lit(100000)).alias("stop"),
        D.value_color(F.lit(10**9)).alias("high"), D.value_color(F.lit(None).cast("long")).alias("none"),
        D.money_or_na(F.lit(0)).alias("zero"), D.money_or_na(F.lit(1234567)).alias("money"),
        D.text_or("x", F.lit("")).alias("empty"), D.to_number(F.lit("12a")).alias("bad"),
    ).first()
    assert (row.low, row.stop, row.high, row.none) == ("#3b82f6", "#6366f1", "#ef4444", "#6366f1")
    assert (row.zero, row.money, row.empty, row.bad) == ("N/A", "$1,234,567", "x", 0.0)


def test_quality(spark):
    rows = [("A", "13121"), ("A", "13121"), (None, "13121"), ("B", "9912345")]
    parcels = spark.createDataFrame(rows, "parcel_id string, geoid string")
    counties = spark.createDataFrame([("13121", "13", "Fulton"), ("77001", "77", "Nowhere")],
                                     "geoid string, statefp string, county_name string")
    got = {r.rule: r.violations for r in quality.quality_report(parcels, counties).collect()}
    assert got == {
        "parcel_id is null": 1, "parcel_id longer than 100": 0, "geoid is null": 0, "geoid longer than 5": 1,
        "duplicate (geoid, parcel_id)": 1, "geoid not in counties": 1, "county state not in states": 1,
    }


def test_column_profile_and_edges(spark, sf_dir):
    profile = {r.column_name: r for r in reports.column_profile(S.parcel_raw(spark, sf_dir)).collect()}
    assert profile["lrid"].non_null == 1500 and profile["geom"].min_value is None
    assert reports.edge_profile(S.edges(spark, sf_dir)).first().fips == "13121"


def test_dataset_text_filters_reach_the_scan(spark, sf_dir):
    rows = S.table(spark, sf_dir, "orders").where(F.col("o_totalprice") > 1000).select("o_orderkey")
    assert "PushedFilters: [IsNotNull(o_totalprice), GreaterThan(o_totalprice,1000.0)]" in plan(rows)
