"""The commit log: whole runs or nothing, and rebuilds of what has changed."""

import glob
import os
import shutil

import pytest
from pyspark.sql import functions as F

from cadastra.operators import filters, layout, publish
from cadastra.plans import rebuild
from cadastra.plans import standins as S

TIE = ("lrid",)


@pytest.fixture(scope="module")
def source(spark, sf_dir):
    return S.raw_multi(spark, sf_dir).select("lrid", "statefp", "countyfp", "totalvalue", "bbox")


def files(path):
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/**/*.parquet", recursive=True)}


def dead_run(rows, path):
    keyed = layout.with_partition_keys(rows)
    publish.write_run(keyed, path, TIE, publish.new_run(), publish.contents(keyed))


def counts(df):
    return {(r.state, r.county): r["count"] for r in df.groupBy("state", "county").count().collect()}


def test_published_counties_are_left_alone(spark, source, tmp_path):
    path = str(tmp_path / "c")
    publish.publish_counties(filters.of_state(source, "13"), path, TIE)
    before = files(path)
    assert publish.publish_counties(source, path, TIE) is not None
    after = files(path)
    assert {f: after[f] for f in before} == before and len(after) > len(before)
    assert publish.read_published(spark, path).count() == 1500
    assert publish.publish_counties(source, path, TIE) is None and files(path) == after


def test_a_dead_run_is_never_read(spark, source, tmp_path):
    path = str(tmp_path / "c")
    dead_run(filters.of_state(source, "37").where("lrid % 2 = 0"), path)
    with pytest.raises(ValueError):
        publish.read_published(spark, path)
    publish.publish_counties(filters.of_state(source, "13"), path, TIE)
    assert {k[0] for k in counts(publish.read_published(spark, path))} == {"13"}
    publish.publish_counties(source, path, TIE)
    want = counts(layout.with_partition_keys(source))
    assert counts(publish.read_published(spark, path)) == want
    assert len(publish.leftovers(spark, path)) > 0 and publish.vacuum(spark, path) > 0
    assert publish.leftovers(spark, path) == [] and counts(publish.read_published(spark, path)) == want


def test_a_commit_that_did_not_end_does_not_count(spark, source, tmp_path):
    path = str(tmp_path / "c")
    publish.publish_counties(filters.of_state(source, "13"), path, TIE)
    publish.publish_counties(source, path, TIE)
    last = max(os.listdir(f"{path}/{publish.COMMITS}"))
    os.remove(f"{path}/{publish.COMMITS}/{last}/_SUCCESS")
    assert {k[0] for k in counts(publish.read_published(spark, path))} == {"13"}


def test_a_run_with_lost_files_commits_nothing(spark, source, tmp_path, monkeypatch):
    path = str(tmp_path / "c")
    written = publish.write_run

    def losing(rows, path, *rest):
        written(rows, path, *rest)
        shutil.rmtree(glob.glob(f"{path}/state=37/county=0*")[0])

    monkeypatch.setattr(publish, "write_run", losing)
    with pytest.raises(publish.IncompleteRun):
        publish.publish_counties(source, path, TIE)
    assert publish.committed(spark, path) is None


def test_a_new_version_replaces_the_old_one_at_its_commit(spark, source, tmp_path):
    path = str(tmp_path / "c")
    publish.publish_counties(source, path, TIE)
    newer = filters.of_state(source, "13").where("lrid % 2 = 0").withColumn("extra", F.lit("x"))
    publish.publish_counties(newer, path, TIE, overwrite=True)
    back = publish.read_published(spark, path)
    assert back.where("state = '13'").count() == newer.count() == back.where("extra = 'x'").count()
    assert back.where("state <> '13'").count() == source.where("statefp <> '13'").count()
    some = publish.read_published(spark, path, F.col("state") == "37")
    assert {k[0] for k in counts(some)} == {"37"} and all("state=37" in f for f in some.inputFiles())
    assert publish.read_published(spark, path, F.col("state") == "99").count() == 0


def test_fingerprints_name_the_content(spark):
    rows = [(1, "a", None), (2, None, "a"), (3, "b", "b")]
    schema = "k int, u string, v string"

    def name(rows, schema=schema):
        return spark.createDataFrame(rows, schema).repartition(3).agg(publish.fingerprint(["k", "u", "v"]).alias("f")).first().f

    first = name(rows)
    assert first == name(rows[::-1]) and first != name(rows[:2]) and first != name([*rows, rows[2]])
    assert first != name([(1, None, "a"), (2, "a", None), (3, "b", "b")]) and first != name([(1, "a", None), (2, None, "a"), (3, "b", "c")])


def test_only_what_changed_is_rebuilt(spark, sf_dir, tmp_path):
    root, raw = str(tmp_path), S.raw_multi(spark, sf_dir)
    everything = rebuild.rebuild_state(raw, "37", root, TIE)
    assert all(everything.values())
    before = files(f"{root}/by_county") | files(f"{root}/tiles")
    assert not any(rebuild.rebuild_state(raw, "37", root, TIE).values())
    assert files(f"{root}/by_county") | files(f"{root}/tiles") == before
    changed = raw.withColumn("totalvalue", F.when(F.col("countyfp") == "013", 7).otherwise(F.col("totalvalue")).cast("long"))
    done = rebuild.rebuild_state(changed, "37", root, TIE)
    assert done == {"state": [("37", "")], "counties": [("37", "013")], "tiles": [("37", "013")], "catalogue": [("37", "")]}
    after = files(f"{root}/by_county") | files(f"{root}/tiles")
    assert {f: after[f] for f in before} == before
    assert all("county=013" in f for f in set(after) - set(before))
    assert publish.read_published(spark, f"{root}/by_county").where("county = '013' AND totalvalue <> 7").count() == 0
    assert spark.read.json(f"{root}/_catalogue/state=37").count() == len({c for _, c in everything["counties"]})


def test_a_run_that_died_between_two_outputs_is_made_good(spark, sf_dir, tmp_path, monkeypatch):
    root, raw = str(tmp_path), S.raw_multi(spark, sf_dir)

    def die(*args):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(rebuild, "_write_tiles", die)
        with pytest.raises(RuntimeError):
            rebuild.rebuild_state(raw, "13", root, TIE)
    done = rebuild.rebuild_state(raw, "13", root, TIE)
    assert done["state"] == done["counties"] == [] and done["tiles"] and done["catalogue"]


def test_a_county_that_goes_takes_its_tiles_along(spark, sf_dir, tmp_path):
    root, raw = str(tmp_path), S.raw_multi(spark, sf_dir)
    rebuild.rebuild_state(raw, "13", root, TIE)
    gone = min(c for _, c in counts(publish.read_published(spark, f"{root}/by_county")))
    done = rebuild.rebuild_state(raw.where(F.col("countyfp") != gone), "13", root, TIE)
    assert done["counties"] == done["tiles"] == [("13", gone)]
    for name in ("by_county", "tiles"):
        assert gone not in {c for _, c in counts(publish.read_published(spark, f"{root}/{name}"))}
    nothing = rebuild.rebuild_state(raw.where("false"), "13", root, TIE)
    assert nothing["counties"] and not any(rebuild.rebuild_state(raw.where("false"), "13", root, TIE).values())


def test_the_raw_layer_is_evaluated_once_for_all_writes(spark, sf_dir, tmp_path):
    rows = S.raw_multi(spark, sf_dir).where("statefp = '13'").localCheckpoint()
    seen = spark.sparkContext.accumulator(0)

    @F.udf("boolean")
    def count(lrid):
        seen.add(1)
        return True

    outputs = rebuild.state_outputs(rows.where(count.asNondeterministic()("lrid")), "13", str(tmp_path), TIE)
    rebuild.bring_up_to_date(outputs[:2])  # state file and counties: tiles read the counties
    assert 0 < seen.value <= 2 * rows.count()  # its contents, then the rows that are kept for the writes
