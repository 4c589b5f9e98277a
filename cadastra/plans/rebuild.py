"""Rebuild of one state's outputs: only what its input has changed.

Outputs form a small graph: the state file and the counties come from the raw layer, the tiles and the catalogue from the
counties. Each output keeps, for every part of it, the fingerprint of what the part was built from. A part is stale when
that differs from the fingerprint of its source now; sources come first, so whatever depends on a changed county
follows, also when an earlier run died between two outputs.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cadastra.operators import descent, filters, layout, publish, tiling
from cadastra.operators.layout import path_exists
from cadastra.operators.steps import discard, stored

Key = tuple[str, str]
Stamps = dict[Key, str]


@dataclass(frozen=True)
class Output:
    """An output: the fingerprints its parts should have been built from, those they were, and how to build some parts."""

    name: str
    wanted: Callable[[], Stamps]
    built: Callable[[], Stamps]
    build: Callable[[Stamps, list[Key]], None]


def outdated(wanted: Stamps, built: Stamps) -> tuple[Stamps, list[Key]]:
    """Parts to build, with their fingerprints, and parts whose source is gone."""
    return {k: v for k, v in sorted(wanted.items()) if built.get(k) != v}, sorted(set(built) - set(wanted))


def bring_up_to_date(outputs: list[Output]) -> dict[str, list[Key]]:
    """Build the stale parts of each output in turn; returns which ones, with those removed. Sources come first."""
    done: dict[str, list[Key]] = {}
    for output in outputs:
        stale, gone = outdated(output.wanted(), output.built())
        if stale or gone:
            output.build(stale, gone)
        done[output.name] = sorted([*stale, *gone])
    return done


def _stamps(entries: DataFrame | None, statefp: str) -> Stamps:
    """Fingerprints of one state's partitions: at most 1,001."""
    if entries is None:
        return {}
    return {(r.state, r.county): r.fingerprint for r in entries.where((F.col("state") == statefp) & (F.col("n") > 0)).collect()}


def _among(keys: list[Key]) -> Column:
    return F.concat_ws("-", *publish.KEYS).isin([f"{s}-{c}" for s, c in keys])


def _summary(stamps: Stamps) -> str:
    return hashlib.sha256(json.dumps(sorted((*k, v) for k, v in stamps.items())).encode()).hexdigest()


def _read_mark(spark: SparkSession, path: str) -> str | None:
    if not path_exists(spark, f"{path}/_SUCCESS"):
        return None
    return spark.read.schema("mark string").json(path).first().mark


def _write_mark(spark: SparkSession, path: str, mark: str) -> None:
    spark.createDataFrame([(mark,)], "mark string").write.mode("overwrite").json(path)


def _write_tiles(spark: SparkSession, counties: str, path: str, key: tuple[str, ...], stale: Stamps, gone: list[Key]) -> None:
    """County pyramids of the stale counties as one run. Their entries name the fingerprint of the county."""
    run = publish.new_run()
    found: dict[Key, int] = {}
    if stale:
        rows = publish.read_published(spark, counties, _among(list(stale)))
        parts = (*publish.KEYS, publish.RUN)
        descent.write_pyramid(rows.withColumn(publish.RUN, F.lit(run)), path, key, **tiling.PRESETS["county"], partition_by=parts, files=layout.COUNTY_LAYOUT)
        stored = spark.read.option("basePath", path).schema("state string, county string, run string").parquet(f"{path}/state=*/county=*/run={run}")
        found = {(r.state, r.county): r.n for r in stored.groupBy(*publish.KEYS).agg(F.count("*").alias("n")).collect()}
        if set(found) != set(stale):
            raise publish.IncompleteRun(f"run {run}: tiles of {sorted(set(stale) ^ set(found))}")
    entries = [(*k, n, stale[k]) for k, n in found.items()] + [(*k, 0, None) for k in gone]
    table = spark.createDataFrame(entries, "state string, county string, n bigint, fingerprint string")
    publish.commit(table.withColumns({c: F.lit(None).cast("double") for c in ("xmin", "ymin", "xmax", "ymax")}), path, run)


def state_outputs(
    raw: DataFrame, statefp: str, root: str, tie: tuple[str, ...] = ("parcelid", "lrid"), known: dict[str, DataFrame] | None = None
) -> list[Output]:
    """The outputs of one state: state file, counties, county tiles and catalogue, sources before what depends on them.

    `known` gets the tables that the outputs share; `rows` in it, the state's stored rows, is there only after a write.
    """
    spark, base = raw.sparkSession, root.rstrip("/")
    counties, tiles = f"{base}/by_county", f"{base}/tiles"
    state_path, state_mark = f"{base}/by_state/state={statefp}", f"{base}/_marks/state={statefp}"
    catalogue, catalogue_mark = f"{base}/_catalogue/state={statefp}", f"{base}/_marks/catalogue={statefp}"
    rows = layout.with_partition_keys(filters.with_box(filters.state_extract(filters.with_box(raw), statefp)))
    columns = rows.columns
    known = {} if known is None else known

    def contents() -> DataFrame:
        if "now" not in known:  # one pass over the state's rows, kept on the driver: at most 1,001 entries
            found = publish.contents(rows, columns)
            known["now"] = spark.createDataFrame(found.collect(), found.schema)
        return known["now"]

    def source() -> Stamps:
        return {(r.state, r.county): r.fingerprint for r in contents().collect()}

    def kept() -> DataFrame:
        if "rows" not in known:  # the raw layer is evaluated once for all writes; a range sort reads its input twice
            known["rows"] = stored(rows)
        return known["rows"]

    def write_counties(stale: Stamps, gone: list[Key]) -> None:
        some = kept().where(_among(list(stale))) if stale else rows.where(F.lit(False))
        lost = spark.createDataFrame(gone, "state string, county string") if gone else None
        publish.publish_rows(some, counties, tie, known=contents().where(_among(list(stale))), gone=lost)

    whole: Key = (statefp, "")

    def one(stamps: Stamps) -> Stamps:
        return {whole: _summary(stamps)} if stamps else {}

    def marked(path: str) -> Stamps:
        mark = _read_mark(spark, path)
        return {} if mark in (None, "") else {whole: mark}

    def write_state(stale: Stamps, gone: list[Key]) -> None:
        layout.write_parquet(layout.hilbert_sorted_state(kept().drop(*publish.KEYS), statefp if statefp in filters.STATE_BOUNDS else None, tie=tie), state_path, **layout.STATE_LAYOUT)
        _write_mark(spark, state_mark, stale.get(whole, ""))

    def write_catalogue(stale: Stamps, gone: list[Key]) -> None:
        entries = publish.committed(spark, counties).where((F.col("state") == statefp) & (F.col("n") > 0))
        entries.drop(publish.RUN).coalesce(1).write.mode("overwrite").json(catalogue)
        _write_mark(spark, catalogue_mark, stale.get(whole, ""))

    def of_counties() -> Stamps:
        return _stamps(publish.committed(spark, counties), statefp)

    return [
        Output("state", lambda: one(source()), lambda: marked(state_mark), write_state),
        Output("counties", source, of_counties, write_counties),
        Output("tiles", of_counties, lambda: _stamps(publish.committed(spark, tiles), statefp), lambda s, g: _write_tiles(spark, counties, tiles, tie, s, g)),
        Output("catalogue", lambda: one(of_counties()), lambda: marked(catalogue_mark), write_catalogue),
    ]


def rebuild_state(raw: DataFrame, statefp: str, root: str, tie: tuple[str, ...] = ("parcelid", "lrid")) -> dict[str, list[Key]]:
    """Bring a state's outputs up to date with the raw layer; returns which parts of each were built or removed."""
    known: dict[str, DataFrame] = {}
    try:
        return bring_up_to_date(state_outputs(raw, statefp, root, tie, known))
    finally:
        if "rows" in known:
            discard(known["rows"])
