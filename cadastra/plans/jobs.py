"""Composed jobs: extract, lay out, normalize, load, export, tile and report."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadastra import lookups
from cadastra.functions.geometry import Box
from cadastra.operators import descent, filters, layout, quality, reports, tiling
from cadastra.operators.normalize import normalize
from cadastra.operators.simplify import simplify
from cadastra.plans import rebuild
from cadastra.sources import geojson, jdbc

TIE = ("parcelid", "lrid")


def extract_box(raw: DataFrame, bounds: Box, path: str) -> None:
    """Features that meet a box, spatially sorted, with covering boxes."""
    rows = filters.intersecting_box(filters.with_box(raw), bounds)
    layout.write_parquet(layout.hilbert_sorted(rows, bounds, TIE), path)


def extract_state(raw: DataFrame, statefp: str, path: str) -> None:
    """Features that meet the bounds of a state, whatever state they name."""
    extract_box(raw, lookups.bounds_of(statefp), path)


def publish_state(raw: DataFrame, statefp: str, root: str) -> str:
    """Features of one state (bounds and state code), Hilbert-sorted under root/state=XX."""
    bounds = lookups.bounds_of(statefp)
    rows = filters.state_extract(filters.with_box(raw), statefp)
    path = f"{root.rstrip('/')}/state={statefp}"
    layout.write_parquet(layout.hilbert_sorted(rows, bounds, TIE), path, **layout.STATE_LAYOUT)
    return path


def states_extract(raw: DataFrame) -> DataFrame:
    """Rows of all states, each checked against its own bounds: one job, not one per state.

    A state without bounds is kept whole, as in `filters.state_extract`; so are rows with an unknown state code.
    """
    from cadastra.functions import geometry as G

    bounds = lookups.state_bounds(raw.sparkSession).select(
        "statefp", F.struct("xmin", "ymin", "xmax", "ymax").alias("_state_box")
    )
    rows = filters.with_box(raw)
    joined = rows.join(F.broadcast(bounds), "statefp", "left")
    box, state_box = F.col("bbox"), F.col("_state_box")
    # A feature whose box lies inside the bounds needs no exact test.
    inside = (
        (box["xmin"] >= state_box["xmin"]) & (box["xmax"] <= state_box["xmax"])
        & (box["ymin"] >= state_box["ymin"]) & (box["ymax"] <= state_box["ymax"])
    )
    meets = filters.boxes_overlap(box, state_box)
    if "geom" in rows.columns:
        meets = meets & (inside | G.intersects_box(F.col("geom"), state_box))
    return joined.where(state_box.isNull() | meets).select(*rows.columns)


def publish_all_states(raw: DataFrame, root: str) -> None:
    """Every state's extract under root/state=XX in one job."""
    layout.write_by_state(states_extract(raw), root, TIE)


def county_parallel_extract(raw: DataFrame, statefp: str, path: str) -> None:
    """One state's counties, merged and Hilbert-sorted in the state's bounds.

    Counties need no tasks of their own: the state is filtered once and one range shuffle sorts it.
    """
    rows = filters.with_box(filters.of_state(raw, statefp))
    layout.write_parquet(layout.hilbert_sorted(rows, lookups.bounds_of(statefp), TIE), path, **layout.STATE_LAYOUT)


def refresh_parcels(raw: DataFrame, root: str, version: str, view: str = "parcel") -> str:
    """Normalize the landing table and swap the new version in under a view."""
    parcels = layout.hilbert_sorted(normalize(raw), tie=("geoid", "parcel_id"))
    return layout.publish_version(parcels, root, version, view)


@dataclass
class ExtractRequest:
    """A named extract: where, in which formats, how generalized, and whether to load it."""

    name: str
    bounds: Box
    formats: list[str] = field(default_factory=lambda: ["parquet"])
    simplify: float | None = None
    load: bool = True
    table: str = "parcels.parcel_raw"


def run_extract(raw: DataFrame, request: ExtractRequest, root: str, url: str | None = None,
                properties: list[str] | None = None) -> list[str]:
    """Run an extract request; returns the paths written. Formats: parquet, geojson, tiles."""
    unknown = set(request.formats) - {"parquet", "geojson", "tiles"}
    if unknown:
        raise ValueError(f"unknown formats {sorted(unknown)}")
    rows = filters.intersecting_box(filters.with_box(raw), request.bounds)
    if request.simplify:
        rows = simplify(rows, request.simplify)
    written = []
    for kind in request.formats:
        path = f"{root.rstrip('/')}/{kind}/{request.name}"
        if kind == "parquet":
            layout.write_parquet(layout.hilbert_sorted(rows, request.bounds, TIE), path)
        elif kind == "geojson":
            geojson.write_lines(rows, path, properties or ["parcelid", "parceladdr", "ownername", "totalvalue"])
        else:
            descent.write_pyramid(rows, path, ("lrid",), **tiling.PRESETS["export"])
        written.append(path)
    if request.load and "parquet" in request.formats and url is not None:
        stored = raw.sparkSession.read.parquet(f"{root.rstrip('/')}/parquet/{request.name}")
        jdbc.write_table(stored, url, request.table)
        written.append(f"table:{request.table}")
    return written


def tile_state(raw: DataFrame, statefp: str, path: str, key: tuple[str, ...] = ("lrid",), **options) -> None:
    """The thinned pyramid of one state; `key` names a feature, and its draw decides where it stays visible."""
    rows = filters.with_box(filters.of_state(raw, statefp))
    descent.write_pyramid(rows, path, key, **tiling.PRESETS["state"], **options)


def national_tiles(raw: DataFrame, root: str, key: tuple[str, ...] = ("lrid",), **options) -> str:
    """The pyramids of all states under root/states in one job, and merged under root/national; returns that path."""
    base = root.rstrip("/")
    rows = layout.with_state_key(filters.with_box(raw))
    descent.write_pyramid(rows, f"{base}/states", key, **tiling.PRESETS["state"], partition_by=("state", "z"), **options)
    descent.merge_pyramids(raw.sparkSession, f"{base}/states", f"{base}/national", key)
    return f"{base}/national"


def tile_counties(raw: DataFrame, path: str, key: tuple[str, ...] = ("lrid",), **options) -> None:
    """County pyramids of all counties in one job; a county is the rows of its own state and county codes."""
    rows = layout.with_partition_keys(filters.with_box(raw))
    descent.write_pyramid(rows, path, key, **tiling.PRESETS["county"], partition_by=("state", "county"), **options)


def full_run(raw: DataFrame, statefp: str, name: str, root: str, url: str | None = None) -> list[str]:
    """Extract a state, load it and export the derived formats."""
    request = ExtractRequest(name, lookups.bounds_of(statefp), ["parquet", "geojson", "tiles"], load=url is not None)
    return run_extract(raw, request, root, url)


def incremental_state(raw: DataFrame, statefp: str, root: str) -> dict[str, str]:
    """Extract, county split, tiles and catalogue of one state; what its input has not changed is left alone."""
    rebuild.rebuild_state(raw, statefp, root, TIE)
    base = root.rstrip("/")
    return {"state": f"{base}/by_state/state={statefp}", "counties": f"{base}/by_county", "tiles": f"{base}/tiles",
            "catalogue": f"{base}/_catalogue/state={statefp}"}


def publish(dataset: DataFrame, bucket: str, prefix: str, statefp: str) -> str:
    """Write one state's dataset straight to the object store, with its catalogue entry."""
    path = f"{bucket.rstrip('/')}/{prefix.strip('/')}/state={statefp}"
    layout.write_parquet(dataset, path, **layout.STATE_LAYOUT)
    stored = dataset.sparkSession.read.parquet(path)
    layout.write_manifest(stored.withColumn("state", F.lit(statefp)), ["state"],
                          f"{bucket.rstrip('/')}/{prefix.strip('/')}/_catalogue/state={statefp}")
    return path


def status(datasets: dict[str, DataFrame]) -> DataFrame:
    """Rows and extent of every dataset."""
    return reports.status_report(datasets)


def showcase(spark: SparkSession, source: str, properties: str, root: str) -> dict[str, object]:
    """GeoJSON -> sorted Parquet -> tiles -> bounded query, end to end."""
    features = geojson.read_collection(spark, source, properties)
    path = f"{root.rstrip('/')}/parquet"
    layout.write_parquet(layout.hilbert_sorted(features, tie=("parcel_id",)), path)
    stored = spark.read.parquet(path)
    descent.write_pyramid(stored, f"{root.rstrip('/')}/tiles", ("parcel_id",), 12, 16)
    box = reports.extent(stored).first()
    return quality.bounded_query_check(stored, (box.xmin, box.ymin, box.xmax, box.ymax))
