"""Bench: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query runs once to warm up and is then timed, the better of two runs, from building the plan to the last row. `bbox_layout` times the
bounded query on a Hilbert-sorted layout that was written beforehand, with the row groups it had to read.
"""

from __future__ import annotations

import contextlib
import glob
import json
import os
import sys
import tempfile
import time

import pyarrow.parquet as pq

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from cadastra.operators import filters, layout  # noqa: E402
from cadastra.plans import standins  # noqa: E402
from cadastra.plans.queries import METRO_BOX, QUERIES  # noqa: E402
from cadastra.session import build_session  # noqa: E402

HEADLINE = [
    "normalize_dedup", "parcel_coverage", "fips_summary", "county_value_top10", "county_medians", "county_extents",
    "table_extent", "bbox_count", "bbox_search", "search_address", "search_owner", "hilbert_order", "pip_enrich",
    "overlap_share", "adjacent_parcels", "footprint_containment", "property_match", "tile_counts", "tile_thinned",
    "tile_stats", "cell_summary", "layout_roundtrip", "quality_report",
]
ROWS_PER_GROUP = 2_000


def consume(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(action) -> float:
    started = time.perf_counter()
    action()
    return round(time.perf_counter() - started, 3)


def row_groups_met(path: str, box: tuple[float, float, float, float]) -> tuple[int, int]:
    """Row groups whose statistics meet the box, and all row groups."""
    met = total = 0
    for file in glob.glob(f"{path}/*.parquet"):
        meta = pq.ParquetFile(file).metadata
        names = [meta.row_group(0).column(i).path_in_schema for i in range(meta.num_columns)] if meta.num_row_groups else []
        at = {c: names.index(f"bbox.{c}") for c in ("xmin", "ymin", "xmax", "ymax")} if names else {}
        for g in range(meta.num_row_groups):
            stats = {c: meta.row_group(g).column(i).statistics for c, i in at.items()}
            met += (
                stats["xmin"].min <= box[2] and stats["xmax"].max >= box[0]
                and stats["ymin"].min <= box[3] and stats["ymax"].max >= box[1]
            )
            total += 1
    return met, total


def main() -> int:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        f"local[{cpus}]", "bench", spark__sql__shuffle__partitions=cpus, spark__ui__enabled="false",
        spark__driver__memory="12g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}
    details: dict[str, object] = {}
    with contextlib.redirect_stdout(sys.stderr), tempfile.TemporaryDirectory(prefix="bench-") as folder:
        for name in HEADLINE:
            run = QUERIES[name]
            cold = timed(lambda: consume(run(spark, sf_dir)))
            times[name] = min(timed(lambda: consume(run(spark, sf_dir))) for _ in range(2))
            details[f"{name}_cold"] = cold
        raw = standins.raw_multi(spark, sf_dir)
        for kind, df in (("plain", raw), ("hilbert", layout.hilbert_sorted(raw, tie=("lrid",)))):
            path = f"{folder}/{kind}"
            layout.write_parquet(df, path, rows=ROWS_PER_GROUP)
            dataset = spark.read.parquet(path)

            def bounded() -> None:
                filters.intersecting_box(dataset, METRO_BOX).count()

            bounded()
            details[f"bbox_{kind}_sec"] = timed(bounded)
            met, total = row_groups_met(path, METRO_BOX)
            details[f"bbox_{kind}_row_groups"] = f"{met}/{total}"
        times["bbox_layout"] = details["bbox_hilbert_sec"]
        spark.stop()
    print(json.dumps({
        "metric": "headline queries, warm", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")), "details": details,
    }))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
