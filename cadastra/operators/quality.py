"""Data-quality checks. Each is an aggregate or an anti join; none collects the rows it checks."""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadastra import lookups
from cadastra.functions.geometry import Box
from cadastra.operators.filters import intersecting_box
from cadastra.schemas import PARCEL_COLUMNS, REQUIRED


def duplicate_keys(df: DataFrame, *keys: str) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where(F.col("n") > 1)


def _rules(df: DataFrame) -> dict[str, Column]:
    rules: dict[str, Column] = {}
    for name, length in REQUIRED.items():
        if name in df.columns:
            rules[f"{name} is null"] = F.col(name).isNull()
            rules[f"{name} longer than {length}"] = F.length(name) > length
    for target, _, _, length in PARCEL_COLUMNS:
        if length is not None and target in df.columns and target not in REQUIRED:
            rules[f"{target} longer than {length}"] = F.length(target) > length
    return rules


def rule_violations(parcels: DataFrame) -> DataFrame:
    """Rows that break each null or length rule (rule, violations), all rules in one pass."""
    rules = _rules(parcels)
    counts = parcels.agg(*[F.count_if(rule).alias(f"r{i}") for i, rule in enumerate(rules.values())])
    lines = [
        F.struct(F.lit(name).alias("rule"), F.col(f"r{i}").alias("violations")) for i, name in enumerate(rules)
    ]
    return counts.select(F.explode(F.array(*lines)).alias("l")).select("l.*")


def unknown_states(counties: DataFrame) -> DataFrame:
    """Counties whose state is not in the state lookup."""
    states = F.broadcast(lookups.states(counties.sparkSession))
    return counties.join(states, "statefp", "left_anti")


def unknown_counties(parcels: DataFrame, counties: DataFrame) -> DataFrame:
    """Parcels per geoid that is not in the county lookup. Parcels are counted before the join."""
    per_geoid = parcels.groupBy("geoid").agg(F.count("*").alias("n"))
    return per_geoid.join(F.broadcast(lookups.county_table(counties)), "geoid", "left_anti")


def quality_report(parcels: DataFrame, counties: DataFrame) -> DataFrame:
    """All checks as (rule, violations)."""
    def total(df: DataFrame, name: str, amount: Column) -> DataFrame:
        return df.agg(F.coalesce(amount, F.lit(0).cast("bigint")).alias("violations")).select(
            F.lit(name).alias("rule"), "violations"
        )

    return (
        rule_violations(parcels)
        .unionByName(total(duplicate_keys(parcels, "geoid", "parcel_id"), "duplicate (geoid, parcel_id)",
                           F.sum(F.col("n") - 1)))
        .unionByName(total(unknown_counties(parcels, counties), "geoid not in counties", F.sum("n")))
        .unionByName(total(unknown_states(counties), "county state not in states", F.count("*")))
    )


def bounded_query_check(dataset: DataFrame, bounds: Box, warn_seconds: float = 2.0) -> dict[str, object]:
    """Run the bounded query that a published dataset must answer; warns when it takes too long."""
    started = time.perf_counter()
    n = intersecting_box(dataset, bounds).count()
    seconds = time.perf_counter() - started
    return {"parcels": n, "seconds": seconds, "slow": seconds > warn_seconds}


def small_artifacts(inventory: DataFrame, least_mb: float = 0.01) -> DataFrame:
    """Published files that are suspiciously small."""
    return inventory.where(F.col("size_mb") < least_mb)
