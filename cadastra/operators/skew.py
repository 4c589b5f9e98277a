"""Equi-joins that stay parallel when one key holds a large part of all rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROWS_PER_SPLIT = 1_000_000
BROADCAST_BYTES = 256 * 1024 * 1024
GROUP_LIMIT = 200_000


def _bytes(value: Column, kind: T.DataType) -> Column:
    """Approximate in-memory size of a value."""
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(value), F.lit(0)).cast("bigint") + 16
    if isinstance(kind, T.StructType):
        return reduce(lambda a, b: a + b, [_bytes(value[f.name], f.dataType) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        nested = F.aggregate(
            value, F.lit(16).cast("bigint"), lambda total, item: total + _bytes(item, kind.elementType)
        )
        return F.coalesce(nested, F.lit(16).cast("bigint"))
    return F.lit(16).cast("bigint")


def row_bytes(df: DataFrame) -> Column:
    """Approximate size of a row of `df` in bytes, from its values."""
    return reduce(lambda a, b: a + b, [_bytes(F.col(f"`{f.name}`"), f.dataType) for f in df.schema.fields])


def estimated_small(df: DataFrame) -> bool:
    """True when Spark's own size estimate of `df` is under its broadcast threshold."""
    threshold = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return 0 <= int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()) <= threshold


def few_groups(df: DataFrame, keys: list[str], limit: int = GROUP_LIMIT) -> bool:
    """True when `df` has at most about `limit` groups (one scan of the key columns, estimated within 5 %)."""
    return df.agg(F.approx_count_distinct(F.struct(*keys))).first()[0] <= limit


def salted_join(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    salt_by: list[str],
    how: str = "inner",
    rows_per_split: int = ROWS_PER_SPLIT,
) -> DataFrame:
    """Join where keys of `left` may be hot: their rows are spread over salts and `right` is repeated per salt.

    Only keys above `rows_per_split` are salted, each of them: there are at most rows / rows_per_split of them, and Spark
    chooses how to join that list. A right row of any other key is not repeated. `salt_by` names columns of `left` that
    differ between the rows of a key. Left rows with a null key have no partner and are not shuffled for one. No row is
    dropped, so the result equals the plain join for inner, left, left_semi and left_anti.

    A right side that Spark estimates to be under its broadcast threshold is left to it; then no key is shuffled.
    """
    if estimated_small(right):
        return left.join(right, on, how)
    return salted(left, right, on, salt_by, how, rows_per_split)


def salted(
    left: DataFrame, right: DataFrame, on: list[str], salt_by: list[str], how: str, rows_per_split: int
) -> DataFrame:
    """The salted form of `salted_join`, for a right side known to be large."""
    keyed = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in on])
    hot = (
        left.where(keyed)
        .groupBy(*on)
        .agg(F.count("*").alias("_rows"))
        .where(F.col("_rows") > rows_per_split)
        .select(*on, F.ceil(F.col("_rows") / rows_per_split).cast("int").alias("_splits"))
    )
    splits = F.coalesce(F.col("_splits"), F.lit(1))
    salted_left = (
        left.where(keyed)
        .join(hot, on, "left")
        .withColumn("_salt", F.pmod(F.xxhash64(*salt_by), splits).cast("int"))
        .drop("_splits")
    )
    salted_right = (
        right.join(hot, on, "left")
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), splits - 1)))
        .drop("_splits")
    )
    joined = salted_left.join(salted_right, [*on, "_salt"], how).drop("_salt")
    if how in ("left", "left_anti"):
        return joined.unionByName(left.where(~keyed), allowMissingColumns=True)
    return joined


def grid_joined(left: DataFrame, right: DataFrame, on: list[str], left_by: list[str], right_by: list[str], rows_per_split: int) -> DataFrame:
    """Inner join in which a key may be hot on both sides.

    A hot key gets a grid: its left rows are dealt to the lines by a hash of `left_by` and repeated for all columns, its
    right rows to the columns by a hash of `right_by` and repeated for all lines. So every pair of rows meets in one task, and no
    task gets more than about `rows_per_split` rows of a side. Keys with fewer rows have one task and no copies.
    """
    def counted(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy(*on).agg(F.count("*").alias(name)).where(F.col(name) > rows_per_split)

    def parts(name: str, other: str) -> Column:
        return F.coalesce(F.ceil(F.col(name) / rows_per_split), F.lit(1)).cast("int").alias(other)

    hot = counted(left, "_nl").join(counted(right, "_nr"), on, "full").select(*on, parts("_nl", "_lines"), parts("_nr", "_columns"))

    def dealt(df: DataFrame, by: list[str], own: str, across: str, own_salt: str, across_salt: str) -> DataFrame:
        known = df.join(hot, on, "left").withColumns({c: F.coalesce(c, F.lit(1)) for c in ("_lines", "_columns")})
        placed = known.withColumn(own_salt, F.pmod(F.xxhash64(*by), F.col(own)).cast("int"))
        return placed.withColumn(across_salt, F.explode(F.sequence(F.lit(0), F.col(across) - 1))).drop("_lines", "_columns")

    a = dealt(left, left_by, "_lines", "_columns", "_line", "_column")
    b = dealt(right, right_by, "_columns", "_lines", "_column", "_line")
    # Spark's estimate knows the size of the files, not that of the rows made from them; a large side would be broadcast.
    return a.join(b.hint("merge"), [*on, "_line", "_column"]).drop("_line", "_column")
