"""MinHash near-duplicates: one-permutation hashing with optimal densification, banded buckets, star-shaped candidates.

Texts with the same set of shingles form a class, and only one row of a class goes on. A bucket gives one candidate
pair for each member (with a centre), not all pairs. Pairs are confirmed on full sets. Where a bucket still holds
several components, later rounds choose other centres; where it does so after the last round, a prefix-filtered join
on the members' rarest shingles decides what is left.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadastra.llm.common import buffers, chunks, components, forget, hot_keys, spread_join, text_of, written
from cadastra.llm.words import mixed, shingles, words_of


@dataclass(frozen=True)
class Near:
    """What counts as near: `percent` of the union of two sets of `size`-word shingles is shared."""

    size: int = 5
    percent: int = 80
    bands: int = 36
    rows: int = 7
    rounds: int = 5

    @property
    def bins(self) -> int:
        return self.bands * self.rows


def sets_of(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text in ascending order, and the text index of each.

    A text with fewer than `size` words has its whole sequence as its one shingle, a text without words none.
    """
    words, _, _, doc = words_of(data, offsets)
    value, at = shingles(words, doc, size)
    owner = doc[at]
    count = np.bincount(doc, minlength=len(offsets) - 1)
    for k in range(1, size):
        short, first = shingles(words, doc, k)
        whole = count[doc[first]] == k
        value = np.concatenate([value, mixed(short[whole], k)])
        owner = np.concatenate([owner, doc[first][whole]])
    order = np.lexsort((value, owner))
    value, owner = value[order], owner[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
    return value[new], owner[new]


@lru_cache
def _detours(bins: int) -> np.ndarray:
    """For each bin, the order in which other bins are asked for a value when it is empty; the same for all texts."""
    tries = np.arange(bins * bins, dtype=np.uint64).reshape(bins, bins)
    return np.argsort(mixed(tries, 77), axis=1)


def signatures(value: np.ndarray, owner: np.ndarray, texts: int, bins: int) -> np.ndarray:
    """One row of `bins` minima for each text with a set: each hash falls into one bin; empty bins borrow."""
    scrambled = mixed(value, 5)
    at = (scrambled >> np.uint64(32)) * np.uint64(bins) >> np.uint64(32)
    table = np.full(texts * bins, np.iinfo(np.uint64).max, np.uint64)
    np.minimum.at(table, owner * bins + at.astype(np.int64), mixed(value, 6))
    table = table.reshape(texts, bins)
    empty = table == np.iinfo(np.uint64).max
    row, column = np.nonzero(empty & ~empty.all(axis=1)[:, None])
    out, detours = table.copy(), _detours(bins)
    for step in range(bins):
        if not len(row):
            break
        source = detours[column, step]
        found = ~empty[row, source]
        out[row[found], column[found]] = table[row[found], source[found]]
        row, column = row[~found], column[~found]
    return out


def _band_keys(table: np.ndarray, near: Near) -> np.ndarray:
    grid = table.reshape(len(table), near.bands, near.rows)
    key = np.broadcast_to(np.arange(near.bands, dtype=np.uint64), grid.shape[:2]).copy()
    with np.errstate(over="ignore"):
        for k in range(near.rows):
            key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + grid[:, :, k], 9)
    return key.view(np.int64)


def sketches(docs: DataFrame, near: Near) -> DataFrame:
    """doc_id, n_shingles, mark (128-bit hash of the set, null without words), keys (one bucket key for each band)."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text"):
            value, owner = sets_of(*buffers(batch.column("text")), near.size)
            edges = np.searchsorted(owner, np.arange(batch.num_rows + 1))
            marks = [xxhash.xxh3_128_digest(value[a:b].tobytes()) if b > a else None for a, b in zip(edges[:-1], edges[1:], strict=True)]
            keys = _band_keys(signatures(value, owner, batch.num_rows, near.bins), near)
            lists = pa.FixedSizeListArray.from_arrays(pa.array(keys.ravel()), near.bands).cast(pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.diff(edges)), pa.array(marks, pa.binary()), lists], names=["doc_id", "n_shingles", "mark", "keys"]
            )

    return text_of(docs).mapInArrow(sketch, "doc_id long, n_shingles long, mark binary, keys array<long>")


def _full_sets(docs: DataFrame, size: int) -> DataFrame:
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text"):
            value, owner = sets_of(*buffers(batch.column("text")), size)
            edges = np.searchsorted(owner, np.arange(batch.num_rows + 1))
            packed = [value[a:b].tobytes() for a, b in zip(edges[:-1], edges[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(packed, pa.binary())], names=["doc_id", "members"])

    return docs.mapInArrow(build, "doc_id long, members binary")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose full sets share `percent` of their union. A centre with very many pairs is split."""

    @F.arrow_udf("boolean")
    def near(left: pa.Array, right: pa.Array) -> pa.Array:
        out = []
        for x, y in zip(left, right, strict=True):
            p, q = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
            both = len(np.intersect1d(p, q, assume_unique=True))
            out.append(100 * both >= percent * (len(p) + len(q) - both))
        return pa.array(out, pa.bool_())

    a, b = (sets.select(F.col("doc_id").alias(x), F.col("members").alias(f"set_{x}")) for x in "ab")
    joined = spread_join(pairs.join(b, "b"), a, ["a"], ["b"], hot_keys(pairs, ["a"]))
    return joined.where(near("set_a", "set_b")).select("a", "b")


def _prefixes(held: DataFrame, percent: int) -> DataFrame:
    """doc_id, component, size, token, at: the rarest shingles of each set, as many as near sets cannot miss each other in.

    `held`: doc_id, component, members. Shingles are ordered by the number of sets that hold them, then by value; `at`
    is the place in that order. Two sets that are near share one of their first size - ceil(percent * size) + 1. What
    only one set holds comes first and meets nothing, so it is counted, not listed.
    """

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "members"):
            data, offsets = buffers(batch.column("members"))
            size = np.diff(offsets) // 8
            columns = [np.repeat(batch.column("doc_id").to_numpy(), size), np.frombuffer(data.tobytes(), np.int64)]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=["doc_id", "token"])

    tokens = written(held.mapInArrow(explode, "doc_id long, token long"))
    often = written(tokens.groupBy("token").agg(F.count("*").alias("_n")).where("_n > 1"))
    shared = spread_join(tokens, often, ["token"], ["doc_id"], hot_keys(tokens, ["token"], counts=often))
    lists = shared.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("_n", "token"))).alias("list"))
    sized = held.select("doc_id", "component", (F.octet_length("members") / 8).cast("long").alias("size")).join(lists, "doc_id")
    alone = F.col("size") - F.size("list")
    first = F.col("size") - F.ceil(F.col("size") * percent / F.lit(100)) + 1
    sized = sized.withColumn("alone", alone).withColumn("list", F.slice("list", 1, F.greatest(first - alone, F.lit(0)).cast("int")))
    rows = sized.select("doc_id", "component", "size", "alone", F.posexplode("list").alias("k", "x"))
    out = written(rows.select("doc_id", "component", "size", "x.token", (F.col("alone") + F.col("k")).alias("at")))
    forget(tokens, often)
    return out


def _rest(now: DataFrame, tried: DataFrame | None, sets: DataFrame, hot: DataFrame, percent: int) -> DataFrame:
    """Near pairs (a, b) of different components, of all members of buckets that still hold several components.

    A set-similarity join: two sets meet only at a shingle of both their prefixes, where their sizes and what is left
    behind that shingle still allow `percent`. A shingle whose holders are one component, and a set that the smallest
    holder already rules out, are left out before the join; so the members of a template that are not near each other
    are not paired. Shingles that many prefixes hold are split. `now`: doc_id, n_shingles, key, component.
    """
    keys = now.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count("*").alias("n"))
    keys = keys.where("lo <> hi and n > 2").select("key")  # of two members the first round tried the pair
    left = spread_join(now, keys, ["key"], ["doc_id"], hot).select("doc_id", "component").distinct()
    held = written(left.join(sets, "doc_id"))
    rows = _prefixes(held, percent)

    def possible(behind: Column, size: Column, other: Column) -> Column:
        return behind * (100 + percent) >= (size + other) * percent

    stats = rows.groupBy("token").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.min("size").alias("least"))
    stats = written(stats.where("lo <> hi").select("token", "least"))
    many = written(hot_keys(rows, ["token"]))
    kept = spread_join(rows, stats, ["token"], ["doc_id"], many).where(possible(F.col("size") - F.col("at"), F.col("size"), F.col("least"))).drop("least")
    kept = written(kept)
    x, y = (kept.select("token", *(F.col(c).alias(f"{c}_{side}") for c in ("doc_id", "component", "size", "at"))) for side in "xy")
    met = spread_join(x, y, ["token"], ["doc_id_x"], written(hot_keys(kept, ["token"])))
    behind = F.least(F.col("size_x") - F.col("at_x"), F.col("size_y") - F.col("at_y"))
    met = met.where((F.col("doc_id_x") < F.col("doc_id_y")) & (F.col("component_x") != F.col("component_y")) & possible(behind, F.col("size_x"), F.col("size_y")))
    pairs = met.select(F.col("doc_id_x").alias("a"), F.col("doc_id_y").alias("b")).distinct()
    pairs = written(pairs if tried is None else pairs.join(tried, ["a", "b"], "left_anti"))
    found = written(_confirmed(pairs, sets, percent))
    forget(held, rows, stats, many, kept, pairs)
    return found


def links(docs: DataFrame, reps: DataFrame, near: Near) -> DataFrame:
    """Confirmed pairs (a, b) of class representatives. `reps`: doc_id, n_shingles, keys.

    Round by round, every bucket with several components (at first every row is one) names a centre, the member that
    comes first in an order that changes with the round, and pairs it with its members of other components. Pairs
    that the sizes of the sets rule out, and pairs tried before, are not read again. All rounds together try at most
    `rounds` pairs for each row of a bucket. What they leave open is decided by `_rest`.
    """
    rows = written(reps.select("doc_id", "n_shingles", F.explode("keys").alias("key")))
    shared = rows.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").drop("n")
    hot = written(hot_keys(rows, ["key"]))
    members = written(spread_join(rows, shared, ["key"], ["doc_id"], hot))
    forget(rows)
    ids = members.select("doc_id").distinct()
    sets = written(_full_sets(text_of(docs).dropDuplicates(["doc_id"]).join(ids, "doc_id"), near.size))
    found = tried = None
    labels: DataFrame | None = None

    def labelled() -> DataFrame:
        if labels is None:
            return members.withColumn("component", F.col("doc_id"))
        named = members.join(labels, members.doc_id == labels.node, "left").drop("node")
        return named.withColumn("component", F.coalesce("component", "doc_id"))

    for turn in range(near.rounds):
        now = labelled()
        order = F.struct((F.col("doc_id") if turn == 0 else F.xxhash64("doc_id", F.lit(turn))).alias("turn"), F.col("doc_id").alias("centre"), F.col("component").alias("own"), F.col("n_shingles").alias("size"))
        centres = now.groupBy("key").agg(F.min(order).alias("c"), F.min("component").alias("lo"), F.max("component").alias("hi"))
        centres = centres.where("lo <> hi").select("key", "c.centre", "c.own", "c.size")
        stars = spread_join(now, centres, ["key"], ["doc_id"], hot).where("component <> own")
        fits = F.least("size", "n_shingles") * 100 >= F.greatest("size", "n_shingles") * near.percent
        pairs = stars.where(fits).select(F.least("centre", "doc_id").alias("a"), F.greatest("centre", "doc_id").alias("b")).distinct()
        pairs = written(pairs if tried is None else pairs.join(tried, ["a", "b"], "left_anti"))
        if pairs.isEmpty():
            if turn > 1:
                break
            continue
        edges = written(_confirmed(pairs, sets, near.percent))
        tried = pairs if tried is None else tried.unionAll(pairs)
        found = edges if found is None else found.unionAll(edges)
        labels = written(components(found))
    last = _rest(written(labelled()), tried, sets, hot, near.percent)
    forget(sets)
    return last if found is None else found.unionAll(last)


def groups(docs: DataFrame, near: Near = Near()) -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest doc_id reachable over links), kept (doc_id = component_id).

    Null and empty texts, and texts of white space, have no shingles and are linked with nothing. Rows with a null
    doc_id are left out; a repeated row counts once for links and comes out as often as it is there; other columns
    are left out.
    """
    table = written(sketches(docs.where("doc_id is not null"), near))
    classes = table.where("mark is not null").groupBy("mark").agg(F.min("doc_id").alias("rep"))
    classes = written(classes)
    reps = table.join(classes, (table.doc_id == classes.rep) & (table.mark == classes.mark)).select("doc_id", "n_shingles", "keys")
    found = links(docs, reps.dropDuplicates(["doc_id"]), near)
    labels = components(found.select("a", "b"))
    named = classes.join(labels, classes.rep == labels.node, "left").select("mark", F.coalesce("component", "rep").alias("component_id"))
    full = table.where("mark is not null").select("doc_id", "n_shingles", "mark")
    joined = spread_join(full, named, ["mark"], ["doc_id"], hot_keys(full, ["mark"])).drop("mark")
    empty = table.where("mark is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    result = joined.select("doc_id", "n_shingles", "component_id").unionAll(empty)
    return result.withColumn("kept", F.col("doc_id") == F.col("component_id"))
