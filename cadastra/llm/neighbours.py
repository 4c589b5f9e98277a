"""Approximate nearest neighbours by inner product: an NN-descent graph over all vectors, searched greedily.

Equal vectors are one node. Nodes get one more component, which makes their norms equal; a query has zero there and
norm one, so that the nearest nodes to it are those of the largest inner product, whatever their norms. The first graph comes from blocks of random projections; NN-descent then joins each
node's neighbours, in both directions, with each other, round by round, as Spark joins. A query starts from its own
node's neighbours, the longest nodes and some others, and goes on from the best nodes not yet left until its beam has
none. Vectors travel in half precision; the results
are scored again on the original vectors in double precision.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadastra.llm.common import forget, hot_keys, spread_join, written


@dataclass(frozen=True)
class Graph:
    """Parameters: neighbours kept, projections, rows of a block, reverse neighbours joined, proposals of a join for a
    node, rounds at most and the share of changed neighbours that ends them; beam, nodes left at once and rounds of a
    search (None: until no node of the beam is open), entry nodes (as many of the longest as of any length).
    """

    neighbours: int = 32
    projections: int = 16
    block: int = 2_000
    reverse: int = 16
    proposals: int = 10
    rounds: int = 4
    settled: float = 0.03
    beam: int = 64
    leave: int = 12
    steps: int | None = None
    entries: int = 64


def usable(table: DataFrame, vector: str = "embedding") -> DataFrame:
    """vec_id and `v` (array of doubles) of the vectors that take part: no null, zero or non-finite ones, no null ids."""
    x = F.col("v")
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    clean = table.select(F.col("vec_id").cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v"))
    return clean.where(F.col("vec_id").isNotNull() & x.isNotNull() & ~bad & F.exists(x, lambda c: c != 0))


def _rows(column: pa.Array, width: int) -> np.ndarray:
    """Rows of doubles, shorter vectors filled with zeros."""
    sizes = column.value_lengths().to_numpy()
    flat = column.flatten().to_numpy()
    if (sizes == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(sizes), width))
    at = np.repeat(np.arange(len(sizes)), sizes)
    out[at, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def _half(column: pa.Array, width: int) -> np.ndarray:
    """Rows of a column of packed half-precision vectors, as single precision."""
    return np.frombuffer(b"".join(column.to_pylist()), np.float16).reshape(len(column), width).astype(np.float32)


def _ranked(df: DataFrame, by: str, order: list[Column], count: int) -> DataFrame:
    """The first `count` rows of each `by`; Spark cuts each task's share before the shuffle."""
    return df.withColumn("_at", F.row_number().over(Window.partitionBy(by).orderBy(*order))).where(F.col("_at") <= count).drop("_at")


def _lists(rows: DataFrame, count: int) -> DataFrame:
    """node and `near`, its `count` best ids, from rows of node, id and similarity (repeated ids count once)."""
    best = rows.groupBy("node", "id").agg(F.max("similarity").alias("similarity"), F.min("new").alias("new"))
    return _ranked(best, "node", [F.desc("similarity"), F.asc("id")], count)


def _projected(nodes: DataFrame, width: int, centre: np.ndarray, count: int, what: Graph) -> DataFrame:
    """Neighbours inside blocks: node, id, similarity. Every projection puts each node into one block.

    Nodes are sorted by the signs of random directions, then by one more direction; stretches of about `block` rows
    are compared. However alike the vectors are, no block is larger than twice that.
    """
    depth = max(0, min(40, int(np.ceil(np.log2(max(1, count) / what.block)))))

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes = np.random.default_rng(7).standard_normal((what.projections, depth + 1, width)).astype(np.float32)
        for batch in batches:
            rows = _half(batch.column("h"), width) - centre
            for p in range(what.projections):
                side = rows @ planes[p].T
                code = ((side[:, :depth] > 0) @ (1 << np.arange(depth, dtype=np.int64))) if depth else np.zeros(len(rows), np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(rows), p, np.int32)), pa.array(code), pa.array(side[:, depth]), batch.column("node"), batch.column("h")],
                    names=["projection", "code", "place", "node", "h"],
                )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def block(rows: list[tuple]) -> pa.RecordBatch:
            ids = np.array([r[1] for r in rows], np.int64)
            matrix = np.frombuffer(b"".join(r[2] for r in rows), np.float16).reshape(len(rows), width).astype(np.float32)
            keep = min(what.neighbours, len(rows) - 1)
            out = []
            for first in range(0, len(rows), 256):
                near = matrix[first : first + 256] @ matrix.T
                near[np.arange(len(near)), np.arange(first, first + len(near))] = -np.inf
                at = np.argpartition(-near, keep - 1, axis=1)[:, :keep]
                out.append((np.repeat(ids[first : first + 256], keep), ids[at].ravel(), np.take_along_axis(near, at, 1).ravel()))
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out, strict=True)], names=["node", "id", "similarity"])

        for batch in batches:
            key = list(zip(batch.column("projection").to_pylist(), batch.column("code").to_pylist(), strict=True))
            for k, node, h in zip(key, batch.column("node").to_pylist(), batch.column("h").to_pylist(), strict=True):
                if held and ((k != held[-1][0] and len(held) >= what.block // 2) or len(held) >= 2 * what.block or k[0] != held[-1][0][0]):
                    if len(held) > 1:
                        yield block(held)
                    held = []
                held.append((k, node, h))
        if len(held) > 1:
            yield block(held)

    parts = max(1, -(-count * what.projections // (2 * what.block)))
    rows = nodes.mapInArrow(spread, "projection int, code long, place float, node long, h binary")
    rows = rows.repartitionByRange(parts, "projection", "code", "place").sortWithinPartitions("projection", "code", "place", "node")
    return rows.mapInArrow(compare, "node long, id long, similarity float")


def _local_joins(graph: DataFrame, nodes: DataFrame, width: int, turn: int, what: Graph) -> DataFrame:
    """Proposals (node, id, similarity) from the neighbours of each node's neighbours."""
    forward = graph.select(F.col("node").alias("centre"), F.col("id").alias("member"))
    backward = _ranked(forward.select(F.col("member").alias("centre"), F.col("centre").alias("member")), "centre", [F.xxhash64("member", F.lit(turn)).asc()], what.reverse)
    own = nodes.select(F.col("node").alias("centre"), F.col("node").alias("member"))
    pairs = forward.unionAll(backward).unionAll(own).distinct()
    worst = graph.groupBy("node").agg(F.min("similarity").alias("worst"), F.count("*").alias("n"))
    worst = worst.select("node", F.when(F.col("n") < what.neighbours, float("-inf")).otherwise(F.col("worst")).cast("float").alias("worst"))
    members = nodes.join(worst, "node", "left").select(F.col("node").alias("member"), "h", F.coalesce("worst", F.lit(float("-inf")).cast("float")).alias("worst"))
    hot = hot_keys(pairs, ["member"])
    groups = spread_join(pairs, members, ["member"], ["centre"], hot).groupBy("centre").agg(F.collect_list(F.struct("member", "worst", "h")).alias("m"))

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("m")
            sizes, flat = column.value_lengths().to_numpy(), column.flatten()
            ids, worst = flat.field("member").to_numpy(), flat.field("worst").to_numpy()
            matrix = _half(flat.field("h"), width)
            edges = np.concatenate([[0], np.cumsum(sizes)])
            out: list[tuple] = []
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                near = matrix[a:b] @ matrix[a:b].T
                np.fill_diagonal(near, -np.inf)
                near[near <= worst[a:b, None]] = -np.inf
                keep = min(what.proposals, b - a)
                at = np.argpartition(-near, keep - 1, axis=1)[:, :keep]
                best = np.take_along_axis(near, at, 1)
                row, column_ = np.nonzero(best > -np.inf)
                out.append((ids[a:b][row], ids[a:b][at[row, column_]], best[row, column_]))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out, strict=True)], names=["node", "id", "similarity"])

    return groups.mapInArrow(join, "node long, id long, similarity float")


def build(nodes: DataFrame, width: int, what: Graph) -> DataFrame:
    """The neighbour graph of `nodes` (node, h): node, id, similarity, new."""
    sums = nodes.mapInArrow(lambda batches: _sum(batches, width), "total array<double>, n long").collect()  # one row a task
    count = sum(r["n"] for r in sums)
    centre = (np.sum([r["total"] for r in sums], axis=0) / max(1, count)).astype(np.float32) if sums else np.zeros(width, np.float32)
    first = _projected(nodes, width, centre, count, what).withColumn("new", F.lit(True))
    graph = written(_lists(first, what.neighbours))
    for turn in range(what.rounds):
        proposals = _local_joins(graph, nodes, width, turn, what).withColumn("new", F.lit(True))
        following = written(_lists(graph.withColumn("new", F.lit(False)).unionAll(proposals.select("node", "id", "similarity", "new")), what.neighbours))
        forget(graph)
        graph = following
        changed = graph.agg(F.avg(F.col("new").cast("double"))).first()[0]
        if changed is None or changed < what.settled:
            break
    return graph


def _sum(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    total, n = np.zeros(width), 0
    for batch in batches:
        total += _half(batch.column("h"), width).sum(axis=0)
        n += batch.num_rows
    if n:
        yield pa.RecordBatch.from_arrays([pa.array([total.tolist()]), pa.array([n])], names=["total", "n"])


def _similar(pairs: DataFrame, nodes: DataFrame, asking: DataFrame, width: int) -> DataFrame:
    """Add the inner product of `query` (with its direction `here` in `asking`) and `id` in half precision; the added component is left out."""

    @F.arrow_udf("float")
    def product(a: pa.Array, b: pa.Array) -> pa.Array:
        return pa.array(np.einsum("ij,ij->i", _half(a, width)[:, :-1], _half(b, width)[:, :-1]))

    there = spread_join(pairs, nodes.select(F.col("node").alias("id"), F.col("h").alias("there")), ["id"], ["query"], hot_keys(pairs, ["id"]))
    return there.join(asking, "query").select("query", "id", product("here", "there").alias("similarity"))


def greedy(queries: DataFrame, nodes: DataFrame, entries: DataFrame, graph: DataFrame, width: int, what: Graph) -> DataFrame:
    """query, id: the best nodes found for each of `queries` (query, a node each, and `here`), `beam` at most.

    A node that fell out of a beam is behind all of it and never comes back, so the search ends.
    """
    own = graph.select(F.col("node").alias("query"), "id").join(queries.select("query"), "query").unionAll(queries.select("query", F.col("query").alias("id")))
    start = written(own.unionAll(queries.select("query").crossJoin(F.broadcast(entries.select(F.col("node").alias("id"))))).distinct())
    best = [F.desc("similarity"), F.asc("id")]
    beam = written(_ranked(_similar(start, nodes, queries, width).withColumn("open", F.lit(True)), "query", best, what.beam))
    links = graph.select(F.col("node").alias("id"), F.col("id").alias("next"))
    for _ in itertools.count() if what.steps is None else range(what.steps):
        front = _ranked(beam.where("open"), "query", best, what.leave).select("query", "id")
        front = written(front)
        if front.isEmpty():
            break
        seen = beam.select("query", "id")
        further = spread_join(front, links, ["id"], ["query"], hot_keys(front, ["id"])).select("query", F.col("next").alias("id")).distinct()
        found = _similar(written(further.join(seen, ["query", "id"], "left_anti")), nodes, queries, width).withColumn("open", F.lit(True))
        left = beam.join(front.withColumn("left", F.lit(True)), ["query", "id"], "left")
        left = left.select("query", "id", "similarity", (F.col("open") & F.col("left").isNull()).alias("open"))
        following = written(_ranked(left.unionAll(found), "query", best, what.beam))
        forget(beam)
        beam = following
    return beam.select("query", "id")


def search(vectors: DataFrame, is_query: Column, k: int = 20, what: Graph = Graph()) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: near `k` rows of the largest inner product with each query row, but for its own.

    `vectors` is as from `usable`; every vector is in the graph. Ties go to smaller vec_id; all rows come out where
    there are fewer than `k` others. A repeated row counts once. Shorter vectors are filled up with zeros. No vectors or
    no queries give an empty result.
    """
    spark = vectors.sparkSession
    table = written(vectors.dropDuplicates(["vec_id"]).withColumn("asked", F.coalesce(is_query, F.lit(False))))
    facts = table.agg(F.max(F.size("v")).alias("width"), F.max(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)).alias("norm")).first()
    if facts["width"] is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    width, longest = facts["width"], float(np.sqrt(facts["norm"]))

    @F.arrow_udf("binary")
    def mark(column: pa.Array) -> pa.Array:
        return pa.array([xxhash.xxh3_128_digest((row + 0.0).tobytes()) for row in _rows(column, width)], pa.binary())

    @F.arrow_udf("binary")
    def half(column: pa.Array) -> pa.Array:
        rows = _rows(column, width) / longest
        rest = np.sqrt(np.maximum(0, 1 - (rows**2).sum(axis=1)))
        packed = np.concatenate([rows, rest[:, None]], axis=1).astype(np.float16)
        return pa.array([row.tobytes() for row in packed], pa.binary())

    @F.arrow_udf("binary")
    def direction(column: pa.Array) -> pa.Array:
        rows = _rows(column, width)
        rows = rows / np.abs(rows).max(axis=1)[:, None]
        packed = np.pad(rows / np.sqrt((rows**2).sum(axis=1))[:, None], ((0, 0), (0, 1))).astype(np.float16)
        return pa.array([row.tobytes() for row in packed], pa.binary())

    marked = written(table.withColumn("mark", mark("v")))
    # of equal vectors only the k + 1 smallest ids can be among the nearest; the smallest stands for all
    members = written(_ranked(marked.select("mark", "vec_id"), "mark", [F.asc("vec_id")], k + 1))
    reps = members.groupBy("mark").agg(F.min("vec_id").alias("node"))
    members = members.join(reps, "mark").select("node", "vec_id")
    nodes = written(marked.join(reps, (marked.vec_id == reps.node) & (marked.mark == reps.mark)).select("node", "v", half("v").alias("h")))
    light = nodes.select("node", "h")
    graph = build(light, width + 1, what)
    asked = marked.where("asked").select(F.col("vec_id").alias("query_id"), "mark")
    asked = written(spread_join(asked, reps, ["mark"], ["query_id"], hot_keys(asked, ["mark"])).select("query_id", F.col("node").alias("query")))
    length = F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)
    longest_nodes = nodes.orderBy(length.desc(), "node").select("node").limit(what.entries)
    entries = longest_nodes.unionAll(nodes.orderBy(F.xxhash64("node"), "node").select("node").limit(what.entries)).distinct()
    asking = nodes.join(asked.select(F.col("query").alias("node")).distinct(), "node").select(F.col("node").alias("query"), direction("v").alias("here"))
    found = greedy(written(asking), light, written(entries), graph, width + 1, what)

    @F.arrow_udf("double")
    def exact(a: pa.Array, b: pa.Array) -> pa.Array:
        return pa.array(np.einsum("ij,ij->i", _rows(a, width), _rows(b, width)))

    there, here = nodes.select(F.col("node").alias("id"), F.col("v").alias("there")), nodes.select(F.col("node").alias("query"), F.col("v").alias("here"))
    pairs = written(found)
    scored = spread_join(pairs, there, ["id"], ["query"], hot_keys(pairs, ["id"])).join(here, "query")
    scored = scored.select("query", "id", exact("here", "there").alias("score"))
    # `k` other rows of a query are among the best k + 1 nodes with their members
    scored = written(_ranked(scored, "query", [F.desc("score"), F.asc("id")], k + 1))
    rows = spread_join(scored.withColumnRenamed("id", "node"), members, ["node"], ["query"], hot_keys(scored.withColumnRenamed("id", "node"), ["node"]))
    rows = written(_ranked(rows, "query", [F.desc("score"), F.asc("vec_id")], k + 1).select("query", "vec_id", "score"))
    answers = spread_join(asked, rows, ["query"], ["query_id"], hot_keys(asked, ["query"])).where("vec_id <> query_id")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return answers.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
