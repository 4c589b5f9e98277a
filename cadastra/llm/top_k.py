"""Exact top-k by inner product: global score histograms close in on each query's k-th score, then rows are filtered.

Queries are taken in blocks of bounded size; each block is scored against all rows, one pass for each step. Scores are
never shuffled, only histogram bins: from a task and query at most the bins that hold its k best.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadastra.llm.common import written

QUERY_BLOCK = 4_096
BINS = 1_024
_SAFE = float(1 << 53)
_LARGEST = (1 << 63) - 1


def integer_vectors(table: DataFrame, vector: str = "embedding", scale: int = 1024) -> DataFrame:
    """vec_id and `units`: floor(scale * x) of each component, in double precision, as packed 64-bit integers.

    Vectors that are null or hold null or non-finite components are left out, as are null ids. Vectors of another
    length than most are kept: they meet only vectors of their own length. A component beyond 64 bits counts as the
    64-bit number of a double that is nearest to it.
    """

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = []
            for x in batch.column("v"):
                with np.errstate(over="ignore"):
                    units = np.floor(scale * np.array(x.as_py(), np.float64))
                packed.append(np.clip(units, -(2.0**63 - 1024), 2.0**63 - 1024).astype("<i8").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(packed, pa.binary())], names=["vec_id", "units"])

    x = F.col("v")
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    clean = table.select(F.col("vec_id").cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v"))
    return clean.where(x.isNotNull() & F.col("vec_id").isNotNull() & ~bad).mapInArrow(convert, "vec_id long, units binary")


def _matrix(units: pa.Array) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Positions and integer rows of packed vectors, by their number of components."""
    sizes = np.array([len(u.as_buffer()) // 8 if u.is_valid else 0 for u in units])
    out = {}
    for size in np.unique(sizes):
        at = np.flatnonzero(sizes == size)
        out[int(size)] = at, np.frombuffer(b"".join(units[int(k)].as_py() for k in at), "<i8").reshape(len(at), int(size))
    return out


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products of all rows of `a` and `b`; in doubles where all partial sums are exact there.

    Rows with large components are taken by themselves, as Python integers where 64 bits may not do. A score beyond 64
    bits counts as the nearest one within, up to 2 ** 63 - 1 on either side.
    """
    width = max(1, a.shape[1])
    tops = [np.abs(x).max(axis=1, initial=0).astype(np.float64) for x in (a, b)]
    most = float(tops[0].max(initial=0)) * float(tops[1].max(initial=0)) * width
    if most < _SAFE:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    large = [top > np.sqrt(_SAFE / width) for top in tops]
    if any(x.any() and not x.all() for x in large):
        out = np.empty((len(a), len(b)), np.int64)
        for x in (large[0], ~large[0]):
            for y in (large[1], ~large[1]):
                if x.any() and y.any():
                    out[np.ix_(x, y)] = _products(a[x], b[y])
        return out
    if most < 2.0**62:
        return a @ b.T
    return np.clip(a.astype(object) @ b.astype(object).T, -_LARGEST, _LARGEST).astype(np.int64)


def _width(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Scores in a bin when [low, high] is divided evenly. The distance of two scores takes 64 bits without a sign."""
    return (high.view(np.uint64) - low.view(np.uint64)) // np.uint64(BINS) + np.uint64(1)


class _Block:
    """A block of queries inside a task: scores of a batch of candidates, with the query's own row left out."""

    def __init__(self, rows: list[tuple[int, bytes]]):
        self.ids = np.array([r[0] for r in rows], np.int64)
        self.by_size = _matrix(pa.array([r[1] for r in rows], pa.binary()))

    def scores(self, batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Query positions, candidate ids, scores (a row for each query), a few hundred candidates at a time."""
        for first in range(0, batch.num_rows, 512):
            part = batch.slice(first, 512)
            ids = part.column("vec_id").to_numpy()
            for size, (at, rows) in _matrix(part.column("units")).items():
                if size in self.by_size:
                    queries, matrix = self.by_size[size]
                    yield queries, ids[at], _products(matrix, rows)


def _histograms(candidates: DataFrame, block: list[tuple[int, bytes]], low: np.ndarray, high: np.ndarray, k: int) -> dict[int, tuple[int, int, int]]:
    """For each query (by position): the bounds of the bin with its k-th score, and how many scores are above it.

    Bins divide [low, high] of each query evenly. `k` counts from `high` down, so scores above `high` count first.
    """
    shared = candidates.sparkSession.sparkContext.broadcast((block, low, high))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, low, high = shared.value
        queries = _Block(rows)
        width = _width(low, high)
        bins = np.zeros((len(rows), BINS + 1), np.int64)  # the last bin is for scores above `high`
        for batch in batches:
            for at, ids, scores in queries.scores(batch):
                bin_ = ((scores.view(np.uint64) - low[at].view(np.uint64)[:, None]) // width[at][:, None]).astype(np.int64)
                bin_ = np.where(scores > high[at][:, None], BINS, bin_)
                ok = (scores >= low[at][:, None]) & (queries.ids[at][:, None] != ids[None, :])
                q, c = np.nonzero(ok)
                bins += np.bincount(at[q] * (BINS + 1) + bin_[q, c], minlength=bins.size).reshape(bins.shape)
        above = np.cumsum(bins[:, ::-1], axis=1)[:, ::-1] - bins
        q, b = np.nonzero((bins > 0) & (above < k))  # lower bins of this task cannot hold a k-th score
        yield pa.RecordBatch.from_arrays([pa.array(q), pa.array(b), pa.array(bins[q, b])], names=["q", "bin", "n"])

    counts = candidates.mapInArrow(count, "q long, bin long, n long").groupBy("q", "bin").agg(F.sum("n").alias("n"))
    above = F.sum("n").over(Window.partitionBy("q").orderBy(F.desc("bin")))
    found = counts.withColumn("upto", above).where((F.col("upto") >= k) & (F.col("upto") - F.col("n") < k))
    out = {}
    widths = _width(low, high).tolist()
    for r in found.collect():  # one row for each query of the block
        width = widths[r["q"]]
        start = int(low[r["q"]]) + r["bin"] * width
        out[r["q"]] = start, start + width - 1, r["upto"] - r["n"]
    return out


def _block_top_k(candidates: DataFrame, block: list[tuple[int, bytes]], reach: float, k: int) -> DataFrame:
    """query_id, rank, vec_id, score of one block of queries. `reach` bounds the norm of all candidates."""
    norms = np.array([np.sqrt((np.frombuffer(v, "<i8").astype(np.float64) ** 2).sum()) for _, v in block])
    edge = np.array([min(int(x) + 2, _LARGEST) for x in norms * reach * (1 + 1e-9)], np.int64)
    low, high = -edge, edge.copy()
    open_ = True
    while open_:
        found = _histograms(candidates, block, low, high, k)
        open_ = False
        for q in range(len(block)):
            if q not in found:
                continue  # fewer than k candidates: everything from `low` on counts
            start, end, _ = found[q]
            start, end = max(start, int(low[q])), min(end, int(high[q]))
            open_ |= end > start and (start, end) != (int(low[q]), int(high[q]))
            low[q], high[q] = start, end
        # after the last step low == high == the k-th score
    shared = candidates.sparkSession.sparkContext.broadcast((block, low))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, least = shared.value
        queries = _Block(rows)
        best: list[list[np.ndarray]] = [np.zeros(0, np.int64) for _ in range(3)]
        for batch in batches:
            for at, ids, scores in queries.scores(batch):
                q, c = np.nonzero((scores >= least[at][:, None]) & (queries.ids[at][:, None] != ids[None, :]))
                q_all = np.concatenate([best[0], at[q]])
                id_all, score_all = np.concatenate([best[1], ids[c]]), np.concatenate([best[2], scores[q, c]])
                order = np.lexsort((id_all, -score_all, q_all))  # a task keeps the k first of each query: ties go by id
                q_all, id_all, score_all = q_all[order], id_all[order], score_all[order]
                first = np.searchsorted(q_all, q_all)
                inside = np.arange(len(q_all)) - first < k
                best = [q_all[inside], id_all[inside], score_all[inside]]
        yield pa.RecordBatch.from_arrays([pa.array(queries.ids[best[0]]), pa.array(best[1]), pa.array(best[2])], names=["query_id", "vec_id", "score"])

    rows = candidates.mapInArrow(keep, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def search(vectors: DataFrame, is_query: Column, k: int = 10) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: each query row's `k` largest inner products with other rows.

    `vectors` is as from `integer_vectors`. A query's own row is no candidate of it. Ties go to smaller vec_id. All
    candidates come out where there are fewer than `k`. Repeated rows are separate candidates, and a repeated query
    counts once. No vectors or no queries give an empty result.
    """
    spark = vectors.sparkSession
    table = written(vectors)
    norm = table.mapInArrow(_norms, "norm double").agg(F.max("norm")).first()[0]
    queries = table.where(is_query).dropDuplicates(["vec_id"])
    numbered = written(queries.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(max(1, -(-queries.count() * 2 // QUERY_BLOCK))))))
    result = None
    for n in sorted(r["block"] for r in numbered.select("block").distinct().collect()):
        block = sorted((r["vec_id"], bytes(r["units"])) for r in numbered.where(F.col("block") == n).collect())
        found = written(_block_top_k(table, block, norm, k))
        result = found if result is None else result.unionAll(found)
    return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long") if result is None else result


def _norms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, rows in _matrix(batch.column("units")).values():
            yield pa.RecordBatch.from_arrays([pa.array(np.sqrt((rows.astype(np.float64) ** 2).sum(axis=1)))], names=["norm"])


#: The same as `search` of all vectors with the default parameters for ids divisible by 100, in DuckDB.
ORACLE = """
WITH v AS (SELECT vec_id, [CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS u FROM embeddings
    WHERE embedding IS NOT NULL AND len([1 FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(CAST(q.u AS DOUBLE[]), CAST(c.u AS DOUBLE[])) AS BIGINT) AS score
    FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 100 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""
