"""Hard-negative mining by Kronecker-packed products.

The integer components of several candidates are made non-negative by a bias and put into separate fields of one wide
integer, for each dimension. One multiplication with an anchor's component then serves all fields, and the sums of the
fields, taken apart at the end, are exact scores. The carrier of the wide integer is a double where two fields fit
into its 53 exact bits, a 64-bit integer where one does, and else an integer of any length.

Anchors are taken in blocks of bounded size; each block makes two passes over all rows, one for the positives and one
for the negatives. A task keeps only the best rows of each anchor.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadastra.llm.blocks import Gathered, blocks
from cadastra.llm.common import written

SCALE = 256
#: Bytes of anchor vectors of one block.
ANCHOR_BYTES = 16_000_000
#: Components from here on are scored apart, so that a few of them don't slow down the others.
LARGE = float(1 << 24)
#: Scores beyond 64 bits count as this, with their sign.
MOST = (1 << 63) - 1
#: Fields of a wide integer of any length.
LONG_FIELDS = 16
_TILE = 1_024


def usable(table: DataFrame, vector: str = "embedding", scale: int = SCALE) -> DataFrame:
    """vec_id, label and `units`, the scaled vector, of the rows that take part.

    Rows with a null vec_id, label or vector, or a component that is null or not finite (also after scaling), are left
    out. Where vec_id is divisible by 7, the label becomes (label + 1) % 10.
    """
    id_ = F.col("vec_id").cast("long")
    label = F.col("label").cast("long")
    label = F.when(id_ % 7 == 0, (label + 1) % 10).otherwise(label)
    units = F.transform(F.col(vector).cast("array<double>"), lambda x: x * F.lit(float(scale)))
    rows = table.select(id_.alias("vec_id"), label.alias("label"), units.alias("units"))
    bad = F.exists("units", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("units").isNotNull() & ~bad)


def _whole(x: np.ndarray, exact: bool) -> np.ndarray:
    """Whole-valued doubles as integers of any length, or as 64-bit integers."""
    return x.astype(np.int64) if exact else np.array([[int(v) for v in row] for row in x], object).reshape(x.shape)


def products(anchors: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Exact inner products of all rows of two matrices of whole-valued doubles; beyond 64 bits `MOST` with its sign."""
    (m, size), n = anchors.shape, len(candidates)
    if size == 0 or m == 0 or n == 0:
        return np.zeros((m, n), np.int64)
    exact = size * float(np.abs(anchors).max()) * float(np.abs(candidates).max()) < 2.0**60
    exact &= max(float(np.abs(anchors).max()), float(np.abs(candidates).max())) * size < 2.0**60
    a, c = _whole(anchors, exact), _whole(candidates, exact)
    low_a, low_c = int(a.min()), int(c.min())
    x, y = a - low_a, c - low_c
    width = max(1, (int(x.sum(axis=1).max()) * int(y.max())).bit_length())
    if exact and 2 * width <= 53:
        fields, carrier = 53 // width, np.float64
    elif exact and width <= 63:
        fields, carrier = 63 // width, np.uint64
    else:
        fields, carrier, x, y = LONG_FIELDS, object, x.astype(object), y.astype(object)
    groups = -(-n // fields)
    padded = np.zeros((groups * fields, size), y.dtype)
    padded[:n] = y
    padded = padded.reshape(groups, fields, size)
    whole = object if carrier is object else np.uint64
    packed = np.zeros((groups, size), whole)
    for k in range(fields):
        packed += padded[:, k].astype(whole) << whole(width * k) if whole is np.uint64 else padded[:, k] * (1 << width * k)
    total = x.astype(carrier) @ packed.astype(carrier).T  # one multiplication for each anchor component and wide integer
    total = total.astype(whole)
    one = np.uint64 if whole is np.uint64 else int
    mask = one((1 << width) - 1)
    parts = np.stack([(total >> one(width * k)) & mask for k in range(fields)], axis=2).reshape(m, -1)[:, :n]
    parts = parts.astype(np.int64) if exact else parts
    scores = parts + low_c * a.sum(axis=1)[:, None] + low_a * c.sum(axis=1)[None, :] - size * low_a * low_c
    return scores if exact else np.clip(scores, -MOST, MOST).astype(np.int64)


class _Vectors:
    """Vectors of a batch or block, grouped by their length and by whether they have large components."""

    def __init__(self, units: pa.Array):
        offsets = units.offsets.to_numpy().astype(np.int64)
        flat = np.floor(units.values.slice(offsets[0], offsets[-1] - offsets[0]).to_numpy(zero_copy_only=False))
        offsets -= offsets[0]
        sizes = np.diff(offsets)
        most = np.zeros(len(sizes))
        filled = np.flatnonzero(sizes)
        if len(filled):
            most[filled] = np.maximum.reduceat(np.abs(flat), offsets[:-1][filled])
        self.groups: list[tuple[int, np.ndarray, np.ndarray]] = []
        for size in np.unique(sizes):
            for large in (False, True):
                at = np.flatnonzero((sizes == size) & ((most >= LARGE) == large))
                if len(at):
                    self.groups.append((int(size), at, flat[offsets[at][:, None] + np.arange(size)].reshape(len(at), int(size))))


class _Best:
    """The first `keep` of each slot by falling score, then by id, then by label; and the scores that still count."""

    def __init__(self, slots: int, keep: int):
        self.keep, self.least = keep, np.full(slots, -MOST, np.int64)
        self.rows = [np.zeros(0, np.int64) for _ in range(3)]
        self.new: list[tuple[np.ndarray, ...]] = []

    def add(self, slot: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        ok = scores >= self.least[slot]
        if ok.any():
            self.new.append((slot[ok], ids[ok], scores[ok]))
            if sum(len(x[0]) for x in self.new) > max(100_000, len(self.rows[0])):
                self.cut()

    def cut(self) -> list[np.ndarray]:
        slot, ids, scores = (np.concatenate([self.rows[k], *(x[k] for x in self.new)]) for k in range(3))
        order = np.lexsort((ids, -scores, slot))
        slot, ids, scores = slot[order], ids[order], scores[order]
        place = np.arange(len(slot)) - np.searchsorted(slot, slot)
        last = place == self.keep - 1
        self.least[slot[last]] = scores[last]
        self.rows, self.new = [x[place < self.keep] for x in (slot, ids, scores)], []
        return self.rows


class _Anchors:
    """A block of anchors inside a task: the scores of a batch of rows, a tile at a time."""

    def __init__(self, block: list[tuple[int, int, list[float]]]):
        self.ids = np.array([r[0] for r in block], np.int64)
        self.labels = np.array([r[1] for r in block], np.int64)
        self.vectors = _Vectors(pa.array([r[2] for r in block], pa.list_(pa.float64())))

    def scores(self, batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """Positions of anchors, ids and labels of rows, and their scores (a line for each anchor)."""
        for first in range(0, batch.num_rows, _TILE):
            part = batch.slice(first, _TILE)
            ids, labels = part.column("vec_id").to_numpy(), part.column("label").to_numpy()
            for size, at, rows in _Vectors(part.column("units")).groups:
                for own, where, matrix in self.vectors.groups:
                    for low in range(0, len(where) if own == size else 0, 2 * _TILE):
                        some = slice(low, low + 2 * _TILE)
                        yield where[some], ids[at], labels[at], products(matrix[some], rows)


def _positives(rows: DataFrame, block: list[tuple[int, int, list[float]]], count: int) -> DataFrame:
    """anchor (position in the block), place (from 1), positive_id, positive_score: the first rows of the same label."""
    shared = rows.sparkSession.sparkContext.broadcast(block)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = _Anchors(shared.value)
        best = _Best(len(anchors.ids), count)
        for batch in batches:
            for where, ids, labels, scores in anchors.scores(batch):
                ok = (labels[None, :] == anchors.labels[where][:, None]) & (ids[None, :] != anchors.ids[where][:, None])
                a, c = np.nonzero(ok & (scores >= best.least[where][:, None]))
                best.add(where[a], ids[c], scores[a, c])
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in best.cut()], names=["anchor", "positive_id", "positive_score"])

    found = rows.mapInArrow(find, "anchor long, positive_id long, positive_score long")
    order = Window.partitionBy("anchor").orderBy(F.desc("positive_score"), "positive_id")
    return found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= count)


def _negatives(rows: DataFrame, block: list[tuple[int, int, list[float]]], positives: dict[int, list[int]], count: int, low: int, high: int) -> DataFrame:
    """anchor, place, negative_id, negative_score, rank: the first rows of other labels for each positive."""
    slots = [(a, place, score) for a in range(len(block)) for place, score in enumerate(positives.get(a, []))]
    shared = rows.sparkSession.sparkContext.broadcast((block, slots))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, wanted = shared.value
        anchors = _Anchors(known)
        width = max([1 + place for _, place, _ in wanted], default=1)
        top = np.full((len(known), width), -MOST, np.int64)  # scores of an empty slot: none fits
        bottom = np.full((len(known), width), MOST, np.int64)
        for a, place, score in wanted:
            top[a, place] = min(MOST, high * score // 100)
            bottom[a, place] = max(-MOST, -(-low * score // 100))
        best = _Best(top.size, count)
        for batch in batches:
            for where, ids, labels, scores in anchors.scores(batch):
                least = np.maximum(bottom, best.least.reshape(top.shape))
                inside = (scores >= least[where].min(axis=1)[:, None]) & (scores <= top[where].max(axis=1)[:, None])
                a, c = np.nonzero(inside & (labels[None, :] != anchors.labels[where][:, None]))
                for place in range(width):
                    s = scores[a, c]
                    ok = (s >= least[where[a], place]) & (s <= top[where[a], place])
                    best.add(where[a[ok]] * width + place, ids[c[ok]], s[ok])
        slot, ids, scores = best.cut()
        yield pa.RecordBatch.from_arrays([pa.array(slot // width), pa.array(slot % width + 1), pa.array(ids), pa.array(scores)], names=["anchor", "place", "negative_id", "negative_score"])

    found = rows.mapInArrow(find, "anchor long, place long, negative_id long, negative_score long")
    order = Window.partitionBy("anchor", "place").orderBy(F.desc("negative_score"), "negative_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= count)


def mine(vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100) -> DataFrame:
    """anchor_id, positive_id, rank (from 1), negative_id, positive_score, negative_score.

    `vectors` is as from `usable`; scores are inner products of the floors of `units`. An anchor's positives are its
    first other rows of the same label, the negatives of a positive the first rows of other labels whose score is from
    `low` to `high` percent of the positive's. Higher scores come first, ties by smaller vec_id. All come out where
    there are fewer. Repeated rows are separate positives and negatives; an anchor's vec_id counts once, with its
    smallest label and vector, and rows with that vec_id are not its partners. Vectors of different lengths don't
    meet. Scores beyond 64 bits count as the largest such number. No rows or no anchors give an empty result.
    """
    spark = vectors.sparkSession
    rows = written(vectors)
    anchors = rows.where(is_anchor).groupBy("vec_id").agg(F.min(F.struct("label", "units")).alias("a")).select("vec_id", "a.*")
    nbytes = anchors.agg(F.sum(F.size("units") * 8 + 16)).first()[0] or 0
    ids = "anchor long, anchor_id long"
    out = Gathered(spark, "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    for some in blocks(anchors, "vec_id", nbytes, ANCHOR_BYTES):
        block = sorted((r["vec_id"], r["label"], r["units"]) for r in some)
        first = written(_positives(rows, block, positives))
        scores: dict[int, list[int]] = {}
        for r in first.orderBy("anchor", "place").collect():  # `positives` rows for each anchor of the block
            scores.setdefault(r["anchor"], []).append(r["positive_score"])
        found = _negatives(rows, block, scores, negatives, low, high)
        names = spark.createDataFrame([(k, r[0]) for k, r in enumerate(block)], ids)
        out.add(found.join(first, ["anchor", "place"]).join(names, "anchor").select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))
    return out.table()


#: The same as `mine` with the default parameters for ids divisible by 100, in DuckDB.
ORACLE = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS u FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND len([1 FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, CAST(list_inner_product(a.u, c.u) AS BIGINT) AS score
    FROM v a JOIN v c ON c.vec_id <> a.vec_id WHERE a.vec_id % 100 = 0),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
n AS (SELECT anchor_id, positive_id, s.vec_id AS negative_id, positive_score, s.score AS negative_score,
        CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank
    FROM p JOIN s USING (anchor_id) WHERE NOT s.same AND 80 * positive_score <= 100 * s.score AND 100 * s.score <= 100 * positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5
"""
