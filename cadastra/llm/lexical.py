"""Ranked lexical search: exact sparse inner products, found best-first in ball trees of documents.

A document is a sparse vector over the terms of the queries: its component for a term is (10^9 * tf) div (1000 * tf +
8 * m), where m grows with its length. A query's vector has the weight of each of its terms. Their inner product is the
score. Each task builds a ball tree over the vectors of a batch. A node has a centroid and a radius, so no document
below it scores more than q . centroid + |q| * radius, with q cut to the terms that the node has. Nodes are opened by
falling bounds until none reaches the query's k-th best score. Bounds are doubles, rounded up by more than the error
of their sums can be; scores at the leaves are integers.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F

from cadastra.llm.blocks import Gathered, blocks
from cadastra.llm.common import buffers, chunks, text_of, written
from cadastra.llm.words import LOWER, hashes, spans

#: Bytes of query texts of one block.
QUERY_BYTES = 1_000_000
LEAF_ROWS = 32
#: Components of all centroids of a tree.
TREE_CELLS = 4_000_000
_TERM = np.zeros(256, bool)
_TERM[128:] = True
_TERM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
#: Bytes of terms in lower case, space for all others.
FOLD = np.where(_TERM, LOWER, 32).astype(np.uint8)


class Vocabulary:
    """The distinct terms of a block of queries, found in texts by their hash and confirmed byte by byte."""

    def __init__(self, terms: list[bytes]):
        offsets = np.cumsum([0, *map(len, terms)])
        self.data = np.frombuffer(b"".join(terms), np.uint8)
        self.begin, self.size = offsets[:-1], np.diff(offsets)
        value = hashes(self.data, self.begin, offsets[1:])
        self.order = np.argsort(value, kind="stable")
        self.value = value[self.order]

    def find(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Index of the term that each slice of `data` is, -1 for other slices."""
        out = np.full(len(starts), -1, np.int64)
        if not len(self.value) or not len(starts):
            return out
        value = hashes(data, starts, ends)
        at = np.minimum(np.searchsorted(self.value, value), len(self.value) - 1)
        maybe = np.flatnonzero((self.value[at] == value) & (self.size[self.order[at]] == ends - starts))
        term = self.order[at[maybe]]
        for size in np.unique(self.size[term]):
            of = np.flatnonzero(self.size[term] == size)
            for low in range(0, len(of), max(1, 4_000_000 // int(size))):
                some = of[low : low + max(1, 4_000_000 // int(size))]
                step = np.arange(size)
                same = (data[starts[maybe[some]][:, None] + step] == self.data[self.begin[term[some]][:, None] + step]).all(axis=1)
                out[maybe[some[same]]] = term[some[same]]
        return out


def terms_of(text: str | None) -> set[bytes]:
    """Distinct terms of one text."""
    folded = FOLD[np.frombuffer((text or "").encode(), np.uint8)]
    return set(folded.tobytes().split(b" ")) - {b""}


def term_counts(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """doc_id, n (terms with repeats), terms (indexes of the vocabulary, ascending) and tfs, for each row of `docs`."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        size = max(1, len(known.value))
        for batch in chunks(batches, "text"):
            data, offsets = buffers(batch.column("text"))
            folded = FOLD[data]
            starts, ends, doc = spans(folded, offsets)
            term = known.find(folded, starts, ends)
            both, tf = np.unique((doc * size + term)[term >= 0], return_counts=True)
            edges = np.searchsorted(both, np.arange(batch.num_rows + 1) * size).astype(np.int32)
            n = np.bincount(doc, minlength=batch.num_rows)
            lists = [pa.ListArray.from_arrays(edges, pa.array((both % size).astype(np.int32))), pa.ListArray.from_arrays(edges, pa.array(tf))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n), *lists], names=["doc_id", "n", "terms", "tfs"])

    return text_of(docs).mapInArrow(count, "doc_id long, n long, terms array<int>, tfs array<long>")


def lengths(n: np.ndarray, documents: int, total: int) -> np.ndarray:
    """10 + (90 * n * documents) div total, in integers that don't overflow."""
    if int(n.max(initial=0)) * 90 * documents < 1 << 63:
        return 10 + 90 * documents * n // total
    return np.array([10 + 90 * documents * int(x) // total for x in n], np.int64)


class BallTree:
    """Non-negative sparse rows in a binary tree of balls; every row has at least one term."""

    def __init__(self, ptr: np.ndarray, terms: np.ndarray, values: np.ndarray, width: int):
        self.width = width
        self.ptr, self.terms, self.values = ptr, terms, values
        self.rows = np.arange(len(ptr) - 1)
        x = values.astype(np.float64)
        self.norm = np.add.reduceat(x * x, ptr[:-1])
        self.span: list[tuple[int, int]] = []
        self.children: list[tuple[int, int]] = []
        self.centroid: list[np.ndarray] = []
        self.radius: list[float] = []
        self._node(0, len(self.rows))
        sizes = np.diff(self.ptr)[self.rows]
        flat = self._flat(self.rows)
        self.ptr = np.r_[0, np.cumsum(sizes)]
        self.terms, self.values = self.terms[flat], self.values[flat]
        self.centres = np.array(self.centroid)
        self.radii = np.array(self.radius)
        del self.centroid, self.norm

    def _flat(self, rows: np.ndarray) -> np.ndarray:
        """Places of all components of some rows, row after row."""
        size = self.ptr[rows + 1] - self.ptr[rows]
        end = np.cumsum(size)
        return np.repeat(self.ptr[rows] - (end - size), size) + np.arange(end[-1])

    def _node(self, low: int, high: int) -> int:
        rows = self.rows[low:high]
        flat = self._flat(rows)
        terms, x = self.terms[flat], self.values[flat].astype(np.float64)
        begin = np.r_[0, np.cumsum(self.ptr[rows + 1] - self.ptr[rows])[:-1]]
        centre = np.bincount(terms, x, self.width) / len(rows)
        own = self.norm[rows]
        inner = np.add.reduceat(x * centre[terms], begin)
        apart = own - 2 * inner + centre @ centre
        # sums of up to 10^6 products have relative errors below 1e-9: the square is raised by that of all its parts
        square = apart + 1e-9 * (own + 2 * inner + centre @ centre)
        node = len(self.span)
        self.span.append((low, high))
        self.children.append((-1, -1))
        self.centroid.append(centre)
        self.radius.append(float(np.sqrt(max(0.0, square.max()))))
        if high - low <= LEAF_ROWS:
            return node
        far = self._dense(rows[int(np.argmax(apart))])
        other = self._dense(rows[int(np.argmax(own - 2 * np.add.reduceat(x * far[terms], begin)))])
        along = np.add.reduceat(x * (other - far)[terms], begin)
        middle = (high - low) // 2
        self.rows[low:high] = rows[np.argsort(along, kind="stable")]
        left = self._node(low, low + middle)
        self.children[node] = left, self._node(low + middle, high)
        return node

    def _dense(self, row: int) -> np.ndarray:
        out = np.zeros(self.width)
        part = slice(self.ptr[row], self.ptr[row + 1])
        out[self.terms[part]] = self.values[part]
        return out

    def bounds(self, terms: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """For each node a number that no inner product of a row below it exceeds."""
        part = self.centres[:, terms]
        cut = np.sqrt((part > 0) @ (weights * weights))
        return (part @ weights + cut * self.radii) * (1 + 1e-9) + 1

    def search(self, terms: np.ndarray, weights: np.ndarray, scratch: np.ndarray, best: Best, slot: int) -> int:
        """Put the rows that count into `best`; returns how many leaves were opened. `scratch` is all zeros."""
        bound = self.bounds(terms, weights.astype(np.float64))
        scratch[terms] = weights
        opened = 0
        heap = [(-bound[0], 0)]
        while heap:
            most, node = heapq.heappop(heap)
            if -most < best.least(slot):
                break
            left, right = self.children[node]
            if left >= 0:
                for child in (left, right):
                    heapq.heappush(heap, (max(most, -bound[child]), child))  # a child's bound is no higher than its parent's
                continue
            opened += 1
            low, high = self.span[node]
            a, b = self.ptr[low], self.ptr[high]
            scores = np.add.reduceat(scratch[self.terms[a:b]] * self.values[a:b], self.ptr[low:high] - a)
            best.offer(slot, scores, self.rows[low:high])
        scratch[terms] = 0
        return opened


class Best:
    """For each query the k best documents so far: higher scores first, then smaller ids, null ids last."""

    def __init__(self, slots: int, k: int):
        self.k = k
        self.kept: list[list[tuple[int, bool, int]]] = [[] for _ in range(slots)]
        self.ids: list[int | None] = []

    def least(self, slot: int) -> int:
        """Rows with lower scores don't count."""
        kept = self.kept[slot]
        return -kept[-1][0] if len(kept) == self.k else 1

    def offer(self, slot: int, scores: np.ndarray, rows: np.ndarray) -> None:
        at = np.flatnonzero(scores >= self.least(slot))
        if len(at):
            new = [(-int(scores[x]), self.ids[rows[x]] is None, self.ids[rows[x]] or 0) for x in at]
            self.kept[slot] = heapq.nsmallest(self.k, self.kept[slot] + new)


def _search(counts: DataFrame, items: list[tuple[int | None, np.ndarray, np.ndarray]], width: int, documents: int, total: int, k: int) -> DataFrame:
    """item_id, doc_id, score: the k best of each task and query. `items`: id, terms, weights."""
    shared = counts.sparkSession.sparkContext.broadcast(items)
    rows_of_tree = max(2 * LEAF_ROWS, TREE_CELLS // max(1, width) * LEAF_ROWS // 2)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        best, scratch = Best(len(known), k), np.zeros(width, np.int64)
        for batch in batches:
            for low in range(0, batch.num_rows, rows_of_tree):
                part = batch.slice(low, rows_of_tree)
                best.ids = part.column("doc_id").to_pylist()
                ptr = part.column("terms").offsets.to_numpy().astype(np.int64)
                terms = part.column("terms").values.to_numpy()[ptr[0] : ptr[-1]]
                at = part.column("tfs").offsets.to_numpy()
                tf = part.column("tfs").values.to_numpy()[at[0] : at[-1]]
                m = np.repeat(lengths(part.column("n").to_numpy(), documents, total), np.diff(ptr))
                tree = BallTree(ptr - ptr[0], terms, 1_000_000_000 * tf // (1000 * tf + 8 * m), width)
                for slot, (_, wanted, weights) in enumerate(known):
                    tree.search(wanted, weights, scratch, best, slot)
        out = [(known[slot][0], None if missing else id_, -score) for slot, kept in enumerate(best.kept) for score, missing, id_ in kept]
        columns = zip(*out, strict=True) if out else ([], [], [])
        yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in columns], names=["item_id", "doc_id", "score"])

    return counts.where(F.size("terms") > 0).mapInArrow(find, "item_id long, doc_id long, score long")


def _block(docs: DataFrame, some: list[Row], k: int) -> DataFrame | None:
    of: dict[int | None, set[bytes]] = {}
    for r in some:
        of.setdefault(r["item_id"], set()).update(terms_of(r["text"]))
    names = sorted(set().union(*of.values()))
    place = {t: n for n, t in enumerate(names)}
    counts = written(term_counts(docs, Vocabulary(names)))
    size = counts.agg(F.count(F.when(F.col("n") > 0, 1)).alias("documents"), F.sum("n").alias("total")).first()
    if not names or not size["documents"]:
        return None
    df = np.zeros(len(names), np.int64)
    for r in counts.select(F.explode("terms").alias("term")).groupBy("term").count().collect():  # one row for each term of the block
        df[r["term"]] = r["count"]
    weight = np.floor(1000 * np.log((2.0 * size["documents"] + 2) / (2.0 * df + 1))).astype(np.int64)
    items = []
    for id_, terms in of.items():
        at = np.array(sorted(place[t] for t in terms), np.int64)
        at = at[df[at] > 0]
        if len(at):
            items.append((id_, at, weight[at]))
    return _search(counts, items, len(names), size["documents"], size["total"], k)


def search(docs: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """item_id, rank (from 1), doc_id, score: the k documents with the highest scores above 0 for each item.

    `docs` has doc_id and text, `queries` item_id and text. Equal scores go by ascending doc_id, null ids last. Null
    and empty texts have no terms: such documents are not counted, such items have no rows. Repeated rows of documents
    are documents of their own; queries of one item_id are one item with the terms of all. Texts are read whole: a task
    holds about 40 bytes for each byte of its longest text. Queries go in blocks of `QUERY_BYTES` of text, each with one
    pass over all texts and one over their counts. Empty tables give an empty result.
    """
    spark = docs.sparkSession
    items = queries.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    nbytes = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    out = Gathered(spark, "item_id long, rank int, doc_id long, score long")
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    for some in blocks(items, "item_id", nbytes, QUERY_BYTES):
        found = _block(docs, some, k)
        if found is not None:
            out.add(found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score"))
    return out.table()


#: The same as `search` of `benchmark` in `documents` with the default parameters, in DuckDB.
ORACLE = r"""
WITH low AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM documents),
d AS (SELECT row_number() OVER () AS row, doc_id, t, len(t) AS n FROM low WHERE len(t) > 0),
sizes AS (SELECT count(*) AS documents, CAST(sum(n) AS BIGINT) AS total FROM d),
tf AS (SELECT row, term, count(*) AS tf FROM (SELECT row, unnest(t) AS term FROM d) GROUP BY row, term),
q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
w AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * documents + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
    FROM tf, sizes GROUP BY term, documents),
s AS (SELECT item_id, row, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * documents) // total)))) AS BIGINT) AS score
    FROM q JOIN tf USING (term) JOIN w USING (term) JOIN d USING (row), sizes GROUP BY item_id, row),
r AS (SELECT item_id, doc_id, score, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank
    FROM s JOIN d USING (row) WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 10
"""
