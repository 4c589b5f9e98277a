"""Toxicity: a logistic classifier with a counterfactual penalty.

In labelled texts that name a group, the name is exchanged for another one; the classifier pays for every change of
its score. So naming a group raises no score, and neutral mentions are not taken for attacks.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadastra.llm.common import buffers, chunks, text_of, written
from cadastra.llm.words import LOWER, hashes, words_of

#: At most so many labelled rows are learned from, those with the smallest hash of their doc_id.
SAMPLE = 16_000
BUCKETS = 1 << 22
FEATURES = 4_096
SUPPORT = 5
PREFIXES = (5, 6, 7)
PENALTY = 1.0
RIDGE = 1e-3
STEPS = 400
IDENTITY_TERMS = (
    "women", "men", "muslims", "christians", "jews", "hindus", "buddhists", "atheists", "immigrants", "refugees", "gays",
    "lesbians", "africans", "asians", "europeans", "mexicans", "arabs", "blacks", "whites", "elders", "teenagers",
)
_EDGES = b".,;:!?\"'()[]{}*$%&#"


def _trimmed(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word spans without punctuation at their ends."""
    mark = np.zeros(256, bool)
    mark[list(_EDGES)] = True
    starts, ends = starts.copy(), ends.copy()
    for _ in range(4):
        starts += mark[data[np.minimum(starts, len(data) - 1)]] & (starts < ends)
        ends -= mark[data[np.maximum(ends - 1, 0)]] & (starts < ends)
    return starts, ends


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of each text's words and of their first 5, 6 and 7 bytes, and the text index of each."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    _, starts, ends, doc = words_of(data, offsets)
    starts, ends = _trimmed(data, starts, ends)
    solid = starts < ends
    starts, ends, doc = starts[solid], ends[solid], doc[solid]
    low = LOWER[data]
    out, owner = [hashes(low, starts, ends)], [doc]
    for size in PREFIXES:
        long = ends - starts >= size
        out.append(hashes(low, starts[long], starts[long] + size) + np.uint64(size))
        owner.append(doc[long])
    return (np.concatenate(out) >> np.uint64(64 - 22)).astype(np.int64), np.concatenate(owner)


def swapped(text: str, terms: tuple[str, ...] = IDENTITY_TERMS) -> str:
    """`text` with every identity term exchanged for the next one of the list."""
    follow = dict(zip(terms, (*terms[1:], terms[0]), strict=True))
    pattern = re.compile(r"\b(" + "|".join(map(re.escape, terms)) + r")\b", re.IGNORECASE)
    return pattern.sub(lambda m: follow[m[0].lower()], text)


def train(
    rows: list[list[int]], changed: list[list[int] | None], labels: np.ndarray, size: int, penalty: float = PENALTY
) -> tuple[np.ndarray, float]:
    """Weights and bias from the features present in each text, and in its swapped form where it names a group.

    Minimises the mean logistic loss (both classes weighing the same), a ridge, and `penalty` times the mean squared
    change of the linear score between a text and its swapped form.
    """

    def sparse(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
        return np.repeat(np.arange(len(lists)), [len(x) for x in lists]), np.array([i for x in lists for i in x], np.int64)

    n = len(rows)
    row, column = sparse(rows)
    pairs = [(a, b) for a, b in zip(rows, changed, strict=True) if b is not None]
    row_a, column_a = sparse([sorted(set(a) - set(b)) for a, b in pairs])
    row_b, column_b = sparse([sorted(set(b) - set(a)) for a, b in pairs])
    weight = np.where(labels == 1, n / 2 / max(1, labels.sum()), n / 2 / max(1, n - labels.sum())) / n
    def change_of(v: np.ndarray) -> np.ndarray:
        """What the swap changes in each pair's score; a pair may have no feature that differs."""
        own = np.bincount(row_a, v[column_a], minlength=len(pairs)).astype(float)
        return own - np.bincount(row_b, v[column_b], minlength=len(pairs))

    def curved(v: np.ndarray, v_bias: float) -> tuple[np.ndarray, float]:
        """The largest curvature that the objective can have, times a vector."""
        bend = weight * (np.bincount(row, v[column], minlength=n) + v_bias) / 4
        out = np.bincount(column, bend[row], minlength=size) + RIDGE * v
        if pairs:
            bent = 2 * penalty / len(pairs) * change_of(v)
            out += np.bincount(column_a, bent[row_a], minlength=size) - np.bincount(column_b, bent[row_b], minlength=size)
        return out, float(bend.sum())

    v, v_bias, most = np.ones(size), 1.0, 1.0
    for _ in range(30):  # power iteration: the step must be shorter than one over the largest curvature
        v, v_bias = curved(v, v_bias)
        most = max(float(np.sqrt(v @ v + v_bias**2)), 1e-12)
        v, v_bias = v / most, v_bias / most
    w, bias = np.zeros(size), 0.0
    momentum, momentum_bias = w.copy(), bias
    rate = 0.8 / most
    for step in range(STEPS):
        score = np.bincount(row, momentum[column], minlength=n) + momentum_bias
        error = weight * (1 / (1 + np.exp(-np.clip(score, -50, 50))) - labels)
        slope = np.bincount(column, error[row], minlength=size) + RIDGE * momentum
        if pairs:
            change = 2 * penalty / len(pairs) * change_of(momentum)
            slope += np.bincount(column_a, change[row_a], minlength=size) - np.bincount(column_b, change[row_b], minlength=size)
        new, new_bias = momentum - rate * slope, momentum_bias - rate * error.sum()
        follow = step / (step + 3)
        momentum, momentum_bias = new + follow * (new - w), new_bias + follow * (new_bias - bias)
        w, bias = new, new_bias
    return w, bias


def held_out(doc_id: Column) -> Column:
    """Rows that no label is learned from: crc32 of the doc_id as text is divisible by 5."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def _sample(docs: DataFrame, labels: DataFrame, sample: int) -> DataFrame:
    """Text and label of at most `sample` labelled documents that are not held out. The bound makes the broadcast safe."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("label"))
    known = known.where(F.col("label").isin(0, 1) & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("label").alias("label"))
    some = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    return text_of(docs).join(F.broadcast(some), "doc_id").select("text", "label")


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, terms: tuple[str, ...] = IDENTITY_TERMS) -> tuple[np.ndarray, float]:
    """Weights by bucket and the bias.

    Two passes over the sampled texts: counts of documents by bucket and class choose the FEATURES buckets that
    tell most (chi-square, at least SUPPORT documents); then each text comes as the list of these it has.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros((2, BUCKETS), np.int32)
        texts = [0, 0]
        for batch in chunks(batches, "text"):
            bucket, doc = features(*buffers(batch.column("text")))
            label = batch.column("label").to_numpy()
            pair = np.unique(doc * BUCKETS + bucket)
            for k in (0, 1):
                texts[k] += int((label == k).sum())
                own = pair[label[pair // BUCKETS] == k] % BUCKETS
                seen[k] += np.bincount(own, minlength=BUCKETS).astype(np.int32)
        used = np.flatnonzero(seen.sum(axis=0))
        parts = [np.append(used, -1), *(np.append(seen[k][used], texts[k]) for k in (0, 1))]
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in parts], names=["bucket", "n0", "n1"])

    taken = written(_sample(docs, labels, sample))
    counts = taken.mapInArrow(count, "bucket long, n0 long, n1 long").groupBy("bucket").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    counts = written(counts.where((F.col("n0") + F.col("n1") >= SUPPORT) | (F.col("bucket") < 0)))
    totals = counts.where("bucket < 0").first()
    table = np.zeros(BUCKETS)
    if totals is None or not totals["n0"] or not totals["n1"]:
        return table, 0.0 if totals is None or totals["n0"] == totals["n1"] else 50.0 if totals["n1"] else -50.0
    t0, t1 = float(totals["n0"]), float(totals["n1"])
    gap = F.col("n1") / t1 - F.col("n0") / t0
    rate = (F.col("n0") + F.col("n1")) / (t0 + t1)
    best = counts.where("bucket >= 0").withColumn("gain", gap * gap / (rate * (1.0001 - rate)))
    chosen = np.array([r["bucket"] for r in best.orderBy(F.desc("gain"), "bucket").limit(FEATURES).collect()], np.int64)
    index = {int(b): k for k, b in enumerate(chosen)}
    pattern = "|".join(map(re.escape, terms))

    def present(texts: pa.Array) -> list[list[int]]:
        bucket, doc = features(*buffers(texts))
        out: list[set[int]] = [set() for _ in range(len(texts))]
        hit = np.isin(bucket, chosen)
        for d, b in zip(doc[hit].tolist(), bucket[hit].tolist(), strict=True):
            out[d].add(index[b])
        return [sorted(x) for x in out]

    def list_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        named = re.compile(rf"\b({pattern})\b", re.IGNORECASE)
        for batch in chunks(batches, "text"):
            texts = batch.column("text").to_pylist()
            at = [k for k, t in enumerate(texts) if terms and named.search(t)]
            other: list[list[int] | None] = [None] * len(texts)
            for k, x in zip(at, present(pa.array([swapped(texts[k], terms) for k in at], pa.string())), strict=True):
                other[k] = x
            kind = pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array(present(batch.column("text")), kind), pa.array(other, kind), batch.column("label")], names=["own", "other", "label"]
            )

    rows = taken.mapInArrow(list_features, "own array<int>, other array<int>, label int").collect()  # at most `sample` rows
    rows.sort(key=lambda r: (r["own"], r["label"]))
    w, bias = train([r["own"] for r in rows], [r["other"] for r in rows], np.array([r["label"] for r in rows]), len(chosen))
    table[chosen] = w
    return table, bias


def scored(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, terms: tuple[str, ...] = IDENTITY_TERMS) -> DataFrame:
    """doc_id, held_out, score, predicted for each row of `docs`, from whole texts.

    A score adds the weight of each bucket that a text has. Null and empty texts get the score of the bias. Repeated
    labels of a document count once (the larger one); null labels and other columns are left out. Without labels of
    both classes every score is the one label known, or 0.5.
    """
    table, bias = fit(docs, labels, sample, terms)
    used = np.flatnonzero(table)
    shared = docs.sparkSession.sparkContext.broadcast((used, table[used]))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = np.zeros(BUCKETS)
        weights[shared.value[0]] = shared.value[1]
        for batch in chunks(batches, "text"):
            bucket, doc = features(*buffers(batch.column("text")))
            hit = weights[bucket] != 0
            pair = np.unique(doc[hit] * BUCKETS + bucket[hit])
            total = np.bincount(pair // BUCKETS, weights[pair % BUCKETS], minlength=batch.num_rows) + bias
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(1 / (1 + np.exp(-np.clip(total, -500, 500))))], names=["doc_id", "score"])

    result = text_of(docs).mapInArrow(score, "doc_id long, score double")
    return result.select(
        "doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )
