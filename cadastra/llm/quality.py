"""Quality classifier: regularised quadratic discriminant analysis over transformed document statistics.

Each class has a Gaussian with its own covariance, shrunk towards its diagonal. A score is the logistic function of the
difference of the two Mahalanobis log-densities, from Cholesky factors that are made once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadastra.llm.common import buffers, chunks, text_of, written
from cadastra.llm.words import shingles, words_of

SHRINKAGE = 0.1
RIDGE = 1e-3
STATISTICS = (
    "words", "word_bytes", "distinct", "repeated", "repeated_runs", "upper", "digits", "symbols", "beyond_ascii", "stops",
    "commas", "short_words", "odd_endings", "bare_symbols", "line_words", "alarms",
)

_UPPER, _LETTER, _DIGIT, _SYMBOL, _STOP, _COMMA, _LINE, _ALARM, _HIGH = (1 << k for k in range(9))
_KIND = np.zeros(256, np.uint16)
_KIND[65:91] = _UPPER | _LETTER
_KIND[97:123] = _LETTER
_KIND[128:] = _LETTER | _HIGH
_KIND[48:58] = _DIGIT
_KIND[[ord(c) for c in "#$%&*+/<=>@\\^_`{|}~[]"]] = _SYMBOL
_KIND[[ord(c) for c in ".?"]] = _STOP
_KIND[[ord(c) for c in ",;:"]] = _COMMA
_KIND[ord("!")] = _ALARM
_KIND[10] = _LINE


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of transformed STATISTICS for each text (`data` and `offsets` as from `common.buffers`)."""
    n = len(offsets) - 1
    kind = _KIND[data]
    texts = np.diff(offsets)

    def count(mask: int) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum((kind & mask) != 0)])
        return np.diff(sums[offsets]).astype(float)

    words, starts, ends, doc = words_of(data, offsets)
    total = np.bincount(doc, minlength=n).astype(float)
    per_word = np.maximum(total, 1)

    def share(mask: np.ndarray) -> np.ndarray:
        return np.bincount(doc[mask], minlength=n) / per_word

    order = np.lexsort((words, doc))
    same = np.zeros(len(words), bool)
    same[1:] = (words[order][1:] == words[order][:-1]) & (doc[order][1:] == doc[order][:-1])
    distinct = 1 - np.bincount(doc[order][same], minlength=n) / per_word
    adjacent = np.zeros(len(words), bool)
    adjacent[1:] = (words[1:] == words[:-1]) & (doc[1:] == doc[:-1])
    grams, at = shingles(words, doc, 3)
    gram_doc = doc[at]
    order = np.lexsort((grams, gram_doc))
    again = np.zeros(len(grams), bool)
    again[1:] = (grams[order][1:] == grams[order][:-1]) & (gram_doc[order][1:] == gram_doc[order][:-1])
    runs = np.bincount(gram_doc[order][again], minlength=n) / np.maximum(total - 2, 1)
    lengths = ends - starts
    last = kind[np.maximum(ends - 1, 0)] if len(ends) else np.zeros(0, np.uint16)
    plain = np.concatenate([[0], np.cumsum((kind & (_LETTER | _DIGIT)) != 0)])
    bare = plain[ends] == plain[starts]
    bytes_ = np.maximum(texts, 1)
    letters = np.maximum(count(_LETTER), 1)
    return np.stack([
        np.log1p(total),
        np.log1p(np.bincount(doc, lengths, minlength=n) / per_word),
        distinct - np.minimum(1, 4 / np.sqrt(per_word)),
        np.sqrt(np.bincount(doc[adjacent], minlength=n) / per_word),
        np.sqrt(runs),
        np.sqrt(count(_UPPER) / letters),
        np.sqrt(count(_DIGIT) / bytes_),
        np.sqrt(count(_SYMBOL) / bytes_),
        np.sqrt(count(_HIGH) / letters),
        np.sqrt(count(_STOP) / per_word),
        np.sqrt(count(_COMMA) / per_word),
        share(lengths <= 2),
        np.sqrt(share((last & (_SYMBOL | _ALARM)) != 0)),
        np.sqrt(share(bare)),
        np.log1p(total / (1 + count(_LINE))),
        np.sqrt(count(_ALARM) / per_word),
    ], axis=1)


@dataclass(frozen=True)
class Discriminant:
    """Means, inverse Cholesky factors and constants of the two classes; None where a class has no rows."""

    means: np.ndarray
    factors: np.ndarray
    constants: np.ndarray

    def score(self, rows: np.ndarray) -> np.ndarray:
        """Probability of class 1 for each row of statistics."""
        logs = []
        for mean, factor, constant in zip(self.means, self.factors, self.constants, strict=True):
            logs.append(constant - 0.5 * (((rows - mean) @ factor.T) ** 2).sum(axis=1))
        return 1 / (1 + np.exp(-np.clip(logs[1] - logs[0], -500, 500)))


def fit(sums: dict[int, tuple[int, np.ndarray, np.ndarray]], shrinkage: float = SHRINKAGE) -> Discriminant | float:
    """The discriminant from counts, sums and sums of outer products by class; a constant score if a class is missing."""
    if not sums.get(0) or not sums.get(1):
        return 1.0 if sums.get(1) else 0.0 if sums.get(0) else 0.5
    means, factors, constants = [], [], []
    whole = sum(s[0] for s in sums.values())
    for k in (0, 1):
        n, total, outer = sums[k]
        mean = total / n
        cov = outer / n - np.outer(mean, mean)
        cov = (1 - shrinkage) * cov + shrinkage * np.diag(np.diag(cov)) + RIDGE * np.eye(len(mean))
        lower = np.linalg.cholesky(cov)
        means.append(mean)
        factors.append(np.linalg.inv(lower))
        constants.append(np.log(n / whole) - np.log(np.diag(lower)).sum())
    return Discriminant(np.stack(means), np.stack(factors), np.array(constants))


def held_out(doc_id: Column) -> Column:
    """Rows that no label is learned from: crc32 of the doc_id as text leaves 1 modulo 3."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1


def trained(docs: DataFrame, labels: DataFrame) -> tuple[Discriminant | float, DataFrame]:
    """The model, and the table of doc_id and `stats` of all documents.

    Statistics come from whole texts and are written once; the class sums come from all labelled rows that are not
    held out, one row from each task. Repeated labels of a document count once (the larger one); null labels are left
    out. Without labels of both classes the model is the one label known, or 0.5, as a constant score.
    """

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text"):
            rows = statistics(*buffers(batch.column("text")))
            flat = pa.FixedSizeListArray.from_arrays(pa.array(rows.ravel()), rows.shape[1]).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), flat], names=["doc_id", "stats"])

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = len(STATISTICS)
        state = {k: [0, np.zeros(m), np.zeros((m, m))] for k in (0, 1)}
        for batch in batches:
            rows = batch.column("stats").flatten().to_numpy().reshape(-1, m)
            label = batch.column("label").to_numpy()
            for k in (0, 1):
                own = rows[label == k]
                state[k][0] += len(own)
                state[k][1] += own.sum(axis=0)
                state[k][2] += own.T @ own
        for k, (n, total, outer) in state.items():
            if n:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k]), pa.array([n]), pa.array([total.tolist()]), pa.array([outer.ravel().tolist()])],
                    names=["label", "n", "total", "outer_sum"],
                )

    measured = written(text_of(docs).mapInArrow(measure, "doc_id long, stats array<double>"))
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("label"))
    known = known.where(F.col("label").isin(0, 1) & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("label").alias("label"))
    parts = measured.join(known, "doc_id").select("stats", F.col("label").cast("long").alias("label"))
    parts = parts.mapInArrow(sums, "label long, n long, total array<double>, outer_sum array<double>")
    merged = parts.groupBy("label").agg(
        F.sum("n").alias("n"),
        *[F.array(*[F.sum(F.col(c)[i]) for i in range(size)]).alias(c) for c, size in (("total", len(STATISTICS)), ("outer_sum", len(STATISTICS) ** 2))],
    )
    m = len(STATISTICS)
    rows = {r["label"]: (r["n"], np.array(r["total"]), np.array(r["outer_sum"]).reshape(m, m)) for r in merged.collect()}
    return fit(rows), measured


def _scores(model: Discriminant | float, rows: np.ndarray) -> np.ndarray:
    return np.full(len(rows), model) if isinstance(model, float) else model.score(rows)


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for each row of `docs`; see `trained`.

    Null and empty texts have the statistics of no words. Null doc_ids are scored too; other columns are left out.
    """
    model, measured = trained(docs, labels)

    @F.arrow_udf("double")
    def score(stats: pa.Array) -> pa.Array:
        return pa.array(_scores(model, stats.flatten().to_numpy().reshape(-1, len(STATISTICS))))

    result = measured.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), score("stats").alias("score"))
    return result.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of `docs`, with all their columns, whose score is 0.5 or more. Rows are judged where they are, unshuffled."""
    model, _ = trained(docs, labels)

    @F.arrow_udf("boolean")
    def keep(texts: pa.Array) -> pa.Array:
        batch = pa.RecordBatch.from_arrays([texts], names=["text"])
        parts = [_scores(model, statistics(*buffers(part.column("text")))) for part in chunks(iter([batch]), "text")]
        return pa.array(np.concatenate([np.zeros(0), *parts]) >= 0.5)

    return docs.where(keep(F.coalesce(F.col("text").cast("string"), F.lit(""))))
