"""Line deduplication: lines that many documents share stay in one of them only.

A line's key is the line without white space at its ends and with A-Z in lower case. Keys travel as 128-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadastra.llm.common import chunks, hot_keys, spread_join, text_of, written

MIN_CHARS = 20
MIN_DOCS = 3
_WHITE = b" \t\x0b\x0c\r\n"


def _keys(text: str, min_chars: int) -> list[bytes | None]:
    """Hash of each line's key, or None for a key under `min_chars` code points."""
    out: list[bytes | None] = []
    for line in text.encode().lower().split(b"\n"):  # bytes.lower changes A-Z only
        key = line.strip(_WHITE)
        if len(key) < min_chars or (not key.isascii() and len(key) < 4 * min_chars and len(key.decode()) < min_chars):
            out.append(None)
        else:
            out.append(xxhash.xxh3_128_digest(key))
    return out


def shared_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """doc_id and `lost`: the keys that a document must lose, for documents that lose any.

    A document counts once for a key, however often it or its row is repeated. Counts are combined before each
    shuffle; the join back to documents splits keys that very many documents hold.
    """

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text"):
            keys, owners = [], []
            for k, text in enumerate(batch.column("text").to_pylist()):
                own = set(_keys(text, min_chars)) - {None}
                keys += own
                owners += [k] * len(own)
            doc = batch.column("doc_id").take(pa.array(owners, pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), doc], names=["key", "doc_id"])

    held = written(text_of(docs).where("doc_id is not null").mapInArrow(explode, "key binary, doc_id long"))
    often = held.groupBy("key").agg(F.count_distinct("doc_id").alias("n"), F.max("doc_id").alias("keeper"))
    often = written(often.where(F.col("n") >= min_docs).drop("n"))
    pairs = spread_join(held, often, ["key"], ["doc_id"], hot_keys(held, ["key"]))
    return pairs.where("doc_id <> keeper").groupBy("doc_id").agg(F.collect_set("key").alias("lost"))


def _with_kept(docs: DataFrame, min_chars: int, min_docs: int) -> DataFrame:
    """`docs` and `_kept`: n_lines, n_dropped, kept_text."""
    lost = shared_lines(docs, min_chars, min_docs).select(F.col("doc_id").alias("_lost_doc"), F.col("lost").alias("_lost"))
    joined = docs.join(lost, F.col("doc_id").cast("long") == F.col("_lost_doc"), "left").drop("_lost_doc")

    @F.arrow_udf("struct<n_lines: bigint, n_dropped: bigint, kept_text: string>")
    def keep(texts: pa.Array, lost_keys: pa.Array) -> pa.Array:
        counts, dropped, kept = [], [], []
        for text, keys in zip(texts, lost_keys, strict=True):
            value = text.as_py() or ""
            lines = value.split("\n")
            counts.append(len(lines))
            if keys.is_valid:
                gone = set(keys.as_py())
                lines = [line for line, key in zip(lines, _keys(value, min_chars), strict=True) if key not in gone]
                value = "\n".join(lines)
            dropped.append(counts[-1] - len(lines))
            kept.append(value)
        return pa.StructArray.from_arrays(
            [pa.array(counts, pa.int64()), pa.array(dropped, pa.int64()), pa.array(kept, pa.string())], ["n_lines", "n_dropped", "kept_text"]
        )

    return joined.withColumn("_kept", keep("text", "_lost")).drop("_lost")


def drop_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """`docs` with the lines dropped from its texts; other columns stay, a null text becomes empty.

    Lines end at \\n; a null or empty text is one empty line. Keys of at least `min_chars` code points that at least
    `min_docs` documents hold lose all their lines except in the largest doc_id with the key. The lines that stay are
    joined by \\n. A document with a null doc_id shares no key with others and keeps its lines.
    """
    return _with_kept(docs, min_chars, min_docs).withColumn("text", F.col("_kept.kept_text")).select(*docs.columns)


def digests(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """doc_id, n_lines (before), n_dropped and the SHA-256 of the kept text, by the rules of `drop_lines`."""
    kept = _with_kept(text_of(docs), min_chars, min_docs).select("doc_id", "_kept.*")
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


#: The same as `digests` with the default parameters, in DuckDB.
ORACLE = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
s AS (SELECT doc_id, string_split(text, chr(10)) AS lines FROM d),
l AS (SELECT doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS pos FROM s),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
m AS (SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
j AS (SELECT k.doc_id, k.pos, k.line, m.keeper IS NOT NULL AND m.keeper <> k.doc_id AS gone FROM k LEFT JOIN m ON k.key = m.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM j GROUP BY doc_id
"""
