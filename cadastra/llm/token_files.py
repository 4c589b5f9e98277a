"""Token-id files: ids of whole documents in one row of blocks, document boundaries in Elias-Fano code.

A file set is a Parquet folder of blocks. A block holds some documents that follow each other in doc_id order: their
ids as one array of little-endian 16-bit (or, for large vocabularies, 32-bit) integers, and the offset of each
document in it (and the end) as an `EliasFano` structure instead of a table of 64-bit integers. `part` and `block`
give the order of blocks, `first` the ids before the block inside its part. A document is never split, so a block is
as large as BLOCK_IDS or its longest document.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadastra.llm.common import PIECE_BYTES, buffers, chunks, text_of
from cadastra.llm.elias_fano import EliasFano
from cadastra.llm.pieces import encoder

BLOCK_IDS = 1 << 17
SCHEMA = (
    "part int, block int, first long, n_ids long, id_bytes int, doc_ids array<long>, ids binary, "
    "ends_n long, ends_width int, ends_low binary, ends_high binary, ends_samples binary"
)
_ARROW = pa.schema([
    ("part", pa.int32()), ("block", pa.int32()), ("first", pa.int64()), ("n_ids", pa.int64()), ("id_bytes", pa.int32()),
    ("doc_ids", pa.list_(pa.int64())), ("ids", pa.binary()), ("ends_n", pa.int64()), ("ends_width", pa.int32()),
    ("ends_low", pa.binary()), ("ends_high", pa.binary()), ("ends_samples", pa.binary()),
])


def blocks(docs: DataFrame, vocabulary: str, end_id: int = 2) -> DataFrame:
    """The blocks of `docs` (doc_id, text), in ascending doc_id order over parts and blocks.

    Null texts count as empty and give `end_id` alone; a null doc_id comes first; repeated doc_ids are kept, in order of
    their texts. Other columns are left out. An empty table gives no block.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = encoder(vocabulary)
        wide = 2 if model.tokenizer.get_vocab_size() <= 1 << 16 else 4
        part, number, first, total = TaskContext.get().partitionId(), 0, 0, 0
        held: list[np.ndarray] = []
        docs_held: list[int | None] = []
        sizes: list[int] = []

        def block() -> pa.RecordBatch:
            ids = np.concatenate(held).astype(f"<u{wide}")
            ends = EliasFano.encode(np.concatenate([[0], np.cumsum(sizes)]))
            row = (part, number, first, len(ids), wide, list(docs_held), ids.tobytes(), ends.n, ends.width, ends.low, ends.high, ends.samples)
            return pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(row, _ARROW, strict=True)], schema=_ARROW)

        for batch in chunks(batches, "text", PIECE_BYTES):
            ids, at = model.encode(*buffers(batch.column("text")))
            for k, doc in enumerate(batch.column("doc_id").to_pylist()):
                held += [ids[at[k] : at[k + 1]], np.array([end_id])]
                docs_held.append(doc)
                sizes.append(int(at[k + 1] - at[k]) + 1)
                total += sizes[-1]
                if total >= BLOCK_IDS or len(sizes) >= 4096:
                    yield block()
                    number, first, total = number + 1, first + total, 0
                    held, docs_held, sizes = [], [], []
        if sizes:
            yield block()

    ordered = text_of(docs).repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    return ordered.mapInArrow(encode, SCHEMA)


def _ends(row: dict) -> EliasFano:
    return EliasFano(row["ends_n"], row["ends_width"], row["ends_low"], row["ends_high"], row["ends_samples"])


def document(row: dict, k: int) -> np.ndarray:
    """Ids of the k-th document of a block, found with two selects."""
    ends = _ends(row)
    ids = np.frombuffer(row["ids"], f"<u{row['id_bytes']}")
    return ids[ends.select(k) : ends.select(k + 1)]


def part_starts(files: DataFrame) -> DataFrame:
    """part and `before`, the ids of all parts before it.

    The sums of the parts come to the driver: one row for each output task of the write, whatever their size.
    """
    sums = sorted((r["part"], r["n"]) for r in files.groupBy("part").agg(F.sum("n_ids").alias("n")).collect())
    rows, before = [], 0
    for part, n in sums:
        rows.append((part, before))
        before += n
    return files.sparkSession.createDataFrame(rows, "part int, before long")


def read(files: DataFrame) -> DataFrame:
    """Documents of a file set: doc_id, start (ids before it), n_tokens, ids_crc32 (of its ids as 32-bit integers)."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = {name: batch.column(name)[k].as_py() for name in batch.schema.names}
                boundaries = _ends(row)
                ends = np.array([boundaries.select(k) for k in range(boundaries.n)], np.int64)
                ids = np.frombuffer(row["ids"], f"<u{row['id_bytes']}").astype("<u4")
                sums = [zlib.crc32(ids[a:b]) for a, b in zip(ends[:-1], ends[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["doc_ids"], pa.int64()), pa.array(ends[:-1] + row["before"] + row["first"]), pa.array(np.diff(ends)), pa.array(sums, pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    placed = files.join(F.broadcast(part_starts(files)), "part")
    return placed.mapInArrow(decode, "doc_id long, start long, n_tokens long, ids_crc32 long")
