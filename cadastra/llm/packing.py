"""Best-fit packing of token sequences: a configuration linear program over the histogram of lengths.

The variables are patterns (how many pieces of each length share a sequence). Multiplicative weights solve the
program: lengths have weights, the best pattern for them comes from a knapsack dynamic program, and the lengths that
it covers lose weight. The pattern counts are rounded down; pieces left over go, longest first, to the fullest
sequence with room. All of this works on counts of at most `capacity` lengths. Pieces then find their place from their
length and their rank among the pieces of that length.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cadastra.llm.common import PIECE_BYTES, buffers, chunks, text_of, written
from cadastra.llm.pieces import encoder

CAPACITY = 1024
ROUNDS = 8
RATE = 1.0


def cut(docs: DataFrame, vocabulary: str, end_id: int = 2, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of each document: doc_id, piece, start, length, ids_crc32, with `part` and `local` for ranks.

    A longer document is cut into pieces of `capacity` ids; the first one takes what is over. Null texts count as
    empty: one piece with the end id. `local` counts the pieces of the same length that the same task made before.
    Repeated rows are separate documents. Other columns are left out; an empty table gives no piece.
    """

    def tokenize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, part, made = encoder(vocabulary), TaskContext.get().partitionId(), [0] * (capacity + 1)
        for batch in chunks(batches, "text", PIECE_BYTES):
            ids, at = model.encode(*buffers(batch.column("text")))
            rows: list[tuple] = []
            for k, doc in enumerate(batch.column("doc_id").to_pylist()):
                own = np.append(ids[at[k] : at[k + 1]], end_id).astype("<u4")
                edges = [0, *range(len(own) % capacity or capacity, len(own) + 1, capacity)]
                for piece, (a, b) in enumerate(zip(edges, edges[1:], strict=False)):
                    rows.append((doc, piece, a, b - a, zlib.crc32(own[a:b]), part, made[b - a]))
                    made[b - a] += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _PIECE_TYPES, strict=True)], names=_PIECE_NAMES
            )

    return text_of(docs).mapInArrow(tokenize, "doc_id long, piece int, start long, length long, ids_crc32 long, part int, local long")


_PIECE_NAMES = ["doc_id", "piece", "start", "length", "ids_crc32", "part", "local"]
_PIECE_TYPES = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]


def _price(lengths: np.ndarray, values: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Unbounded knapsack for every room up to `capacity`: the best sum of values, and the piece to take first (or -1)."""
    best, choice = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    fits = np.searchsorted(lengths, np.arange(capacity + 1), side="right")
    for room in range(1, capacity + 1):
        best[room] = best[room - 1]
        if fits[room]:
            total = best[room - lengths[: fits[room]]] + values[: fits[room]]
            k = int(total.argmax())
            if total[k] > best[room]:
                best[room], choice[room] = total[k], k
    return best, choice


def _pattern(first: int, room: int, lengths: list[int], choice: list[int]) -> dict[int, int]:
    """Length `first` and the best filling of the `room` beside it, by indices of lengths."""
    counts = {first: 1}
    while room > 0:
        k = choice[room]
        if k < 0:
            room -= 1
        else:
            counts[k] = counts.get(k, 0) + 1
            room -= lengths[k]
    return counts


def plan(histogram: dict[int, int], capacity: int = CAPACITY, rounds: int = ROUNDS) -> list[tuple[int, dict[int, int]]]:
    """Groups of equal sequences for a histogram of lengths: how many, and how many pieces of each length in one.

    Each round prices all lengths by their weights with one knapsack, and covers an equal share of what is left of
    each length, longest first, with the best pattern that holds it. Weights of covered lengths fall, so the lengths
    that lag behind are worth more in the next round.
    """
    lengths = np.array(sorted(x for x, n in histogram.items() if n > 0), np.int64)
    whole = np.array([histogram[int(x)] for x in lengths], np.int64)
    if not len(lengths):
        return []
    need, rest, weights = whole.astype(float), whole.astype(float).tolist(), np.ones(len(lengths))
    sizes = lengths.tolist()
    uses: dict[tuple, float] = {}
    for step in range(rounds):
        live = [k for k in range(len(sizes)) if rest[k] > 1e-9 * whole[k]]
        if not live:
            break
        _, chosen = _price(lengths[live], (weights * lengths)[live], capacity)
        choice = [live[k] if k >= 0 else -1 for k in chosen.tolist()]
        before = np.array(rest)
        for k in reversed(live):
            pattern = _pattern(k, capacity - sizes[k], sizes, choice)
            share = min(before[k] / (rounds - step) / pattern[k], min(rest[i] / n for i, n in pattern.items()))
            if share > 0:
                for i, n in pattern.items():
                    rest[i] = max(0.0, rest[i] - share * n)
                key = tuple(sorted(pattern.items()))
                uses[key] = uses.get(key, 0.0) + share
        weights *= np.exp(-RATE * (before - rest) / need)
        weights /= weights.max()
    left = whole.copy()
    groups: list[tuple[int, dict[int, int]]] = []
    for key, amount in sorted(uses.items(), key=lambda x: (-x[1], x[0])):
        count = min(int(amount), *(int(left[k]) // n for k, n in key))
        if count > 0:
            for k, n in key:
                left[k] -= count * n
            groups.append((count, {sizes[k]: n for k, n in key}))
    return _fill(groups, dict(zip(sizes, left.tolist(), strict=True)), capacity)


def _fill(groups: list[tuple[int, dict[int, int]]], left: dict[int, int], capacity: int) -> list[tuple[int, dict[int, int]]]:
    """Place the pieces left over, longest first, each into the fullest sequence with room, or into a new one."""
    by_room: dict[int, list[tuple[int, dict[int, int]]]] = {}
    for count, content in groups:
        by_room.setdefault(capacity - sum(x * n for x, n in content.items()), []).append((count, content))
    for length in sorted(left, reverse=True):
        todo = left[length]
        while todo:
            room = min((r for r, g in by_room.items() if r >= length and g), default=None)
            count, content = by_room[room].pop() if room is not None else (-(-todo // (capacity // length)), {})
            room = capacity if room is None else room
            each = min(room // length, max(1, todo // count))
            used = min(count, todo // each)
            if used < count and content:
                by_room[room].append((count - used, content))
            todo -= used * each
            by_room.setdefault(room - each * length, []).append((used, content | {length: content.get(length, 0) + each}))
    return [g for _, rest in sorted(by_room.items()) for g in rest]


def places(groups: list[tuple[int, dict[int, int]]]) -> dict[int, tuple[np.ndarray, ...]]:
    """For each length, stretches of ranks: first rank, first sequence, pieces in a sequence, offset of the first."""
    table: dict[int, list[tuple[int, int, int, int]]] = {}
    filled: dict[int, int] = {}
    sequence = 0
    for count, content in groups:
        offset = 0
        for length in sorted(content, reverse=True):
            each = content[length]
            table.setdefault(length, []).append((filled.get(length, 0), sequence, each, offset))
            filled[length] = filled.get(length, 0) + count * each
            offset += each * length
        sequence += count
    return {length: tuple(np.array(c, np.int64) for c in zip(*rows, strict=True)) for length, rows in table.items()}


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add sequence_id and offset to the pieces of `cut` (a written table, so that `part` and `local` stay as they are).

    Only the histogram of at most `capacity` lengths comes to the driver; the plan sent back is as small. The ranks of
    a task's pieces begin after those of the tasks before it, from sums per task and length.
    """
    counts = written(pieces.groupBy("part", "length").agg(F.count("*").alias("n")))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    table = pieces.sparkSession.sparkContext.broadcast(places(plan(histogram, capacity)))
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("part", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for x in np.unique(length):
                at = np.flatnonzero(length == x)
                first, base, each, start = table.value[int(x)]
                k = np.searchsorted(first, rank[at], side="right") - 1
                inside = rank[at] - first[k]
                sequence[at] = base[k] + inside // each[k]
                offset[at] = start[k] + inside % each[k] * x
            kept = [batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sequence), pa.array(offset)], names=[*_PIECE_NAMES[:5], "sequence_id", "offset"])

    ranked = pieces.join(before, ["part", "length"]).withColumn("rank", F.col("before") + F.col("local")).drop("before", "part", "local")
    return ranked.mapInArrow(place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
