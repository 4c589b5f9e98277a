"""SimHash near-duplicates: Golay-code keys of fingerprint halves, buckets, and links confirmed on whole fingerprints.

A fingerprint has four quarters of 16 bits. At three differing bits or fewer one quarter is equal (pigeonhole), and one
half of the other 48 bits differs in one bit at most. Both of these make a key: the equal quarter, and the index of a
code word near the half. The binary Golay code is perfect: each 23-bit word is within three bits of exactly one code
word. A row asks under its nearest code word and is entered under all code words within four bits, so two halves that
differ in one bit always meet. Equal fingerprints are one row throughout.

Buckets of up to `HEAVY` fingerprints are joined. Larger ones are never paired: their fingerprints meet at words a bit
or two away (see `_meeting`), whose number does not depend on the size of the bucket.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadastra.llm.common import buffers, chunks, components, forget, hot_keys, spread_join, text_of, written
from cadastra.llm.words import LOWER, SPACE, spans

SEED = 42
BITS = 3
#: Fingerprints of a bucket that are compared in pairs.
HEAVY = 64
#: The generator polynomial of the binary Golay code (a fixed value).
GENERATOR = 0b110001110101
_BYTE_FIELDS = (np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little")).view(np.uint64).ravel()


def shingle_hashes(data: np.ndarray, offsets: np.ndarray, size: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """XXH64 of each run of `size` words of each text, joined by one space, repeats included; and the text's index.

    A text with fewer words has its whole sequence as one run, a text without words none.
    """
    low = LOWER[data]
    starts, ends, doc = spans(low, offsets)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    keep = ~SPACE[low]
    spaced = ends[ends < len(low)]
    spaced = spaced[~keep[spaced]]  # the byte after a word stands for the space
    low[spaced] = 32
    keep[spaced] = True
    place = np.zeros(len(low) + 1, np.int64)
    np.cumsum(keep, out=place[1:])
    packed = low[keep].tobytes()
    first = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
    last = np.repeat(np.r_[first[1:], len(doc)] - 1, np.diff(np.r_[first, len(doc)]))
    at = np.arange(len(doc))
    is_first = np.zeros(len(doc), bool)
    is_first[first] = True
    at = at[(at + size - 1 <= last) | is_first]
    left, right = place[starts[at]].tolist(), place[ends[np.minimum(at + size - 1, last[at])]].tolist()
    digest = xxhash.xxh64_intdigest
    values = np.fromiter((digest(packed[a:b], SEED) for a, b in zip(left, right, strict=True)), np.uint64, len(at))
    return values, doc[at]


def majority(values: np.ndarray, owner: np.ndarray, texts: int) -> np.ndarray:
    """For each text the bits that over half of its values have set; 0 for a text without values."""
    out = np.zeros(texts, np.uint64)
    if not len(values):
        return out
    first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
    count = np.diff(np.r_[first, len(owner)])
    parts = -(-count // 255)  # eight one-byte counters in a 64-bit sum hold 255 values
    begin = np.cumsum(np.r_[0, parts[:-1]])
    cuts = np.repeat(first, parts) + 255 * (np.arange(parts.sum()) - np.repeat(begin, parts))
    sums = np.empty((len(cuts), 64), np.uint8)
    octets = values.view(np.uint8).reshape(-1, 8)
    for k in range(8):
        sums[:, 8 * k : 8 * k + 8] = np.add.reduceat(_BYTE_FIELDS[octets[:, k]], cuts).view(np.uint8).reshape(-1, 8)
    total = np.add.reduceat(sums.astype(np.int64), begin, axis=0)
    bits = np.packbits(2 * total > count[:, None], axis=1, bitorder="little")
    out[owner[first]] = bits.reshape(-1, 8).view(np.uint64).ravel()
    return out


def fingerprints(docs: DataFrame, size: int = 3) -> DataFrame:
    """doc_id and `f`, the 64-bit fingerprint, for each row of `docs`."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text"):
            values, owner = shingle_hashes(*buffers(batch.column("text")), size)
            f = majority(values, owner, batch.num_rows).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(f)], names=["doc_id", "f"])

    return text_of(docs).mapInArrow(sketch, "doc_id long, f long")


class Golay:
    """The (23, 12) Golay code: the code words near 23-bit words, by table."""

    def __init__(self) -> None:
        rest = np.arange(1 << 12, dtype=np.int64) << 11
        for k in range(22, 10, -1):
            rest = np.where(rest >> k & 1, rest ^ (GENERATOR << (k - 11)), rest)
        self.parity = rest  # of the 12 message bits
        errors = np.array([sum(1 << k for k in c) for n in range(5) for c in combinations(range(23), n)], np.int64)
        weight = np.array([n for n in range(5) for _ in combinations(range(23), n)])
        syndrome = self.syndrome(errors)
        self.nearest = np.zeros(1 << 11, np.int64)
        self.nearest[syndrome[weight <= 3]] = errors[weight <= 3]
        four = np.flatnonzero(weight == 4)
        four = four[np.argsort(syndrome[four], kind="stable")]
        self.others = np.full((1 << 11, 5), -1, np.int64)  # a word three bits off has five code words four bits off
        found, begin = np.unique(syndrome[four], return_index=True)
        self.others[found] = errors[four[begin[:, None] + np.arange(5)]]

    def syndrome(self, words: np.ndarray) -> np.ndarray:
        return words & 0x7FF ^ self.parity[words >> 11]

    def decode(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the nearest code word, and of the five that are four bits off (-1 where there are none)."""
        s = self.syndrome(words)
        others = self.others[s]
        return (words ^ self.nearest[s]) >> 11, np.where(others < 0, -1, (words[:, None] ^ others) >> 11)


def keys_of(f: np.ndarray, code: Golay) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket keys (31 bits) of fingerprints, the fingerprint's index, and whether the row asks under its key too."""
    quarters = [(f >> np.uint64(16 * k)).astype(np.int64) & 0xFFFF for k in range(4)]
    keys, rows, asks = [], [], []
    every = np.arange(len(f))
    for k in range(4):
        a, b, c = (quarters[x] for x in range(4) if x != k)
        rest = a | b << 16 | c << 32
        for half in range(2):
            near, others = code.decode(rest >> 24 * half & 0x7FFFFF)
            base = (2 * k + half) << 28 | quarters[k] << 12
            keys.append(base | near)
            rows.append(every)
            asks.append(np.ones(len(f), bool))
            row, column = np.nonzero(others >= 0)
            keys.append(base[row] | others[row, column])
            rows.append(row)
            asks.append(np.zeros(len(row), bool))
    return np.concatenate(keys).astype(np.int32), np.concatenate(rows), np.concatenate(asks)


def _bucket_rows(distinct: DataFrame) -> DataFrame:
    """key, f, asks: about 42 rows for each fingerprint."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = Golay()
        for batch in batches:
            f = batch.column("f").to_numpy().view(np.uint64)
            for low in range(0, len(f), 4096):
                key, row, asks = keys_of(f[low : low + 4096], code)
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(f[low + row].view(np.int64)), pa.array(asks)], names=["key", "f", "asks"])

    return distinct.select("f").mapInArrow(emit, "key int, f long, asks boolean")


def _edge(a: str, b: str) -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


#: All words with one bit set, and all with two.
ONE_BIT = "transform(sequence(0, 63), i -> shiftleft(1L, i))"
TWO_BITS = "flatten(transform(sequence(0, 62), i -> transform(sequence(i + 1, 63), j -> shiftleft(1L, i) | shiftleft(1L, j))))"


def _meeting(near: DataFrame, far: DataFrame | None) -> DataFrame:
    """Links (a, b) of fingerprints that meet at a word.

    Each `f` of `near` goes to the words at most one bit away, each `f` of `far` to those two bits away too. At a word
    with a fingerprint at most one bit off, all fingerprints there are linked with the smallest such: they differ
    in three bits at most. So fingerprints of `near` two bits apart are joined, and those of `near` and `far` (which
    is part of `near`) three bits apart. A word has at most 65 fingerprints one bit off and 2,016 two bits off.
    """
    rows = near.select("f", F.explode(F.expr(f"concat(array(0L), {ONE_BIT})")).alias("x")).select(F.col("f").bitwiseXOR(F.col("x")).alias("word"), "f", F.lit(True).alias("close"))
    if far is not None:
        two = far.select("f", F.explode(F.expr(TWO_BITS)).alias("x")).select(F.col("f").bitwiseXOR(F.col("x")).alias("word"), "f", F.lit(False).alias("close"))
        rows = rows.unionAll(two)
    words = rows.groupBy("word").agg(F.min(F.when(F.col("close"), F.col("f"))).alias("centre"), F.collect_list("f").alias("all"), F.count("*").alias("n"))
    stars = words.where("n > 1 and centre is not null").select("centre", F.explode("all").alias("f")).where("centre <> f")
    return stars.select(*_edge("centre", "f")).distinct()


def links(distinct: DataFrame) -> DataFrame:
    """Pairs (a, b) of fingerprints that join all that are linked: the components of the pairs are those of the links.

    `distinct`: column f, each fingerprint once.
    """
    rows = written(_bucket_rows(distinct))
    counts = rows.groupBy("key").agg(F.count("*").alias("n"), F.max("asks").alias("asked")).where("n > 1 and asked").drop("asked")
    counts = written(counts)
    members = written(spread_join(rows, counts, ["key"], ["f"], hot_keys(rows, ["key"], counts=counts.withColumnRenamed("n", "_n"))))
    forget(rows, counts)
    light = members.where(F.col("n") <= HEAVY)
    left = light.where("asks").select("key", F.col("f").alias("g"))
    pairs = left.join(light.select("key", "f"), "key").where((F.col("f") != F.col("g")) & (F.bit_count(F.col("f").bitwiseXOR(F.col("g"))) <= BITS))
    found = written(pairs.select(*_edge("f", "g")).distinct())
    heavy = written(members.where(F.col("n") > HEAVY).select("key", "f"))
    forget(members)
    if heavy.isEmpty():
        return found
    everyone = heavy.select("f").distinct()
    found = written(found.unionAll(_meeting(everyone, None)))
    labels = written(components(found))
    named = heavy.join(labels, heavy.f == labels.node, "left").select("key", "f", F.coalesce("component", "f").alias("component"))
    parts = named.groupBy("key", "component").agg(F.count("*").alias("n"))
    several = parts.groupBy("key").agg(F.max(F.struct("n", "component")).alias("main"), F.count("*").alias("parts")).where("parts > 1")
    several = written(several.select("key", F.col("main.component").alias("main")))
    if several.isEmpty():
        return found
    left_open = written(named.join(several, "key").groupBy("f").agg(F.max(F.col("component") != F.col("main")).alias("other")))
    return written(found.unionAll(_meeting(left_open.select("f"), left_open.where("other").select("f"))))


def groups(docs: DataFrame, size: int = 3) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id: the smallest doc_id reachable over links of at most three
    differing bits.

    Null and empty texts and texts of white space have fingerprint zero and are linked like others. A repeated row
    comes out as often as it is there, each row of a repeated doc_id with the fingerprint of its own text. Rows with a
    null doc_id link others and come out; their component_id is null where no doc_id is reachable. Long texts are read
    whole: a task holds about 30 bytes for each byte of its longest text. An empty table gives an empty result.
    """
    table = written(fingerprints(docs, size))
    counts = written(table.groupBy("f").agg(F.min("doc_id").alias("rep"), F.count("*").alias("_n")))
    labels = written(components(links(counts.select("f"))))
    linked = written(labels.join(counts, labels.node == counts.f).select("f", "component", "rep"))
    tops = linked.groupBy("component").agg(F.min("rep").alias("top"))
    linked = spread_join(linked, tops, ["component"], ["f"], hot_keys(linked, ["component"])).select("f", "top")
    named = counts.select("f", "rep").join(linked, "f", "left").select("f", F.coalesce("top", "rep").alias("component_id"))
    hot = hot_keys(table, ["f"], counts=counts.select("f", "_n"))
    joined = spread_join(table, named, ["f"], ["doc_id"], hot)
    return joined.select("doc_id", F.lower(F.lpad(F.hex("f"), 16, "0")).alias("fingerprint"), "component_id")
