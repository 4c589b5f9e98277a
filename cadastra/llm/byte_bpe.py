"""Byte-level BPE by a file of ranks: pre-tokens found by scans over codepoint classes, merges for all distinct
pre-tokens at once, and decoding from retained offsets. No regular expression runs over a text.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from cadastra.llm.common import PIECE_BYTES, buffers, chunks, text_of

LONG = 48
CACHE_SLICES = 400_000
BLOCK = 256

# The pre-token pattern as an automaton. Symbols: letters, digits, other marks, an apostrophe with one or two letters
# of a contraction behind it, white space before more white space or the end, the last white space of a run (a space,
# or something else). A symbol plus _FIRST is the same at the beginning of a text.
_L, _N, _O, _A1, _A2, _W, _SP, _SQ, _FIRST = range(9)
# States: what the token holds so far; FREE means that the next symbol begins a token whatever it is.
FREE, LETTERS, DIGITS, MARKS, WHITE, LED, TWO, ONE = range(8)


def _step(state: int, symbol: int) -> tuple[int, bool]:
    """Next state, and whether the symbol begins a token."""
    if state == TWO:
        return ONE, False
    if state == ONE:
        return FREE, False
    run = {_L: LETTERS, _N: DIGITS, _O: MARKS, _A1: MARKS, _A2: MARKS}.get(symbol)
    if run is not None and state in (run, LED):  # a run goes on, or follows the space that leads it
        return run, False
    if symbol in (_A1, _A2):
        return (ONE if symbol == _A1 else TWO), True
    if run is not None:
        return run, True
    if symbol == _W:
        return WHITE, state != WHITE
    return (LED if symbol == _SP else FREE), True


class _Automaton:
    """Transition functions of the symbols, closed under composition, with tables for scans.

    Composition is associative, so prefixes of a text can be combined in any grouping: blocks are scanned side by
    side, then their totals, then each block again from its own first state.
    """

    def __init__(self) -> None:
        symbols = []
        for s in range(2 * _FIRST):
            symbols.append(tuple(_step(FREE if s >= _FIRST else q, s % _FIRST)[0] if s % _FIRST < 8 else q for q in range(8)))
        known = {f: k for k, f in enumerate(dict.fromkeys([tuple(range(8)), *symbols]))}
        frontier = list(known)
        while frontier:
            new = []
            for f in frontier:
                for g in set(symbols):
                    h = tuple(g[q] for q in f)
                    if h not in known:
                        known[h] = len(known)
                        new.append(h)
            frontier = new
        functions = list(known)
        self.of_symbol = np.array([known[f] for f in symbols], np.uint16)
        self.apply = np.array(functions, np.uint8)
        # all compositions of two functions, first one first
        self.compose = np.array([[known[tuple(g[q] for q in f)] for g in functions] for f in functions], np.uint16)
        self.begins = np.array([[s >= _FIRST or _step(q, s % _FIRST)[1] for s in range(2 * _FIRST)] for q in range(8)])

    def starts(self, symbols: np.ndarray) -> np.ndarray:
        """Which symbols begin a token."""
        n = len(symbols)
        rows = -(-n // BLOCK)
        f = np.zeros(rows * BLOCK, np.uint16)  # the padding is the identity
        f[:n] = self.of_symbol[symbols]
        table = np.ascontiguousarray(f.reshape(rows, BLOCK).T)
        total = table[0]
        for k in range(1, BLOCK):
            total = self.compose[total, table[k]]
        carried, shift = total.copy(), 1  # inclusive scan over the blocks' functions by doubling
        while shift < rows:
            carried[shift:] = self.compose[carried[:-shift], carried[shift:]]
            shift *= 2
        state = np.full(rows, FREE, np.uint8)
        state[1:] = self.apply[carried[:-1], FREE]
        states = np.empty((BLOCK, rows), np.uint8)
        for k in range(BLOCK):
            states[k] = state
            state = self.apply[table[k], state]
        return self.begins[states.T.ravel()[:n], symbols]


@lru_cache(1)
def _automaton() -> _Automaton:
    return _Automaton()


@lru_cache(1)
def _classes() -> np.ndarray:
    """_L, _N, _O or _W for every codepoint; white space as in Unicode's White_Space."""
    kind = np.full(0x110000, _O, np.uint8)
    for c in range(0x110000):
        major = unicodedata.category(chr(c))[0]
        if major in "LN":
            kind[c] = _L if major == "L" else _N
    white = [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
    kind[white] = _W
    return kind


def pre_tokens(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """First byte of each pre-token of all texts (`data` and `offsets` as from `common.buffers`)."""
    if len(data) == 0:
        return np.zeros(0, np.int64)
    points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), "<u4")
    at = np.zeros(len(points), np.int64)
    width = 1 + (points >= 0x80).astype(np.int8) + (points >= 0x800) + (points >= 0x10000)
    np.cumsum(width[:-1], out=at[1:])
    first = np.searchsorted(at, offsets[:-1][offsets[:-1] < offsets[1:]])
    n = len(points)
    head = np.zeros(n + 1, bool)  # beginnings of texts, and the end
    head[first] = True
    head[n] = True
    symbol = _classes()[points]
    white = symbol == _W
    last = white.copy()  # the last of a run before something solid in the same text
    last[:-1] &= ~white[1:]
    last &= ~head[1:]
    symbol[last] = np.where(points[last] == 32, _SP, _SQ)
    near = np.concatenate([points, np.zeros(2, points.dtype)])
    quote = np.flatnonzero(points == 39)
    a, b = near[quote + 1], near[quote + 2]
    inside = ~head[quote + 1]
    inside_two = inside & ~head[np.minimum(quote + 2, n)]
    one = inside & np.isin(a, [ord(c) for c in "stmd"])
    two = inside_two & (((a == ord("r")) & (b == ord("e"))) | ((a == ord("v")) & (b == ord("e"))) | ((a == ord("l")) & (b == ord("l"))))
    symbol[quote[one]] = _A1
    symbol[quote[two]] = _A2
    symbol[first] += _FIRST
    return at[_automaton().starts(symbol)]


class RankMerger:
    """Ids of byte slices by ranks: the adjacent pair whose joined bytes rank lowest merges first, the leftmost of equals."""

    def __init__(self, path: str):
        with open(path, "rb") as file:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        self.single = np.array([self.ranks[bytes([b])] for b in range(256)], np.int64)
        pairs = {}
        for token, rank in self.ranks.items():
            for k in range(1, len(token)):
                a, b = self.ranks.get(token[:k]), self.ranks.get(token[k:])
                if a is not None and b is not None:
                    pairs[a << 20 | b] = rank
        self.keys = np.array(sorted(pairs), np.int64)
        self.values = np.array([pairs[k] for k in self.keys.tolist()], np.int64)
        size = max(self.ranks.values()) + 1
        tokens = [b""] * size
        for token, rank in self.ranks.items():
            tokens[rank] = token
        self.blob = np.frombuffer(b"".join(tokens), np.uint8)
        self.token_bytes = np.array([len(t) for t in tokens], np.int64)
        self.token_at = np.concatenate([[0], np.cumsum(self.token_bytes)[:-1]])

    def _rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a << 20 | b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.values[at], 1 << 40)

    def merge(self, slices: list[bytes]) -> list[list[int]]:
        """Ids of each slice. Slices of one length are merged together, one merge a round for each."""
        out: list[list[int]] = [[]] * len(slices)
        by_length: dict[int, list[int]] = {}
        for k, s in enumerate(slices):
            if len(s) > LONG:
                out[k] = self._merge_long(s)
            elif s:
                by_length.setdefault(len(s), []).append(k)
        for length, group in by_length.items():
            ids = self.single[np.frombuffer(b"".join(slices[k] for k in group), np.uint8)].reshape(len(group), length)
            sizes = np.full(len(group), length)
            rank = self._rank(ids[:, :-1], ids[:, 1:]) if length > 1 else np.full((len(group), 1), 1 << 40)
            live = np.arange(len(group))
            while len(live) and length > 1:
                at = rank[live].argmin(axis=1)
                lowest = rank[live, at]
                live, at, lowest = (x[lowest < 1 << 40] for x in (live, at, lowest))
                if not len(live):
                    break
                part, grades = ids[live], rank[live]
                columns = np.arange(length)
                source = np.minimum(columns + (columns > at[:, None]), length - 1)  # close the gap behind the pair
                part = np.take_along_axis(part, source, 1)
                part[np.arange(len(live)), at] = lowest
                sizes[live] -= 1
                source = np.minimum(columns[:-1] + (columns[:-1] > at[:, None]), length - 2)
                grades = np.take_along_axis(grades, source, 1)
                end = sizes[live] - 1  # pairs from `end` on are gone
                grades[columns[None, :-1] >= end[:, None]] = 1 << 40
                right = np.flatnonzero(at < end)
                grades[right, at[right]] = self._rank(part[right, at[right]], part[right, at[right] + 1])
                left = np.flatnonzero(at > 0)
                grades[left, at[left] - 1] = self._rank(part[left, at[left] - 1], part[left, at[left]])
                ids[live], rank[live] = part, grades
            for k, row, n in zip(group, ids.tolist(), sizes.tolist(), strict=True):
                out[k] = row[:n]
        return out

    def _merge_long(self, data: bytes) -> list[int]:
        """The same for one long slice, with a heap of pairs over a linked list."""
        ranks = self.ranks
        n = len(data)
        ends, after, before = [k + 1 for k in range(n)], [k + 1 for k in range(n)], [k - 1 for k in range(n)]
        heap: list[tuple[int, int, int]] = []

        def offer(k: int) -> None:
            if k >= 0 and after[k] < n and (r := ranks.get(data[k : ends[after[k]]])) is not None:
                heapq.heappush(heap, (r, k, ends[after[k]]))

        for k in range(n):
            offer(k)
        gone = bytearray(n)
        while heap:
            _, k, end = heapq.heappop(heap)
            if gone[k] or after[k] >= n or ends[after[k]] != end:
                continue
            other = after[k]
            gone[other], ends[k], after[k] = 1, end, after[other]
            if after[k] < n:
                before[after[k]] = k
            offer(k)
            offer(before[k])
        return [ranks[data[k : ends[k]]] for k in range(n) if not gone[k]]

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """Bytes of ids in a row."""
        sizes = self.token_bytes[ids]
        source = np.repeat(self.token_at[ids] - (np.cumsum(sizes) - sizes), sizes)
        source += np.arange(len(source))
        return self.blob[source]


class Codec:
    """Encoder and decoder of one rank file; results for distinct pre-tokens are kept, CACHE_SLICES at most."""

    def __init__(self, path: str):
        self.merger = RankMerger(path)
        self.seen: dict[bytes, list[int]] = {}

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and the offset of each text's first id (one more than texts)."""
        starts = pre_tokens(data, offsets)
        if not len(starts):
            return np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
        bounds = np.append(starts, len(data)).astype(np.int32)
        column = pa.BinaryArray.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(data))])
        coded = column.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        if len(self.seen) + len(distinct) > CACHE_SLICES:
            self.seen.clear()
        missing = [s for s in distinct if s not in self.seen]
        self.seen.update(zip(missing, self.merger.merge(missing), strict=True))
        lists = list(map(self.seen.__getitem__, distinct))
        size = np.fromiter(map(len, lists), np.int64, len(lists))
        flat = np.fromiter((i for x in lists for i in x), np.int64, int(size.sum()))
        begin = np.cumsum(size) - size
        number = coded.indices.to_numpy()
        begin, size = begin[number], size[number]
        ends = np.cumsum(size)
        source = np.repeat(begin - (ends - size), size)
        source += np.arange(len(source))
        return flat[source], np.concatenate([[0], ends])[np.searchsorted(starts, offsets)]


_LOADED: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    """The worker's codec for a rank file, loaded once."""
    if path not in _LOADED:
        _LOADED[path] = Codec(path)
    return _LOADED[path]


def round_trip(docs: DataFrame, ranks: str) -> DataFrame:
    """Encode and decode each text: doc_id, n_tokens, ids (array), decoded (binary).

    Null texts count as empty (no ids); repeated rows and null doc_ids are kept; other columns are left out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for doc, ids, at, data, ends in _coded(batches, ranks):
            yield pa.RecordBatch.from_arrays(
                [doc, pa.array(np.diff(at)), pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids, pa.int32())),
                 pa.BinaryArray.from_buffers(pa.binary(), len(doc), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(data)])],
                names=["doc_id", "n_tokens", "ids", "decoded"],
            )

    return text_of(docs).mapInArrow(run, "doc_id long, n_tokens long, ids array<int>, decoded binary")


def _coded(batches: Iterator[pa.RecordBatch], ranks: str) -> Iterator[tuple]:
    """For each chunk of texts: doc_ids, ids in a row, their offsets, decoded bytes in a row, their offsets."""
    model = codec(ranks)
    for batch in chunks(batches, "text", PIECE_BYTES):
        ids, at = model.encode(*buffers(batch.column("text")))
        data = model.merger.decode(ids)
        ends = np.concatenate([[0], np.cumsum(model.merger.token_bytes[ids])])[at]
        yield batch.column("doc_id"), ids, at, data, ends


def digests(docs: DataFrame, ranks: str) -> DataFrame:
    """As `round_trip`, with hashes in place of ids and bytes: ids_sha256 (of decimal ids joined by commas), decoded_sha256."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names: list[str] = []
        for doc, ids, at, data, ends in _coded(batches, ranks):
            names = names or list(map(str, range(len(codec(ranks).merger.token_bytes))))
            raw, text = data.tobytes(), list(map(names.__getitem__, ids.tolist()))
            cut, spans = at.tolist(), ends.tolist()
            yield pa.RecordBatch.from_arrays(
                [doc, pa.array(np.diff(at)),
                 pa.array([hashlib.sha256(",".join(text[a:b]).encode()).hexdigest() for a, b in zip(cut, cut[1:], strict=False)]),
                 pa.array([hashlib.sha256(raw[a:b]).hexdigest() for a, b in zip(spans, spans[1:], strict=False)])],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return text_of(docs).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
