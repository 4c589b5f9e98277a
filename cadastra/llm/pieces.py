"""Token ids of whole texts with the tokenizers library, each distinct piece of text encoded once per worker.

Texts are cut only where both pre-tokenizers of the public vocabularies always begin a new token, whatever surrounds it:
around runs of Latin-1 letters, of digits and of plain punctuation, and before single spaces. Every other character
(apostrophes, `<|>`, all beyond Latin-1, runs of white space) stays joined to its neighbours. So a text's ids are those
of its pieces in a row. A piece that is one plain word goes to the library's merge model directly; any other piece
goes through the library's whole chain.
"""

from __future__ import annotations

import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from cadastra.llm.words import LOWER

CACHE_PIECES = 700_000

_OTHER, _LETTER, _DIGIT, _MARK, _BLANK, _LINE = range(6)
_CLASS = np.full(256, _OTHER, np.uint8)
_CLASS[[*range(65, 91), *range(97, 123)]] = _LETTER
_CLASS[[*range(48, 58)]] = _DIGIT
_CLASS[[ord(c) for c in ".,!?;:*$&%#()\"-/=+_@[]{}~^`\\"]] = _MARK
_CLASS[32] = _BLANK
_CLASS[10] = _LINE
_LATIN = "A-Za-zÀ-ÖØ-öø-ÿ"


def _byte_chars() -> dict[int, str]:
    """The printable character that stands for each byte in byte-level vocabularies: itself, or 256 and on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(rest)}


class PieceEncoder:
    """Encoder of one tokenizer file; its cache of pieces is bounded by CACHE_PIECES."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.drops_space = self.tokenizer.normalizer is not None  # lower case, white space dropped
        largest = max(self.tokenizer.get_vocab(with_added_tokens=True).values(), default=0)
        self.kind = np.uint16 if largest < 1 << 16 else np.uint32
        self.chars = _byte_chars()
        self.seen: dict[bytes, int] = {}
        self._clear()
        lead, digits = ("", "[0-9]") if self.drops_space else (" ?", "[0-9]+")
        marks = re.escape("".join(chr(c) for c in range(256) if _CLASS[c] == _MARK))
        self.plain = re.compile(f"{lead}(?:[{_LATIN}]+|{digits}|[{marks}]+)" + ("" if self.drops_space else "|\n"))
        self.cut = self._cuts()

    def _clear(self) -> None:
        self.seen.clear()
        self.flat = np.zeros(1 << 16, self.kind)
        self.begin = np.zeros(1 << 16, np.int64)
        self.used = 0

    def _cuts(self) -> np.ndarray:
        """Whether a piece begins between two bytes, by their classes."""
        cut = np.zeros((6, 6), bool)
        for a, b in ((_LETTER, _MARK), (_LETTER, _DIGIT), (_DIGIT, _MARK)):
            cut[a, b] = cut[b, a] = True
        if self.drops_space:
            cut[[_BLANK, _LINE], :] = True
            cut[:, [_BLANK, _LINE]] = False  # white space ends the piece before it
            cut[_DIGIT, _DIGIT] = True
        return cut.ravel()

    def _pieces(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        kind = _CLASS[data]
        pair = np.flatnonzero((data[:-1] == 0xC3) & (data[1:] != 0x97) & (data[1:] != 0xB7))  # À to ÿ without × and ÷
        kind[pair] = kind[pair + 1] = _LETTER
        cut = np.zeros(len(data), bool)
        cut[1:] = self.cut[kind[:-1] * 6 + kind[1:]]
        if not self.drops_space:  # a single space or line end between printable ASCII or Latin-1 letters
            solid = ((data > 32) & (data < 127)) | (kind == _LETTER)
            alone = (kind >= _BLANK)[1:-1] & solid[:-2] & solid[2:]
            cut[1:-1] |= alone
            cut[2:] |= alone & (kind[1:-1] == _LINE)
        cut[offsets[:-1][offsets[:-1] < len(data)]] = True
        return np.flatnonzero(cut)

    def _learn(self, pieces: list[bytes]) -> None:
        """Encode pieces that are not cached and add them."""
        results: list[list[int] | None] = []
        rest: list[str] = []
        model, plain, chars = self.tokenizer.model, self.plain, self.chars
        for raw in pieces:
            text = raw.decode()
            word = text.rstrip(" \n") if self.drops_space else text
            if plain.fullmatch(word):
                if self.drops_space:
                    word = word.lower()
                if not word.isascii() or not word.isalnum():
                    word = word.encode().decode("latin-1").translate(chars)
                results.append([t.id for t in model.tokenize(word)])
            else:
                results.append(None)
                rest.append(text)
        encoded = iter(self.tokenizer.encode_batch(rest, add_special_tokens=False) if rest else ())
        ids = [next(encoded).ids if r is None else r for r in results]
        first = len(self.seen)
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        total = self.used + int(sizes.sum())
        while total > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while first + len(ids) + 1 > len(self.begin):
            self.begin = np.concatenate([self.begin, np.zeros_like(self.begin)])
        self.flat[self.used : total] = np.fromiter((i for x in ids for i in x), np.int64, total - self.used)
        self.begin[first + 1 : first + 1 + len(ids)] = self.used + np.cumsum(sizes)
        self.used = total
        for k, raw in enumerate(pieces):
            self.seen[raw] = first + k

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and the offset of each text's first id (one more than texts).

        `data` and `offsets` are as from `common.buffers`.
        """
        if len(data) == 0:
            return np.zeros(0, self.kind), np.zeros(len(offsets), np.int64)
        starts = self._pieces(data, offsets)
        if self.drops_space:  # fewer distinct pieces; only where no byte beyond ASCII or of a special token is near
            odd = np.add.reduceat((data >= 128) | (data == 60), starts, dtype=np.int32) > 0
            lengths = np.diff(np.append(starts, len(data)))
            data = np.where(np.repeat(odd, lengths), data, LOWER[data])
        bounds = np.append(starts, len(data)).astype(np.int32)
        column = pa.BinaryArray.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(data))])
        coded = column.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        if len(self.seen) + len(distinct) > CACHE_PIECES:
            self._clear()
        seen = self.seen
        missing = [p for p in distinct if p not in seen]
        if missing:
            self._learn(missing)
        number = np.fromiter(map(seen.__getitem__, distinct), np.int64, len(distinct))[coded.indices.to_numpy()]
        begin, size = self.begin[number], self.begin[number + 1] - self.begin[number]
        ends = np.cumsum(size)
        source = np.repeat(begin - (ends - size), size)
        source += np.arange(len(source))
        at = np.searchsorted(starts, offsets)  # first piece of each text
        return self.flat[source], np.concatenate([[0], ends])[at]


_LOADED: dict[str, PieceEncoder] = {}


def encoder(path: str) -> PieceEncoder:
    """The worker's encoder for a file, loaded once."""
    if path not in _LOADED:
        _LOADED[path] = PieceEncoder(path)
    return _LOADED[path]
