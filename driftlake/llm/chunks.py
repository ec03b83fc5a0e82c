"""Texts as sequences of chunks between ASCII white space, each distinct chunk handled once.

A tokenizer that drops white space gives a text the tokens of its chunks, one after another.  Most
chunks come up again and again, so a task keeps what it knows about them in a table.  The table is
emptied when it holds more than ``capacity`` chunks or ``most_bytes`` of them, which bounds memory
and changes no result.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa

from driftlake.llm.common import pieces

PIECE = 16 << 20  # a longer text is handled in parts, cut at white space

_BYTES = np.arange(256, dtype=np.uint8)
_LOWER = np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES + 32, _BYTES).astype(np.uint8)
_SPACE = np.isin(_BYTES, [9, 10, 11, 12, 13, 32])
_MARK = np.isin(_BYTES, list(b"!\"#$%&'()*+,-./:;=>?@[\\]^_`{|}~"))
_WORD = np.isin(_BYTES, list(b"abcdefghijklmnopqrstuvwxyz0123456789"))
_ODD = np.isin(_BYTES, [ord("<"), 0xCC, 0xCD])


def split(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """Chunks of a run of texts, one after another, and how many each text has.

    A-Z become small.  A mark after a letter or digit begins a chunk of its own (``Word,`` is
    ``word`` and ``,``), and so does a letter or digit after a mark other than an apostrophe,
    which may belong to what follows.  For a vocabulary of lower case, whose pre-tokens never
    cross these places, that changes no token and leaves fewer distinct chunks.  Texts that may name special tokens or hold combining marks, which a small
    letter could be joined with, are only cut at white space.
    """
    odd, lowered, marks = _ODD[data], _LOWER[data], _MARK[data]
    if odd.any():
        before = np.concatenate([[0], np.cumsum(odd)])
        strange = np.repeat(before[offsets[1:]] > before[offsets[:-1]], np.diff(offsets))
        lowered, marks = np.where(strange, data, lowered), marks & ~strange
    inside = ~_SPACE[data]
    fresh = inside.copy()
    word, loose = _WORD[lowered], marks & (data != ord("'"))
    fresh[1:] &= ~inside[:-1] | (marks[1:] & word[:-1]) | (word[1:] & loose[:-1])
    begins = offsets[:-1][offsets[:-1] < len(data)]
    fresh[begins] = inside[begins]
    first = np.flatnonzero(fresh)
    ends = np.cumsum(inside)
    places = np.append(ends[first] - 1, ends[-1] if len(ends) else 0).astype(np.int32)
    buffers = [None, pa.py_buffer(places), pa.py_buffer(lowered[inside])]
    return pa.Array.from_buffers(pa.binary(), len(first), buffers), np.diff(np.searchsorted(first, offsets))


class ChunkTable:
    """Values (for instance token ids) of chunks; ``resolve`` finds those of new chunks.

    ``resolve`` takes a list of chunks and returns all their values, flat, and how many each has.
    Chunks are as :func:`split` makes them, which is right for tokenizers that lower-case.
    """

    def __init__(
        self,
        resolve: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]],
        capacity: int = 600_000,
        most_bytes: int = 64 << 20,
    ):
        self.resolve, self.capacity, self.most_bytes = resolve, capacity, most_bytes
        self._reset()

    def _reset(self) -> None:
        self.index: dict[bytes, int] = {}
        self.bytes = 0
        self.lengths = np.zeros(0, np.int64)
        self.starts = np.zeros(0, np.int64)
        self.values = np.zeros(0, np.uint32)

    def codes(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Code of every chunk of the texts, and the number of chunks of each text."""
        if len(self.index) > self.capacity or self.bytes > self.most_bytes:
            self._reset()
        chunks, counts = split(data, offsets)
        encoded = chunks.dictionary_encode()
        distinct = encoded.dictionary.to_pylist()
        new = [chunk for chunk in distinct if chunk not in self.index]
        if new:
            self._add(new)
        known = np.fromiter(map(self.index.__getitem__, distinct), np.int64, len(distinct))
        return known[encoded.indices.to_numpy()], counts

    def _add(self, new: list[bytes]) -> None:
        values, lengths = self.resolve(new)
        base = len(self.index)
        self.index.update(zip(new, range(base, base + len(new)), strict=True))
        self.bytes += sum(map(len, new)) + 4 * len(values)
        starts = len(self.values) + np.concatenate([[0], np.cumsum(lengths)[:-1]])
        self.starts = np.concatenate([self.starts, starts.astype(np.int64)])
        self.lengths = np.concatenate([self.lengths, lengths])
        self.values = np.concatenate([self.values, values])

    def counts(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Number of values of each text; texts are the bytes between two offsets."""
        if len(offsets) == 2 and len(data) > PIECE:
            return sum(self._counts(p, np.array([0, len(p)])) for p in pieces(data, PIECE))
        return self._counts(data, offsets)

    def _counts(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        codes, chunks = self.codes(data, offsets)
        rows = np.repeat(np.arange(len(chunks)), chunks)
        return np.bincount(rows, self.lengths[codes], len(chunks)).astype(np.int64)

    def sequences(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All values of the texts, flat, and the offsets of each text among them."""
        if len(offsets) == 2 and len(data) > PIECE:
            parts = [self._sequences(p, np.array([0, len(p)]))[0] for p in pieces(data, PIECE)]
            return np.concatenate(parts), np.array([0, sum(map(len, parts))])
        return self._sequences(data, offsets)

    def _sequences(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        codes, chunks = self.codes(data, offsets)
        lengths = self.lengths[codes]
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        at = np.repeat(self.starts[codes] - (ends - lengths), lengths) + np.arange(total)
        by_chunk = np.concatenate([[0], ends])
        offsets = by_chunk[np.concatenate([[0], np.cumsum(chunks)])]
        return self.values[at], offsets
