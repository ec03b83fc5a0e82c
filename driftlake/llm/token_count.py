"""Token counts by byte-pair merges over ragged arrays.

The merges of all new pre-tokens of a batch run together: one flat array of symbols, one of
sequence ends.  Each round looks up the rank of every adjacent pair, takes the lowest of each
sequence and merges all its places in that sequence at once, until no pair has a rank.  Merging a
rank can only create pairs of higher rank, so this gives what merging one place at a time gives.
Counts of distinct chunks between white space are kept, see :mod:`driftlake.llm.chunks`.

A pre-token longer than LONG symbols is merged with a priority queue instead, since its rounds
would each touch the whole of it.

Edge cases: null text counts as empty, with 0 bytes and 0 tokens; the strings of special tokens
inside a text count as one token each, as the library has it; repeated rows are counted alike; no
rows give no rows.  Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import functools
import heapq
import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftlake.llm.chunks import ChunkTable
from driftlake.llm.common import blocks, text_buffer

BLOCK_BYTES = 4 << 20
LONG = 4096
NONE = np.int64(1) << 40


def _byte_characters() -> list[str]:
    """The character that stands for each byte: itself if it prints, else the next beyond 255."""
    prints = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = iter(range(256, 512))
    return [chr(b) if b in prints else chr(next(others)) for b in range(256)]


class WordBpe:
    """A vocabulary with word ends, as its tokenizer file describes it."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, vocab = spec["model"], spec["model"]["vocab"]
        end = model["end_of_word_suffix"]
        steps = spec["pre_tokenizer"]["pretokenizers"]
        pattern = steps[0]["pattern"]["Regex"].replace(r"\s", r"\p{White_Space}")
        self.pattern = regex.compile(pattern)
        self.lines = regex.compile(rf"\n|{pattern}")
        specials = [t["content"] for t in spec["added_tokens"]]
        self.special = regex.compile("|".join(map(regex.escape, specials))) if specials else None
        characters = _byte_characters()
        self.inner = np.array([vocab[c] for c in characters], np.int64)
        self.last = np.array([vocab[c + end] for c in characters], np.int64)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        keys = np.array([(vocab[a] << 20) | vocab[b] for a, b in pairs], np.int64)
        merged = np.array([vocab[a + b] for a, b in pairs], np.int64)
        order = np.argsort(keys)
        self.keys, self.ranks, self.merged = keys[order], order.astype(np.int64), merged[order]

    def pre_tokens(self, chunk: bytes) -> tuple[list[str], int]:
        """Pre-tokens of a chunk, and how many special tokens it names."""
        text, specials = chunk.decode("utf-8", "replace"), 0
        parts = [text]
        if self.special is not None and "<" in text:
            parts = self.special.split(text)
            specials = len(self.special.findall(text))
        out = []
        for part in parts:
            if not part.isascii():
                part = unicodedata.normalize("NFC", part)
            # Letter by letter: the library knows no final sigma.
            part = "".join(c.lower() for c in part) if "Σ" in part else part.lower()
            out += self.pattern.findall(part)
        return out, specials

    def _look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = (left << 20) | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        known = self.keys[at] == key
        return np.where(known, self.ranks[at], NONE), at

    def count(self, tokens: list[bytes]) -> np.ndarray:
        """Symbols left of each pre-token once no more pair can be merged."""
        out = np.ones(len(tokens), np.int64)
        long = [i for i, t in enumerate(tokens) if len(t) > LONG]
        for i in long:
            out[i] = self._count_long(tokens[i])
        rest = [i for i, t in enumerate(tokens) if 1 < len(t) <= LONG]
        if rest:
            out[rest] = self._count_ragged([tokens[i] for i in rest])
        return out

    def _count_ragged(self, tokens: list[bytes]) -> np.ndarray:
        lengths = np.fromiter(map(len, tokens), np.int64, len(tokens))
        data = np.frombuffer(b"".join(tokens), np.uint8)
        ends = np.cumsum(lengths)
        symbols = self.inner[data]
        symbols[ends - 1] = self.last[data[ends - 1]]
        owner = np.arange(len(tokens))
        out = lengths.copy()
        while len(owner):
            starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
            rank, at = self._look_up(symbols[:-1], symbols[1:])
            rank = np.append(rank, NONE)
            rank[starts[1:] - 1] = NONE  # no pair across sequences
            lowest = np.minimum.reduceat(rank, starts)
            open_ = lowest < NONE
            out[owner] = lengths
            # Merge every place of the lowest rank, in a run of overlapping ones every other.
            hit = (rank == np.repeat(lowest, lengths)) & (rank < NONE)
            places = np.flatnonzero(hit)
            first = np.ones(len(places), bool)
            first[1:] = places[1:] != places[:-1] + 1
            run = np.maximum.accumulate(np.where(first, np.arange(len(places)), 0))
            places = places[(np.arange(len(places)) - run) % 2 == 0]
            symbols[places] = self.merged[at[places]]
            keep = np.repeat(open_, lengths)
            keep[places + 1] = False
            lengths = np.add.reduceat(keep, starts, dtype=np.int64)[open_]
            symbols, owner = symbols[keep], owner[open_]
        return out

    def _count_long(self, token: bytes) -> int:
        """The same with a queue of (rank, place), for one long pre-token."""
        symbols = self.inner[np.frombuffer(token, np.uint8)].copy()
        symbols[-1] = self.last[token[-1]]
        n = len(symbols)
        rank, _ = self._look_up(symbols[:-1], symbols[1:])
        queue = [(int(r), i) for i, r in enumerate(rank) if r < NONE]
        heapq.heapify(queue)
        symbols = symbols.tolist()
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        left = n
        table = self.by_key
        while queue:
            r, i = heapq.heappop(queue)
            j = after[i]
            if symbols[i] < 0 or j >= n:
                continue
            known = table.get((symbols[i] << 20) | symbols[j])
            if known is None or known[0] != r:
                continue
            symbols[i], symbols[j] = known[1], -1
            left -= 1
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            for a in (before[i], i):
                if a >= 0 and after[a] < n:
                    pair = table.get((symbols[a] << 20) | symbols[after[a]])
                    if pair:
                        heapq.heappush(queue, (pair[0], a))
        return left

    @functools.cached_property
    def by_key(self) -> dict[int, tuple[int, int]]:
        rows = zip(self.keys.tolist(), self.ranks.tolist(), self.merged.tolist(), strict=True)
        return {key: (rank, merged) for key, rank, merged in rows}

    def resolve(self, chunks: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Number of tokens of each chunk, in the form :class:`ChunkTable` takes."""
        distinct: dict[str, int] = {}
        places, owners, counts = [], [], np.zeros(len(chunks), np.int64)
        rare = [i for i, c in enumerate(chunks) if b"<" in c or b"\xce\xa3" in c]  # specials, sigma
        for i in rare:
            parts, counts[i] = self.pre_tokens(chunks[i])
            for part in parts:
                places.append(distinct.setdefault(part, len(distinct)))
                owners.append(i)
        # The others in one go, a line each.
        plain = np.setdiff1d(np.arange(len(chunks)), rare)
        text = b"\n".join([chunks[i] for i in plain]).decode("utf-8", "replace")
        if not text.isascii():
            text = unicodedata.normalize("NFC", text)
        found = self.lines.findall(text.lower())
        line = np.cumsum(np.fromiter((f == "\n" for f in found), bool, len(found)))
        kept = np.fromiter((f != "\n" for f in found), bool, len(found))
        places += [distinct.setdefault(f, len(distinct)) for f in found if f != "\n"]
        owners = np.concatenate([np.array(owners, np.int64), plain[line[kept]] if len(plain) else line[kept]])
        if distinct:
            sizes = self.count([d.encode() for d in distinct])
            counts += np.bincount(owners, sizes[places], len(chunks)).astype(np.int64)
        return np.zeros(0, np.uint32), counts


@functools.lru_cache(maxsize=2)
def _model(path: str) -> WordBpe:
    return WordBpe(path)


def _counter(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks = ChunkTable(_model(path).resolve)
        for batch in batches:
            data, offsets = text_buffer(batch.column("text"))
            counts = [np.zeros(0, np.int64)]
            for a, b in blocks(offsets, BLOCK_BYTES):
                counts.append(chunks.counts(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]))
            yield pa.record_batch(
                [batch.column("doc_id"), pa.array(np.diff(offsets)), pa.array(np.concatenate(counts))],
                names=["doc_id", "n_bytes", "n_tokens"],
            )

    return run


def count_tokens(docs: DataFrame, path: str, limit: int = 2048) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of every document, by the vocabulary at ``path``."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    counted = rows.mapInArrow(_counter(path), "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
