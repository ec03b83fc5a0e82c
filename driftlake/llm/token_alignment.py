"""Alignment of two tokenizers' tokens: groups between common ends, and pairs of overlapping tokens.

Both tokenizers spell out the same bytes, so a token is known by where it ends.  The ends of one
tokenizer are looked up among those of the other by galloping: the shorter list drives, each of its
ends probes the longer list in doubling steps from where it is expected, then by binary search
between the last two probes.  What comes out is a rank in the longer list and whether the end is
there too.  Ends found in both lists cut the tokens into groups; the ranks of a token's start and
end bound the tokens that overlap it.  All ends of a batch are looked up in step.

Neither tokenizer has a token across a single space between two characters that aren't white space:
the byte-level one cuts there before it merges, and the piece model has no piece with a space after
another character (checked when it is loaded; else texts are left whole).  Texts are therefore cut
there, and a task aligns each distinct chunk once.  The table of chunks starts over between blocks
when it is full, which changes no result.

How often a pair of ids is linked is counted over all documents.  A block of documents (BLOCK_BYTES
of text, or one longer text) is kept as one row: its distinct pairs, its chunks as lists of pairs,
its texts as lists of chunks.  Counting shuffles a pair once a block; the counts come back to the
block by its number.  No key holds more than one row of a block, so none is hot.

Edge cases: null and empty texts, and texts that a tokenizer does not reproduce byte for byte (for
instance those with U+2581), have no tokens: zeros, empty digest, and no part in any count.
Repeated rows and equal texts all count.  Null ids stay null.  A text of any length is handled
in parts of PIECE bytes, cut where chunks are; a stretch without such a place stays whole, and the
distinct chunks and chunk numbers of one text must fit into a task.  No rows give no rows.  Only
``doc_id`` and ``text`` are read, so further columns may have any names.
"""

from __future__ import annotations

import functools
import hashlib
import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from driftlake.llm.common import blocks, stored, text_buffer, tidy

BLOCK_BYTES = 4 << 20
PIECE = 16 << 20
CAPACITY = 400_000
TOGETHER = 8192  # chunks given to the tokenizers at once
MOST_BYTES = 64 << 20
B_BITS = 32
SPACE = 0x20

_COUNTS = ("n_a", "n_b", "n_groups", "n_links")
BLOCK_SCHEMA = (
    "block long, doc_id array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, "
    "groups_sha256 array<string>, groups array<string>, texts binary, chunks binary, "
    "pair array<long>, n array<long>"
)
RESULT_SCHEMA = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
    "groups_sha256 string, groups string"
)


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Places ``starts[i] .. starts[i] + lengths[i] - 1`` of all i, one after another."""
    ends = np.cumsum(lengths)
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)


def gallop(keys: np.ndarray, others: np.ndarray, guess: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each key the number of smaller ``others`` (sorted, distinct), and whether it is among them.

    From ``guess`` on in doubling steps until the key is passed, then by halves in between.
    """
    n = len(others)
    if not n:
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    at = np.clip(guess, 0, n - 1)
    below = others[at] < keys
    # low: a place known to be smaller, or -1.  high: one known not to be, or n.
    low, high = np.where(below, at, -1), np.where(below, n, at)
    open_, step = np.arange(len(keys)), 1
    while len(open_):
        up = below[open_]
        probe = np.where(up, low[open_] + step, high[open_] - step)
        inside = (probe >= 0) & (probe < n)
        smaller = others[np.clip(probe, 0, n - 1)] < keys[open_]
        stays = inside & (smaller == up)
        ends = inside & (smaller != up)
        low[open_[stays & up]] = probe[stays & up]
        high[open_[stays & ~up]] = probe[stays & ~up]
        high[open_[ends & up]] = probe[ends & up]
        low[open_[ends & ~up]] = probe[ends & ~up]
        open_, step = open_[stays], step * 2
    open_ = np.flatnonzero(high - low > 1)
    while len(open_):
        middle = (low[open_] + high[open_]) // 2
        smaller = others[middle] < keys[open_]
        low[open_[smaller]] = middle[smaller]
        high[open_[~smaller]] = middle[~smaller]
        open_ = open_[high[open_] - low[open_] > 1]
    found = (high < n) & (others[np.minimum(high, n - 1)] == keys)
    return high, found


def overlaps(
    short_ends: np.ndarray, long_ends: np.ndarray, guess: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Overlapping tokens (place in the shorter list, place in the longer), and the places of the
    common ends in both lists.  Both lists end on the same byte."""
    rank, common = gallop(short_ends, long_ends, guess)
    first = np.concatenate([[0], rank[:-1] + common[:-1]]) if len(rank) else rank
    width = rank - first + 1
    shared = np.flatnonzero(common)
    return np.repeat(np.arange(len(rank)), width), ragged(first, width), shared, rank[shared]


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: itself if it can be seen,
    else the next code point from 256 on."""
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in seen]
    return {chr(b): b for b in seen} | {chr(256 + i): b for i, b in enumerate(hidden)}


class _Spelling:
    """Bytes of each id of a vocabulary."""

    def __init__(self, tokens: list[bytes]):
        self.lengths = np.array([len(t) for t in tokens], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.data = np.frombuffer(b"".join(tokens), np.uint8)

    def reproduces(self, ids: np.ndarray, counts: np.ndarray, texts: list[bytes]) -> np.ndarray:
        """Whether the ids of each text, ``counts`` of them, spell it."""
        owner = np.repeat(np.arange(len(texts)), counts)
        spelled = np.bincount(owner, self.lengths[ids], len(texts)).astype(np.int64)
        wanted = np.array([len(t) for t in texts], np.int64)
        same = spelled == wanted
        kept = same[owner]
        got = self.data[ragged(self.starts[ids[kept]], self.lengths[ids[kept]])]
        want = np.frombuffer(b"".join(t for t, s in zip(texts, same, strict=True) if s), np.uint8)
        wrong = np.repeat(np.flatnonzero(same), wanted[same])[got != want]
        same[wrong] = False
        return same


class ByteBpe:
    """A byte-level vocabulary of the tokenizers library; texts get a space in front."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task for each core
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.model.encode_special_tokens = True
        with open(path, encoding="utf-8") as f:
            special = {t["id"]: t["content"] for t in json.load(f)["added_tokens"]}
        letters = _byte_letters()
        tokens = [b""] * self.model.get_vocab_size()
        for token, i in self.model.get_vocab().items():
            tokens[i] = special[i].encode() if i in special else bytes(letters[c] for c in token)
        self.spelling = _Spelling(tokens)

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.model.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)]


class PieceBpe:
    """A sentencepiece model with byte fallback, which puts a space in front of a text itself."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.cuts_at_spaces = not any(re.search("[^▁]▁", p) for p in pieces)
        self.spelling = _Spelling([
            bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode()
            for i, p in enumerate(pieces)])

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


def cut_places(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Places of single spaces between characters that are surely not white space.

    Characters whose first byte is C2, E1, E2 or E3 count as white space, as some of them are.
    """
    at = np.flatnonzero(data == SPACE)
    at = at[(at > 0) & (at < len(data) - 1)]
    at = at[~np.isin(at, offsets) & ~np.isin(at + 1, offsets)]
    before, after = data[at - 1], data[at + 1]
    first_of_two, first_of_three = data[np.maximum(at - 2, 0)], data[np.maximum(at - 3, 0)]
    seen_before = (before > 0x20) & (before < 0x7F)
    wide_before = (before >= 0x80) & (first_of_two != 0xC2) & ~np.isin(first_of_three, [0xE1, 0xE2, 0xE3])
    seen_after = (after > 0x20) & (after < 0x7F)
    wide_after = (after >= 0xC3) & ~np.isin(after, [0xE1, 0xE2, 0xE3])
    return at[(seen_before | wide_before) & (seen_after | wide_after)]


def split(data: np.ndarray, offsets: np.ndarray, cut: bool) -> tuple[pa.Array, np.ndarray]:
    """Chunks of a run of texts, one after another, and how many each text has."""
    places = cut_places(data, offsets) if cut else np.zeros(0, np.int64)
    kept = np.ones(len(data), bool)
    kept[places] = False
    begins = offsets[:-1][np.diff(offsets) > 0]
    starts = np.union1d(begins, places + 1)
    removed = np.searchsorted(places, np.append(starts, len(data)))
    at = (np.append(starts, len(data)) - removed).astype(np.int32)
    buffers = [None, pa.py_buffer(at), pa.py_buffer(data[kept])]
    return pa.Array.from_buffers(pa.binary(), len(starts), buffers), np.diff(np.searchsorted(starts, offsets))


def _parts(data: np.ndarray, limit: int) -> Iterator[np.ndarray]:
    """A long text in parts, cut at the last place of each ``limit`` bytes; the space goes."""
    start = 0
    while len(data) - start > limit:
        end, place = start, np.zeros(0, np.int64)
        while not len(place) and end < len(data):
            end = min(end + limit, len(data))
            place = cut_places(data[start:end], np.zeros(0, np.int64))
        if not len(place):
            break
        yield data[start : start + int(place[-1])]
        start += int(place[-1]) + 1
    yield data[start:]


class _Chunks:
    """What a task knows about chunks: counts, pairs of overlapping ids, and groups as text."""

    def __init__(self, a: ByteBpe, b: PieceBpe):
        self.a, self.b = a, b
        self.reset()

    def reset(self) -> None:
        self.index: dict[bytes, int] = {}
        self.bytes = 0
        self.groups: list[bytes] = []
        self.good = np.zeros(0, bool)
        self.counts = np.zeros((0, len(_COUNTS)), np.int64)
        self.starts = np.zeros(0, np.int64)
        self.links = np.zeros(0, np.int64)

    def full(self) -> bool:
        return len(self.index) > CAPACITY or self.bytes > MOST_BYTES

    def codes(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Codes of the distinct chunks, and for every chunk which of these it is."""
        encoded = chunks.dictionary_encode()
        distinct = encoded.dictionary.to_pylist()
        new = [c for c in distinct if c not in self.index]
        for i in range(0, len(new), TOGETHER):
            self._add(new[i : i + TOGETHER])
        known = np.fromiter(map(self.index.__getitem__, distinct), np.int64, len(distinct))
        return known, encoded.indices.to_numpy().astype(np.int64)

    def _add(self, new: list[bytes]) -> None:
        texts = [c.decode() for c in new]
        spelled = [b" " + c for c in new]
        tokens, sizes, good = [], [], np.ones(len(new), bool)
        for model in (self.a, self.b):
            found = model.encode(texts)
            count = np.fromiter(map(len, found), np.int64, len(found))
            ids = np.fromiter((i for f in found for i in f), np.int64, int(count.sum()))
            good &= model.spelling.reproduces(ids, count, spelled)
            tokens.append(ids)
            sizes.append(count)
        tokens = [t[np.repeat(good, s)] for t, s in zip(tokens, sizes, strict=True)]
        sizes = [np.where(good, s, 0) for s in sizes]
        counts, links, groups = self._align(tokens, sizes)
        base = len(self.index)
        self.index.update(zip(new, range(base, base + len(new)), strict=True))
        self.starts = np.append(self.starts, len(self.links) + np.cumsum(counts[:, 3]) - counts[:, 3])
        self.links = np.append(self.links, links)
        self.counts = np.concatenate([self.counts, counts])
        self.good = np.append(self.good, good)
        self.groups += groups
        self.bytes += sum(map(len, new)) + sum(map(len, groups)) + links.nbytes

    def _align(self, tokens, sizes) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
        ends = [np.cumsum(m.spelling.lengths[t]) for m, t in zip((self.a, self.b), tokens, strict=True)]
        drive = 0 if len(tokens[0]) <= len(tokens[1]) else 1
        firsts = [np.cumsum(s) - s for s in sizes]
        # An end is expected as far into its chunk's other list as it is into its own.
        guess = np.arange(len(tokens[drive])) + np.repeat(firsts[1 - drive] - firsts[drive], sizes[drive])
        of_short, of_long, *shared = overlaps(ends[drive], ends[1 - drive], guess)
        of_a, of_b = (of_short, of_long) if drive == 0 else (of_long, of_short)
        shared_a, shared_b = shared if drive == 0 else shared[::-1]
        owner = np.repeat(np.arange(len(sizes[0])), sizes[0])
        n_groups = np.bincount(owner[shared_a], minlength=len(sizes[0]))
        n_links = np.bincount(owner[of_a], minlength=len(sizes[0]))
        counts = np.stack([sizes[0], sizes[1], n_groups, n_links], axis=1).astype(np.int64)
        pairs = (tokens[0][of_a] << B_BITS) | tokens[1][of_b]
        return counts, pairs, self._spell_groups(tokens, shared_a, shared_b, n_groups)

    @staticmethod
    def _spell_groups(tokens, shared_a, shared_b, n_groups) -> list[bytes]:
        a, b = ([b"%d" % i for i in t.tolist()] for t in tokens)
        out, x, y = [], 0, 0
        for i, j in zip((shared_a + 1).tolist(), (shared_b + 1).tolist(), strict=True):
            out.append(b"%b|%b" % (b",".join(a[x:i]), b",".join(b[y:j])))
            x, y = i, j
        ends = np.cumsum(n_groups).tolist()
        return [b";".join(out[s:e]) for s, e in zip([0, *ends[:-1]], ends, strict=True)]


@functools.lru_cache(maxsize=2)
def _models(a_path: str, b_path: str) -> tuple[ByteBpe, PieceBpe]:
    return ByteBpe(a_path), PieceBpe(b_path)


def _pack(*arrays: np.ndarray) -> bytes:
    return zstandard.compress(b"".join(a.astype("<i4").tobytes() for a in (np.array([len(a) for a in arrays]), *arrays)))


def _unpack(data: bytes, arrays: int) -> list[np.ndarray]:
    values = np.frombuffer(zstandard.decompress(data), "<i4")
    return np.split(values[arrays:], np.cumsum(values[:arrays])[:-1])


def _block_row(table: _Chunks, data: np.ndarray, offsets: np.ndarray, with_groups: bool) -> list:
    """Columns of a block's row, without its number and ids."""
    parts = [data]
    if len(offsets) == 2 and len(data) > PIECE and table.b.cuts_at_spaces:
        parts = list(_parts(data, PIECE))
    known, codes, counts = [], [], np.zeros(len(offsets) - 1, np.int64)
    for part in parts:
        chunks, per_text = split(part, offsets if len(parts) == 1 else np.array([0, len(part)]), table.b.cuts_at_spaces)
        found, which = table.codes(chunks)
        known.append(found)
        codes.append(which)
        counts += per_text
    if len(parts) == 1:
        known, codes = known[0], codes[0]
    else:
        known, codes = np.unique(np.concatenate([f[w] for f, w in zip(known, codes, strict=True)]), return_inverse=True)
    texts = len(counts)
    owner = np.repeat(np.arange(texts), counts)
    good = counts > 0
    good[owner[~table.good[known][codes]]] = False
    codes, counts = codes[good[owner]], np.where(good, counts, 0)
    owner = np.repeat(np.arange(texts), counts)
    sums = [np.bincount(owner, table.counts[known, c][codes], texts).astype(np.int64) for c in range(len(_COUNTS))]
    spelled = [table.groups[k] for k in known.tolist()]
    at, listed = np.concatenate([[0], np.cumsum(counts)]).tolist(), codes.tolist()
    joined = (b";".join([spelled[c] for c in listed[at[i] : at[i + 1]]]) for i in range(texts))
    digests, shown = [], []
    for ok, line in zip(good.tolist(), joined, strict=True):
        digests.append(hashlib.sha256(line).hexdigest() if ok else "")
        shown.append(line.decode() if with_groups else None)
    # Pairs of the block: its chunks hold places in this list.
    links = table.links[ragged(table.starts[known], table.counts[known, 3])]
    pairs, places = np.unique(links, return_inverse=True)
    times = np.repeat(np.bincount(codes, minlength=len(known)), table.counts[known, 3])
    n = np.bincount(places, times, len(pairs)).astype(np.int64)
    return [*sums, digests, shown, _pack(counts, codes), _pack(table.counts[known, 3], places), pairs, n]


def _blocks(a_path: str, b_path: str, with_groups: bool):
    schema = pa.schema(
        [("block", pa.int64()), ("doc_id", pa.list_(pa.int64()))]
        + [(c, pa.list_(pa.int64())) for c in _COUNTS]
        + [("groups_sha256", pa.list_(pa.string())), ("groups", pa.list_(pa.string())), ("texts", pa.binary()),
           ("chunks", pa.binary()), ("pair", pa.list_(pa.int64())), ("n", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _Chunks(*_models(a_path, b_path))
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            data, offsets = text_buffer(batch.column("text"))
            for a, b in blocks(offsets, BLOCK_BYTES):
                if table.full():
                    table.reset()
                own = data[offsets[a] : offsets[b]]
                row = _block_row(table, own, offsets[a : b + 1] - offsets[a], with_groups)
                values = [number, batch.column("doc_id")[a:b].to_pylist(), *row]
                yield pa.record_batch([pa.array([v], f.type) for v, f in zip(values, schema, strict=True)], schema=schema)
                number += 1

    return run


def aligned_blocks(docs: DataFrame, a_path: str, b_path: str, with_groups: bool = False) -> DataFrame:
    """A row for each block of documents, written to the shared folder."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return stored(rows.mapInArrow(tidy(_blocks(a_path, b_path, with_groups)), BLOCK_SCHEMA), "aligned")


def _block_pairs(aligned: DataFrame) -> DataFrame:
    """Distinct pairs of each block with their place there and number of links."""
    return aligned.select("block", F.posexplode(F.arrays_zip("pair", "n")).alias("place", "link")).select(
        "block", "place", F.col("link.pair").alias("pair"), F.col("link.n").alias("n")).filter("n > 0")


def pair_counts(aligned: DataFrame) -> DataFrame:
    """Every pair of ids linked anywhere: pair, id_a, id_b, links, and whether that is the most its
    id_b has with any id_a."""
    counts = _block_pairs(aligned).groupBy("pair").agg(F.sum("n").alias("links"))
    id_b = F.col("pair").bitwiseAND(F.lit((1 << B_BITS) - 1))
    counts = counts.withColumn("id_a", F.shiftright("pair", B_BITS)).withColumn("id_b", id_b)
    most = F.max("links").over(Window.partitionBy("id_b"))
    return counts.select("pair", "id_a", "id_b", "links", (F.col("links") == most).alias("best"))


def _finish(block: pa.Table, known: pa.Table) -> pa.Table:
    """Documents of one block, from its row and the counts of its pairs."""
    row = {c: block.column(c)[0] for c in block.column_names}
    links, best = (np.zeros(len(row["pair"]), np.int64) for _ in range(2))
    place = known.column("place").to_numpy()
    links[place] = known.column("links").to_numpy()
    best[place] = known.column("best").to_numpy().astype(np.int64)
    counts, codes = _unpack(row["texts"].as_py(), 2)
    widths, places = _unpack(row["chunks"].as_py(), 2)
    ends, at = np.cumsum(widths, dtype=np.int64), np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])
    sums = []
    for value in (best, links):
        before = np.concatenate([[0], np.cumsum(value[places])])
        chunk = before[ends] - before[ends - widths]
        before = np.concatenate([[0], np.cumsum(chunk[codes])])
        sums.append(pa.array(before[at[1:]] - before[at[:-1]]))
    columns = {c: row[c].values for c in ("doc_id", *_COUNTS, "groups_sha256", "groups")}
    columns |= {"n_best": sums[0], "count_sum": sums[1]}
    names = [c.split()[0] for c in RESULT_SCHEMA.split(", ")]
    return pa.table([columns[n] for n in names], names=names)


def align(docs: DataFrame, a_path: str, b_path: str, with_groups: bool = False) -> DataFrame:
    """Per document: doc_id, n_a, n_b, n_groups, n_links, n_best (links of a pair that is its id_b's
    most frequent), count_sum (sum of the links' counts), groups_sha256, and with ``with_groups``
    the groups as text, ``a1,a2|b1;a3|b2``."""
    aligned = aligned_blocks(docs, a_path, b_path, with_groups)
    counts = pair_counts(aligned).select("pair", "links", "best")
    known = _block_pairs(aligned).join(counts, "pair").select(F.col("block").alias("of"), "place", "links", "best")
    rows = aligned.drop("n").groupBy("block").cogroup(known.groupBy("of")).applyInArrow(_finish, RESULT_SCHEMA)
    return rows if with_groups else rows.drop("groups")
