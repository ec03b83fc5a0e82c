import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from driftlake.llm import packing
from driftlake.llm.chunks import ChunkTable

PATH = public_tokenizers.path("word_bpe_49k.json")


def fill(counts, capacity):
    plan = packing.make_plan(counts, capacity)
    key, first_rank, first_sequence, each = plan.arrays()
    held = Counter()
    for n, c in counts.items():
        rank = np.arange(c)
        at = np.searchsorted(key, (n << 48) + rank, side="right") - 1
        assert ((key[at] >> 48) == n).all()
        for s in first_sequence[at] + (rank - first_rank[at]) // each[at]:
            held[int(s)] += n
    assert set(held) == set(range(plan.sequences))
    assert not held or max(held.values()) <= capacity
    return plan.sequences


@pytest.mark.parametrize("counts", [{}, {4096: 5}, {1: 10_000}, {2049: 7, 2047: 7}, {1400: 9, 1300: 9, 1396: 9}])
def test_small_plans_are_best(counts):
    bound = -(-sum(n * c for n, c in counts.items()) // 4096)
    assert fill(counts, 4096) == bound


def best_fit_decreasing(lengths, capacity):
    rooms = []
    for n in sorted(lengths, reverse=True):
        fits = [i for i, r in enumerate(rooms) if r >= n]
        if fits:
            rooms[min(fits, key=lambda i: rooms[i])] -= n
        else:
            rooms.append(capacity - n)
    return len(rooms)


@pytest.mark.parametrize("seed", range(6))
def test_random_plans_come_close_to_best_fit_decreasing(seed):
    rng = np.random.default_rng(seed)
    lengths = np.clip(np.exp(rng.normal(6.5, 1.1, 1500)), 1, 4096).astype(int)
    counts = {int(n): int(c) for n, c in zip(*np.unique(lengths, return_counts=True), strict=True)}
    assert fill(counts, 4096) <= 1.01 * best_fit_decreasing(lengths.tolist(), 4096) + 1


def test_chunks_get_the_ids_of_the_library():
    rng = random.Random(6)
    letters = "Ab cdeéÉß'sl12.,;!#$\n\t\x0b　日<|>endoftextΣσİ́W̊ªŉ"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 200))) for _ in range(300)]
    texts += ["a.b,c!!x.'s '' 's'", "<|endoftext|>,x", "\xa0", "", "W̊,", "naïve Straße ÀÉÎ", "it's### $$$end 'tis"]
    library = Tokenizer.from_file(PATH)
    table = ChunkTable(packing._resolver(PATH, together=7), capacity=300)
    for a in range(0, len(texts), 40):
        data = [t.encode() for t in texts[a : a + 40]]
        offsets = np.concatenate([[0], np.cumsum([len(t) for t in data])]).astype(np.int64)
        values, at = table.sequences(np.frombuffer(b"".join(data), np.uint8), offsets)
        for i, text in enumerate(texts[a : a + 40]):
            want = library.encode(text, add_special_tokens=False).ids
            assert values[at[i] : at[i + 1]].tolist() == want, text


def test_odd_rows_are_cut_and_packed(docs_of, odd_rows):
    library = Tokenizer.from_file(PATH)
    got = packing.pack(docs_of(odd_rows), PATH, capacity=64, end_id=1).collect()
    want = Counter()
    for doc_id, text in odd_rows:
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        for piece, start in enumerate(range(0, len(ids), 64)):
            part = ids[start : start + 64]
            want[doc_id, piece, start, len(part), zlib.crc32(part.tobytes())] += 1
    assert Counter(tuple(r)[:5] for r in got) == want
    sequences = defaultdict(list)
    for r in got:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 64
    total = sum(r["length"] for r in got)
    assert len(sequences) <= -(-total // 64) + 1
