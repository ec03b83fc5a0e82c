import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from driftlake.llm import suffix_dedup as s


def removed(rows):
    """Which bytes go, by looking every string up."""
    first, last = {}, 2**63 - 1
    data = [((last if i is None else i), (t or "").encode()) for i, t in rows]
    for doc, text in data:
        for a in range(len(text) - s.LENGTH + 1):
            k = text[a : a + s.LENGTH]
            first[k] = min(first.get(k, last), doc)
    out = []
    for doc, text in data:
        gone = np.zeros(len(text), bool)
        for a in range(len(text) - s.LENGTH + 1):
            if first[text[a : a + s.LENGTH]] < doc:
                gone[a : a + s.LENGTH] = True
        out.append(gone)
    return out


def brute(rows):
    out = []
    for (doc_id, text), gone in zip(rows, removed(rows), strict=True):
        data = np.frombuffer((text or "").encode(), np.uint8)
        spans = int(np.count_nonzero(np.diff(np.concatenate([[0], gone.astype(np.int8)])) == 1))
        kept = hashlib.sha256(data[~gone].tobytes()).hexdigest()
        out.append((doc_id, len(data), int(gone.sum()), spans, kept))
    return sorted(out, key=str)


def texts(seed):
    rng = random.Random(seed)
    letters = rng.choice(["a", "ab", "abcdefgh \n", "aé日"])
    pool = ["".join(rng.choice(letters) for _ in range(rng.randint(1, 200))) for _ in range(4)]
    out = []
    for _ in range(rng.randint(1, 12)):
        parts = []
        for _ in range(rng.randint(0, 4)):
            if rng.random() < 0.6:
                x = rng.choice(pool)
                a = rng.randint(0, len(x))
                parts.append(x[a : rng.randint(a, len(x))] if rng.random() < 0.5 else x)
            else:
                parts.append("".join(rng.choice(letters) for _ in range(rng.randint(0, 60))))
        out.append((rng.randint(0, 8) if seed % 3 == 0 else len(out), "".join(parts)))
    return out


@pytest.mark.parametrize("seed", range(80))
def test_buckets_against_brute_force(seed, monkeypatch):
    rng = random.Random(seed)
    monkeypatch.setattr(s, "HASH_BYTES", rng.choice([60, 100, 1 << 19]))
    monkeypatch.setattr(s, "PART", rng.choice([3, 50, 100_000]))
    rows = texts(seed)
    data = [t.encode() for _, t in rows]
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in data])]).astype(np.int64)
    found = s.find_segments(np.frombuffer(b"".join(data), np.uint8), offsets, np.array([i for i, _ in rows]))
    if len(found):
        halves = [found.take(np.arange(a, len(found), 2)) for a in (0, 1)]
        found = s.Segments.unpack([h.pack() for h in halves])
    got = [np.zeros(len(t), bool) for t in data]
    for own, a, b in s.spans_of(found).tolist():
        got[own][a:b] = True
    for x, y in zip(got, removed(rows), strict=True):
        assert (x == y).all()


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("block_bytes", [300, 8 << 20])
def test_tables_against_brute_force(docs_of, odd_rows, block_bytes):
    rows = odd_rows + [(100 + 100 * k + i, t) for k in (1, 2, 4) for i, t in texts(k)]
    docs = docs_of(rows)
    assert result(s.remove_repeats(docs, block_bytes=block_bytes)) == brute(rows)


def test_text_that_is_left(docs_of):
    line = "This sentence is long enough to be more than fifty bytes of text. "
    rows = [(1, "a " + line), (2, "b " + line + "end"), (3, line), (4, line)]
    got = {r["doc_id"]: r["kept"] for r in s.remove_repeats(docs_of(rows), with_text=True).collect()}
    assert got == {1: "a " + line, 2: "bend", 3: "", 4: ""}


def test_covers_and_orders():
    for v in (2, 7, 32, 64):
        cover = s.difference_cover(v)
        assert {(a - b) % v for a in cover for b in cover} == set(range(v))
    rng = np.random.default_rng(3)
    rows = np.zeros((60, s.ROW), np.uint8)
    rows[:, :80] = rng.integers(97, 99, (60, 80))
    rows[20:40, :80] = rows[:20, :80]
    rows[45, 10:80] = rows[3, :70]
    places = np.concatenate([np.arange(31) + s.ROW * i for i in range(60)])
    got = s.CoverOrder(rows).sort(places)
    flat = rows.reshape(-1)
    keys = [flat[p : p + s.LENGTH].tobytes() for p in got]
    assert keys == sorted(keys)


def test_blocks_do_not_share_a_group():
    """Rows that only need to reach their block are grouped by it, however many blocks there are."""
    text = "".join(chr(33 + i * i * 7 % 90) for i in range(400))
    rows = pa.table({"block": [0, 0], "least": [1, 2], "sha": ["a", "b"], "text": [text, text + "x"]})
    told = pa.table({"bucket": pa.array([], pa.int32()), "block": pa.array([], pa.int64()), "anchors": pa.array([], pa.binary())})
    buckets = {s._send(8)((pa.scalar(b),), rows, told).column("bucket")[0].as_py() for b in range(200)}
    assert len(buckets) == 200 and max(buckets) < 0
