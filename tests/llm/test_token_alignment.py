"""Token alignment against a plain version that compares every two tokens of a text."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import public_tokenizers
from driftlake.llm import token_alignment as ta
from driftlake.llm.queries import op13_token_alignment

A = public_tokenizers.path("byte_bpe_50k.json")
B = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def libraries():
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B)


def tokens_of(libraries, text):
    """(ids, ranges) of both tokenizers for a whole text, or None."""
    a, b = libraries
    letters = ta._byte_letters()
    ids = [a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)]
    spelled = [
        [b"<|endoftext|>" if i == 50256 else bytes(letters[c] for c in a.id_to_token(i)) for i in ids[0]],
        [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
         for i in ids[1]],
    ]
    if any(b"".join(s) != b" " + text.encode() for s in spelled):
        return None
    ranges = []
    for parts in spelled:
        ends = np.cumsum([len(p) for p in parts]).tolist()
        ranges.append(list(zip([0, *ends[:-1]], ends)))
    return ids, ranges


def plain(libraries, rows):
    out, counts = [], Counter()
    for doc_id, text in rows:
        found = tokens_of(libraries, text) if text else None
        if not found:
            out.append((doc_id, 0, 0, 0, [], "", ""))
            continue
        (a, b), (of_a, of_b) = found
        links = [(x, y) for x, (s, e) in zip(a, of_a) for y, (u, v) in zip(b, of_b) if s < v and u < e]
        cuts = sorted({e for _, e in of_a} & {e for _, e in of_b})
        groups, start = [], 0
        for cut in cuts:
            groups.append("|".join(
                ",".join(str(i) for i, (_, e) in zip(ids, own) if start < e <= cut) for ids, own in ((a, of_a), (b, of_b))))
            start = cut
        line = ";".join(groups)
        counts.update(links)
        out.append((doc_id, len(a), len(b), len(groups), links, hashlib.sha256(line.encode()).hexdigest(), line))
    most = defaultdict(int)
    for (_, y), n in counts.items():
        most[y] = max(most[y], n)
    return [
        (i, na, nb, ng, len(links), sum(counts[p] == most[p[1]] for p in links), sum(counts[p] for p in links), sha, line)
        for i, na, nb, ng, links, sha, line in out
    ]


ODD = [
    "a", "b", "the", " ", "  ", "\n", "\t", "é", "ß", "日本", "。", " ", " ", "　", "'s", "'", "1", "23", "!",
    "...", "<|endoftext|>", "<s>", "<0x0A>", " ", "😀", "É", "ﬁ", "́", "Σ", "\x00", "\x1c", "\x85", "“", "”",
    "​", "word", "ing", " word", " the", " ", "▁",
]


def random_rows(seed, n, length):
    rng = random.Random(seed)
    weights = [1 if p == "▁" else 12 for p in ODD]
    return [(i, "".join(rng.choices(ODD, weights, k=rng.randint(0, length)))) for i in range(n)]


def test_against_plain_version(spark, docs_of, libraries, odd_rows):
    short = [(i, t if t is None or len(t) < 5000 else t[:3000]) for i, t in odd_rows]
    rows = short + random_rows(3, 300, 40) + [(7, "the the"), (7, "the the"), (8, "x▁y the")]
    got = ta.align(docs_of(rows), A, B, with_groups=True).collect()
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    def key(r):
        return tuple(str(v) for v in r)

    found = sorted(([*(r[n] for n in names), r.groups] for r in got), key=key)
    assert found == sorted((list(r) for r in plain(libraries, rows)), key=key)
    assert sum(r["n_a"] > 0 for r in got) > 250


def test_registered_query_on_whole_texts(spark, tmp_path, libraries):
    rows = [(i, t) for i, t in random_rows(11, 40, 25)]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(tuple(r) for r in op13_token_alignment(spark, str(tmp_path)).collect())
    assert got == sorted(r[:-1] for r in plain(libraries, rows))


def test_pair_counts_are_corpus_wide(spark, docs_of, libraries):
    rows = [(1, "the cat"), (2, "the the dog"), (3, "a the")]
    aligned = ta.aligned_blocks(docs_of(rows).repartition(3), A, B)
    counted = Counter()
    for _, text in rows:
        (a, b), (of_a, of_b) = tokens_of(libraries, text)
        counted.update((x, y) for x, (s, e) in zip(a, of_a) for y, (u, v) in zip(b, of_b) if s < v and u < e)
    assert {(r.id_a, r.id_b): r.links for r in ta.pair_counts(aligned).collect()} == dict(counted)


def test_long_text_in_parts_and_full_table(monkeypatch):
    """A text above PIECE, in parts and with a table that starts over, gives what one piece gives."""
    text = " ".join(f"word{i % 37} täil{i % 11}, x　y  z" for i in range(900)).encode()
    data, offsets = np.frombuffer(text, np.uint8), np.array([0, len(text)])
    models = ta._models(A, B)
    whole = ta._block_row(ta._Chunks(*models), data, offsets, True)
    monkeypatch.setattr(ta, "PIECE", 1000)
    parts = ta._block_row(ta._Chunks(*models), data, offsets, True)
    assert [len(p) <= 1000 for p in ta._parts(data, 1000)].count(False) == 0
    assert [c.tolist() for c in whole[:4]] == [c.tolist() for c in parts[:4]]
    assert whole[4:6] == parts[4:6]
    pairs = [dict(zip(r[8].tolist(), r[9].tolist())) for r in (whole, parts)]
    assert pairs[0] == pairs[1]
    solid = np.frombuffer(b"x" * 5000, np.uint8)
    assert [len(p) for p in ta._parts(solid, 1000)] == [5000]


def test_galloping_finds_ranks_from_any_guess():
    rng = np.random.default_rng(1)
    for _ in range(200):
        keys, others = (np.unique(rng.integers(0, 300, rng.integers(1, 60))) for _ in range(2))
        rank, found = ta.gallop(keys, others, rng.integers(-5, 70, len(keys)))
        assert rank.tolist() == np.searchsorted(others, keys).tolist()
        assert found.tolist() == np.isin(keys, others).tolist()
    rank, found = ta.gallop(np.array([3]), np.zeros(0, np.int64), np.array([0]))
    assert (rank.tolist(), found.tolist()) == ([0], [False])
