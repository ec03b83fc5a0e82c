import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from driftlake.llm import token_count
from driftlake.llm.chunks import ChunkTable

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def lengths(library, texts):
    return [len(e.ids) for e in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def counts(table, texts):
    data = [t.encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in data])]).astype(np.int64)
    return list(table.counts(np.frombuffer(b"".join(data), np.uint8), offsets))


def test_odd_rows(docs_of, odd_rows, library):
    got = token_count.count_tokens(docs_of(odd_rows), PATH, limit=5).collect()
    texts = [t for _, t in odd_rows]
    want = [(i, len((t or "").encode()), n, n > 5) for (i, t), n in zip(odd_rows, lengths(library, texts), strict=True)]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_random_texts(library):
    rng = random.Random(4)
    letters = "Ab cdeéß'sl12.,;!\n\t\x0b　日<|>endoftextΣσİ́W̊"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 300))) for _ in range(400)]
    texts += ["aaaa aaaaaaa" * 5, "ǅ ﬁ ẞ", "a\x0bb\x0cc\x1cd\x1fe\x85f\xa0g", "A.b,C!!x.'s (y,)", "W̊,E\u0301!", "", " ", "<|endoftext|>x<|startoftext|>"]
    table = ChunkTable(token_count.WordBpe(PATH).resolve, capacity=200)
    got = [n for at in range(0, len(texts), 50) for n in counts(table, texts[at : at + 50])]
    assert got == lengths(library, texts)


def test_long_pre_tokens_take_the_queue(library):
    texts = ["x" * 9000 + "ab" * 300, "日本語テキスト" * 900]
    table = ChunkTable(token_count.WordBpe(PATH).resolve)
    assert counts(table, texts) == lengths(library, texts)
