import random
from collections import defaultdict

import numpy as np
import pytest

from driftlake.llm import decontaminate as d


def brute(texts, items):
    """Words, hit words and items of each text, by looking everywhere."""
    windows = defaultdict(set)
    for item_id, text in items:
        words = d.words_of(text)
        for a in range(max(len(words) - d.WINDOW, 0) + 1 if words else 0):
            windows[tuple(words[a : a + d.WINDOW])].add("" if item_id is None else str(item_id))
    out = []
    for text in texts:
        words, hit, found = d.words_of(text), set(), set()
        for n in {len(w) for w in windows}:
            for a in range(len(words) - n + 1):
                if tuple(words[a : a + n]) in windows:
                    found |= windows[tuple(words[a : a + n])]
                    hit.update(range(a, a + n))
        out.append((len(words), len(hit), sorted(found)))
    return out


def case(seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(rng.choice([2, 5, 30]))]
    sizes = [10, 11, 15, 30] if seed % 2 else [0, 1, 3, 9, 10, 11, 30]
    items = [(i, " ".join(rng.choice(words) for _ in range(rng.choice(sizes)))) for i in range(rng.randint(0, 5))]
    texts = []
    for _ in range(rng.randint(1, 8)):
        parts = []
        for _ in range(rng.randint(0, 4)):
            if items and rng.random() < 0.6:
                parts.append(rng.choice(items)[1])
            else:
                parts.append(" ".join(rng.choice([*words, "zz", "Qq", "é"]) for _ in range(rng.randint(0, 20))))
        texts.append(rng.choice([" ", ", ", "\n"]).join(parts))
    return texts, items


@pytest.mark.parametrize("seed", range(60))
def test_shards_against_brute_force(seed):
    texts, items = case(seed)
    data = [t.encode() for t in texts]
    hits = d.search_shard(data, d.Phrases.of(items))
    want = brute(texts, items)
    assert list(zip(hits.n_words.tolist(), hits.n_hit.tolist(), hits.items, strict=True)) == want
    for text, spans, (_, n_hit, _) in zip(data, hits.spans, want, strict=True):
        assert sum(len(d.words_of(text[s["start"] : s["end"]].decode())) for s in spans) == n_hit
    first = d.search_shard(data, d.Phrases.of(items[:2]))
    both = d.search_shard(data, d.Phrases.of(items[2:]), (first.spans, first.items))
    assert list(zip(both.n_words.tolist(), both.n_hit.tolist(), both.items, strict=True)) == want


def test_suffix_order_and_wavelets():
    rng = np.random.default_rng(1)
    symbols = np.append(rng.integers(0, 4, 500), 0)
    names = symbols.astype(object)
    zeros = np.flatnonzero(symbols == 0)
    # Separators are told apart by their place.
    keys = [(0, i) if s == 0 else (1, s) for i, s in enumerate(names)]
    want = sorted(range(len(keys)), key=lambda i: keys[i : zeros[zeros >= i][0] + 1])
    assert d.suffix_order(symbols).tolist() == want
    matrix = d.WaveletMatrix(symbols, 3)
    places = np.arange(len(symbols))
    assert (matrix.access(places) == symbols).all()
    for c in range(1, 4):
        assert (matrix.rank(np.full(len(places), c), places) == np.cumsum(symbols == c) - (symbols == c)).all()


@pytest.mark.parametrize("block_bytes", [10, 1 << 20])
def test_odd_rows_and_item_blocks(spark, docs_of, odd_rows, block_bytes):
    docs = docs_of(odd_rows)
    items = [(7, "quick brown fox jumps over the lazy dog again and"), (8, None), (9, ""), (None, "é"), (10, "a")]
    table = spark.createDataFrame(items, "item_id long, text string")
    found = d.find(docs, table, block_bytes)
    got = sorted(((r["row"]["doc_id"], r["n_words"], r["n_hit"], r["items"]) for r in found.collect()), key=str)
    texts = [t for _, t in odd_rows]
    want = sorted(((i, *w) for (i, _), w in zip(odd_rows, brute(texts, items), strict=True)), key=str)
    assert got == want
    clean = d.remove_spans(found)
    assert clean.columns == docs.columns
    rows = clean.collect()
    assert len(rows) == sum(not (w[1] and w[1] == w[0]) for w in brute(texts, items))
    assert {r["doc_id"]: r["text"] for r in rows}[1] == "The  again."
    assert {r["doc_id"]: r["n_chars"] for r in rows}[1] == 11


def test_each_stage_searches_one_block_of_phrases(spark, docs_of):
    """A benchmark in several blocks gives the hits of one pass, and no stage with two searches."""
    items = [(f"i{n}", " ".join(f"w{n}x{k}" for k in range(14))) for n in range(12)]
    docs = docs_of([(n, "before " + items[n][1] + " and " + items[(n + 5) % 12][1]) for n in range(12)] + [(99, None)])
    bench = spark.createDataFrame(items, "item_id string, text string")
    one, many = d.find(docs, bench), d.find(docs, bench, block_bytes=300)
    assert one._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    assert many._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1

    def key(df):
        return sorted(str((r["row"]["doc_id"], r.n_words, r.n_hit, r.spans, sorted(r["items"]), r.left)) for r in df.collect())

    assert key(one) == key(many)
    assert len(list(d.item_blocks(bench, 300))) > 3
