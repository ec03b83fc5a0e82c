import random

import numpy as np
import public_tokenizers
import pyarrow as pa
from test_jaccard_join import shingles

from driftlake.llm import chunks, jaccard_join, lang_id
from driftlake.llm.common import blocks, from40, low40, pieces, text_buffer
from driftlake.llm.token_count import WordBpe


def test_pieces_are_the_text_again_and_end_on_white_space():
    rng = random.Random(1)
    for _ in range(200):
        text = "".join(rng.choice("ab \n") if rng.random() < 0.3 else "x" for _ in range(rng.randint(0, 300))).encode()
        parts = [p.tobytes() for p in pieces(np.frombuffer(text, np.uint8), rng.randint(1, 40))]
        assert b"".join(parts) == text
        assert all(p[-1:] in (b" ", b"\n") for p in parts[:-1])


def test_buffers_and_blocks_of_sliced_columns():
    column = pa.array(["skipped", None, "", "é", "abc"]).slice(1)
    data, offsets = text_buffer(column)
    assert data.tobytes() == "éabc".encode() and offsets.tolist() == [0, 0, 0, 2, 5]
    assert list(blocks(offsets, 2)) == [(0, 3), (3, 4)]
    assert text_buffer(pa.array([], pa.string()))[1].tolist() == [0]
    numbers = np.array([0, 5, 2**40 - 1], np.uint64)
    assert (from40(low40(numbers)) == numbers).all()


def test_long_texts_in_parts_give_the_same(monkeypatch):
    rng = random.Random(2)
    text = " ".join(f"word{rng.randint(0, 99)}, Ünd{rng.randint(0, 9)}" for _ in range(400))
    data = np.frombuffer(text.encode(), np.uint8)
    ends = np.array([0, len(data)])
    path = public_tokenizers.path("word_bpe_49k.json")
    whole = chunks.ChunkTable(WordBpe(path).resolve).counts(data, ends).tolist()
    vector = lang_id.bundle([text.encode()])
    monkeypatch.setattr(chunks, "PIECE", 100)
    monkeypatch.setattr(jaccard_join, "HASH_BYTES", 64)
    monkeypatch.setattr(lang_id, "BLOCK_BYTES", 64)
    assert chunks.ChunkTable(WordBpe(path).resolve).counts(data, ends).tolist() == whole
    assert len(jaccard_join.shingle_sets(data, ends, 5)[0]) == len(shingles(text))
    ((_, _, parts),) = lang_id._vectors(pa.array([text]))
    assert np.array_equal(parts, vector)


def test_groups_of_many_rows_are_sent_to_the_rows(spark, monkeypatch):
    from driftlake.llm import common

    monkeypatch.setattr(common, "HEAVY_ROWS", 5)
    rows = [(i, "hot", i % 7) for i in range(400)] + [(None, "hot", 1)] + [(i, f"k{i // 3}", 2) for i in range(90)]
    rows += [(7, "warm", 3)] * 5 + [(8, "brisk", 3)] * 6
    df = spark.createDataFrame(rows, "doc_id long, sha string, x int")
    groups = df.groupBy("sha").count().withColumnRenamed("count", "n").selectExpr("sha", "n", "upper(sha) AS big").cache()
    got = common.join_groups(df, groups, "sha", "n")
    assert got.columns == ["doc_id", "sha", "x", "n", "big"]
    sizes = {}
    for _, sha, _ in rows:
        sizes[sha] = sizes.get(sha, 0) + 1
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(str((*r, sizes[r[1]], r[1].upper())) for r in rows)
    # The hot key's rows are spread: no task after the shuffle has most of them.
    spread = got.filter("sha = 'hot'")
    plan = spread._jdf.queryExecution().toString()
    assert "BroadcastHashJoin" in plan or "broadcast" in plan.lower()
    assert common.join_groups(df.limit(0), groups.limit(0), "sha", "n").collect() == []
