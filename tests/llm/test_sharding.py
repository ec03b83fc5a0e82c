import zlib
from collections import Counter

from pyspark.sql import functions as F

from driftlake.llm import sharding


def test_places_are_even_gapless_and_computable(spark, docs_of, odd_rows):
    rows = odd_rows + [(100 + i, f"text {i}") for i in range(500)]
    found = sharding.shard_rows(docs_of(rows), shards=7)
    got = found.collect()
    assert len(got) == len(rows)
    sizes = Counter(r["shard"] for r in got)
    assert max(sizes.values()) - min(sizes.values()) <= 1
    for shard, n in sizes.items():
        assert sorted(r["slot"] for r in got if r["shard"] == shard) == list(range(n))
    assert sorted(r["row_number"] for r in got) == list(range(len(rows)))
    want = Counter((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in rows)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == want
    back = sharding.row_number_at(F.col("shard"), F.col("slot"), 7, F.col("total"))
    assert found.filter(back != F.col("row_number")).count() == 0


def test_same_places_again_and_other_seed(spark, docs_of):
    docs = docs_of([(i, f"t{i}") for i in range(300)])
    place = lambda seed, d: {r["doc_id"]: (r["shard"], r["slot"]) for r in sharding.shard_rows(d, 5, seed).collect()}
    first = place(1, docs)
    assert first == place(1, docs.repartition(13))
    assert first != place(2, docs)


def test_permutation_of_small_counts(spark):
    for total in (1, 2, 3, 5, 17, 64, 1000):
        x = spark.range(total).select(sharding.walk(F.col("id"), F.lit(total).cast("long"), 3).alias("y"))
        assert sorted(r["y"] for r in x.collect()) == list(range(total))


def plain_place(x, total, seed):
    """Feistel rounds and the cycle walk by plain integers."""
    import math
    import struct

    import xxhash

    def mixed(*parts):
        out = 42  # Spark hashes column by column, each with the hash before as its seed
        for data in parts:
            out = xxhash.xxh64_intdigest(data, out)
        return out - (1 << 64) if out >> 63 else out

    a = max(math.ceil(math.sqrt(total)), 1)
    b = (total + a - 1) // a
    while True:
        left, right = divmod(x, b)
        for i in range(sharding.ROUNDS):
            keys = struct.pack("<i", seed), struct.pack("<i", i)
            if i % 2 == 0:
                left = (left + mixed(struct.pack("<q", right), *keys) % a) % a
            else:
                right = (right + mixed(struct.pack("<q", left), *keys) % b) % b
        x = left * b + right
        if x < total:
            return x


def test_places_against_a_plain_feistel(spark, docs_of, odd_rows):
    rows = odd_rows + [(100 + i, f"text {i % 30}") for i in range(300)]
    found = sharding.shard_rows(docs_of(rows), shards=24, seed=5).collect()
    assert sorted(r.row_number for r in found) == list(range(len(rows)))
    for r in found:
        place = plain_place(r.row_number, len(rows), 5)
        assert (r.shard, r.slot) == (place % 24, place // 24)
