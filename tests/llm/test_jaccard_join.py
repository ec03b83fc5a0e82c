import random
import re

import numpy as np
import pytest

from driftlake.llm import jaccard_join as j


def shingles(text, k=5):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in re.split("[ \t-\r]+", text) if w]
    return {tuple(words[i : i + k]) for i in range(max(len(words) - k, 0) + 1)} if words else set()


def linked(a, b):
    common = len(a & b)
    return 100 * common >= 75 * (len(a) + len(b) - common) and common > 0


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if linked(sets[a], sets[b]):
                root[find(a)] = find(b)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[find(i)] = min(least.get(find(i), doc_id), doc_id)
    return sorted(((rows[i][0], len(s), least.get(find(i)) if s else rows[i][0]) for i, s in enumerate(sets)), key=str)


def result(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_shingles", "component_id").collect()), key=str)


def near_copies(seed, clusters=12):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = [rng.choice(vocabulary) for _ in range(30)]
    rows = []
    for _ in range(clusters):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([3, 8, 40, 150]))]
        if rng.random() < 0.5:
            base[len(base) // 2 : len(base) // 2] = passage
        for _ in range(rng.choice([1, 2, 5, 25])):
            own = [rng.choice(vocabulary) if rng.random() < 0.01 else w for w in base]
            rows.append((len(rows), " ".join(own)))
            base = own if rng.random() < 0.3 else base
    return rows


@pytest.mark.parametrize(("seed", "chunk"), [(1, 2048), (2, 6), (3, 2), (4, 1)])
def test_components_against_brute_force(docs_of, seed, chunk):
    rows = near_copies(seed)
    assert result(j.near_duplicates(docs_of(rows), chunk=chunk)) == brute(rows)


def test_odd_rows(docs_of, odd_rows):
    assert result(j.near_duplicates(docs_of(odd_rows))) == brute(odd_rows)


def test_one_document_of_each_component(docs_of, odd_rows):
    docs = docs_of(odd_rows)
    kept = j.first_of_each(docs)
    assert kept.columns == docs.columns
    # 2 and 3 go for 1, 10 goes for 9; texts without a word stay, repeated rows once.
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(
        map(str, [1, 4, 5, 6, 7, 8, 9, None, None, 11, 12, -3]))


def test_shingle_hashes_stand_for_shingles(monkeypatch):
    rng = random.Random(5)
    for _ in range(40):
        texts = ["".join(rng.choice(["a", "b", "B", "é", "\x1c", " ", " ", "\n", "\x0b"]) for _ in range(rng.randint(0, 80)))
                 for _ in range(rng.randint(1, 12))]
        data = [t.encode() for t in texts]
        offsets = np.concatenate([[0], np.cumsum([len(t) for t in data])]).astype(np.int64)
        monkeypatch.setattr(j, "HASH_BYTES", rng.choice([1, 50, 1 << 20]))
        sets = j.shingle_sets(np.frombuffer(b"".join(data), np.uint8), offsets, 5)
        for a, x in zip(texts, sets, strict=True):
            assert len(x) == len(shingles(a))
            for b, y in zip(texts, sets, strict=True):
                assert len(np.intersect1d(x, y)) == len(shingles(a) & shingles(b))


@pytest.mark.parametrize("seed", range(40))
def test_trees_link_what_brute_force_links(seed, monkeypatch):
    monkeypatch.setattr(j, "LEAF", 3)
    rng = random.Random(seed)
    base, sets = [rng.getrandbits(63) for _ in range(60)], []
    for _ in range(rng.randint(2, 60)):
        if sets and rng.random() < 0.7:
            own = {x for x in rng.choice(sets) if rng.random() > 0.1} | {rng.getrandbits(63) for _ in range(rng.randint(0, 4))}
        else:
            own = {rng.choice(base) for _ in range(rng.randint(1, 40))}
        sets.append(own or {1})
    arrays = [np.array(sorted(s), np.uint64) for s in sets]
    tree = j.SignatureTree(list(range(len(sets))), [len(s) for s in sets], arrays, (75, 100))
    tree.join_self()
    label = dict(zip(tree.classes, tree.labels.tolist(), strict=True))
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            if linked(sets[a], sets[b]):
                root[find(a)] = find(b)
    for a in range(len(sets)):
        for b in range(a):
            assert (label[a] == label[b]) == (find(a) == find(b))


def test_blocks_do_not_share_a_group(spark):
    """Ids and sizes, which only need to reach their block, are grouped by it."""
    docs = spark.range(0, 150, 1, 150).selectExpr("concat('text number ', id) AS text")
    dealt = docs.mapInArrow(j._deal(5, 8), j.PAYLOAD_SCHEMA).filter("bucket < 0").select("bucket", "block").collect()
    assert len({r["block"] for r in dealt}) == len({r["bucket"] for r in dealt}) == 150


def test_all_bits_of_a_shingle_are_kept(spark):
    """What comes back from the buckets is all 64 bits of the hashes."""
    text = "one two three four five six seven eight nine"
    docs = spark.createDataFrame([(text,), (text + " ten",)], "text string").repartition(1)
    whole = set(j.shingle_sets(np.frombuffer(text.encode(), np.uint8), np.array([0, len(text)]), 5)[0].tolist())
    for bits in (8, 11):
        dealt = docs.mapInArrow(j._deal(5, bits), j.PAYLOAD_SCHEMA)
        rows = dealt.groupBy("bucket").applyInArrow(j._count(bits), j.SHARED_SCHEMA).filter("hashes is not null").collect()
        assert {x for r in rows for x in np.frombuffer(r["hashes"], np.uint64).tolist()} == whole


def chain(n):
    """Texts of four blocks of words each, three of them shared with the next text: a similarity of
    0.6, so none is linked, but most are candidates of their neighbours.  Some are copied closely."""
    blocks = [" ".join(f"b{i}w{k}" for k in range(16)) for i in range(n + 4)]
    rows = [(i, " ".join(blocks[i : i + 4])) for i in range(n)]
    return rows + [(n + i, rows[i * 9][1] + f" end{i}") for i in range(n // 20)]


def test_a_chained_group_is_sent_in_proportion_to_its_size(spark, docs_of, monkeypatch):
    """3,000 sets in chained groups: linear in what is sent, and no link is lost."""
    sent = {}
    whole = j._parts

    def counting(units, chunk):
        found = whole(units, chunk)
        sent[chunk] = found.count()
        return found

    monkeypatch.setattr(j, "_parts", counting)
    rows = chain(3000)
    got = {r["doc_id"]: r["component_id"] for r in j.near_duplicates(docs_of(rows), chunk=16).collect()}
    assert got == {i: (i - 3000) * 9 if i >= 3000 else i for i, _ in rows}
    # Chunk by chunk a group of n sets would send n * n / 16; a set has 17 rarest shingles at most here.
    assert 0 < sent[16] <= 17 * len(rows)


def test_one_rare_shingle_that_many_sets_share(docs_of):
    """More than a chunk of unlinked sets behind one shingle still meet, chunk by chunk."""
    import itertools

    common = "one two three four five"
    pairs = list(itertools.combinations(range(9), 2))
    parts = [" ".join(f"p{i}w{k}" for k in range(9)) for i in range(9)]
    rows = [(n, f"{common} {parts[a]} {parts[b]}") for n, (a, b) in enumerate(pairs)]
    rows += [(100 + n, t + f" more{n}") for n, t in rows[::5]]
    for chunk in (1, 3, 8):
        assert result(j.near_duplicates(docs_of(rows), chunk=chunk)) == brute(rows)
