import hashlib
import random

import pytest

from driftlake.llm import exact_dedup

SPACE = " \t\n\x0b\x0c\r"


def brute(rows):
    groups = {}
    for doc_id, text in rows:
        norm = "".join(c for c in text or "" if c not in SPACE)
        groups.setdefault(norm, []).append((doc_id, len(text or "")))
    out = []
    for norm, own in groups.items():
        best = min(own, key=lambda o: (-o[1], o[0] is None, o[0] or 0))
        sha, first = hashlib.sha256(norm.encode()).hexdigest(), True
        for o in own:
            kept = o == best and first
            first = first and not kept
            out.append((o[0], best[0], len(own), kept, sha))
    return sorted(out, key=str)


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_odd_rows(docs_of, odd_rows):
    got = exact_dedup.exact_dedup(docs_of(odd_rows))
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert result(got) == brute(odd_rows)


def test_spilling_gives_the_same(docs_of):
    rng = random.Random(1)
    pool = ["".join(rng.choice("abc \n") for _ in range(rng.randint(0, 60))) for _ in range(80)]
    rows = [(i, rng.choice(pool)) for i in range(600)]
    assert result(exact_dedup.exact_dedup(docs_of(rows), limit=64)) == brute(rows)


@pytest.mark.parametrize("limit", [1, 100, 10**6])
def test_grace_partitions_leave_no_files(tmp_path, limit):
    rng = random.Random(2)
    records = []
    for i in range(3000):
        content = str(rng.randint(0, 700)).encode() * 3
        records.append((hashlib.blake2b(content, digest_size=16).digest(), content, 5, i, 1))
    found = list(exact_dedup.grace(iter(records), limit, str(tmp_path)))
    assert len(found) == len({r[1] for r in records})
    assert sum(f[4] for f in found) == 3000
    assert list(tmp_path.iterdir()) == []


def test_equal_hash_of_other_content_stays_apart():
    table = exact_dedup.ContentTable(2)
    for i, content in enumerate([b"a", b"b", b"a"]):
        table.add(b"\0" * 16, content, 1, i, 1)
    assert [(e[1], e[3], e[4]) for e in table.entries] == [(b"a", 0, 2), (b"b", 1, 1)]


def test_one_document_of_each_group_with_all_columns(docs_of, odd_rows):
    docs = docs_of(odd_rows)
    kept = exact_dedup.distinct_documents(docs)
    assert kept.columns == docs.columns
    want = sorted(((r[0], r[4]) for r in brute(odd_rows) if r[3]), key=str)
    got = [(r["doc_id"], hashlib.sha256("".join(c for c in r["text"] or "" if c not in SPACE).encode()).hexdigest())
           for r in kept.collect()]
    assert sorted(got, key=str) == want


def test_many_short_texts_stay_within_the_limit(tmp_path):
    """A million distinct texts of ten bytes: what the table takes, not only its content, counts."""
    import tracemalloc

    from driftlake.llm import exact_dedup

    limit, n = 24 << 20, 1_000_000

    def records():
        for i in range(n):
            content = b"%010d" % i
            yield exact_dedup._hash(content), content, 10, i, 1

    tracemalloc.start()
    groups = sum(1 for _ in exact_dedup.grace(records(), limit, str(tmp_path)))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert groups == n
    assert peak < 1.5 * limit
