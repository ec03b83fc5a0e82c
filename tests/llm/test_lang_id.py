import zlib

from driftlake.llm import lang_id


def test_accuracy_on_held_out_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = lang_id.identify(docs).select("row.doc_id", "row.lang", "held_out", "lang_pred", "score").collect()
    assert len(rows) == docs.count()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r["held_out"] and r["lang_pred"] != "und"]
    assert sum(r["lang"] == r["lang_pred"] for r in held) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_rows_to_learn_from_decide_and_others_do_not(docs_of, spark):
    rows = [(i, "aaa bab aba") if i % 2 else (i, "zzz yzy zyz") for i in range(60)]
    docs = spark.createDataFrame([(i, t, "aa" if i % 2 else "zz") for i, t in rows], "doc_id long, text string, lang string")
    wrong = spark.createDataFrame(
        [(i, t, None if zlib.crc32(str(i).encode()) % 4 != 2 else "no") for i, t in rows], "doc_id long, text string, lang string")
    both = lang_id.identify(docs).select("row.doc_id", "lang_pred").collect()
    assert all(r["lang_pred"] == ("aa" if r["doc_id"] % 2 else "zz") for r in both)
    assert {r["lang_pred"] for r in lang_id.identify(wrong).collect()} == {"und"}


def test_odd_rows(docs_of, odd_rows):
    docs = docs_of(odd_rows)
    found = lang_id.identify(docs).collect()
    assert len(found) == len(odd_rows)
    for r in found:
        letters = any(c.isalpha() for c in r["row"]["text"] or "")
        assert r["lang_pred"] == ("en" if letters else "und")
        assert (r["score"] == 0) == (not letters) or letters
    kept = lang_id.known_language(docs)
    assert kept.columns == docs.columns
    assert kept.count() == sum(any(c.isalpha() for c in t or "") for _, t in odd_rows)


def test_bundles_do_not_depend_on_neighbours():
    texts = ["one two", "", "ÄÖ ü!", "x", "one two"]
    together = lang_id.bundle([t.encode() for t in texts])
    for text, row in zip(texts, together, strict=True):
        assert (lang_id.bundle([text.encode()])[0] == row).all()


def test_texts_with_letters_stay_whatever_the_labels(spark):
    rows = [(i, "plain words here" if i % 3 else "123 ?!") for i in range(30)] + [(30, None)]
    want = sorted(i for i, t in rows if i % 3 and t)
    for lang in (None, "und"):
        docs = spark.createDataFrame([(i, t, lang) for i, t in rows], "doc_id long, text string, lang string")
        kept = lang_id.known_language(docs)
        assert kept.columns == docs.columns
        assert sorted(r["doc_id"] for r in kept.collect()) == want


def plain_vector(text):
    """Sum over the letters of each word of the product of its and its neighbours' vectors."""
    import numpy as np

    slots, vectors = lang_id._slots(), lang_id._letters()[2].astype(np.int64)
    symbols = [0, *(int(slots[ord(c)]) for c in text.lower()), 0]
    total = np.zeros(lang_id.DIMENSIONS, np.int64)
    for before, letter, after in zip(symbols, symbols[1:], symbols[2:]):
        if letter:
            total += np.roll(vectors[before], 2) * np.roll(vectors[letter], 1) * vectors[after]
    return total


def test_against_plain_version(spark, docs_of, odd_rows):
    """Profiles letter by letter, prototypes and cosines one by one."""
    import numpy as np

    texts = {"en": "the quick brown fox", "de": "der schnelle braune füchs", "es": "el zorro marrón rápido", "ja": "日本 の 狐"}
    rows = [(i, f"{texts[lang]} {w} {i % 7}", lang) for i in range(40) for lang, w in zip(texts, ("it's", "über", "ñandú", "です"))]
    rows = [(n, t, lang) for n, (_, t, lang) in enumerate(rows)]
    rows += [(1000 + n, None if t is None else t[:400], None) for n, (_, t) in enumerate(odd_rows)] + [(None, "the", "en")]
    got = lang_id.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5)).collect()
    sums = {}
    for doc_id, text, lang in rows:
        if lang is None or text is None or zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 4 == 2:
            continue
        vector = plain_vector(text)
        steps = np.rint(vector / max(np.linalg.norm(vector), 1) * lang_id.UNIT)
        sums[lang] = sums.get(lang, 0) + steps
    prototypes = {lang: s / np.linalg.norm(s) for lang, s in sums.items()}
    want = {}
    for doc_id, text, _ in rows:
        vector = plain_vector(text or "")
        norm = np.linalg.norm(vector)
        cosines = {lang: float(vector @ p / norm) for lang, p in prototypes.items()} if norm else {}
        want[str((doc_id, text))] = cosines
    for r in got:
        cosines = want[str((r.row.doc_id, r.row.text))]
        if not cosines:
            assert (r.lang_pred, r.score) == ("und", 0.0)
            continue
        best = max(cosines.values())
        assert abs(cosines[r.lang_pred] - best) < 1e-4
        assert abs(r.score - min(max(best, 0), 1)) < 1e-4
    assert len(got) == len(rows)


def test_a_text_beyond_a_block_is_judged_whole(spark):
    """Longer than BLOCK_BYTES, with its language in the last part only."""
    head = "1234567890 " * (lang_id.BLOCK_BYTES // 10)
    rows = [(i, "der hund und die katze", "de") for i in range(40)] + [(100 + i, "the dog and the cat", "en") for i in range(40)]
    rows += [(1000, head + "der hund und die katze", None), (1001, head + "the dog and the cat", None), (1002, head, None)]
    found = lang_id.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    got = {r.row.doc_id: r.lang_pred for r in found.filter("row.doc_id >= 1000").collect()}
    assert got == {1000: "de", 1001: "en", 1002: "und"}


def test_more_languages_than_are_held_at_once(spark, monkeypatch):
    """In blocks of languages the same predictions come out as in one."""
    rng = __import__("random").Random(4)
    rows = []
    for i in range(40):
        words = ["".join(rng.choices("abcdefghijklmnop", k=5)) for _ in range(6)]
        rows += [(len(rows) + k, " ".join(rng.choices(words, k=8)), f"l{i:02}") for k in range(8)]
    rows += [(5000, None, None), (5001, "123", None), (None, "abc", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")

    def found():
        got = lang_id.identify(docs).collect()
        return sorted((str(r.row.doc_id), r.held_out, r.lang_pred, round(r.score, 5)) for r in got)

    whole = found()
    monkeypatch.setattr(lang_id, "MOST_LANGUAGES", 7)
    assert found() == whole
    assert len({r[2] for r in whole}) > 30
