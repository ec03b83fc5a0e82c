"""The stages against brute force, and what each of them promises."""

import corpus_pipeline
import public_tokenizers
from test_decontaminate import brute as brute_hits
from test_exact_dedup import brute as brute_copies
from test_jaccard_join import brute as brute_near
from tokenizers import Tokenizer

ITEM = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"


def write(spark, tmp_path, rows):
    docs = spark.createDataFrame(
        [(i, t, "en", "s", len(t or "")) for i, t in rows],
        "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    items = spark.createDataFrame([(1, ITEM)], "item_id long, text string")
    items.write.parquet(f"{tmp_path}/benchmark.parquet")
    return docs


def test_each_stage_on_its_own_input(spark, tmp_path, odd_rows):
    rows = odd_rows + [(50, "start of it " + ITEM + " and the rest"), (51, ITEM)]
    docs = write(spark, tmp_path, rows)
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = [(r["doc_id"], r["text"]) for r in docs.collect()]
        after = stage(spark, docs, str(tmp_path)).cache()
        got = sorted(((r["doc_id"], r["text"]) for r in after.collect()), key=str)
        assert after.columns == columns
        if name == "language_id":
            want = [r for r in before if any(c.isalpha() for c in r[1] or "")]
        elif name == "exact_dedup":
            kept = {r[0] for r in brute_copies(before) if r[3]}
            want = [r for r in set(before) if r[0] in kept]
        elif name == "near_duplicates":
            kept = {r[0] for r in brute_near(before) if r[0] == r[2]}
            want = [r for r in before if r[0] in kept]
        else:
            hits = brute_hits([t for _, t in before], [(1, ITEM)])
            want = [(i, t if not h[1] else "start of it  and the rest") for (i, t), h in zip(before, hits, strict=True)
                    if not h[1] or h[1] < h[0]]
        assert got == sorted(want, key=str), name
        docs = spark.createDataFrame(after.collect(), docs.schema)


def test_whole_run(spark, tmp_path, odd_rows):
    rows = odd_rows + [(50, "start of it " + ITEM + " and the rest"), (51, ITEM)]
    write(spark, tmp_path, rows)
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r["doc_id"] for r in got} == {1, 8, 9, None, 11, 12, -3, 50}
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    own = [r for r in got if r["doc_id"] == 50]
    assert [r["length"] for r in own] == [len(library.encode("start of it  and the rest").ids) + 1]


def test_empty_table(spark, tmp_path):
    write(spark, tmp_path, [])
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
