"""Licence scan against a plain version that tries every template at every place."""

import math
import random

import pytest
from driftlake.llm import license_scan as ls
from driftlake.llm.queries import BASE_LICENSES, op12_license_scan

ALL = BASE_LICENSES + ls.TEMPLATES


def plain(rows, templates):
    texts = [ls.words_of(t or "") for _, t in rows]
    weight = {
        w: math.log(1 + (len(rows) + 1) / (sum(w in words for words in texts) + 1))
        for t in templates for w in ls.words_of(t.text)
    }
    out = []
    for (doc_id, _), words in zip(rows, texts):
        places = []
        for template in templates:
            own = ls.words_of(template.text)
            rare, keys = ls.rare_words(template, weight), ls._keys(template)
            for start in range(-len(own), len(words)):
                there = [0 <= start + i < len(words) and words[start + i] == w for i, w in enumerate(own)]
                score = sum(weight[w] for w, here in zip(own, there) if here) / sum(weight[w] for w in own)
                agreed = sum(there[i] for i, _ in rare)
                if agreed >= (len(rare) + 1) // 2 and all(there[i] for i, _ in keys) and score >= ls.LEAST:
                    places.append((template.label, template.base, start, len(own), round(score, 9)))
        out.append((str(doc_id), len(words), sorted(places)))
    return sorted(out)


def found(df):
    return sorted((str(r.doc_id), r.n_words, sorted((*p[:4], round(p.score, 9)) for p in r.places)) for r in df.collect())


def random_texts(seed, n):
    rng = random.Random(seed)
    pieces = [t.text for t in ALL] + ["cc", "by", "CC BY", "general public", "all rights", "lorem", "ipsum", "é", "2.0"]
    out = []
    for i in range(n):
        words = " ".join(rng.choices(pieces, k=rng.randint(0, 6))).split()
        for _ in range(rng.randint(0, 3)):
            if words:  # a word lost, changed or put in
                words[rng.randrange(len(words))] = rng.choice(["", "x", "new word"])
        out.append((i, rng.choice([" ", ", ", "\n", " -- "]).join(words)))
    return out


def test_against_plain_version(spark, docs_of, odd_rows):
    short = [(i, t if t is None else t[:4000]) for i, t in odd_rows]
    rows = short + random_texts(1, 250) + [
        (900, "ALL RIGHTS RESERVED. All rights reserved"), (901, "all rights all rights reserved"),
        (902, "cc-by CC_BY ccby cc/by 4.0"), (903, "of the general public license"), (903, "of the general public license"),
    ]
    got = found(ls.find(docs_of(rows), ALL))
    assert got == plain(rows, ALL)
    assert sum(len(p) for _, _, p in got) > 200
    assert any(s < 1 for _, _, p in got for *_, s in p)


def test_every_base_place_counts(spark, tmp_path):
    rows = [(1, "cc by x cc by. All rights reserved"), (2, "no notice"), (3, None), (4, ""),
            (5, "Licensed under CC BY-NC 4.0."), (6, "This work is licensed under the GNU General Public License, version 3."),
            (None, "Released under the MIT License.")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in op12_license_scan(spark, str(tmp_path)).collect()}
    assert tuple(got[1])[1:7] == (8, 3, 0, 5, "cc-by,reserved", "cc-by,reserved")
    assert tuple(got[2])[1:] == (2, 0, None, None, "", "", 0.0)
    assert tuple(got[3])[1:] == tuple(got[4])[1:] == (0, 0, None, None, "", "", 0.0)
    assert tuple(got[5])[2:7] == (1, 2, 2, "cc-by", "cc-by,cc-by-nc")
    assert tuple(got[6])[2:7] == (1, 7, 7, "gpl", "gpl,gpl-3")
    assert tuple(got[None])[2:] == (0, None, None, "", "mit", 1.0)


def test_very_long_text(spark, docs_of):
    many = "all rights reserved " * 40_000 + "word " * 200_000 + "cc by"
    row = ls.find(docs_of([(1, many), (2, "x " * 500_000)]), BASE_LICENSES).orderBy("doc_id").collect()
    assert row[0].n_words == 320_002 and len(row[0].places) == 40_001
    assert max(p.start for p in row[0].places) == 320_000
    assert (row[1].n_words, row[1].places) == (500_000, [])


def test_no_python_in_the_plan(spark, docs_of):
    plan = ls.find(docs_of([(1, "a")]), ALL)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_key_phrase_must_be_in_its_template():
    with pytest.raises(ValueError):
        ls._keys(ls.Template("x", "one two three", ("two four",)))
