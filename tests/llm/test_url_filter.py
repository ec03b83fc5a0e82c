import math
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from driftlake.llm import url_filter as u
from driftlake.llm.queries import URL_RULES


def plain_rule(url):
    rest = url.partition("://")[2] if url and "://" in url else ""
    host = next((rest[:i] for i, c in enumerate(rest) if c in "/?#"), rest)
    path = rest[len(host) :]
    path = next((path[:i] for i, c in enumerate(path) if c in "?#"), path)
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = [r for r in URL_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: len(r.name), default=None)
    return host, path, best.name if best else None, best.verdict if best else None


URLS = [
    None, "", "no scheme", "http://", "HTTP://WWW.Example.ORG/en/12?x#y", "http://example.org/en/2", "http://org",
    "http://a.org/", "http://b.com/fr/1", "http://b.com/fr", "http://com/de/", "http://xcom/de/", "http://a.com?x=://b/",
    "http://example.org/es/", "http://notexample.org/es/1", "http://É.ORG/\nx", "a://b://c.org/", "http://x.net/a#b?c",
]


def judged(spark, urls):
    pages = spark.createDataFrame([(i, x, "h", 1.5) for i, x in enumerate(urls)], "page_id long, url string, html string, score double")
    return u.judge_urls(pages, URL_RULES)


def test_hosts_paths_and_rules(spark):
    got = {r["page_id"]: r for r in judged(spark, URLS + URLS).collect()}
    assert len(got) == 2 * len(URLS)
    for i, url in enumerate(URLS + URLS):
        host, path, rule, verdict = plain_rule(url)
        assert (got[i]["host"], got[i]["path"], got[i]["rule"]) == (host, path, rule), url
        assert got[i]["verdict"] in ("allow", "block")
        if verdict:
            assert got[i]["verdict"] == verdict


def slow_model(urls, labels):
    """The same model by dictionaries: Witten-Bell over exact contexts of up to ORDER symbols.
    """
    table = u._symbols()
    counts = [defaultdict(lambda: defaultdict(int)) for _ in (0, 1)]

    def sequence(url):
        return [int(table[b]) for b in (url or "").encode()] + [u.END]

    def contexts(own, i):
        return [tuple(own[i - k] if i >= k else u.END for k in range(1, order + 1)) for order in range(u.ORDER + 1)]

    for url, label in zip(urls, labels, strict=True):
        own = sequence(url)
        for i, c in enumerate(own):
            for k in contexts(own, i):
                counts[label][k][c] += 1

    def score(url):
        own, total = sequence(url), 0.0
        for i, c in enumerate(own):
            for label, sign in ((0, 1), (1, -1)):
                p = 1 / u.ALPHABET
                for k in contexts(own, i):
                    seen = counts[label].get(k, {})
                    n, kinds = sum(seen.values()), len(seen)
                    if n:
                        p = n / (n + kinds) * seen.get(c, 0) / n + kinds / (n + kinds) * p
                total += sign * math.log(p)
        return total / len(own)

    return score


def test_model_against_dictionaries(spark):
    rows = [(f"http://good.example/{i % 7}/page", 0) for i in range(40)] + [(f"http://bad-{i}.example/buy", 1) for i in range(40)]
    model = u.fit(spark.createDataFrame(rows, "url string, label int"))
    counted = spark.createDataFrame(rows, "url string, label int").filter(
        F.pmod(F.crc32(F.col("url").cast("binary")), F.lit(u.HELD_OUT)) != 0).collect()
    slow = slow_model([r["url"] for r in counted], [r["label"] for r in counted])
    urls = ["http://good.example/3/page", "http://bad-7.example/buy", "", "ftp://é.x/"]
    assert np.allclose(model.score(pa.array(urls)), [slow(x) for x in urls], atol=1e-9)
    good, bad = model.score(pa.array(urls[:2]))
    assert good >= model.threshold > bad


def test_threshold_separates_best():
    assert u.best_threshold({}) == 0.0
    assert u.best_threshold({(0, 5): 3}) == 0.0
    width = 2 * u.CLIP / u.BINS
    cut = u.best_threshold({(0, 1200): 9, (0, 100): 1, (1, 1000): 10})
    assert 1000 * width - u.CLIP < cut <= 1200 * width - u.CLIP


def test_nothing_labelled(spark):
    rows = judged(spark, ["http://a.net/", None]).collect()
    assert {(r["score"], r["verdict"]) for r in rows} == {(0.0, "allow")}


@pytest.mark.parametrize("sf_dir", ["/root/testdata/sf0.01"])
def test_unseen_labels_are_told_apart(spark, sf_dir):
    """Urls of blocked rules score below those of allowed ones."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    rows = u.judge_urls(pages, URL_RULES).filter("rule is not null").collect()
    mean = {v: np.mean([r["score"] for r in rows if r["verdict"] == v]) for v in ("allow", "block")}
    assert mean["allow"] > mean["block"]


def test_contexts_are_not_mixed_up(spark):
    """However many contexts there are, the model is that of the dictionaries, and the urls that set
    the threshold are counted in the end."""
    rng = np.random.default_rng(5)
    letters = np.array(list("abcdefghijklmnopqrstuvwxyz0123456789"))
    rows = [("http://" + "".join(rng.choice(letters, 60)) + f".{x}/", i % 2) for i, x in enumerate(["org", "com"] * 700)]
    df = spark.createDataFrame(rows, "url string, label int")
    kept = df.filter(F.pmod(F.crc32(F.col("url").cast("binary")), F.lit(u.HELD_OUT)) != 0).collect()
    urls = [x for x, _ in rows[:20]] + ["http://" + "".join(rng.choice(letters, 60)) for _ in range(20)]
    slow = slow_model([r["url"] for r in kept], [r["label"] for r in kept])
    assert np.allclose(u.fit(df).score(pa.array(urls)), [slow(x) for x in urls], atol=1e-9)
    slow = slow_model(*zip(*rows, strict=True))
    assert np.allclose(u.fit_whole(df).score(pa.array(urls)), [slow(x) for x in urls], atol=1e-9)


def test_verdicts_end_to_end(spark):
    """Urls without a rule: threshold and verdict by dictionaries and by trying every cut."""
    rng = np.random.default_rng(9)
    words = {"allow": ["library", "history", "garden", "org"], "block": ["casino", "prize", "click", "win"]}
    urls = []
    for i in range(240):
        kind = "allow" if i % 2 else "block"
        tail = "-".join(rng.choice(words[kind], 3)) + str(rng.integers(0, 50))
        urls.append(f"http://site{i % 9}.org/{tail}" if kind == "allow" else f"http://site{i % 9}.com/de/{tail}")
    loose = [f"http://x{i}.net/" + "-".join(rng.choice(words["allow"] + words["block"], 3)) for i in range(60)] + ["", None, "é"]
    rows = [(i, x) for i, x in enumerate(urls + loose)]
    got = {r.page_id: r for r in u.judge_urls(spark.createDataFrame(rows, "page_id long, url string"), URL_RULES).collect()}
    labels = [0 if plain_rule(x)[3] == "allow" else 1 for x in urls]
    held = [zlib.crc32(x.encode()) % u.HELD_OUT == 0 for x in urls]
    part = slow_model([x for x, h in zip(urls, held) if not h], [y for y, h in zip(labels, held) if not h])
    width, bins = 2 * u.CLIP / u.BINS, [[], []]
    for x, y, h in zip(urls, labels, held):
        if h:
            bins[y].append(min(max(math.floor((part(x) + u.CLIP) / width), 0), u.BINS))
    best = []
    for cut in range(u.BINS + 2):
        accuracy = sum(b >= cut for b in bins[0]) / len(bins[0]) + sum(b < cut for b in bins[1]) / len(bins[1])
        best.append((round(accuracy, 9), cut))
    top = [cut for accuracy, cut in best if accuracy == max(best)[0]]
    threshold = top[len(top) // 2] * width - u.CLIP
    score = slow_model(urls, labels)
    judged_ = 0
    for i, url in rows[len(urls):]:
        own = score(url)
        assert math.isclose(got[i].score, own, abs_tol=1e-9) and got[i].rule is None
        if abs(own - threshold) > 1e-9:
            assert got[i].verdict == ("allow" if own >= threshold else "block")
            judged_ += 1
    assert judged_ > 50 and {got[i].verdict for i in range(len(urls), len(rows))} == {"allow", "block"}
