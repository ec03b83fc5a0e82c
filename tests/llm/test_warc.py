import base64
import gzip
import hashlib

import pytest

from driftlake.llm import warc


def pages_of(spark, rows):
    return spark.createDataFrame([(*r, "x", 3) for r in rows], "page_id long, url string, html string, shard string, first int")


ROWS = [
    (5, "http://a/", "<p>one</p>"), (3, "http://b/", "<p>one</p>"), (9, None, None), (8, "http://c/\r\nX: y", ""),
    (1, "http://d/", "é" * 70_000), (7, "http://e/", "two"), (7, "http://e/", "two"), (7, "http://e/", "three"),
    (None, "http://f/", "two"), (None, None, "alone"), (None, None, "alone"), (-4, "http://g/", "\r\n\r\n"), (2**40, "u", "far"),
]


def brute(rows):
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    first, out = {}, []
    for page_id, _, html in order:
        data = (html or "").encode()
        if data not in first:
            first[data] = page_id
            refers, kind = None, "response"
        else:
            refers, kind = first[data], "revisit"
        out.append((page_id, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), kind, refers))
    return sorted(out, key=str)


def result(df):
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


@pytest.mark.parametrize(("shard_bytes", "file_bytes"), [(64 << 20, 32 << 20), (600, 300), (1, 1)])
def test_round_trip(spark, tmp_path, shard_bytes, file_bytes):
    folder = f"{tmp_path}/archives"
    manifest = warc.write_archives(pages_of(spark, ROWS), folder, shard_bytes, file_bytes)
    assert sum(r["records"] for r in manifest.collect()) == len(ROWS)
    back = warc.read_archives(spark, folder)
    assert result(back) == brute(ROWS)
    texts = {r["page_id"]: r["html"] for r in back.filter("record_type = 'response'").collect()}
    assert texts[1] == "é" * 70_000
    assert texts[-4] == "\r\n\r\n"


def test_files_are_the_same_whatever_the_partitions(spark, tmp_path):
    def files(name, pages):
        warc.write_archives(pages, f"{tmp_path}/{name}", 2000, 500)
        return {p.name: p.read_bytes() for p in (tmp_path / name).glob("*.gz")}

    rows = [(i, f"http://x/{i}", f"page {i % 40} " * (i % 50)) for i in range(200)]
    one = files("one", pages_of(spark, rows).coalesce(1))
    two = files("two", pages_of(spark, list(reversed(rows))).repartition(9))
    assert one == two
    assert len(one) > 5
    for data in one.values():
        assert gzip.decompress(data).startswith(b"WARC/1.1\r\n")
    assert not [p for p in (tmp_path / "one").iterdir() if p.name.startswith(".pages")]


def test_a_second_manifest_is_refused(spark, tmp_path):
    warc.write_archives(pages_of(spark, ROWS[:2]), f"{tmp_path}/a")
    with pytest.raises(FileExistsError):
        warc.write_archives(pages_of(spark, ROWS[:2]), f"{tmp_path}/a")


def test_small_payloads_may_all_be_responses(spark, tmp_path):
    warc.write_archives(pages_of(spark, ROWS), f"{tmp_path}/a", least=4)
    kinds = [(r["payload_bytes"], r["record_type"]) for r in warc.read_archives(spark, f"{tmp_path}/a").collect()]
    assert all(kind == "response" for size, kind in kinds if size < 4)
    assert any(kind == "revisit" for _, kind in kinds)


def test_damage_is_noticed():
    data = warc.record(1, "http://a/", b"payload", None, False)
    assert warc.parse(data)["html"] == "payload"
    with pytest.raises(ValueError, match="digest"):
        warc.parse(data.replace(b"payload\r\n", b"paYload\r\n"))


def test_shards_of_skewed_ids(spark, tmp_path):
    """One far id, ids of all 64 bits, a repeated id and many rows without one: no shard takes all."""
    html = [f"<p>{i} " + "x" * 500 for i in range(300)]
    rows = [(i, f"u{i}", html[i]) for i in range(100)] + [(2**63 - 1, "far", "far"), (-(2**63), "low", html[3])]
    rows += [(7, f"again{i}", html[i]) for i in range(100, 200)] + [(None, f"none{i}", html[i]) for i in range(200, 300)]
    manifest = warc.write_archives(pages_of(spark, rows), f"{tmp_path}/archives", 10_000, 1 << 20)
    shards = {}
    for r in manifest.collect():
        name = r["file"].split("-")[1]
        shards[name] = shards.get(name, 0) + r["records"]
    assert sum(shards.values()) == len(rows)
    assert max(shards.values()) <= 40
    assert result(warc.read_archives(spark, f"{tmp_path}/archives")) == brute(rows)


def test_bounds_do_not_depend_on_the_partitions(spark, settings):
    html = "x" * 88
    rows = [(i * 3, "u", html) for i in range(400)] + [(30, "u", html)] * 40 + [(None, "u", html)] * 7
    found = []
    for parts in ("2", "7"):
        settings(spark__sql__shuffle__partitions=parts)
        bounds = warc.shard_bounds(pages_of(spark, rows).repartition(int(parts) + 1), 6000)
        # What a run says of every id, however the runs are cut.
        places = {}
        for page_id in {r[0] for r in rows} - {None}:
            at = max(i for i, start in enumerate(bounds.starts) if start <= page_id)
            places[page_id] = (bounds.shards[at], bounds.counts[at])
        found.append((places, bounds.counts[-1], bounds.with_id))
    assert found[0] == found[1]
    places, none, shards = found[0]
    assert none == 1 and shards == -(-440 * 600 // 6000)
    assert [i for i, (_, count) in places.items() if count > 1] == [30]
    size, before = {i: 600 * (41 if i == 30 else 1) for i in places}, 0
    for page_id in sorted(places):
        assert places[page_id][0] == before // 6000
        before += size[page_id]


def test_a_shard_is_found_among_many_as_fast_as_among_few(spark):
    """20,000 bounds take some steps more a row than 20, not a thousand times as long."""
    import time

    from pyspark.sql import functions as F

    def seconds(starts):
        rows = spark.range(0, 400_000, 1, 4).select(warc._run_of(F.col("id"), starts).alias("run"))
        best = []
        for _ in range(3):
            began = time.time()
            rows.agg(F.sum("run")).collect()
            best.append(time.time() - began)
        return min(best)

    few, many = seconds(list(range(0, 400_000, 20_000))), seconds(list(range(0, 400_000, 20)))
    assert many < 6 * few + 1
    starts = [3, 5, 9, 2**62]
    ids = [-(2**63), 2, 3, 4, 5, 8, 9, 10, 2**62 - 1, 2**62, 2**63 - 1]
    rows = spark.createDataFrame([(i,) for i in ids], "id long")
    got = [r.run for r in rows.select(warc._run_of(F.col("id"), starts).alias("run")).collect()]
    assert got == [sum(s <= i for s in starts) for i in ids]


def test_every_shard_has_a_task_of_its_own(spark, tmp_path):
    rows = [(i, "u", "x" * 1000) for i in range(200)]
    manifest = warc.write_archives(pages_of(spark, rows), f"{tmp_path}/a", 20_000, 1 << 20)
    from pyspark.sql import functions as F

    files = manifest.groupBy(F.input_file_name().alias("task")).agg(F.count_distinct(F.substring("file", 1, 12)).alias("n"))
    counts = [r.n for r in files.filter("n > 0").collect()]
    assert len(counts) == 16 and set(counts) == {1}


def test_number_of_shards_is_bounded(spark, monkeypatch):
    monkeypatch.setattr(warc, "SHARD_BYTES", 1000)
    monkeypatch.setattr(warc, "MOST_SHARDS", 8)
    bounds = warc.shard_bounds(pages_of(spark, [(i, "u", "x" * 488) for i in range(500)]))
    assert bounds.with_id == 8 and bounds.total == 9
