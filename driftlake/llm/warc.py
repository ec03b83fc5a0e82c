"""Deterministic WARC archives: sharded, rolled by compressed size, committed by a manifest.

Pages are cut into shards by ranges of their id: in order of the ids, a shard begins at every
``shard_bytes``.  A page finds its shard by binary search among the bounds, of which there are at
most MOST_SHARDS, as shards grow with the pages beyond that.
An id with more bytes than a shard, and the rows without an id, are dealt to several shards by the
digest of their payload; only rows that repeat an id and its payload always stay together.  Each
shard is sorted and written by one task, as gzip members of one record each; a new file starts once ``file_bytes`` compressed bytes are reached.  Headers and digests are
made from the rows alone, so the same pages give the same files, byte by byte, on any cluster.

A file is written under a temporary name and then moved to its own, so a repeated or lost task
leaves no half file under a final name.  The tasks' rows (file, records, bytes) become the
manifest, which is written last and renamed into place; readers use only files it names.

Paths are opened through ``pyarrow.fs`` and may be of any store that it knows.

Edge cases: null html is an empty payload; a null url becomes an empty target; rows with a null id
are written last, in shards of their own; of repeated rows one is the response and the others
revisit it (a null id answers only for payloads that no id has); a payload of any length is one
record, which one task holds a few times over.  No pages give no archives and no
rows.  Only ``page_id``, ``url`` and ``html`` are read.
"""

from __future__ import annotations

import base64
import hashlib
import itertools
import uuid
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftlake.llm.common import partitions_for, stored
from driftlake.sources import files

SHARD_BYTES = 64 << 20
MOST_SHARDS = 65_536
DATE = "2024-01-01T00:00:00Z"  # of every record: the date is not part of the rows
MANIFEST_SCHEMA = "file string, records long, bytes long"


def digest32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _urn(page_id) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def _id(urn: str):
    name = urn[len("<urn:page:") : -1]
    return None if name == "none" else int(name)


def record(page_id, url: str | None, payload: bytes, refers_to, revisit: bool) -> bytes:
    """One WARC record: a response with its payload, or a revisit with the HTTP header only."""
    sha = digest32(payload)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    target = (url or "").replace("\r", "%0D").replace("\n", "%0A")
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {_urn(page_id)}",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {target}",
        "Content-Type: application/http; msgtype=response",
        f"WARC-Payload-Digest: sha1:{sha}",
        f"WARC-Block-Digest: sha1:{digest32(block)}",
    ]
    if revisit:
        lines += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: {_urn(refers_to)}",
        ]
    head = "\r\n".join([*lines, f"Content-Length: {len(block)}"]) + "\r\n\r\n"
    return head.encode() + block + b"\r\n\r\n"


def _member(data: bytes) -> bytes:
    """A gzip member without a time stamp."""
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


class _Files:
    """The files of one shard, rolled by compressed size."""

    def __init__(self, store: pafs.FileSystem, folder: str, shard: int, file_bytes: int):
        self.store, self.folder, self.shard, self.file_bytes = store, folder, shard, file_bytes
        self.number, self.out, self.done = 0, None, []

    def add(self, data: bytes) -> None:
        if self.out is None:
            self.name = f"pages-{self.shard:06d}-{self.number:04d}.warc.gz"
            self.temporary = f"{self.folder}/.{self.name}.{uuid.uuid4().hex}"
            self.out, self.records, self.bytes = self.store.open_output_stream(self.temporary, compression=None), 0, 0
        member = _member(data)
        self.out.write(member)
        self.records, self.bytes = self.records + 1, self.bytes + len(member)
        if self.bytes >= self.file_bytes:
            self.close()

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.store.move(self.temporary, f"{self.folder}/{self.name}")
            self.done.append((self.name, self.records, self.bytes))
            self.out, self.number = None, self.number + 1


def _manifest_rows(done: list) -> pa.RecordBatch:
    return pa.record_batch(
        [pa.array([d[0] for d in done], pa.string()), pa.array([d[1] for d in done], pa.int64()),
         pa.array([d[2] for d in done], pa.int64())],
        names=["file", "records", "bytes"],
    )


def _writer(folder: str, file_bytes: int):
    """Write sorted rows; a role row (``first`` of a later copy) comes right before its pages."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = pafs.FileSystem.from_uri(folder)
        current, role, before = None, None, None
        for batch in batches:
            names = ("shard", "page_id", "sha", "page", "first", "url", "html")
            for values in zip(*(batch.column(n) for n in names), strict=True):
                shard, page_id, sha, page, first, url, html = (v.as_py() for v in values)
                if not page:
                    role = (shard, page_id, sha, first)
                    continue
                if current is None or current.shard != shard:
                    if current:
                        current.close()
                        yield _manifest_rows(current.done)
                    current = _Files(store, root, shard, file_bytes)
                key = (shard, page_id, sha)
                refers_to, revisit = page_id, key == before and sha is not None
                if role and role[:3] == key:
                    refers_to, revisit = role[3], True
                before = key
                current.add(record(page_id, url, (html or "").encode(), refers_to, revisit))
        if current:
            current.close()
            yield _manifest_rows(current.done)

    return run


def _digest(least: int):
    """Hex SHA-1 of the payload; null for payloads too small to be answered by another."""
    html = F.coalesce("html", F.lit(""))
    return F.when(F.octet_length(html) >= least, F.sha1(html.cast("binary")))


def roles(pages: DataFrame, least: int) -> DataFrame:
    """page_id, sha and the smallest id of that payload, for all but the smallest.

    Only ids and digests are shuffled.
    """
    keys = pages.select("page_id", _digest(least).alias("sha")).groupBy("page_id", "sha").count()
    first = keys.filter("sha is not null").groupBy("sha").agg(
        F.min("page_id").alias("first"), F.count("*").alias("ids")).filter("ids > 1")
    later = F.coalesce(F.col("page_id") != F.col("first"), F.col("first").isNotNull())
    return keys.join(first, "sha").filter(later).select("page_id", "sha", "first")


def _weight() -> Column:
    return F.octet_length(F.coalesce("html", F.lit(""))) + 512


class Bounds(NamedTuple):
    """Runs of ids: the first id of each, its first shard, and over how many shards its rows are
    dealt (more than one only if the run is one id).  The last number is that of the rows without an
    id, which come after all shards."""

    starts: list[int]
    shards: list[int]
    counts: list[int]

    @property
    def with_id(self) -> int:
        return max((s + c for s, c in zip(self.shards, self.counts)), default=0)

    @property
    def total(self) -> int:
        return self.with_id + self.counts[-1]


def shard_bounds(pages: DataFrame, shard_bytes: int | None = None) -> Bounds:
    """Where the shards begin: at every ``shard_bytes`` of the pages in order of their ids.

    The bytes of each id are summed, and laid out in order over the partitions of a range shuffle.
    The bytes before a partition come from the totals, those before an id from a running sum, and an
    id's shard is what these make.  So bounds depend on the rows alone, not on how Spark has dealt
    them.  The driver gathers a number a partition and a row a shard.
    """
    spark = pages.sparkSession
    sizes = pages.groupBy("page_id").agg(F.sum(_weight()).alias("bytes"), F.count("*").alias("rows"))
    laid = stored(
        sizes.repartitionByRange("page_id").withColumn("part", F.spark_partition_id()), "id_sizes")
    with_id = laid.filter("page_id is not null")
    totals = {r["part"]: r["n"] for r in with_id.groupBy("part").agg(F.sum("bytes").alias("n")).collect()}
    none, unnamed = laid.filter("page_id is null").agg(F.sum("bytes"), F.sum("rows")).first()
    none = none or 0
    if shard_bytes is None:
        shard_bytes = max(SHARD_BYTES, -(-(sum(totals.values()) + none) // MOST_SHARDS))
    pieces = max(1, min(-(-none // shard_bytes), unnamed or 0))
    parts = sorted(totals)
    before = dict(zip(parts, itertools.accumulate([0, *(totals[p] for p in parts)]), strict=False))
    offsets = spark.createDataFrame(list(before.items()), "part int, before long")
    order = Window.partitionBy("part").orderBy("page_id")
    placed = with_id.join(F.broadcast(offsets), "part").withColumn(
        "ends", F.col("before") + F.sum("bytes").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    shard = F.expr(f"(ends - bytes) div {shard_bytes}")
    count = F.when(F.col("bytes") > shard_bytes, F.expr(f"(ends - 1) div {shard_bytes}") - shard + 1).otherwise(1)
    placed = placed.select("part", "page_id", "rows", shard.alias("shard"), count.alias("count"))
    changed = (
        F.lag("shard").over(order).isNull() | (F.lag("shard").over(order) != F.col("shard"))
        | (F.col("count") > 1) | (F.lag("count").over(order) > 1)
    )
    found = placed.withColumn("new", changed).filter("new").select("page_id", "shard", "count", "rows").collect()
    starts, shards, counts, last, end = [], [], [], None, -1
    for page_id, first, span, rows in sorted(tuple(r) for r in found):
        # Shards in which nothing begins get no number, and no id has more than it has rows.
        starts.append(page_id)
        shards.append(end if first == last else end + 1)
        counts.append(min(span, rows))
        last, end = first + span - 1, shards[-1] + counts[-1] - 1
    return Bounds(starts, shards, [*counts, pieces])


def _numbers(values: list[int]) -> Column:
    """An array from one literal, however long it is."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")


def _run_of(page_id: Column, starts: list[int]) -> Column:
    """Place, from 1 on, of the last of the sorted starts that is not above the id; 0 if none is.

    A binary search: half of what is left goes in each step.
    """
    array = _numbers(starts)

    def half(left, _):
        low, high = left["low"], left["high"]
        middle = F.shiftright(low + high + 1, 1)
        up = F.get(array, middle - 1) <= page_id
        return F.when(low >= high, left).when(up, F.struct(middle.alias("low"), high.alias("high"))).otherwise(
            F.struct(low.alias("low"), (middle - 1).alias("high")))

    whole = F.struct(F.lit(0).alias("low"), F.lit(len(starts)).alias("high"))
    steps = F.sequence(F.lit(1), F.lit(len(starts).bit_length() + 1))
    return F.aggregate(steps, whole, half, lambda found: found["low"])


def write_archives(
    pages: DataFrame, folder: str, shard_bytes: int | None = None, file_bytes: int = 32 << 20,
    least: int = 0,
) -> DataFrame:
    """Write the archives and commit their manifest; returns the manifest.

    ``shard_bytes`` is SHARD_BYTES, or as much more as makes MOST_SHARDS of the pages.  A shard is
    sorted (and spilled, if need be) and written by a task of its own.
    """
    spark = pages.sparkSession
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    bounds = shard_bounds(pages, shard_bytes)
    run = F.greatest(_run_of(F.col("page_id"), bounds.starts), F.lit(1)) if bounds.starts else F.lit(1)
    place = F.when(F.col("page_id").isNull(), len(bounds.counts)).otherwise(run)

    def shard(sha: Column) -> Column:
        """The first shard of the row's run, or that of several which the digest says."""
        base = F.element_at(_numbers([*bounds.shards, bounds.with_id]), place)
        if max(bounds.counts) > 1:
            of = F.element_at(_numbers(bounds.counts), place)
            base = base + F.when(of > 1, F.pmod(F.crc32(sha.cast("binary")), of)).otherwise(0)
        return base.cast("int").alias("shard")

    plain = pages.select(
        shard(_digest(0)), "page_id", _digest(least).alias("sha"), F.lit(True).alias("page"),
        F.lit(None).cast("long").alias("first"), "url", "html")
    told = roles(pages, least).select(
        shard(F.col("sha")), "page_id", "sha", F.lit(False).alias("page"), "first",
        F.lit(None).cast("string").alias("url"), F.lit(None).cast("string").alias("html"))
    if files.exists(spark, f"{folder}/manifest"):
        raise FileExistsError(f"{folder} holds a manifest already")
    fs, handle = files.open_path(spark, folder)
    fs.mkdirs(handle)
    uri = fs.makeQualified(handle).toUri().toString()
    written = (
        plain.union(told)
        .repartitionById(min(bounds.total, MOST_SHARDS), "shard")
        .sortWithinPartitions("shard", F.col("page_id").asc_nulls_last(), "sha", "page", "url")
        .mapInArrow(_writer(uri, file_bytes), MANIFEST_SCHEMA)
    )
    temporary = f"{folder}/.manifest-{uuid.uuid4().hex}"
    written.write.parquet(temporary)
    source, target = (files.open_path(spark, p)[1] for p in (temporary, f"{folder}/manifest"))
    if fs.exists(target) or not fs.rename(source, target):
        raise FileExistsError(f"{folder} got a manifest from another writer")
    return spark.read.schema(MANIFEST_SCHEMA).parquet(f"{folder}/manifest")


def members(stream) -> Iterator[bytes]:
    """Contents of the gzip members of a file, one at a time."""
    unpacker, out = zlib.decompressobj(31), []
    while chunk := stream.read(1 << 20):
        while chunk:
            out.append(unpacker.decompress(chunk))
            chunk = unpacker.unused_data
            if unpacker.eof:
                yield b"".join(out)
                unpacker, out = zlib.decompressobj(31), []
    if out:
        raise ValueError("the last record is not complete")


def parse(data: bytes) -> dict:
    """Fields of one record; checks both digests where the record has the bytes."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:])["Content-Length"])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    revisit = fields["WARC-Type"] == "revisit"
    if fields["WARC-Block-Digest"] != f"sha1:{digest32(block)}":
        raise ValueError(f"block digest of {fields['WARC-Record-ID']} does not match")
    if not revisit and (digest32(payload) != digest or len(payload) != size):
        raise ValueError(f"payload digest of {fields['WARC-Record-ID']} does not match")
    return {
        "page_id": _id(fields["WARC-Record-ID"]), "url": fields["WARC-Target-URI"],
        "payload_bytes": size, "payload_digest": digest, "record_type": fields["WARC-Type"],
        "refers_to": _id(fields["WARC-Refers-To"]) if revisit else None,
        "html": None if revisit else payload.decode(),
    }


def _reader(folder: str, with_html: bool):
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "file"]
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()]
    if with_html:
        names, kinds = [*names, "html"], [*kinds, pa.string()]

    def batch_of(found: list) -> pa.RecordBatch:
        return pa.record_batch(
            [pa.array([f[n] for f in found], k) for n, k in zip(names, kinds, strict=True)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = pafs.FileSystem.from_uri(folder)
        for batch in batches:
            for name in batch.column("file").to_pylist():
                found, size = [], 0
                with store.open_input_stream(f"{root}/{name}", compression=None) as stream:
                    for data in members(stream):
                        found.append(parse(data) | {"file": name})
                        size += len(data)
                        if size > 16 << 20:
                            yield batch_of(found)
                            found, size = [], 0
                yield batch_of(found)

    return run


def read_archives(spark, folder: str, with_html: bool = True) -> DataFrame:
    """Records of the files that the manifest names."""
    fs, handle = files.open_path(spark, folder)
    uri = fs.makeQualified(handle).toUri().toString()
    manifest = spark.read.schema(MANIFEST_SCHEMA).parquet(f"{folder}/manifest")
    named = manifest.select("file").repartition(partitions_for(manifest))  # in turn: files are alike in size
    schema = ("page_id long, url string, payload_bytes long, payload_digest string, "
              "record_type string, refers_to long, file string")
    return named.mapInArrow(_reader(uri, with_html), schema + (", html string" if with_html else ""))
