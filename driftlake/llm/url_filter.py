"""URL filtering: allow and block rules, and a character language model ratio for the rest.

Rules name a host and a path prefix; the longest that fits decides.  Urls that a rule allows or
blocks teach two variable-order Markov models, one of accepted and one of rejected urls.  Each
mixes orders 0 to ORDER by Witten-Bell smoothing: a context that was followed by many different
characters hands more weight to the shorter one.  A url scores the difference of both models'
log-likelihoods divided by its length; the threshold is set on a fifth of the labelled urls kept
out of the counts, where it separates both labels best (balanced accuracy).

Counts are exact and their number grows with the input: one for each label and each run of ORDER + 1
symbols seen, from which those of the shorter contexts follow.  They stay a table.  Only those of
contexts of two symbols, of which there are ALPHABET ** 2, are gathered on the driver.  Urls are
scored in blocks: a block asks each part of the table once for the runs it holds, so a run that
every url has, like ``https``, is looked up once a block.  Once the threshold is set the fifth kept
out is counted too.

Edge cases: a null url, or one without ``://``, has an empty host and path and no rule; the text
scored is then whatever there is.  Without labelled urls of both kinds the threshold is 0; without
any, every score is 0 too, so all urls pass.  A url of any length is scored whole, in one task.
Repeated rows are judged alike; no rows
give no rows.  Only ``page_id`` and ``url`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftlake.llm.common import ascii_lower, blocks, partitions_for, runs, stored, text_buffer

ORDER = 4
ALPHABET = 64
SMALL = 2  # the order up to which counts are gathered
CELLS = ALPHABET ** (ORDER + 1)
GROUPS = ALPHABET**3  # contexts of three symbols; one's cells are in one part of the table
SPREAD = 162_007  # odd, deals the groups to parts
HELD_CELLS = 1 << 21  # counts a task holds before it hands them on
BLOCK = 1 << 20  # bytes of urls scored together
HELD_OUT = 5  # one in so many labelled urls sets the threshold
BINS = 2000  # of the scores between -CLIP and CLIP
CLIP = 10.0
END, OTHER = 0, 1
# Characters with a symbol of their own, in the order of their symbols from 2 on (fixed values).
KNOWN = "abcdefghijklmnopqrstuvwxyz0123456789/.-_:?=&#%+~,;@!$'()*[]|"


@dataclass(frozen=True)
class Rule:
    verdict: str
    name: str  # host, then the path prefix from the first slash on

    @property
    def host(self) -> str:
        return self.name.partition("/")[0]

    @property
    def path(self) -> str:
        return self.name[len(self.host) :]


def host_of(url: Column) -> Column:
    return F.coalesce(ascii_lower(F.regexp_extract(url, "://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: list[Rule], field: str) -> Column:
    """Name or verdict of the longest rule that fits; null if none does."""
    out = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.name), r.name)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        out = F.when(fits, F.lit(getattr(rule, field))).otherwise(out)
    return out


def _symbols() -> np.ndarray:
    table = np.full(256, OTHER, np.int64)
    for i, c in enumerate(KNOWN):
        table[ord(c)] = table[ord(c.upper())] = i + 2
    return table


def _cells(urls: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Cell of every character (and of the end) of every url, and its url.

    A cell is the context, the nearest symbol first, and then the symbol: what is before a context
    of k symbols are the first k digits, so cells of one context are neighbours in every order."""
    data, offsets = text_buffer(urls)
    lengths = np.diff(offsets)
    rows = np.repeat(np.arange(len(lengths)), lengths + 1)
    ends = np.cumsum(lengths + 1) - 1
    symbols = np.full(len(rows), END, np.int64)
    inner = np.ones(len(rows), bool)
    inner[ends] = False
    symbols[inner] = _symbols()[data]
    starts = (ends - lengths)[rows]
    place = np.arange(len(rows))
    context = np.zeros(len(rows), np.int64)
    for order in range(1, ORDER + 1):
        back = place - order
        context = context * ALPHABET + np.where(back >= starts, symbols[np.maximum(back, 0)], END)
    return context * ALPHABET + symbols, rows


def _part(cell, parts: int):
    """Part of the table a cell is in; for numbers in numpy and for columns."""
    if isinstance(cell, Column):
        group = F.shiftright(cell.cast("long"), 12)
        return F.shiftright((group * SPREAD).bitwiseAND(GROUPS - 1) * parts, 18).cast("int")
    return (((cell >> 12) * SPREAD & GROUPS - 1) * parts) >> 18


def _sums(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    first, _ = runs(keys[order])
    return keys[order][first], np.add.reduceat(n[order], first) if len(first) else n[:0]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cell counts of a task's accepted and rejected urls, added up before the shuffle."""

    def rows() -> pa.RecordBatch:
        cell = (keys % CELLS).astype(np.int32)
        return pa.record_batch([pa.array((keys // CELLS // 2).astype(np.int32)),
                                pa.array(keys // CELLS % 2 == 1), pa.array(cell), pa.array(n)],
                               names=["label", "held", "cell", "n"])

    keys, n = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for batch in batches:
        label = np.asarray(batch.column("label").to_numpy(zero_copy_only=False), np.int64)
        held = np.asarray(batch.column("held").to_numpy(zero_copy_only=False), np.int64)
        urls = batch.column("url")
        for x, y in blocks(text_buffer(urls)[1], BLOCK):
            cells, at = _cells(urls.slice(x, y - x))
            found, times = np.unique(cells + CELLS * (2 * label[x:y] + held[x:y])[at], return_counts=True)
            keys, n = _sums(np.concatenate([keys, found]), np.concatenate([n, times]))
            if len(keys) > HELD_CELLS:
                yield rows()
                keys, n = keys[:0], n[:0]
    yield rows()


def _mixed(keys: np.ndarray, n: np.ndarray, cells: np.ndarray, shorter: np.ndarray) -> np.ndarray:
    """Probability of each of ``cells`` by counts ``n`` of the cells ``keys``, which are sorted, mixed
    with what the shorter context says."""
    if not len(keys):
        return shorter
    first, end = runs(keys // ALPHABET)
    contexts, total = keys[first] // ALPHABET, np.add.reduceat(n, first)
    at = np.minimum(np.searchsorted(contexts, cells // ALPHABET), len(contexts) - 1)
    known = contexts[at] == cells // ALPHABET
    kinds = (end - first)[at]
    own = np.minimum(np.searchsorted(keys, cells), len(keys) - 1)
    seen = np.where(keys[own] == cells, n[own], 0)
    return np.where(known, (seen + kinds * shorter) / (total[at] + kinds), shorter)


def _shorten(cells: np.ndarray, order: int) -> np.ndarray:
    """The cells of the first ``order`` symbols of the contexts."""
    return cells // ALPHABET ** (ORDER + 1 - order) * ALPHABET + cells % ALPHABET


def _short_probabilities(keys: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Probability of every cell of order SMALL, from the counts of all that were seen."""
    p, every = np.full(ALPHABET, 1.0 / ALPHABET), np.arange(ALPHABET)
    for order in range(SMALL + 1):
        if order:  # the shorter context of a cell is its own without the last symbol
            every = np.arange(ALPHABET ** (order + 1))
            p = p[every // ALPHABET**2 * ALPHABET + every % ALPHABET]
        cells = keys // ALPHABET ** (SMALL + 1 - order) * ALPHABET + keys % ALPHABET
        p = _mixed(*_sums(cells, n), every, p)
    return p


def _answers(short: list[np.ndarray], cells: np.ndarray, counts: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Log-probability of each cell's symbol after its context, accepted minus rejected.  ``counts``
    are those of a part of the table by label, ``short`` the probabilities of order SMALL."""
    logs = []
    for p, (keys, n) in zip(short, counts, strict=True):
        p = p[_shorten(cells, SMALL)]
        for order in range(SMALL + 1, ORDER + 1):
            p = _mixed(*_sums(_shorten(keys, order), n), _shorten(cells, order), p)
        logs.append(np.log(p))
    return logs[0] - logs[1]


def _in_blocks(parts: int):
    """Rows in blocks: one row of the block's own, of part -1, and one for each part it asks."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for rows in _gathered(batches):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, rows.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                out.write_table(rows)
            asked, cells = _asked(_cells(rows.column("url"))[0], parts)
            first, end = runs(asked)
            data = [sink.getvalue().to_pybytes(), *(cells[x:y].astype("<u4").tobytes() for x, y in zip(first, end, strict=True))]
            yield pa.record_batch([pa.array([number] * len(data), pa.int64()),
                                   pa.array([-1, *asked[first].tolist()], pa.int32()),
                                   pa.array(data, pa.binary())], names=["block", "part", "data"])
            number += 1

    return cut


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows in tables of about BLOCK bytes of urls; a longer url stands alone."""
    held, size = [], 0
    for batch in batches:
        offsets = text_buffer(batch.column("url"))[1] + np.arange(batch.num_rows + 1)
        for x, y in blocks(offsets, BLOCK):
            more = int(offsets[y] - offsets[x])
            if held and size + more > BLOCK:
                yield pa.Table.from_batches(held)
                held, size = [], 0
            held.append(batch.slice(x, y - x))
            size += more
    if held:
        yield pa.Table.from_batches(held)


def _asked(cells: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct cells by part, and the part of each."""
    cells = np.unique(cells)
    part = _part(cells, parts)
    order = np.argsort(part, kind="stable")
    return part[order], cells[order]


def _looked_up(short: list[np.ndarray]):
    """Answers to the blocks' questions.  Rows come by part, its counts (block null) first."""

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, found, counts = None, [], None
        for batch in batches:
            own = batch.column("part").to_numpy()
            counted = np.asarray(batch.column("block").is_null())
            out = []
            for x, y in zip(*runs(own * 2 + ~counted), strict=True):
                if own[x] != part:
                    part, found, counts = own[x], [], None
                if counted[x]:
                    found.append([batch.column(c).slice(x, y - x).to_numpy() for c in ("label", "cell", "n")])
                    continue
                if counts is None:
                    label, cell, n = (np.concatenate(c) for c in zip(*found, strict=True)) if found else [np.zeros(0, np.int64)] * 3
                    counts = [_sums(cell[label == k].astype(np.int64), n[label == k]) for k in (0, 1)]
                questions = [np.frombuffer(v.as_buffer(), "<u4") for v in batch.column("data").slice(x, y - x)]
                cuts = np.cumsum([0, *map(len, questions)])
                answers = _answers(short, np.concatenate(questions).astype(np.int64), counts)
                out += [(batch.column("block")[x + i].as_py(), int(part), answers[s:e].astype("<f8").tobytes())
                        for i, (s, e) in enumerate(zip(cuts, cuts[1:], strict=False))]
            columns = list(zip(*out, strict=True)) or [[]] * 3
            yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.int32(), pa.binary()), strict=True)],
                                  names=["block", "part", "data"])

    return look_up


def _put_together(parts: int):
    """The blocks' rows with their scores.  Rows come by block, its own first, then the answers."""

    def scored(data: bytes, answers: list[bytes]) -> Iterator[pa.RecordBatch]:
        rows = pa.ipc.open_stream(data).read_all()
        cells, at = _cells(rows.column("url"))
        _, distinct = _asked(cells, parts)
        order = np.argsort(distinct)
        value = np.frombuffer(b"".join(answers), "<f8")[order][np.searchsorted(distinct[order], cells)]
        lengths = np.bincount(at, minlength=rows.num_rows)
        score = np.bincount(at, value, minlength=rows.num_rows) / np.maximum(lengths, 1)
        yield from rows.append_column("score", pa.array(score)).combine_chunks().to_batches()

    def put_together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, answers = None, []
        for batch in batches:
            for part, data in zip(batch.column("part").to_pylist(), batch.column("data").to_pylist(), strict=True):
                if part >= 0:
                    answers.append(data)
                    continue
                if own is not None:
                    yield from scored(own, answers)
                own, answers = data, []
        if own is not None:
            yield from scored(own, answers)

    return put_together


class Model:
    """Log-probability of a cell's symbol after its context, accepted minus rejected.

    ``counts`` is a table (label, cell, n) with each cell once a label.
    """

    def __init__(self, counts: DataFrame, threshold: float = 0.0):
        self.counts, self.threshold = counts, threshold

    def _short(self) -> list[np.ndarray]:
        cell = F.col("cell")
        short = (F.floor(cell / ALPHABET ** (ORDER + 1 - SMALL)) * ALPHABET + cell % ALPHABET).cast("long")
        found = (
            self.counts.groupBy("label", short.alias("cell")).agg(F.sum("n").alias("n")).toArrow()
        )  # at most 2 * ALPHABET ** (SMALL + 1) rows
        label, cell, n = (found.column(c).to_numpy() for c in ("label", "cell", "n"))
        return [_short_probabilities(cell[label == k], n[label == k]) for k in (0, 1)]

    def score_rows(self, rows: DataFrame) -> DataFrame:
        """``rows``, which have a column ``url``, with their ``score``."""
        parts = min(GROUPS, 2 * partitions_for(rows, 16))
        asking = stored(rows.mapInArrow(_in_blocks(parts), "block long, part int, data binary"), "url_blocks")
        table = self.counts.select(
            F.lit(None).cast("long").alias("block"), _part(F.col("cell"), parts).alias("part"),
            F.lit(None).cast("binary").alias("data"), "label", "cell", "n")
        answers = (
            table.unionByName(asking.filter("part >= 0"), allowMissingColumns=True)
            .repartition("part").sortWithinPartitions("part", F.col("block").asc_nulls_first())
            .mapInArrow(_looked_up(self._short()), asking.schema)
        )
        schema = T.StructType([*rows.schema.fields, T.StructField("score", T.DoubleType())])
        return (
            asking.filter("part < 0").unionByName(answers)
            .repartition("block").sortWithinPartitions("block", "part")
            .mapInArrow(_put_together(parts), schema)
        )

    def score(self, urls: pa.Array) -> np.ndarray:
        """Scores of a few urls at hand."""
        rows = self.counts.sparkSession.createDataFrame(list(enumerate(urls.to_pylist())), "i long, url string")
        found = {r["i"]: r["score"] for r in self.score_rows(rows).select("i", "score").collect()}
        return np.array([found[i] for i in range(len(urls))])


def best_threshold(bins: dict[tuple[int, int], int]) -> float:
    """Score from which on urls pass: the cut with the highest balanced accuracy, the middle one
    of equals.  ``bins`` counts held-out urls by (label, bin)."""
    held = np.zeros((2, BINS + 1))
    for (label, b), n in bins.items():
        held[label, b] += n
    if not held.sum(axis=1).all():
        return 0.0
    below = np.concatenate([np.zeros((2, 1)), np.cumsum(held, axis=1)], axis=1)
    share = below / held.sum(axis=1)[:, None]
    accuracy = (1 - share[0]) + share[1]
    best = np.flatnonzero(accuracy >= accuracy.max() - 1e-12)
    return float(best[len(best) // 2]) * 2 * CLIP / BINS - CLIP


def _counted(labelled: DataFrame) -> DataFrame:
    """label, cell, and how often: ``n`` among the urls that are not held out, ``held`` among the others."""
    cells = labelled.select("url", "label", _held().alias("held")).mapInArrow(
        _count, "label int, held boolean, cell int, n long")

    def total(of: Column) -> Column:
        return F.sum(F.when(of, F.col("n")).otherwise(0))

    return stored(cells.groupBy("label", "cell").agg(
        total(~F.col("held")).alias("n"), total(F.col("held")).alias("held")), "url_counts")


def _held() -> Column:
    return F.coalesce(F.pmod(F.crc32(F.col("url").cast("binary")), F.lit(HELD_OUT)) == 0, F.lit(False))


def _fit(labelled: DataFrame, counts: DataFrame) -> Model:
    model = Model(counts.filter("n > 0").select("label", "cell", "n"))
    score = F.col("score")
    width = 2 * CLIP / BINS
    bins = (
        model.score_rows(labelled.filter(_held()).select("label", "url"))
        .select("label", F.least(F.greatest(F.floor((score + CLIP) / width), F.lit(0)), F.lit(BINS))
                .cast("int").alias("bin"))
        .groupBy("label", "bin").count().collect()  # at most 2 * (BINS + 1) rows
    )
    model.threshold = best_threshold({(r["label"], r["bin"]): r["count"] for r in bins})
    return model


def fit(labelled: DataFrame) -> Model:
    """Model and threshold from (url, label) rows, label 0 accepted and 1 rejected; the model
    without the urls that set the threshold."""
    return _fit(labelled, _counted(labelled))


def fit_whole(labelled: DataFrame) -> Model:
    """The same threshold, and a model of all rows."""
    counts = _counted(labelled)
    whole = counts.select("label", "cell", (F.col("n") + F.col("held")).alias("n"))
    return Model(whole, _fit(labelled, counts).threshold)


def judge_urls(pages: DataFrame, rules: list[Rule]) -> DataFrame:
    """page_id, host, path, rule, score and verdict of every page."""

    def ruled(rows: DataFrame) -> DataFrame:
        rows = rows.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
        return rows.withColumns({
            "rule": rule_of(F.col("host"), F.col("path"), rules, "name"),
            "ruled": rule_of(F.col("host"), F.col("path"), rules, "verdict"),
        })

    urls = pages.select("page_id", "url")
    labelled = ruled(urls).filter("ruled is not null").select(
        "url", F.when(F.col("ruled") == "allow", 0).otherwise(1).alias("label"))
    model = fit_whole(labelled)
    passes = F.when(F.col("score") >= model.threshold, "allow").otherwise("block")
    return ruled(model.score_rows(urls)).select(
        "page_id", "host", "path", "rule", "score", F.coalesce("ruled", passes).alias("verdict"))
