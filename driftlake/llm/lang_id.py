"""Language identification by hyperdimensional profiles.

Every letter has a random vector of +1 and -1.  A letter trigram is the product of its letters'
vectors, each rotated by its place (binding); a text is the sum of its trigrams (bundling), a
language the sum of its texts' directions.  A text gets the language whose prototype it makes the
smallest angle with; the score is that cosine, or 0 if it is negative.

Trigrams lie within words, with a blank on either side; letters are lower-cased, and all other
characters count as blanks.  Code points from SLOTS on share vectors by a hash.

Prototypes are fitted on a bounded sample: of each language about ``per_language`` of the rows to
learn from, chosen by a hash of the id.  Their size is languages times DIMENSIONS numbers; of more
than MOST_LANGUAGES the prototypes are made and compared in blocks, one pass over the texts for each.

Edge cases: null text, and text without a letter, is ``und`` with score 0; so is everything if
there is no labelled text to learn from.  Of languages equally near the first by name is taken.
A null id counts as empty text where the split is decided.  Repeated rows are judged alike; no
rows give no rows.  A text beyond BLOCK_BYTES is the sum of its parts, cut at white space.  Only
``doc_id``, ``text`` and, for learning, ``lang`` are read.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftlake.llm.common import blocks, mix, pieces, stored, text_buffer, tidy

DIMENSIONS = 1024
SLOTS = 4096
SEED = 11
BLOCK_BYTES = 1 << 19
TEXTS = 256  # handled at once
GRAMS = 4096  # distinct trigrams whose vectors are held at once
UNIT = 1 << 20  # a text's direction is summed in these steps, exactly and in any order
MOST_LANGUAGES = 1_000  # whose prototypes are held at once
UNKNOWN = "und"


@functools.lru_cache(maxsize=1)
def _slots() -> np.ndarray:
    """Slot of each code point's letter, 0 for everything that is no letter."""
    points = np.arange(0x110000, dtype=np.uint64)
    letter = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
    shared = 1 + mix(points) % np.uint64(SLOTS - 1)
    return np.where(letter, np.where(points < SLOTS, points, shared), 0).astype(np.int64)


@functools.lru_cache(maxsize=1)
def _letters() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Vectors of all slots, rotated for the first, second and third place of a trigram."""
    rng = np.random.default_rng(SEED)
    third = (rng.integers(0, 2, (SLOTS, DIMENSIONS), dtype=np.int8) * 2 - 1).astype(np.int8)
    return np.roll(third, 2, axis=1), np.roll(third, 1, axis=1), third


def bundle(texts: list[bytes]) -> np.ndarray:
    """One vector per text: the sum of its trigrams' vectors."""
    slots, blank = _slots(), np.zeros(1, np.int64)
    parts, owners = [blank], [blank]
    for i, text in enumerate(texts):
        points = np.frombuffer(text.decode("utf-8", "replace").lower().encode("utf-32-le"), "<u4")
        parts += [slots[points], blank]
        owners.append(np.full(len(points) + 1, i, np.int64))
    symbols, owner = np.concatenate(parts), np.concatenate(owners)
    keep = symbols != 0
    keep[1:] |= symbols[:-1] != 0
    keep[0] = True  # the blank before the first word
    symbols, owner = symbols[keep], owner[keep]
    inner = np.flatnonzero(symbols[1:-1]) + 1
    trigram = (symbols[inner - 1] << 24) | (symbols[inner] << 12) | symbols[inner + 1]
    key = np.sort((owner[inner] << 36) | trigram)
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])[: len(key)])
    counts = np.diff(np.append(first, len(key)))
    rows, grams = key[first] >> 36, key[first] & ((1 << 36) - 1)
    distinct, column = np.unique(grams, return_inverse=True)
    a, b, c = _letters()
    out = np.zeros((len(texts), DIMENSIONS), np.float32)
    for at in range(0, len(distinct), GRAMS):  # bounds the table of trigram vectors
        some = distinct[at : at + GRAMS]
        vectors = a[some >> 24] * b[(some >> 12) & 4095] * c[some & 4095]
        own = (column >= at) & (column < at + GRAMS)
        dense = np.zeros((len(texts), len(some)), np.float32)
        dense[rows[own], column[own] - at] = counts[own]
        out += dense @ vectors.astype(np.float32)
    return out


def _vectors(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray]]:
    data, offsets = text_buffer(texts)
    for a, b in blocks(offsets, BLOCK_BYTES):
        if b - a == 1:  # a long text is the sum of its parts, cut at white space
            parts = pieces(data[offsets[a] : offsets[b]], BLOCK_BYTES)
            yield a, b, sum((bundle([p.tobytes()]) for p in parts), np.zeros((1, DIMENSIONS), np.float32))
            continue
        for start in range(a, b, TEXTS):  # also bounds the rows of many short texts
            end = min(start + TEXTS, b)
            yield start, end, bundle([data[offsets[i] : offsets[i + 1]].tobytes() for i in range(start, end)])


def _learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of the directions of a task's texts, by language."""
    sums: dict[str, np.ndarray] = {}
    for batch in batches:
        langs = np.array(batch.column("lang").to_pylist(), object)
        for start, end, found in _vectors(batch.column("text")):
            norm = np.linalg.norm(found, axis=1, keepdims=True)
            steps = np.rint(found / np.maximum(norm, 1) * UNIT).astype(np.int64)
            for lang in set(langs[start:end]):
                own = steps[langs[start:end] == lang].sum(axis=0)
                sums[lang] = sums.get(lang, 0) + own
    for lang, total in sums.items():
        yield pa.record_batch(
            [pa.array([lang] * DIMENSIONS), pa.array(np.arange(DIMENSIONS, dtype=np.int32)), pa.array(total)],
            names=["lang", "dimension", "value"])


def held_out(doc_id: Column) -> Column:
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(4)) == 2


def language_blocks(labelled: DataFrame) -> Iterator[tuple[DataFrame, dict[str, int]]]:
    """Rows to learn from, about MOST_LANGUAGES languages at a time, and how many each of them has."""
    def sizes(rows: DataFrame) -> dict[str, int]:
        return {r["lang"]: r["count"] for r in rows.collect()}

    found = sizes(labelled.groupBy("lang").count().limit(MOST_LANGUAGES + 1))
    if len(found) <= MOST_LANGUAGES:
        yield labelled, found
        return
    number = -(-labelled.agg(F.count_distinct("lang")).first()[0] // MOST_LANGUAGES)
    for i in range(number):
        own = labelled.filter(F.pmod(F.xxhash64("lang"), F.lit(number)) == i)
        yield own, sizes(own.groupBy("lang").count())


def fit(labelled: DataFrame, sizes: dict[str, int], per_language: int) -> tuple[list[str], np.ndarray]:
    """Languages and their prototypes from (doc_id, text, lang) rows, ``sizes`` of each language."""
    if not sizes:
        return [], np.zeros((0, DIMENSIONS), np.float32)
    share = {lang: min(UNIT, -(-per_language * UNIT // n)) for lang, n in sizes.items()}
    shares = labelled.sparkSession.createDataFrame(list(share.items()), "lang string, share long")
    sample = labelled.join(F.broadcast(shares), "lang").filter(
        F.pmod(F.xxhash64(F.lit(SEED), "doc_id"), F.lit(UNIT)) < F.col("share"))
    sums = (
        sample.select("text", "lang").mapInArrow(tidy(_learn), "lang string, dimension int, value long")
        .groupBy("lang", "dimension").agg(F.sum("value").alias("value")).toArrow()
    )  # languages times DIMENSIONS rows
    names = sums.column("lang").to_pylist()
    langs = sorted(set(names))
    place, out = {lang: i for i, lang in enumerate(langs)}, np.zeros((len(langs), DIMENSIONS))
    out[[place[n] for n in names], sums.column("dimension").to_numpy()] = sums.column("value").to_numpy()
    out /= np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)
    return langs, out.astype(np.float32)


def _predictor(langs: list[str], prototypes: np.ndarray):
    """The nearest language of each text and its cosine; that of an earlier pass stays if it is nearer."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            best, score, letters = np.full(n, -1), np.full(n, -np.inf), np.zeros(n, bool)
            for start, end, found in _vectors(pc.struct_field(batch.column("row"), "text")):
                norm = np.linalg.norm(found, axis=1)
                letters[start:end] = norm > 0
                if not langs:
                    continue
                cosine = (found @ prototypes.T) / np.maximum(norm, 1e-9)[:, None]
                best[start:end] = np.where(norm > 0, cosine.argmax(axis=1), -1)
                score[start:end] = np.where(norm > 0, cosine.max(axis=1), -np.inf)
            names = [langs[i] if i >= 0 else UNKNOWN for i in best]
            if "lang_pred" in batch.schema.names:
                before = batch.column("lang_pred").to_pylist(), batch.column("score").to_numpy()
                for i, (name, cosine) in enumerate(zip(*before, strict=True)):
                    if best[i] < 0 or cosine > score[i] or cosine == score[i] and name < names[i]:
                        names[i], score[i] = name, cosine
            yield pa.record_batch(
                [batch.column("row"), batch.column("held_out"), pa.array(names, pa.string()), pa.array(score), pa.array(letters)],
                names=["row", "held_out", "lang_pred", "score", "has_letters"])

    return run


def _judged(docs: DataFrame, per_language: int) -> DataFrame:
    out = held_out(F.col("doc_id"))
    labelled = docs.filter(~out & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("doc_id", "text", "lang")
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), out.alias("held_out"))
    schema = T.StructType([*rows.schema.fields, T.StructField("lang_pred", T.StringType()),
                           T.StructField("score", T.DoubleType()), T.StructField("has_letters", T.BooleanType())])
    for number, (own, sizes) in enumerate(language_blocks(labelled)):
        # A pass of its own for each block of languages: a task holds the prototypes of one.
        rows = stored(rows, "languages") if number else rows
        rows = rows.mapInArrow(tidy(_predictor(*fit(own, sizes, per_language))), schema)
    return rows.withColumn("score", F.least(F.greatest("score", F.lit(0.0)), F.lit(1.0)))


def identify(docs: DataFrame, per_language: int = 5000) -> DataFrame:
    """Every document as a struct ``row``, with its held_out, lang_pred and score."""
    return _judged(docs, per_language).drop("has_letters")


def known_language(docs: DataFrame, per_language: int = 5000) -> DataFrame:
    """The documents that have a letter, with all their columns, whatever their language is called
    and also if there was nothing to learn from."""
    return _judged(docs, per_language).filter("has_letters").select("row.*")
