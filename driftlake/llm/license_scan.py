"""Licence notices in texts, by an index of each template's rarest words (DataFrame functions only).

A template is a run of words with a label and mandatory key phrases.  How many documents hold each
licence word is counted over the whole corpus; the RARE words of a template with the highest
inverse document frequency make up the index, as word -> (template, place in it).

Of every text only the words in the index are looked up.  A word at place i that stands at place p
of a template proposes that the template begins at i - p; proposals of one template and beginning
are intersected: enough of its rare words must stand at their places from there.  What is left is
verified: all words of the key phrases must stand at theirs.  Its score is the share of the
template's weight (the sum of its words' inverse document frequencies) that does, and must reach
LEAST.  A phrase that is its own key phrase is so found wherever its words stand consecutively,
since its rarest word proposes every such place.

The corpus is read twice, to count and to look up, and nothing is shuffled but the counts.  The
driver holds the templates and the counts of their words.

Edge cases: null and empty texts have no words and no places.  Repeated rows and null ids are
treated like any others.  A text's words are one array in its row, whatever its length; work and
memory grow with its words.  Words that come up again and again propose each beginning once.
Overlapping places all count.  No rows give no rows.  Only ``doc_id`` and ``text`` are read, so
further columns may have any names.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftlake.llm.common import ascii_lower

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
RARE = 4
LEAST = 0.6


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    keys: tuple[str, ...] = ()  # phrases of the text that must be there; none: all of it
    base: bool = False


# Wording of public licences and of the notices that name them (fixed values).
TEMPLATES = [
    Template("mit", "released under the mit license", ("mit license",)),
    Template("mit", "licensed under the mit license", ("mit license",)),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and "
             "associated documentation files", ("hereby granted free of charge", "obtaining a copy of this software")),
    Template("apache-2.0", "licensed under the apache license version 2 0", ("apache license version 2",)),
    Template("gpl-2", "gnu general public license version 2", ("general public license version 2",)),
    Template("gpl-3", "gnu general public license version 3", ("general public license version 3",)),
    Template("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu "
             "general public license as published by the free software foundation", ("gnu general public license",)),
    Template("lgpl", "gnu lesser general public license", ("lesser general public license",)),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted "
             "provided that the following conditions are met", ("redistribution and use in source and binary forms",)),
    Template("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0",
             ("mozilla public license",)),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee "
             "is hereby granted", ("permission to use copy modify",)),
    Template("cc-by-nc", "licensed under cc by nc 4 0", ("cc by nc",)),
    Template("cc-by-sa", "licensed under cc by sa 4 0", ("cc by sa",)),
    Template("cc-by-nd", "licensed under cc by nd 4 0", ("cc by nd",)),
    Template("cc0", "cc0 1 0 universal public domain dedication", ("cc0 1 0 universal",)),
    Template("unlicense", "this is free and unencumbered software released into the public domain",
             ("unencumbered software released into the public domain",)),
]

PLACE_SCHEMA = "label string, base boolean, start long, n_words long, score double"


def words_of(text: str) -> list[str]:
    return re.findall(WORD, text.translate({c: c + 32 for c in range(65, 91)}))


def _words(text: Column) -> Column:
    return F.regexp_extract_all(ascii_lower(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))


def word_weights(docs: DataFrame, templates: list[Template]) -> dict[str, float]:
    """Inverse document frequency of every licence word, over all documents."""
    vocabulary = sorted({w for t in templates for w in words_of(t.text)})
    held = F.array_distinct(F.filter(_words(F.col("text")), lambda w: w.isin(vocabulary)))
    # The empty word stands for the document itself.
    counts = (
        docs.select(F.explode(F.concat(F.array(F.lit("")), held)).alias("word"))
        .groupBy("word").count().collect()
    )
    found = {r["word"]: r["count"] for r in counts}
    return {w: math.log(1 + (found.get("", 0) + 1) / (found.get(w, 0) + 1)) for w in vocabulary}


def _placed(places: list[tuple[int, str]]) -> Column:
    return F.array(*(F.struct(F.lit(p).cast("long").alias("at"), F.lit(w).alias("word")) for p, w in places))


def _keys(template: Template) -> list[tuple[int, str]]:
    """Places and words of the key phrases in their template."""
    words, out = words_of(template.text), set()
    for phrase in template.keys or (template.text,):
        key = words_of(phrase)
        at = next((i for i in range(len(words)) if words[i : i + len(key)] == key), None)
        if not key or at is None:
            raise ValueError(f"{phrase!r} is no phrase of {template.text!r}")
        out |= {(at + i, w) for i, w in enumerate(key)}
    return sorted(out)


def rare_words(template: Template, weights: dict[str, float]) -> list[tuple[int, str]]:
    """First places of the words with the highest weights; one is enough for a whole phrase."""
    words = words_of(template.text)
    first = {w: words.index(w) for w in words}
    most = RARE if template.keys else 1
    return sorted((first[w], w) for w in sorted(first, key=lambda w: (-weights[w], first[w]))[:most])


def _index(templates: list[Template], weights: dict[str, float]) -> tuple[dict[str, list[tuple[int, int]]], Column]:
    """Postings of the rare words, and the templates as one literal array."""
    postings: dict[str, list[tuple[int, int]]] = {}
    described = []
    for number, template in enumerate(templates):
        words, rare = words_of(template.text), rare_words(template, weights)
        for at, word in rare:
            postings.setdefault(word, []).append((number, at))
        weighed = F.array(*(
            F.struct(F.lit(i).cast("long").alias("at"), F.lit(w).alias("word"), F.lit(weights[w]).alias("weight"))
            for i, w in enumerate(words)))
        described.append(F.struct(
            F.lit(template.label).alias("label"), F.lit(template.base).alias("base"),
            F.lit(len(words)).cast("long").alias("n_words"), _placed(rare).alias("rare"),
            F.lit((len(rare) + 1) // 2).alias("need"), _placed(_keys(template)).alias("keys"),
            weighed.alias("words"), F.lit(sum(weights[w] for w in words)).alias("total")))
    return postings, F.array(*described)


def find(docs: DataFrame, templates: list[Template] = TEMPLATES) -> DataFrame:
    """doc_id, n_words and ``places``: label, base, start, n_words and score of every notice."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    postings, described = _index(templates, word_weights(rows, templates))
    numbers, margin = F.lit(len(templates)).cast("long"), max(len(words_of(t.text)) for t in templates)
    # A proposal (template, beginning) as one number; beginnings may lie before the text.
    listed = F.create_map(*(
        c for word, found in sorted(postings.items())
        for c in (F.lit(word), F.array(*(F.lit((margin - at) * len(templates) + t).cast("long") for t, at in found)))))

    def proposals(words: Column) -> Column:
        at = F.array_compact(F.transform(words, lambda w, i: F.when(w.isin(sorted(postings)), i.cast("long"))))
        each = F.transform(at, lambda i: F.transform(listed[F.get(words, i.cast("int"))], lambda p: p + i * numbers))
        return F.array_distinct(F.flatten(each))

    def judged(words: Column, proposal: Column) -> Column:
        template = F.element_at(described, (F.pmod(proposal, numbers) + 1).cast("int"))
        start = F.floor(proposal / numbers).cast("long") - margin

        def stands(p: Column) -> Column:
            return F.coalesce(F.get(words, (start + p["at"]).cast("int")) == p["word"], F.lit(False))

        agreed = F.size(F.filter(template["rare"], stands)) >= template["need"]
        weight = F.aggregate(template["words"], F.lit(0.0), lambda s, p: s + F.when(stands(p), p["weight"]).otherwise(0.0))
        score = F.when(agreed & F.forall(template["keys"], stands), F.least(weight / template["total"], F.lit(1.0)))
        return F.struct(template["label"].alias("label"), template["base"].alias("base"), start.alias("start"),
                        template["n_words"].alias("n_words"), score.alias("score"))

    split = rows.select("doc_id", _words(F.col("text")).alias("words"))
    words = F.col("words")
    places = F.filter(F.transform(proposals(words), lambda p: judged(words, p)), lambda p: p["score"] >= LEAST)
    return split.select("doc_id", F.size(words).cast("long").alias("n_words"), places.alias("places"))


def labels(places: Column) -> Column:
    """Distinct labels of the places, sorted and comma-joined."""
    return F.array_join(F.array_sort(F.array_distinct(places["label"])), ",")
