"""A corpus made ready for training: five stages, each an operator of ``driftlake.llm``.

Every stage reads all that the one before it kept.  All but the last return documents with their
columns; the last returns the packed pieces.  Between stages the rows are written and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from driftlake.llm import decontaminate, exact_dedup, jaccard_join, lang_id, packing
from driftlake.llm.common import stored, table
from driftlake.llm.queries import vocabulary


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language go: no text, or no letter in it."""
    return lang_id.known_language(docs)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are equal but for white space one stays."""
    return exact_dedup.distinct_documents(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a shingle similarity of 0.75 or more, the smallest id stays."""
    return jaccard_join.first_of_each(docs, k=5, threshold=(75, 100))


def remove_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of test items go, and documents that have no others."""
    return decontaminate.remove_spans(decontaminate.find(docs, table(spark, sf_dir, "benchmark")))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 4096 tokens with their places in sequences."""
    return packing.pack(docs, vocabulary("word_bpe_49k.json"), capacity=4096, end_id=1)


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_copies),
    ("near_duplicates", drop_near_copies),
    ("decontamination", remove_benchmarks),
    ("packing", pack_sequences),
]

# Neither language identification nor packing can be said in SQL; tests/llm checks the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
