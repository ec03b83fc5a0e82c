import os
import sys

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [HERE, os.path.dirname(HERE), os.path.dirname(os.path.dirname(HERE))]


@pytest.fixture(scope="session")
def docs_of(spark):
    """A table of documents from (doc_id, text) rows, with columns whose names clash with results."""

    def make(rows, lang="en"):
        full = [(i, t, lang, "src", len(t or ""), "x", 7, True) for i, t in rows]
        return spark.createDataFrame(
            full, "doc_id long, text string, lang string, source string, n_chars long, "
            "component_id string, shard int, kept boolean")

    return make


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and long texts, ties, repeated rows, odd characters."""
    long = " ".join(f"word{i % 977} tail{i % 13}" for i in range(30_000))
    return [
        (1, "The quick brown fox jumps over the lazy dog again and again."),
        (2, "The quick brown fox jumps over the lazy dog again and again."),
        (2, "The quick brown fox jumps over the lazy dog again and again."),
        (3, "the  quick brown\tfox jumps over the lazy dog again and again."),
        (4, None), (5, ""), (6, "   \n\t"), (7, "?!... 123 --- 456"), (8, "é"),
        (9, long), (10, long + " end"), (None, "no id here at all"), (None, None), (11, "a"),
        (12, "naïve café İstanbul Σίσυφος 日本語 \U0001f600 <|endoftext|> x"), (-3, "negative id"),
    ]
