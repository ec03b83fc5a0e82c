"""Several captured tables in one log, told apart by topic."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftlake.operators.envelope import decode, valid_changes
from driftlake.spec import TableSpec


def is_own(topic: str, spec: TableSpec) -> bool:
    """Whether a topic is the table's: the one the spec names, else one that ends on its name."""
    return topic == spec.topic if spec.topic else topic.rpartition(".")[2] == spec.name


def own_rows(raw: DataFrame, spec: TableSpec) -> DataFrame:
    """The raw rows of one captured table.

    Rows that carry a topic are kept if it is the table's (see :func:`is_own`); rows without that column are all
    taken to be its own.  On a raw layer partitioned by topic the test prunes directories.
    """
    if "topic" not in raw.columns or "topic" in spec.row_columns:
        return raw
    own = spec.topic or spec.name
    same = F.col("topic") == own
    return raw.filter(same if spec.topic else same | F.endswith("topic", F.lit(f".{own}")))


def own_changes(raw: DataFrame, spec: TableSpec) -> DataFrame:
    """Valid decoded changes of one captured table out of a raw log."""
    return valid_changes(decode(own_rows(raw, spec), spec), spec)


def route(raw: DataFrame, specs: Iterable[TableSpec]) -> dict[str, DataFrame]:
    """Valid changes per captured table, keyed by table name."""
    return {spec.name: own_changes(raw, spec) for spec in specs}
