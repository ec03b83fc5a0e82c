"""Newest change per key under one total event order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftlake.spec import TableSpec

RANK = "_rank"


def event_order(spec: TableSpec, available: list[str], side: str | None = None) -> list[Column]:
    """The total order of events, most significant first; NULL counts as lowest.

    It ends on a hash of operation and attributes: two events that compare equal then are, but
    for a chance of 1 in 2^64, the same event.  One hash costs less than sorting by every column.
    """
    prefix = f"{side}." if side else ""
    content = [F.col(f"{prefix}`{c}`") for c in ["op", *spec.attributes] if c in available]
    order = [F.col(prefix + c) for c in spec.order_columns(available)]
    return [*order, F.xxhash64(*content)] if content else order


def latest_per_key(changes: DataFrame, spec: TableSpec) -> DataFrame:
    """One row per key: greatest version first, missing versions last.

    ``rank = 1`` directly above ``row_number`` lets Spark keep only the best row per key in
    every map task (WindowGroupLimit), so a key holding most of the log still sends one
    row per task through the shuffle.
    """
    order = [c.desc_nulls_last() for c in event_order(spec, changes.columns)]
    ranked = Window.partitionBy(*spec.keys).orderBy(*order)
    return changes.withColumn(RANK, F.row_number().over(ranked)).filter(F.col(RANK) == 1).drop(RANK)


def latest_per_key_agg(changes: DataFrame, spec: TableSpec) -> DataFrame:
    """The same result as an aggregate; also usable on a streaming DataFrame.

    Structs compare field by field with NULL lowest, which is ``desc_nulls_last`` under max.
    """
    rest = [c for c in changes.columns if c not in spec.keys]
    order = event_order(spec, changes.columns)
    best = F.max_by(F.struct(*rest), F.struct(*order)).alias("_best")
    grouped = changes.groupBy(*spec.keys).agg(best)
    return grouped.select(*spec.keys, "_best.*").select(*changes.columns)


def newer(left: list[Column], right: list[Column]) -> Column:
    """True where ``left`` is at or after ``right`` in event order (NULL sorts first)."""
    return F.struct(*left) >= F.struct(*right)
