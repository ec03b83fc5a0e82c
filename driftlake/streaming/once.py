"""Redelivered records dropped where they come in.

A record is known by topic, partition and offset.  Spark keeps those it has seen for as long as a
watermark says, in state that is checkpointed with the query, so redelivery after a restart is
noticed too.  The clock is the time a record comes in, which is never late: no first delivery is
ever dropped.  What is delivered again after ``within`` gets through; the merge jobs and the ledger
take a maximum per key, so it does no harm there.

By the record's own time (``clock``) the state can be shorter, but Spark drops what is older than
the watermark, first deliveries included.  Use it only where the topic cannot be that late.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

POSITION = ["topic", "partition", "offset"]
_CLOCK = "_seen_at"


def first_deliveries(changes: DataFrame, within: str = "1 day", clock: str | None = None) -> DataFrame:
    """The changes without those whose position came ``within`` that time before.

    State is one position per record of that time, spread over the shuffle partitions; a position
    is one record, so no key is hot.
    """
    columns = changes.columns
    seen = F.current_timestamp() if clock is None else F.col(clock)
    timed = changes.withColumn(_CLOCK, seen).withWatermark(_CLOCK, within)
    return timed.dropDuplicatesWithinWatermark(POSITION).select(*columns)
