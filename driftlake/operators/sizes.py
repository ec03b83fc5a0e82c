"""How much may be sent to every task."""

from __future__ import annotations

import re

from pyspark.sql import SparkSession

BROADCAST_THRESHOLD = "spark.sql.autoBroadcastJoinThreshold"
UNITS = {"": 1, "b": 1, "k": 1 << 10, "m": 1 << 20, "g": 1 << 30, "t": 1 << 40, "p": 1 << 50}


def broadcast_limit(spark: SparkSession) -> int:
    """The session's broadcast threshold in bytes, negative if broadcasting is off."""
    text = spark.conf.get(BROADCAST_THRESHOLD, "10MB").strip().lower()
    number, unit = re.fullmatch(r"(-?\d+)\s*([a-z]*)", text).groups()
    return int(number) * UNITS[unit[:1]]
