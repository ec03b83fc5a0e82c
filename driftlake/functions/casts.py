"""Casts from JSON text that never fail a job, whatever the session's ANSI setting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

INTEGRAL = {"tinyint", "smallint", "int", "integer", "bigint", "long"}


# A plain decimal number, blanks around it; its fraction is left out of the two groups.
DECIMAL_TEXT = r"^[\x00-\x20\x7f]*(?<sign>[+-]?)(?<whole>[0-9]*)\.[0-9]*[\x00-\x20\x7f]*$"


def lenient_bigint(text: Column) -> Column:
    """Text to BIGINT: fractions are cut off, anything that is no plain number is NULL.

    Almost every value is settled by the first ``try_cast``; the pattern only runs for the
    rest.  The zero stands in for a missing whole part, as in ``.5``.
    """
    cut = F.regexp_replace(text, F.lit(DECIMAL_TEXT), F.lit("${sign}0${whole}"))
    return F.coalesce(text.try_cast("bigint"), cut.try_cast("bigint"))


def lenient_cast(text: Column, data_type: str) -> Column:
    """Text to ``data_type``; unreadable text becomes NULL."""
    name = data_type.lower()
    if name == "string":
        return text
    if name in INTEGRAL:
        return lenient_bigint(text).try_cast(name)
    return text.try_cast(name)


def epoch_millis(ts: Column) -> Column:
    """Milliseconds since 1970 of a zone-less timestamp, independent of the session zone."""
    day = F.unix_date(ts.cast("date")).cast("bigint")
    seconds = F.hour(ts) * 3600 + F.minute(ts) * 60
    millis = F.floor(F.extract(F.lit("SECOND"), ts) * 1000).cast("bigint")
    return day * 86_400_000 + seconds.cast("bigint") * 1000 + millis
