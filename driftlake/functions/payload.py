"""Turning a topic value into the one ``payload`` string the raw layer stores."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

KEEP_NULLS = {"ignoreNullFields": "false"}
JSON_BLANKS = " \t\r\n"

# Options of from_json: its parser takes texts and numbers of any length, nested as deep as may be.
NO_LIMITS = {n: "2147483647" for n in ("maxStringLen", "maxNumLen", "maxNestingDepth")}
STRICT = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}


def pack_record(*columns: Column | str) -> Column:
    """Columns to one JSON object; null fields are written out, not dropped."""
    return F.to_json(F.struct(*columns), KEEP_NULLS)


def _ends_marked(both: Column, marked: Callable[[Column], Column]) -> Column:
    """Whether an array, which is computed once, has two elements and the second is the mark."""
    found = F.exists(F.array(both), lambda b: (F.size(b) == 2) & marked(F.try_element_at(b, F.lit(2))))
    return F.coalesce(found, F.lit(False))


def is_json(text: Column) -> Column:
    """Whether the text is one JSON value: the one before the mark in an array of two."""
    mark = uuid.uuid4().hex  # nothing the text can hold
    both = F.from_json(F.concat(F.lit("["), text, F.lit(f',"{mark}"]')), "array<string>", {**STRICT, **NO_LIMITS})
    return _ends_marked(both, lambda last: last == mark)


def is_json_object(text: Column) -> Column:
    """Whether the text is one JSON object: the one before the marked one in an array of two.

    The object's own fields are skipped, not read, so its size and depth don't matter.
    """
    mark = uuid.uuid4().hex  # nothing the text can hold
    both = F.from_json(
        F.concat(F.lit("["), text, F.lit(f',{{"{mark}":true}}]')), f"array<struct<`{mark}`: boolean>>",
        {**STRICT, **NO_LIMITS})
    return _ends_marked(both, lambda last: last[mark])


def normalize_value(value: Column, normalize: bool = True) -> Column:
    """Raw topic value to payload.

    Objects pass through untouched.  Every other value (string, number, array, null) is
    wrapped as ``{"value": ...}``; with ``normalize=False`` it is kept as bare JSON.
    Text that is no JSON at all is quoted first, text that only begins like an object included.
    An object's fields are skipped by that check, not read.  The size of a value makes no difference.
    """
    is_object = F.ltrim(value, F.lit(JSON_BLANKS)).startswith("{") & is_json_object(value)
    quoted = F.to_json(F.array(value))
    as_text = F.substring(quoted, F.lit(2), F.length(quoted) - 2)
    bare = F.when(value.isNull(), F.lit("null")).when(is_json(value), value).otherwise(as_text)
    if not normalize:
        return F.when(is_object, value).otherwise(bare)
    return F.when(is_object, value).otherwise(F.concat(F.lit('{"value": '), bare, F.lit("}")))
