"""Access rules as a table: which rule decides, found by joins instead of one long CASE.

``rules(ord, user_re, catalog_re, allow)``: patterns match whole strings, a missing one matches all,
and the matching rule with the least ``ord`` decides.  A CASE is best for a rule file of some lines;
a table holds thousands, and can be joined and stored like any other.

Only distinct requests are matched, and each side on its own: which patterns does a user match, and
which a catalog.  A plain name is found by equality.  A pattern that begins with plain letters is
found by that prefix and then tested; only what begins with anything else is tested against every
distinct name.  A request then meets the rules by its two patterns, an equality again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EVERYTHING = ".*"
# Letters of a pattern's prefix that are looked up; the pattern itself is tested afterwards.
PREFIX = 16

_LITERAL = r"\A\w+\z"
# The plain beginning: letters that no quantifier follows.  Alternatives have none in common.
_PLAIN = r"\A((?:\w(?![*+?{]))+)"


def _whole(value: Column, pattern: Column) -> Column:
    return F.rlike(value, F.concat(F.lit(r"\A(?:"), pattern, F.lit(r")\z")))


def matching_patterns(values: DataFrame, patterns: DataFrame) -> DataFrame:
    """(value, pattern) of distinct ``values(value)`` and distinct ``patterns(pattern)`` that match."""
    plain = F.when(~F.contains("pattern", F.lit("|")), F.regexp_extract("pattern", _PLAIN, 1))
    sorted_out = patterns.select(
        "pattern", F.col("pattern").rlike(_LITERAL).alias("literal"),
        F.left(F.coalesce(plain, F.lit("")), F.lit(PREFIX)).alias("prefix"))
    every = values.withColumn("pattern", F.lit(EVERYTHING))
    named = values.join(sorted_out.filter("literal").select("pattern"), F.col("value") == F.col("pattern"))
    real = sorted_out.filter(~F.col("literal") & (F.col("pattern") != EVERYTHING))
    beginnings = values.withColumn("prefix", F.explode(F.transform(
        F.sequence(F.lit(1), F.lit(PREFIX)), lambda n: F.left(F.col("value"), n)))).dropDuplicates()
    begun = beginnings.join(real.filter("prefix <> ''").select("prefix", "pattern"), "prefix")
    free = values.join(real.filter("prefix = ''").select("pattern"), _whole(F.col("value"), F.col("pattern")))
    return (
        every.unionByName(named)
        .unionByName(begun.filter(_whole(F.col("value"), F.col("pattern"))).select("value", "pattern"))
        .unionByName(free)
    )


def decide(requests: DataFrame, rules: DataFrame) -> DataFrame:
    """``requests`` (user, catalog and others) with ``ord`` and ``allow`` of the rule that decides,
    NULL if none does."""
    rules = rules.select(
        "ord", "allow", F.coalesce("user_re", F.lit(EVERYTHING)).alias("user_re"),
        F.coalesce("catalog_re", F.lit(EVERYTHING)).alias("catalog_re"))
    pairs = requests.select("user", "catalog").dropDuplicates()
    found = pairs
    for side in ("user", "catalog"):
        values = pairs.select(F.col(side).alias("value")).filter("value IS NOT NULL").dropDuplicates()
        patterns = rules.select(F.col(f"{side}_re").alias("pattern")).dropDuplicates()
        match = matching_patterns(values, patterns).select(
            F.col("value").alias(side), F.col("pattern").alias(f"{side}_re"))
        found = found.join(match, side)
    # Of rules with the same two patterns only the first can ever decide.
    first = rules.groupBy("user_re", "catalog_re").agg(
        F.min("ord").alias("ord"), F.min_by("allow", "ord").alias("allow"))
    decided = found.join(first, ["user_re", "catalog_re"]).groupBy("user", "catalog").agg(
        F.min("ord").alias("ord"), F.min_by("allow", "ord").alias("allow"))
    return requests.join(decided, ["user", "catalog"], "left")
