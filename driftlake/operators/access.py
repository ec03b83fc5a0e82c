"""Access audits over grant relations, rule lists and access logs."""

from __future__ import annotations

import json
import re
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What a rule may allow, and the actions each allows.
ALLOW_ALL = "all"
ALLOW_READ = "read-only"
ALLOW_NONE = "none"
READ_ACTION = "read"


@dataclass(frozen=True)
class Rule:
    """One line of a rule file; a missing pattern matches everything."""

    allow: str
    catalog: str | None = None
    user: str | None = None


def load_rules(text: str) -> list[Rule]:
    """Rules of a JSON document ``{"catalogs": [{"user", "catalog", "allow"}, ...]}``, in order."""
    return [Rule(**entry) for entry in json.loads(text)["catalogs"]]


def effective_privileges(
    principal_roles: DataFrame, role_map: DataFrame, grants: DataFrame
) -> DataFrame:
    """Which principal holds which privilege on which catalog.

    ``principal_roles(principal, principal_role)``, ``role_map(principal_role, catalog,
    catalog_role)``, ``grants(catalog, catalog_role, privilege)``.  Roles are resolved to
    distinct privileges before the principals, the one large relation, come in.
    """
    per_role = (
        role_map.join(grants, ["catalog", "catalog_role"])
        .select("principal_role", "catalog", "privilege")
        .dropDuplicates()
    )
    held = principal_roles.join(per_role, "principal_role")
    return held.select("principal", "catalog", "privilege").dropDuplicates()


def _matches(value: Column, pattern: str | None) -> Column:
    """Whole-string match; a plain name needs no regular expression."""
    if pattern is None:
        return F.lit(True)
    if re.fullmatch(r"\w+", pattern):
        return value == pattern
    return value.rlike(rf"\A(?:{pattern})\z")


def first_match(user: Column, catalog: Column, rules: Iterable[Rule]) -> Column:
    """``allow`` of the first rule that matches, NULL if none does.

    The rule file becomes one CASE expression: no join, no shuffle, one pass over the log.
    """
    decision = F
    for rule in rules:
        decision = decision.when(
            _matches(user, rule.user) & _matches(catalog, rule.catalog), F.lit(rule.allow)
        )
    return F.lit(None).cast("string") if decision is F else decision


def permits(allow: Column, action: Column) -> Column:
    """Whether a decision lets an action through; no decision denies."""
    granted = F.when(allow == ALLOW_ALL, True).when(
        allow == ALLOW_READ, action == READ_ACTION
    )
    return F.coalesce(granted, F.lit(False))


def granted_actions(privileges: DataFrame, needed: DataFrame) -> DataFrame:
    """user, catalog and action that a held privilege is enough for.

    ``privileges(principal, catalog, privilege)`` as :func:`effective_privileges` gives them,
    ``needed(privilege, action)`` which actions each privilege covers.
    """
    held = privileges.join(F.broadcast(needed), "privilege")
    return held.select(F.col("principal").alias("user"), "catalog", "action").dropDuplicates()


def audit_access(
    log: DataFrame, rules: Iterable[Rule], expected: DataFrame, granted: DataFrame | None = None
) -> DataFrame:
    """Requests per team, catalog and action, and how they differ from the expectation.

    ``log(user, team, catalog, action, allowed)`` is what happened; ``expected(team,
    catalog, action, expected)`` is what should, one row per combination.  What nothing is
    expected for should be denied, as by the last line of a rule file; ``covered`` tells such
    requests from others.  With ``granted(user, catalog, action)`` the report also says what the
    grants allow and where they differ.  The log is aggregated first, by user at most, so the
    joins handle few rows however large or one-sided the log is.
    """
    decided = permits(first_match(F.col("user"), F.col("catalog"), rules), F.col("action"))
    combination = ["team", "catalog", "action"]
    counts = {
        "requests": F.count(F.lit(1)),
        "let_through": F.count_if("allowed"),
        "rules_allow": F.count_if(decided),
    }
    checks = {"rule_drift": "rules_allow", "violations": "let_through"}
    if granted is None:
        totals = log.groupBy(*combination).agg(*(c.alias(n) for n, c in counts.items()))
    else:
        by_user = log.groupBy("user", *combination).agg(*(c.alias(n) for n, c in counts.items()))
        held = granted.select("user", "catalog", "action", F.lit(True).alias("_held"))
        known = by_user.join(held, ["user", "catalog", "action"], "left")
        totals = known.groupBy(*combination).agg(
            *(F.sum(n).alias(n) for n in counts),
            F.sum(F.when(F.col("_held"), F.col("requests")).otherwise(0)).alias("grants_allow"),
        )
        checks["grant_drift"] = "grants_allow"
    report = totals.join(expected, combination, "left").withColumns({
        "covered": F.col("expected").isNotNull(),
        "expected": F.coalesce("expected", F.lit(False)),
    })
    return report.withColumns({
        name: F.when(F.col("expected"), F.col("requests") - F.col(allowed)).otherwise(F.col(allowed))
        for name, allowed in checks.items()
    })
