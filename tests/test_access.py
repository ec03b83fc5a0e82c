"""Grants, first-match rules and the audit report."""

import re

import pytest
from pyspark.sql import functions as F

from driftlake.operators import (
    Rule,
    audit_access,
    effective_privileges,
    first_match,
    granted_actions,
    load_rules,
)
from driftlake.operators.access import permits
from driftlake.plans.access_queries import EXPECTED, GRANTS, NEEDED, ROLE_MAP, RULES
from driftlake.sources import typed_rows

USERS = ["de_ann", "de_", "ds_bob", "xde_eve", "guest", "de_a\nb"]
CATALOGS = ["system", "bronze_de", "silver_de", "silver_ds", "gold_ds", "bronze_de2", "bronzexde"]


def by_hand(user, catalog, rules):
    for rule in rules:
        patterns = ((rule.user, user), (rule.catalog, catalog))
        if all(p is None or re.fullmatch(p, text) for p, text in patterns):
            return rule.allow
    return None


@pytest.mark.parametrize(
    "rules",
    [
        load_rules(RULES),
        [Rule("all", user="de_(ann|x)"), Rule("read-only", catalog="s.*")],
        [Rule("none", "bronze.de"), Rule("all", user="de_.*")],
        [],
    ],
)
def test_first_match(spark, rules):
    log = typed_rows(spark, [(u, c) for u in USERS for c in CATALOGS], "user STRING, catalog STRING")
    got = log.select("user", "catalog", first_match(F.col("user"), F.col("catalog"), rules).alias("a"))
    for row in got.collect():
        assert row.a == by_hand(row.user, row.catalog, rules), row


def test_rules_need_no_shuffle(spark):
    log = spark.range(10).select(F.concat(F.lit("de_"), "id").alias("user"), F.lit("system").alias("catalog"))
    decided = log.withColumn("a", first_match(F.col("user"), F.col("catalog"), load_rules(RULES)))
    plan = decided._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan


def test_permits(spark):
    cases = [("all", "write", True), ("read-only", "read", True), ("read-only", "write", False),
             ("none", "read", False), (None, "read", False)]
    rows = typed_rows(spark, cases, "allow STRING, action STRING, want BOOLEAN")
    got = rows.withColumn("got", permits(F.col("allow"), F.col("action"))).collect()
    assert [r.got for r in got] == [r.want for r in got]


def test_effective_privileges(spark):
    principals = [("de_team", "de_team_role"), ("ds_team", "ds_team_role"), ("both", "de_team_role"),
                  ("both", "ds_team_role"), ("idle", "no_role")]
    got = effective_privileges(
        typed_rows(spark, principals, "principal STRING, principal_role STRING"),
        typed_rows(spark, ROLE_MAP, "principal_role STRING, catalog STRING, catalog_role STRING"),
        typed_rows(spark, GRANTS + GRANTS[:1], "catalog STRING, catalog_role STRING, privilege STRING"),
    )
    assert {tuple(r) for r in got.collect()} == {
        ("de_team", "bronze_catalog", "CATALOG_MANAGE_CONTENT"),
        ("de_team", "silver_catalog", "CATALOG_MANAGE_CONTENT"),
        ("ds_team", "silver_catalog", "CATALOG_READ_PROPERTIES"),
        ("ds_team", "gold_catalog", "CATALOG_MANAGE_CONTENT"),
        ("both", "bronze_catalog", "CATALOG_MANAGE_CONTENT"),
        ("both", "silver_catalog", "CATALOG_MANAGE_CONTENT"),
        ("both", "silver_catalog", "CATALOG_READ_PROPERTIES"),
        ("both", "gold_catalog", "CATALOG_MANAGE_CONTENT"),
    }
    assert got.count() == 8


def test_audit_shows_where_rules_and_expectation_differ(spark):
    log = [
        ("ds_bob", "ds", "gold_ds", "write", True),  # expected, but the rules deny it
        ("ds_bob", "ds", "gold_ds", "write", False),
        ("ds_bob", "ds", "silver_ds", "write", True),  # let through against expectation
        ("de_ann", "de", "bronze_de", "read", True),
        ("guest", "guest", "system", "read", False),  # nothing is expected
        ("guest", "guest", "gold_ds", "read", True),
    ]
    report = audit_access(
        typed_rows(spark, log, "user STRING, team STRING, catalog STRING, action STRING, allowed BOOLEAN"),
        load_rules(RULES),
        typed_rows(spark, EXPECTED, "team STRING, catalog STRING, action STRING, expected BOOLEAN"),
    )
    got = {
        (r.team, r.catalog, r.action): (
            r.requests, r.let_through, r.rules_allow, r.expected, r.covered, r.rule_drift, r.violations)
        for r in report.collect()
    }
    assert got == {
        ("ds", "gold_ds", "write"): (2, 1, 0, True, True, 2, 1),
        ("ds", "silver_ds", "write"): (1, 1, 1, False, True, 1, 1),
        ("de", "bronze_de", "read"): (1, 1, 1, True, True, 0, 0),
        ("guest", "system", "read"): (1, 0, 0, False, False, 0, 0),
        ("guest", "gold_ds", "read"): (1, 1, 0, False, False, 0, 1),  # let in where nobody expects it
    }


def test_audit_against_grants(spark):
    """A team that may read by expectation, but holds a privilege on properties only."""
    roles = typed_rows(spark, [("ds_bob", "ds_team_role")], "principal STRING, principal_role STRING")
    role_map = typed_rows(spark, ROLE_MAP, "principal_role STRING, catalog STRING, catalog_role STRING")
    grants = typed_rows(spark, GRANTS, "catalog STRING, catalog_role STRING, privilege STRING")
    needed = typed_rows(spark, NEEDED, "privilege STRING, action STRING")
    granted = granted_actions(effective_privileges(roles, role_map, grants), needed)
    granted = granted.withColumn("catalog", F.regexp_replace("catalog", "catalog$", "ds"))
    log = [("ds_bob", "ds", "silver_ds", "read", True), ("ds_bob", "ds", "gold_ds", "read", True),
           ("ds_eve", "ds", "gold_ds", "read", True)]
    report = audit_access(
        typed_rows(spark, log, "user STRING, team STRING, catalog STRING, action STRING, allowed BOOLEAN"),
        load_rules(RULES),
        typed_rows(spark, EXPECTED, "team STRING, catalog STRING, action STRING, expected BOOLEAN"),
        granted,
    )
    got = {r.catalog: (r.requests, r.grants_allow, r.grant_drift) for r in report.collect()}
    assert got == {"silver_ds": (1, 0, 1), "gold_ds": (2, 1, 1)}
