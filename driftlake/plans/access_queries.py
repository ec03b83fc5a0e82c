"""Queries over the given tables: grants and access logs derived from events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftlake.operators.access import (
    audit_access,
    effective_privileges,
    first_match,
    granted_actions,
    load_rules,
)
from driftlake.plans.feeds import mapped, table
from driftlake.sources.tables import typed_rows

# Rule list, role assignments, grants and expected access per team.
RULES = """{"catalogs": [
    {"user": "de_.*", "catalog": "system", "allow": "read-only"},
    {"user": "de_.*", "catalog": "bronze_de", "allow": "all"},
    {"user": "de_.*", "catalog": "silver_de", "allow": "all"},
    {"user": "ds_.*", "catalog": "system", "allow": "read-only"},
    {"user": "ds_.*", "catalog": "silver_ds", "allow": "all"},
    {"catalog": ".*", "allow": "none"}
]}"""
ROLE_MAP = [
    ("de_team_role", "bronze_catalog", "de_bronze_role"),
    ("de_team_role", "silver_catalog", "de_silver_role"),
    ("ds_team_role", "silver_catalog", "ds_silver_read_role"),
    ("ds_team_role", "gold_catalog", "ds_gold_write_role"),
]
GRANTS = [
    ("bronze_catalog", "de_bronze_role", "CATALOG_MANAGE_CONTENT"),
    ("silver_catalog", "de_silver_role", "CATALOG_MANAGE_CONTENT"),
    ("silver_catalog", "ds_silver_read_role", "CATALOG_READ_PROPERTIES"),
    ("gold_catalog", "ds_gold_write_role", "CATALOG_MANAGE_CONTENT"),
]
EXPECTED = [
    ("de", "bronze_de", "read", True),
    ("de", "bronze_de", "write", True),
    ("de", "silver_de", "read", True),
    ("de", "silver_de", "write", True),
    ("ds", "silver_ds", "read", True),
    ("ds", "silver_ds", "write", False),
    ("ds", "gold_ds", "read", True),
    ("ds", "gold_ds", "write", True),
    ("ds", "bronze_ds", "read", False),
]
# The actions a privilege covers; reading properties is no reading of rows.
NEEDED = [("CATALOG_MANAGE_CONTENT", "read"), ("CATALOG_MANAGE_CONTENT", "write")]
CATALOGS = {"view": "silver_ds", "click": "bronze_de", "purchase": "gold_ds", "signup": "system"}


def access_log(spark, sf_dir) -> DataFrame:
    """events as requests: team by user, catalog by event type, a write if costly."""
    third = F.pmod("user_id", F.lit(3))
    team = F.when(third == 0, "de").when(third == 1, "ds").otherwise("guest")
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.concat_ws("_", team, F.col("user_id")).alias("user"),
        team.alias("team"),
        mapped("event_type", CATALOGS, "silver_de").alias("catalog"),
        F.when(F.col("value") < 30, "read").otherwise("write").alias("action"),
        (F.col("value") < 100).alias("allowed"),
    )


def privileges(spark, sf_dir):
    """Every user of the log is a principal holding its team's role."""
    users = access_log(spark, sf_dir)
    roles = users.select(
        F.col("user").alias("principal"), F.concat("team", F.lit("_team_role")).alias("principal_role")
    )
    role_map = typed_rows(
        spark, ROLE_MAP, "principal_role STRING, catalog STRING, catalog_role STRING"
    )
    grants = typed_rows(spark, GRANTS, "catalog STRING, catalog_role STRING, privilege STRING")
    return effective_privileges(roles.dropDuplicates(), role_map, grants)


def rule_decisions(spark, sf_dir):
    log = access_log(spark, sf_dir)
    allow = first_match(F.col("user"), F.col("catalog"), load_rules(RULES))
    return log.select("event_id", "user", "catalog", allow.alias("allow"))


def compliance(spark, sf_dir):
    expected = typed_rows(
        spark, EXPECTED, "team STRING, catalog STRING, action STRING, expected BOOLEAN"
    )
    needed = typed_rows(spark, NEEDED, "privilege STRING, action STRING")
    granted = granted_actions(privileges(spark, sf_dir), needed)
    # A team sees a catalog under its own name: silver_catalog is silver_ds to the ds team.
    team = F.substring_index("user", "_", 1)
    seen = granted.withColumn("catalog", F.regexp_replace("catalog", F.lit("catalog$"), team))
    return audit_access(access_log(spark, sf_dir), load_rules(RULES), expected, seen)


def _values(rows) -> str:
    return ", ".join("(" + ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in r) + ")" for r in rows)


LOG = """
    SELECT event_id, team || '_' || user_id AS "user", team, catalog, action, value < 100 AS allowed
    FROM (SELECT *, CASE user_id % 3 WHEN 0 THEN 'de' WHEN 1 THEN 'ds' ELSE 'guest' END AS team,
              CASE event_type WHEN 'view' THEN 'silver_ds' WHEN 'click' THEN 'bronze_de'
                   WHEN 'purchase' THEN 'gold_ds' WHEN 'signup' THEN 'system'
                   ELSE 'silver_de' END AS catalog,
              CASE WHEN value < 30 THEN 'read' ELSE 'write' END AS action
          FROM events)"""
DECISIONS = f"""
    SELECT l.*, r.allow FROM ({LOG}) l JOIN (VALUES
        (1, 'de_.*', 'system', 'read-only'), (2, 'de_.*', 'bronze_de', 'all'),
        (3, 'de_.*', 'silver_de', 'all'), (4, 'ds_.*', 'system', 'read-only'),
        (5, 'ds_.*', 'silver_ds', 'all'), (6, '.*', '.*', 'none')
    ) r(ord, user_re, catalog_re, allow)
    ON regexp_full_match(l."user", r.user_re) AND regexp_full_match(l.catalog, r.catalog_re)
    QUALIFY row_number() OVER (PARTITION BY l.event_id ORDER BY r.ord) = 1"""

QUERIES = {
    "g_effective": (
        privileges,
        f"""SELECT DISTINCT l."user" AS principal, m.catalog, g.privilege
        FROM ({LOG}) l
        JOIN (VALUES {_values(ROLE_MAP)}) m(principal_role, catalog, catalog_role)
          ON m.principal_role = l.team || '_team_role'
        JOIN (VALUES {_values(GRANTS)}) g(catalog, catalog_role, privilege)
          ON g.catalog = m.catalog AND g.catalog_role = m.catalog_role""",
    ),
    "g_rules": (rule_decisions, f'SELECT event_id, "user", catalog, allow FROM ({DECISIONS})'),
    "g_audit": (
        compliance,
        f"""SELECT d.team, d.catalog, d.action, count(*) AS requests,
               CAST(sum(CASE WHEN allowed THEN 1 ELSE 0 END) AS BIGINT) AS let_through,
               CAST(sum(CASE WHEN decided THEN 1 ELSE 0 END) AS BIGINT) AS rules_allow,
               CAST(sum(CASE WHEN granted THEN 1 ELSE 0 END) AS BIGINT) AS grants_allow,
               coalesce(any_value(expected), false) AS expected,
               any_value(expected) IS NOT NULL AS covered,
               CAST(sum(CASE WHEN decided <> coalesce(expected, false) THEN 1 ELSE 0 END) AS BIGINT) AS rule_drift,
               CAST(sum(CASE WHEN allowed <> coalesce(expected, false) THEN 1 ELSE 0 END) AS BIGINT) AS violations,
               CAST(sum(CASE WHEN granted <> coalesce(expected, false) THEN 1 ELSE 0 END) AS BIGINT) AS grant_drift
        FROM (SELECT *, allow = 'all' OR (allow = 'read-only' AND action = 'read') AS decided,
                     (team || '_team_role', catalog, action) IN (
                         SELECT (m.principal_role, replace(m.catalog, 'catalog', split_part(m.principal_role, '_', 1)), n.action)
                         FROM (VALUES {_values(ROLE_MAP)}) m(principal_role, catalog, catalog_role)
                         JOIN (VALUES {_values(GRANTS)}) g(catalog, catalog_role, privilege)
                           ON g.catalog = m.catalog AND g.catalog_role = m.catalog_role
                         JOIN (VALUES {_values(NEEDED)}) n(privilege, action) ON n.privilege = g.privilege) AS granted
              FROM ({DECISIONS})) d
        LEFT JOIN (VALUES {_values(EXPECTED)}) e(team, catalog, action, expected)
          ON e.team = d.team AND e.catalog = d.catalog AND e.action = d.action
        GROUP BY 1, 2, 3""",
    ),
}
