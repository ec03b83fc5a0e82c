from driftlake.operators.access import (
    Rule,
    audit_access,
    effective_privileges,
    first_match,
    granted_actions,
    load_rules,
)
from driftlake.operators.discover import draft_spec, drift_report, topic_shapes
from driftlake.operators.envelope import decode, rejected_changes, valid_changes
from driftlake.operators.latest import latest_per_key, latest_per_key_agg, newer
from driftlake.operators.merge import (
    apply_scd1,
    check_unique,
    merge_into_table,
    merge_ledger_into_table,
    merge_source,
    repeated_keys,
    upsert,
)
from driftlake.operators.routing import own_changes, own_rows, route
from driftlake.operators.rule_table import decide
from driftlake.operators.variants import decode_variant, shredding, to_variant

__all__ = [
    "Rule",
    "apply_scd1",
    "audit_access",
    "check_unique",
    "decide",
    "decode",
    "decode_variant",
    "draft_spec",
    "drift_report",
    "effective_privileges",
    "first_match",
    "granted_actions",
    "latest_per_key",
    "latest_per_key_agg",
    "load_rules",
    "merge_into_table",
    "merge_ledger_into_table",
    "merge_source",
    "newer",
    "own_changes",
    "own_rows",
    "rejected_changes",
    "repeated_keys",
    "route",
    "shredding",
    "to_variant",
    "topic_shapes",
    "upsert",
    "valid_changes",
]
