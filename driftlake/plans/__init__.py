from driftlake.plans.layers import (
    append,
    ensure_namespace,
    ensure_table,
    list_catalogs,
    list_namespaces,
    list_tables,
    promote,
    seed_if_missing,
)
from driftlake.plans.refine import live_rows, merge_changes, read_current, refine, upsert_rows

__all__ = [
    "append",
    "ensure_namespace",
    "ensure_table",
    "list_catalogs",
    "list_namespaces",
    "list_tables",
    "live_rows",
    "merge_changes",
    "promote",
    "read_current",
    "refine",
    "seed_if_missing",
    "upsert_rows",
]
