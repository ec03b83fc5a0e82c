from driftlake.streaming.bronze import (
    start_archive,
    start_bronze,
    start_bronze_batches,
    start_print,
    to_bronze,
    with_retries,
)
from driftlake.streaming.counts import read_counts, start_counted
from driftlake.streaming.expiring import start_latest_expiring
from driftlake.streaming.history import fold_history, key_history, read_history, start_history
from driftlake.streaming.latest import fold_latest, read_latest, start_latest
from driftlake.streaming.ledger import (
    CompactionConflictError,
    apply_batch,
    compact,
    current_state,
    current_view,
    drop_superseded,
    start_scd1,
    start_scd1_tables,
    wait_for_compactions,
)
from driftlake.streaming.listener import read_stored, store_counts, uncounted
from driftlake.streaming.once import first_deliveries
from driftlake.streaming.state_audit import audit_latest, latest_state, read_state

__all__ = [
    "CompactionConflictError",
    "apply_batch",
    "audit_latest",
    "compact",
    "current_state",
    "current_view",
    "drop_superseded",
    "first_deliveries",
    "fold_history",
    "fold_latest",
    "key_history",
    "latest_state",
    "read_counts",
    "read_history",
    "read_latest",
    "read_state",
    "read_stored",
    "start_archive",
    "start_bronze",
    "start_bronze_batches",
    "start_counted",
    "start_history",
    "start_latest",
    "start_latest_expiring",
    "start_print",
    "start_scd1",
    "start_scd1_tables",
    "store_counts",
    "to_bronze",
    "uncounted",
    "wait_for_compactions",
    "with_retries",
]
