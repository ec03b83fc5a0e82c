from driftlake.sources.changes import (
    CONTRACT,
    read_changes,
    read_raw,
    replay_options,
    topic_schema,
)
from driftlake.sources.tables import click_event_schema, preview, table_exists, typed_rows

__all__ = [
    "CONTRACT",
    "click_event_schema",
    "preview",
    "read_changes",
    "read_raw",
    "replay_options",
    "table_exists",
    "topic_schema",
    "typed_rows",
]
