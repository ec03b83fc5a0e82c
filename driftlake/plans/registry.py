"""Every registered query, with the SQL that checks it."""

from __future__ import annotations

from driftlake.plans import (
    access_queries,
    decode_queries,
    ingest_queries,
    layer_queries,
    merge_queries,
    upkeep_queries,
)

REGISTRY = {
    **decode_queries.QUERIES,
    **merge_queries.QUERIES,
    **ingest_queries.QUERIES,
    **layer_queries.QUERIES,
    **access_queries.QUERIES,
    **upkeep_queries.QUERIES,
}
