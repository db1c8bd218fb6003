"""The hourly load as Structured Streaming."""

from .late import admit_sink, late_rows, mark_replayed, pending_batches, stream_accepted
from .payloads import payload_sink, quarantined, stream_documents
from .readings import (
    append_sink,
    dedup_stream,
    drain,
    enrich_sink,
    enrich_stream,
    hourly_wide_stream,
    last_state_sink,
    last_state_stream,
    state_times_stream,
    stream_readings,
    upsert_interval_sink,
    upsert_result_sink,
)

__all__ = [
    "admit_sink",
    "append_sink",
    "dedup_stream",
    "drain",
    "enrich_sink",
    "enrich_stream",
    "hourly_wide_stream",
    "last_state_sink",
    "last_state_stream",
    "late_rows",
    "mark_replayed",
    "payload_sink",
    "pending_batches",
    "quarantined",
    "state_times_stream",
    "stream_accepted",
    "stream_documents",
    "stream_readings",
    "upsert_interval_sink",
    "upsert_result_sink",
]
