"""DataFrame to DataFrame operators, the same for batch and streaming input."""

from eventlake.operators.analytics import enrich, late_rows, windowed_counts
from eventlake.operators.census import field_census, undeclared
from eventlake.operators.decode import accepted, decode_lenient, decode_strict, rejected
from eventlake.operators.messages import to_messages
from eventlake.operators.sessions import first_of_repeats, open_sessions, session_counts
from eventlake.operators.sketches import estimates, hourly_sketches, merge_sketches
from eventlake.operators.synthetic import synthesize, synthetic_events
from eventlake.operators.timed_joins import as_of, join_within
from eventlake.operators.upsert import latest_per_key

__all__ = [
    "accepted",
    "as_of",
    "decode_lenient",
    "decode_strict",
    "enrich",
    "estimates",
    "field_census",
    "first_of_repeats",
    "hourly_sketches",
    "join_within",
    "late_rows",
    "latest_per_key",
    "merge_sketches",
    "open_sessions",
    "rejected",
    "session_counts",
    "synthesize",
    "synthetic_events",
    "to_messages",
    "undeclared",
    "windowed_counts",
]
