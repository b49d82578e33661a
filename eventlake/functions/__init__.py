"""Scalar functions as column expressions."""

from eventlake.functions.names import table_name, table_name_column
from eventlake.functions.times import (
    day_bucket,
    event_time,
    format_text_time,
    hour_bucket,
    ingestion_time,
    seconds_of,
    text_time,
    wall_clock,
)

__all__ = [
    "day_bucket",
    "event_time",
    "format_text_time",
    "hour_bucket",
    "ingestion_time",
    "seconds_of",
    "table_name",
    "table_name_column",
    "text_time",
    "wall_clock",
]
