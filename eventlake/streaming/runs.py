"""Triggers, one query per topic, and waiting."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.streaming.readwriter import DataStreamWriter

from eventlake.functions.names import table_name

COMMIT_INTERVAL = "60 seconds"


def with_trigger(writer: DataStreamWriter, every: str | None) -> DataStreamWriter:
    """Commit ``every`` interval, or, with None, work off what is there and stop."""
    if every is None:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=every)


def topic_tables(topics: str | Sequence[str]) -> dict[str, str]:
    """Topic to table name. Topics may be one comma-separated text; names are trimmed.

    Two topics that would share a table are refused.
    """
    listed = topics.split(",") if isinstance(topics, str) else topics
    names = [t.strip() for t in listed]
    if not names or "" in names:
        raise ValueError(f"empty topic name in {topics!r}")
    tables: dict[str, str] = {}
    for topic in dict.fromkeys(names):
        table = table_name(topic)
        if table in tables.values():
            raise ValueError(f"topic {topic!r} shares table {table!r} with another topic")
        tables[topic] = table
    return tables


def fan_out(
    topics: str | Sequence[str], start: Callable[[str, str], StreamingQuery]
) -> dict[str, StreamingQuery]:
    """``start(topic, table)`` for each topic: independent queries in one session."""
    return {topic: start(topic, table) for topic, table in topic_tables(topics).items()}


def wait_for_all(queries: dict[str, StreamingQuery]) -> None:
    """Block until every query has stopped; a failed one raises. For ``every=None``."""
    for query in queries.values():
        query.awaitTermination()


def wait_for_any(queries: dict[str, StreamingQuery], poll_seconds: int = 1) -> None:
    """Block while all run. When one stops or fails, stop the rest: one job, one fate."""
    try:
        while all(q.isActive for q in queries.values()):
            for query in queries.values():
                query.awaitTermination(poll_seconds)
        for query in queries.values():
            if not query.isActive:
                query.awaitTermination()
    finally:
        for query in queries.values():
            query.stop()
