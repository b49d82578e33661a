"""Encode rows as JSON messages, each routed to its topic."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def to_messages(df: DataFrame, topic: Column, columns: Sequence[str | Column]) -> DataFrame:
    """``topic`` and JSON ``value``; no key, so copies of an id may land in any partition.

    A NULL field is written as JSON null rather than left out.
    """
    payload = F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
    return df.select(topic.alias("topic"), payload.alias("value"))


def publish(messages: DataFrame, servers: str, options: Mapping[str, str] | None = None) -> None:
    """Write messages to their topics (needs the Kafka connector on the class path)."""
    (
        messages.write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .options(**{f"kafka.{k}": v for k, v in (options or {}).items()})
        .save()
    )
