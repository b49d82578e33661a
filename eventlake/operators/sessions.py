"""Session windows whose gap depends on the event, and repeated messages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def session_counts(
    df: DataFrame, time: str, key: str, gap: Column, value: Column, *, lateness: str | None
) -> DataFrame:
    """Count and sum per session of a key: an event keeps its session open for its own ``gap``.

    Sessions that touch are one. A NULL time is in no session; NULL is a key like others. On a
    stream a session is emitted once the watermark has passed its end; ``open_sessions`` reads those
    still open. Sessions are merged inside each task before the shuffle, so a hot key sends its
    sessions and not its events.
    """
    if df.isStreaming and lateness is not None:
        df = df.withWatermark(time, lateness)
    counts = df.where(F.col(time).isNotNull()).groupBy(F.session_window(time, gap).alias("s"), F.col(key))
    counts = counts.agg(F.count(F.lit(1)).alias("n_events"), F.sum(value).alias("total"))
    start, end = F.col("s.start").alias("session_start"), F.col("s.end").alias("session_end")
    return counts.select(start, end, key, "n_events", "total")


def open_sessions(spark: SparkSession, checkpoint: str, key: str) -> DataFrame:
    """Sessions that a stopped ``session_counts`` stream still holds, from its state."""
    state = spark.read.format("statestore").load(checkpoint)
    return state.select(
        F.col("value.session_window.start").alias("session_start"),
        F.col("value.session_window.end").alias("session_end"),
        F.col(f"value.{key}").alias(key),
        F.col("value.count").alias("n_events"),
        F.col("value.sum").alias("total"),
    )


def first_of_repeats(messages: DataFrame, keys: Sequence[str], time: str, within: str) -> DataFrame:
    """K10, for producers that send again: one row of those alike in ``keys``.

    On a stream a copy goes if it comes within ``within`` of the first one in event time; state is
    dropped beyond that, so it does not grow with the stream. In batch all copies but one go. NULLs
    are alike. A row without a time has nothing to be late by: on a stream it is held against those
    that are still in state, and kept.
    """
    if messages.isStreaming:
        return messages.withWatermark(time, within).dropDuplicatesWithinWatermark(list(keys))
    return messages.dropDuplicates(list(keys))
