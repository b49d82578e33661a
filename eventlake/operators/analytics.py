"""T1 windowed counts and T2 static enrichment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery


def windowed_counts(
    df: DataFrame,
    time: str,
    key: str,
    value: Column,
    *,
    window: str = "1 hour",
    lateness: str | None,
) -> DataFrame:
    """Count and sum per tumbling event-time window and key.

    ``time`` must be a zoned timestamp. ``lateness`` only matters on a stream: a window is final
    once the latest time seen is that far past its end. Rows that come for it afterwards are not
    counted; ``late_rows`` tells how many those were. With None no row is ever late, and state is
    kept for ever. In append mode only final windows are emitted, in update mode all of them as they
    grow (see ``update_to_path``). Map-side partial aggregation keeps a hot key to one row per task
    and window.
    """
    if df.isStreaming and lateness is not None:
        df = df.withWatermark(time, lateness)
    return (
        df.groupBy(F.window(time, window).alias("w"), F.col(key))
        .agg(F.count(F.lit(1)).alias("n_events"), F.sum(value).alias("total"))
        .select(
            F.col("w.start").alias("window_start"),
            F.col("w.end").alias("window_end"),
            key,
            "n_events",
            "total",
        )
    )


def late_rows(query: StreamingQuery) -> int:
    """Rows that a stream's windows have refused as too late, as far as its progress is kept."""
    return sum(
        state["numRowsDroppedByWatermark"]
        for progress in query.recentProgress
        for state in progress["stateOperators"]
    )


def enrich(df: DataFrame, reference: DataFrame, on: Column) -> DataFrame:
    """Left join to a reference table, batch or stream-static.

    There is no broadcast hint on purpose. Spark broadcasts the reference only while its size
    is below ``spark.sql.autoBroadcastJoinThreshold`` and otherwise joins by shuffle, where
    adaptive execution splits a hot key. On a stream that shuffles the reference in every
    micro-batch; one that is bucketed by the join key is read where it lies.
    """
    return df.join(reference, on, "left")
