"""The row side of the three pipelines; the same plan in batch and on a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from eventlake import schemas as S
from eventlake.functions.times import (
    day_bucket,
    event_time,
    hour_bucket,
    ingestion_time,
    wall_clock,
)
from eventlake.operators.decode import decode_lenient, decode_strict


def nested_ride_rows(
    messages: DataFrame, metrics: str | Observation | None = None
) -> DataFrame:
    """Strict decode plus ``event_hour``; ``reject_reason`` is NULL on good rows."""
    decoded = decode_strict(
        messages, S.NESTED_RIDE, epoch_ms="event_timestamp", metrics=metrics
    )
    return decoded.withColumn("event_hour", hour_bucket(F.col("event_timestamp")))


def bid_rows(messages: DataFrame, metrics: str | Observation | None = None) -> DataFrame:
    """Lenient decode, event time and ingestion time in milliseconds."""
    bids = decode_lenient(messages, S.BID, metrics=metrics)
    return bids.select(
        "event_name",
        "user_id",
        "city_id",
        "platform",
        "session_id",
        wall_clock(event_time(F.col("timestamp_ms"))).alias("event_time"),
        ingestion_time().alias("ingestion_time"),
    )


def flat_ride_rows(
    messages: DataFrame, metrics: str | Observation | None = None
) -> DataFrame:
    """Lenient decode plus ``event_date``."""
    rides = decode_lenient(messages, S.FLAT_RIDE, metrics=metrics)
    return rides.withColumn("event_date", day_bucket(F.col("event_timestamp")))
