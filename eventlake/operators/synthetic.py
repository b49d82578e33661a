"""G1: synthetic events of the four kinds, generated on the executors.

One MD5 of (seed, kind, id) per row gives 32 hex digits; each field takes its own slice of
them. So the same arguments give the same rows on any cluster and in any partitioning, and
another engine can recompute them. Event times come from a column, not from the wall clock.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Event types and id prefixes per topic.
EVENT_TYPES = {
    "user_events": (
        "surge_viewed",
        "ride_requested",
        "driver_assigned",
        "driver_profile_viewed",
        "fare_viewed",
        "ride_cancelled",
    ),
    "payment_events": (
        "payment_initiated",
        "payment_completed",
        "payment_failed",
        "refund_requested",
        "refund_processed",
        "wallet_updated",
    ),
    "driver_events": (
        "driver_online",
        "driver_offline",
        "ride_accepted",
        "ride_started",
        "ride_completed",
        "location_updated",
    ),
    "bid_events": ("bid_booking_timeout", "ride_requested", "driver_assigned"),
}
ID_PREFIX = {"user_events": "evt", "payment_events": "pay", "driver_events": "drv"}
PLATFORMS = ("ios", "android", "web")
RIDERS = 100
DRIVERS = 50


def _draw(start: int, digits: int, low: int, high: int) -> Column:
    """An integer in low..high from a slice of the row's hash."""
    number = F.conv(F.substring("__hash", start, digits), 16, 10).cast("bigint")
    return F.lit(low) + number % F.lit(high - low + 1)


def _choice(start: int, digits: int, values: Sequence[str]) -> Column:
    index = _draw(start, digits, 1, len(values)).cast("int")
    return F.element_at(F.array(*[F.lit(v) for v in values]), index)


def synthesize(df: DataFrame, id_: str, time_ms: str, kind: str, seed: int = 0) -> DataFrame:
    """One event per row of ``df``, from an id column and an epoch-ms column."""
    if kind not in EVENT_TYPES:
        raise ValueError(f"unknown kind {kind!r}; one of {sorted(EVENT_TYPES)}")
    ms = F.col(time_ms)
    base = df.select(
        F.col(time_ms),
        F.md5(F.concat(F.lit(f"{seed}:{kind}:"), F.col(id_).cast("string"))).alias("__hash"),
    )
    event_type = _choice(5, 4, EVENT_TYPES[kind])
    if kind == "bid_events":
        seconds = F.call_function("div", ms, F.lit(1000)).cast("string")
        return base.select(
            event_type.alias("event_name"),
            _draw(9, 6, 10_000, 99_999).alias("user_id"),
            _draw(1, 4, 1, 10).cast("int").alias("city_id"),
            _choice(15, 4, PLATFORMS).alias("platform"),
            F.concat(seconds, _draw(19, 6, 10_000, 99_999).cast("string")).alias("session_id"),
            F.concat(seconds, _draw(25, 6, 10_000, 99_999).cast("string")).alias("flow_id"),
            ms.alias("timestamp_ms"),
        )
    person = ("driver_", DRIVERS) if kind == "driver_events" else ("user_", RIDERS)
    suffix = _draw(29, 4, 1000, 9999).cast("string")
    return base.select(
        F.concat(F.lit(ID_PREFIX[kind] + "_"), ms.cast("string"), F.lit("_"), suffix).alias(
            "event_id"
        ),
        F.concat(F.lit(person[0]), _draw(1, 4, 1, person[1]).cast("string")).alias("user_id"),
        event_type.alias("event_type"),
        ms.alias("timestamp"),
        F.concat(F.lit("ride_"), _draw(9, 6, 10_000, 99_999).cast("string")).alias("ride_id"),
        F.struct(
            (_draw(15, 4, 10, 30) / F.lit(10.0)).alias("surge_multiplier"),
            _draw(19, 4, 2, 15).cast("int").alias("estimated_wait_minutes"),
            _draw(23, 3, 100, 800).cast("int").alias("fare_amount"),
            (_draw(26, 3, 35, 50) / F.lit(10.0)).alias("driver_rating"),
        ).alias("metadata"),
    )


def synthetic_events(
    spark: SparkSession,
    n: int,
    kind: str,
    *,
    start_ms: int,
    step_ms: int = 1000,
    seed: int = 0,
) -> DataFrame:
    """``n`` events of one kind, ``step_ms`` apart from ``start_ms`` on."""
    ids = spark.range(n).withColumn("ms", F.lit(start_ms) + F.col("id") * F.lit(step_ms))
    return synthesize(ids, "id", "ms", kind, seed)
