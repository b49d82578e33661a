"""J1 to J3 as running queries over a stream of messages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming.query import StreamingQuery

from eventlake import schemas as S
from eventlake.plans import bid_rows, flat_ride_rows
from eventlake.streaming import tables as K
from eventlake.streaming.append import append_to_path, append_to_table
from eventlake.streaming.runs import COMMIT_INTERVAL
from eventlake.streaming.upsert import ARRIVAL, UpsertFolder


def upsert_rides(
    messages: DataFrame,
    path: str,
    checkpoint: str,
    *,
    order: tuple[str, ...] = ARRIVAL,
    every: str | None = COMMIT_INTERVAL,
) -> StreamingQuery:
    """Nested ride events, upserted by (event_id, event_hour)."""
    table = UpsertFolder(messages.sparkSession, path, order)
    return table.start(messages, checkpoint, every=every)


def append_bids(
    messages: DataFrame,
    path: str,
    checkpoint: str,
    *,
    every: str | None = COMMIT_INTERVAL,
    stateful: bool = False,
) -> StreamingQuery:
    """Flat bid events, appended. ``stateful``: repeats were taken out of ``messages``."""
    return append_to_path(bid_rows(messages), S.BID_TABLE, path, checkpoint, every=every, stateful=stateful)


def append_rides_by_day(
    messages: DataFrame, path: str, checkpoint: str, *, every: str | None = COMMIT_INTERVAL
) -> StreamingQuery:
    """Flat ride events, appended by day."""
    return append_to_path(
        flat_ride_rows(messages),
        S.RIDE_DAY_TABLE,
        path,
        checkpoint,
        partition_by=["event_date"],
        every=every,
    )


def _append_to_catalog(
    rows: DataFrame,
    spec: K.TableSpec,
    table: str,
    checkpoint: str,
    provider: str,
    location: str | None,
    every: str | None,
) -> StreamingQuery:
    spark = rows.sparkSession
    namespace, _, _ = table.rpartition(".")
    if namespace:
        K.create_namespace(spark, namespace)
    K.create_table(spark, table, spec, provider, location)
    return append_to_table(
        rows, spec.schema, table, checkpoint, partition_by=spec.partition_by, every=every
    )


def append_bids_to_table(
    messages: DataFrame,
    table: str,
    checkpoint: str,
    *,
    provider: str = "iceberg",
    location: str | None = None,
    every: str | None = COMMIT_INTERVAL,
) -> StreamingQuery:
    """J2 into a catalog table, which is created, with its namespace, if it is absent."""
    rows = bid_rows(messages)
    return _append_to_catalog(rows, K.BIDS, table, checkpoint, provider, location, every)


def append_rides_by_day_to_table(
    messages: DataFrame,
    table: str,
    checkpoint: str,
    *,
    provider: str = "iceberg",
    location: str | None = None,
    every: str | None = COMMIT_INTERVAL,
) -> StreamingQuery:
    """J3 into a catalog table by day, which is created, with its namespace, if it is absent."""
    rows = flat_ride_rows(messages)
    return _append_to_catalog(rows, K.RIDE_DAYS, table, checkpoint, provider, location, every)
