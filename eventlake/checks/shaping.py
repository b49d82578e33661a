"""JSON messages made from the whole ``events`` table.

Every event becomes one message. What its payload looks like depends on ``k`` (0..99, from the
``props`` column), so that each decode rule meets its share of the rows. The payload texts are
plain SQL that Spark and the oracle engine read alike; what a decode must make of them is
computed by the oracle from the columns, not from the text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LONG_MAX = 9223372036854775807

ID = "CAST(event_id AS STRING)"
USER = "CAST(user_id AS STRING)"
MS = "CAST(ms AS STRING)"

# An upsert key that repeats: one key per user and hour, and a hot one with 40 % of all rows.
UPSERT_ID = f"CASE WHEN k >= 60 THEN 'hot' ELSE 'u' || {USER} END"


def _bad_metadata(good: str) -> str:
    return f"""CASE
        WHEN k BETWEEN 5 AND 9 THEN ''
        WHEN k BETWEEN 10 AND 14 THEN ',"metadata":"none"'
        ELSE ',"metadata":' || {good} END"""


def nested_ride(event_id: str = ID) -> str:
    metadata = f"""'{{"surge_multiplier":'
        || CASE WHEN k BETWEEN 35 AND 39 THEN 'null' ELSE CAST(value AS STRING) END
        || ',"estimated_wait_minutes":'
        || CASE WHEN k BETWEEN 25 AND 29 THEN '99999999999'
                WHEN k BETWEEN 35 AND 39 THEN '"' || CAST(k AS STRING) || '.9"'
                ELSE CAST(k AS STRING) END
        || ',"fare_amount":'
        || CASE WHEN k BETWEEN 35 AND 39 THEN '"abc"'
                ELSE CAST(event_id % 701 + 100 AS STRING) END
        || ',"driver_rating":4.' || CAST(abs(user_id) % 10 AS STRING) || '}}'"""
    body = f"""CASE WHEN k BETWEEN 15 AND 19 THEN '{{"EVENT_ID":"' ELSE '{{"event_id":"' END
        || {event_id} || '"'
        || CASE WHEN k BETWEEN 40 AND 44 THEN ',"user_id":null'
                ELSE ',"user_id":"user_' || {USER} || '"' END
        || ',"event_type":"' || event_type || '"'
        || CASE WHEN k BETWEEN 30 AND 34 THEN ',"timestamp":{LONG_MAX}'
                WHEN k BETWEEN 35 AND 39 THEN ',"timestamp":"' || {MS} || '"'
                ELSE ',"timestamp":' || {MS} END
        || CASE WHEN k BETWEEN 40 AND 44 THEN ',"ride_id":{{"id":1}}'
                ELSE ',"ride_id":"ride_' || {USER} || '"' END
        || {_bad_metadata(metadata)}"""
    return f"""CASE WHEN k < 5 THEN {body}
        WHEN k BETWEEN 20 AND 24 THEN '[' || {body} || '}}]'
        ELSE {body} || '}}' END"""


BID = f"""CASE WHEN k < 5 THEN 'junk ' WHEN k BETWEEN 5 AND 9 THEN '[' ELSE '' END
    || '{{"event_name":"' || event_type || '"'
    || CASE WHEN k BETWEEN 45 AND 49 THEN ',"event_name":"' || event_type || '_last"' ELSE '' END
    || ',"user_id":'
    || CASE WHEN k BETWEEN 10 AND 14 THEN '" ' || {USER} || ' "'
            WHEN k BETWEEN 15 AND 19 THEN 'true'
            ELSE {USER} END
    || ',"city_id":'
    || CASE WHEN k BETWEEN 10 AND 14 THEN CAST(k AS STRING) || '.9'
            WHEN k BETWEEN 15 AND 19 THEN '99999999999'
            WHEN k BETWEEN 20 AND 24 THEN '"7.9"'
            ELSE CAST(k AS STRING) END
    || CASE WHEN k BETWEEN 20 AND 24 THEN ',"platform":null'
            WHEN k BETWEEN 25 AND 29 THEN ''
            ELSE ',"platform":"web"' END
    || ',"session_id":'
    || CASE WHEN k BETWEEN 20 AND 24 THEN {USER} || '.0'
            WHEN k BETWEEN 25 AND 29 THEN '{{"s":' || {USER} || '}}'
            ELSE '"' || {ID} || '"' END
    || ',"flow_id":"f' || {ID} || '"'
    || ',"timestamp_ms":'
    || CASE WHEN k BETWEEN 30 AND 34 THEN '{LONG_MAX}'
            WHEN k BETWEEN 35 AND 39 THEN '-' || {MS}
            ELSE {MS} END
    || '}}'
    || CASE WHEN k BETWEEN 5 AND 9 THEN ']' WHEN k BETWEEN 40 AND 44 THEN ' tail' ELSE '' END"""

FLAT_RIDE = f"""'{{"event_id":"' || {ID} || '","user_id":"user_' || {USER}
    || '","event_type":"' || event_type || '"'
    || CASE WHEN k < 5 THEN ''
            WHEN k BETWEEN 5 AND 9 THEN ',"event_timestamp":-1'
            WHEN k BETWEEN 10 AND 14 THEN ',"event_timestamp":-' || {MS}
            WHEN k BETWEEN 15 AND 19 THEN ',"event_timestamp":" ' || {MS} || ' "'
            WHEN k BETWEEN 20 AND 24 THEN ',"event_timestamp":' || {MS} || '.75'
            ELSE ',"event_timestamp":' || {MS} END
    || ',"ride_id":"ride_' || {USER} || '","surge_multiplier":' || CAST(value AS STRING)
    || ',"estimated_wait_minutes":' || CAST(k AS STRING)
    || ',"fare_amount":' || CAST(event_id % 701 + 100 AS STRING) || '}}'"""

# A user id that a sign can be put before.
PLAIN = "CAST(abs(user_id) AS STRING)"

# The same JSON token in a text, an int, a long and a double field.
TOKEN = f"""CASE
    WHEN k < 5 THEN '"' || {PLAIN} || '"'
    WHEN k < 10 THEN {PLAIN}
    WHEN k < 15 THEN {PLAIN} || '.9'
    WHEN k < 20 THEN '-' || {PLAIN} || '.9'
    WHEN k < 25 THEN 'true'
    WHEN k < 30 THEN 'null'
    WHEN k < 35 THEN '"x' || {PLAIN} || '"'
    WHEN k < 40 THEN '{{"q":' || {PLAIN} || '}}'
    WHEN k < 45 THEN '[' || {PLAIN} || ']'
    WHEN k < 50 THEN '"' || {PLAIN} || '.9"'
    WHEN k < 55 THEN {PLAIN} || '.0'
    WHEN k < 60 THEN '99999999999'
    WHEN k < 65 THEN 'false'
    ELSE {ID} END"""
COERCION = (
    f"""'{{"a":' || {TOKEN} || ',"n":' || {TOKEN} || ',"l":' || {TOKEN} || ',"d":' || {TOKEN} || '}}'"""
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole table, with ``ms`` (epoch) and ``k`` next to its columns."""
    return table(spark, sf_dir, "events").select(
        "event_id",
        "user_id",
        "event_type",
        "value",
        "ts",
        F.regexp_extract("props", r"(\d+)", 1).cast("int").alias("k"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("ms"),
    )


def messages(rows: DataFrame, payload: str, *keep: str) -> DataFrame:
    """Rows as they would come from a topic: four partitions, the event id as offset."""
    return rows.select(
        *keep,
        F.expr(payload).alias("value"),
        F.col("event_type").alias("topic"),
        F.expr("CAST(event_id % 4 AS INT)").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
    )


def heartbeats(rides: DataFrame, topics: list[str | None]) -> DataFrame:
    """A message of each topic, ten days after all others, of a ride that no other one has."""
    last = rides.agg(F.max("timestamp").alias("at"), F.max("offset").alias("offset"))
    topic = F.explode(F.array(*[F.lit(t).cast("string") for t in topics])).alias("topic")
    late = last.where("at IS NOT NULL").select(F.expr("at + INTERVAL 10 DAYS").alias("timestamp"), "offset", topic)
    payload = F.to_json(
        F.struct(
            F.lit("end").alias("event_id"),
            F.lit("end").alias("user_id"),
            F.lit("end").alias("event_type"),
            F.unix_millis("timestamp").alias("timestamp"),
            F.concat(F.lit("end_"), F.col("topic")).alias("ride_id"),
            F.struct(
                F.lit(1.0).alias("surge_multiplier"),
                F.lit(2).alias("estimated_wait_minutes"),
                F.lit(100).alias("fare_amount"),
                F.lit(4.0).alias("driver_rating"),
            ).alias("metadata"),
        )
    )
    return late.select(payload.alias("value"), "topic", F.lit(0).alias("partition"), "offset", "timestamp")
