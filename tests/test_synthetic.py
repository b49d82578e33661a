import json
import re

import pytest
from pyspark.sql import functions as F

from eventlake import schemas as S
from eventlake.operators import (
    accepted,
    decode_lenient,
    enrich,
    late_rows,
    synthetic_events,
    to_messages,
    windowed_counts,
)
from eventlake.operators.synthetic import EVENT_TYPES, ID_PREFIX, PLATFORMS
from eventlake.plans import nested_ride_rows
from eventlake.streaming.append import read_updated, update_to_path

START = 1704067200000


@pytest.mark.parametrize("kind", ID_PREFIX)
def test_ride_ranges(spark, kind):
    rows = synthetic_events(spark, 5000, kind, start_ms=START, seed=3).collect()
    person, many = ("driver", 50) if kind == "driver_events" else ("user", 100)
    assert {r["user_id"] for r in rows} == {f"{person}_{i}" for i in range(1, many + 1)}
    assert {r["event_type"] for r in rows} == set(EVENT_TYPES[kind])
    assert [r["timestamp"] for r in rows] == [START + 1000 * i for i in range(5000)]
    pattern = re.compile(rf"{ID_PREFIX[kind]}_\d{{13}}_[1-9]\d{{3}}")
    assert all(pattern.fullmatch(r["event_id"]) for r in rows)
    assert all(re.fullmatch(r"ride_[1-9]\d{4}", r["ride_id"]) for r in rows)
    meta = [r["metadata"] for r in rows]
    assert {m["surge_multiplier"] for m in meta} == {i / 10 for i in range(10, 31)}
    assert {m["estimated_wait_minutes"] for m in meta} == set(range(2, 16))
    assert {m["driver_rating"] for m in meta} == {i / 10 for i in range(35, 51)}
    fares = {m["fare_amount"] for m in meta}
    assert min(fares) == 100 and max(fares) == 800 and len(fares) > 600


def test_bid_ranges(spark):
    rows = synthetic_events(spark, 5000, "bid_events", start_ms=START).collect()
    assert {r["event_name"] for r in rows} == set(EVENT_TYPES["bid_events"])
    assert {r["city_id"] for r in rows} == set(range(1, 11))
    assert {r["platform"] for r in rows} == set(PLATFORMS)
    assert all(10_000 <= r["user_id"] <= 99_999 for r in rows)
    for name in ("session_id", "flow_id"):
        assert all(re.fullmatch(r"17040\d{5}[1-9]\d{4}", r[name]) for r in rows)


def test_same_seed_same_rows_in_any_partitioning(spark):
    one = synthetic_events(spark, 500, "user_events", start_ms=START, seed=1)
    spread = spark.range(0, 500, 1, 7).selectExpr("id", f"{START} + id * 1000 AS ms")
    from eventlake.operators import synthesize

    again = synthesize(spread, "id", "ms", "user_events", 1)
    other = synthetic_events(spark, 500, "user_events", start_ms=START, seed=2)
    assert sorted(one.collect()) == sorted(again.collect()) != sorted(other.collect())
    with pytest.raises(ValueError, match="unknown kind"):
        synthetic_events(spark, 1, "nope", start_ms=START)


def test_messages_survive_the_decoders(spark):
    made = synthetic_events(spark, 200, "payment_events", start_ms=START)
    sent = to_messages(made, F.lit("payment_events"), made.columns)
    assert sent.columns == ["topic", "value"]
    first = json.loads(sent.first()["value"])
    assert list(first) == made.columns and isinstance(first["metadata"]["fare_amount"], int)
    assert accepted(nested_ride_rows(sent)).count() == 200
    bids = synthetic_events(spark, 200, "bid_events", start_ms=START)
    back = decode_lenient(to_messages(bids, F.lit("bid-events"), bids.columns), S.BID)
    assert sorted(back.collect()) == sorted(bids.drop("flow_id").collect())


def test_null_is_written_as_null(spark):
    df = spark.sql("SELECT 1 a, CAST(NULL AS STRING) b")
    assert to_messages(df, F.lit("t"), ["a", "b"]).first()["value"] == '{"a":1,"b":null}'


def test_late_rows_are_dropped_and_open_windows_held_back(spark, tmp_path):
    schema = "at timestamp, k string, v double"
    path = str(tmp_path / "in")

    def add(*rows):
        df = spark.createDataFrame([(r,) for r in rows], "t string")
        df.selectExpr("cast(t as timestamp) at", "'a' k", "1.5d v").coalesce(1).write.mode(
            "append"
        ).parquet(path)

    def run():
        stream = spark.readStream.schema(schema).parquet(path)
        counts = windowed_counts(stream, "at", "k", F.col("v"), lateness="10 minutes")
        writer = counts.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "c"))
        query = writer.trigger(availableNow=True).start(str(tmp_path / "out"))
        query.awaitTermination()
        late.append(late_rows(query))
        out = spark.read.parquet(str(tmp_path / "out")).collect()
        return sorted((str(r["window_start"])[11:16], r["n_events"], r["total"]) for r in out)

    late = []

    add("2024-01-01 00:10:00", "2024-01-01 00:50:00", "2024-01-01 01:05:00")
    assert run() == []  # 00:55 is as far as the watermark got
    add("2024-01-01 00:20:00", "2024-01-01 01:20:00")  # the first window is still open
    assert run() == [("00:00", 3, 4.5)]
    add("2024-01-01 00:30:00", "2024-01-01 02:30:00")
    assert run() == [("00:00", 3, 4.5), ("01:00", 2, 3.0)]
    assert late == [0, 0, 1]


def test_open_windows_come_in_update_mode(spark, tmp_path):
    path, keys = str(tmp_path / "in"), ["window_start", "k"]
    for n in (1, 2):
        rows = spark.createDataFrame([("2024-01-01 00:10:00",)] * n, "t string")
        rows = rows.selectExpr("cast(t as timestamp) at", "'a' k", "1.5d v")
        rows.coalesce(1).write.mode("append").parquet(path)
        stream = spark.readStream.schema(rows.schema).parquet(path)
        counts = windowed_counts(stream, "at", "k", F.col("v"), lateness=None)
        update_to_path(
            counts, counts.schema, str(tmp_path / "out"), str(tmp_path / "c"), every=None
        ).awaitTermination()
        out = read_updated(spark, counts.schema, str(tmp_path / "out"), keys).collect()
        assert [(r["k"], r["n_events"]) for r in out] == [("a", 1 if n == 1 else 3)]


def test_enrich_leaves_the_join_to_the_size(spark):
    left = spark.range(1000).selectExpr("id % 3 k", "id v")
    right = spark.range(2).selectExpr("id k2", "'n' || id name")
    out = enrich(left, right, left["k"] == right["k2"])
    assert out.count() == 1000 and out.where("name is null").count() == 333
    plan = out._jdf.queryExecution()
    assert "BroadcastHashJoin" in plan.executedPlan().toString()
    assert "hint" not in plan.analyzed().toString().lower()
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        again = enrich(left, right, left["k"] == right["k2"])
        assert "SortMergeJoin" in again._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
