"""The upsert folder whose compacted rows are dealt by key."""

import pathlib
import re

import pytest
from pyspark.sql import functions as F
from test_streaming import HOUR0, HOUR1, Rides, ride_json

from eventlake.session import settings
from eventlake.sources import landed_messages
from eventlake.streaming.colocated import BucketedUpsertFolder
from eventlake.streaming.upsert import UpsertFolder


@pytest.fixture
def rides(spark, tmp_path):
    out = Rides(spark, tmp_path)
    out.plain = out.table
    out.table = BucketedUpsertFolder(spark, out.plain.path, table="default.dealt_rides", buckets=4)
    yield out
    spark.sql("DROP TABLE IF EXISTS default.dealt_rides")


def plain_state(rides):
    """The same folder read as if it had never been compacted."""
    rows = UpsertFolder(rides.spark, rides.plain.path)._merged(-1)[0].collect()
    return sorted((r["event_id"], r["event_hour"][-2:], r["fare_amount"]) for r in rows)


def shuffled_scans(df):
    """Which scans of the bucketed table lie below a shuffle, in the plan as it ran."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    plan = plan.split("\n+- == Initial Plan ==")[0]
    stack, hits, scans = [], [], 0
    for line in plan.splitlines():
        depth = len(re.match(r"[\s:+\-|]*", line).group())
        while stack and stack[-1][0] >= depth:
            stack.pop()
        if "dealt_rides" in line and "FileScan" in line:
            scans += 1
            above = [name for _, name in stack]
            shuffles = [name for name in above if name.startswith(("Exchange", "ShuffleQueryStage"))]
            if shuffles:
                hits.append(shuffles)
        stack.append((depth, line[depth:].strip()))
    return scans, hits


def test_state_after_compactions_is_the_state_without(rides):
    rides.landing.add(*[ride_json(f"e{i % 50}", HOUR0 + (i % 3) * 3_600_000, i) for i in range(300)])
    rides.run()
    assert rides.state() == plain_state(rides)
    for _ in range(3):
        rides.table.compact()
        rides.table.compact()  # nothing new
        assert rides.state() == plain_state(rides)
        n = 1000 + rides.landing.offset
        rides.landing.add(*[ride_json(f"e{i}", HOUR1, n + i) for i in range(45, 60)])
        rides.run()
        assert rides.state() == plain_state(rides)


def test_only_changes_are_shuffled_and_the_table_is_read_by_hour(rides):
    rides.landing.add(*[ride_json(f"e{i}", HOUR0 + (i % 4) * 3_600_000, i) for i in range(200)])
    rides.run()
    rides.table.compact()
    rides.landing.add(ride_json("e1", HOUR1, 999), ride_json("new", HOUR1, 5))
    rides.run()
    scans, hits = shuffled_scans(rides.table.current())
    assert scans == 2 and not hits
    one = rides.table.current().where(F.col("event_hour") == "2024-01-01-01")
    assert one.count() == 51
    with settings(rides.spark, {"spark.sql.maxMetadataStringLength": "2000"}):
        plan = one._jdf.queryExecution().executedPlan().toString()
    table = [line for line in plan.split("\n+- == Initial Plan ==")[0].splitlines() if "dealt_rides" in line]
    assert table and all(re.search(r"PartitionFilters: \[.*event_hour#\d+ = 2024-01-01-01", line) for line in table)


def test_a_lost_compaction_and_a_lost_catalog_entry_are_made_good(rides):
    rides.landing.add(ride_json("e1", HOUR0, 1), ride_json("e2", HOUR1, 2))
    rides.run()
    # Written, but without the marker that makes it count.
    own = rides.table.create()
    own._rewrite(own._merged(-1, 0)[0].withColumn("fare_amount", F.lit(7.0)), 0)
    assert rides.state() == [("e1", "00", 1.0), ("e2", "01", 2.0)]
    rides.table.compact()
    assert rides.state() == [("e1", "00", 1.0), ("e2", "01", 2.0)]
    rides.spark.sql("DROP TABLE default.dealt_rides")
    assert rides.state() == [("e1", "00", 1.0), ("e2", "01", 2.0)]
    files = {p.name.rpartition("_")[2][:5] for p in (pathlib.Path(rides.table.path) / "buckets").rglob("*.parquet")}
    assert files <= {f"{i:05d}" for i in range(4)}


def test_another_number_of_buckets_or_folder_is_refused(rides, tmp_path):
    rides.table.create()
    other = BucketedUpsertFolder(rides.spark, rides.table.path, table="default.dealt_rides", buckets=8)
    with pytest.raises(ValueError, match="4 buckets"):
        other.current()
    elsewhere = BucketedUpsertFolder(rides.spark, str(tmp_path / "else"), table="default.dealt_rides", buckets=4)
    with pytest.raises(ValueError, match="buckets in"):
        elsewhere.create()


def test_an_empty_folder_and_a_routed_one(rides, spark, tmp_path):
    assert rides.table.current().count() == 0
    rides.table.compact()
    assert rides.table.current().count() == 0
    routed = BucketedUpsertFolder(spark, str(tmp_path / "r"), routed=True, table="default.dealt_routed", buckets=3)
    rides.landing.add(ride_json("e1", HOUR0, 1), ride_json("e2", HOUR0, 2))
    routed.start(landed_messages(spark, rides.landing.path), str(tmp_path / "rc"), every=None).awaitTermination()
    routed.compact()
    rides.landing.add(ride_json("e1", HOUR0, 3))
    routed.start(landed_messages(spark, rides.landing.path), str(tmp_path / "rc"), every=None).awaitTermination()
    rows = routed.current().collect()
    spark.sql("DROP TABLE default.dealt_routed")
    assert sorted((r["table_name"] is not None, r["event_id"], r["fare_amount"]) for r in rows) == [(True, "e1", 3.0), (True, "e2", 2.0)]
