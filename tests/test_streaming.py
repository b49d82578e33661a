"""The pipelines as real streams over landed files."""

import datetime as dt
import pathlib

import pytest
from pyspark.sql import functions as F

from eventlake import schemas as S
from eventlake.operators import latest_per_key
from eventlake.sources import landed_messages, text_messages
from eventlake.streaming import pipelines, runs
from eventlake.streaming.append import read_appended
from eventlake.streaming.upsert import UpsertFolder

HOUR0 = 1704067200000
HOUR1 = HOUR0 + 3_600_000


def ride_json(event_id, ms, fare):
    return (
        f'{{"event_id":"{event_id}","user_id":"user_1","event_type":"fare_viewed","timestamp":{ms},'
        f'"ride_id":"ride_1","metadata":{{"surge_multiplier":1.0,"estimated_wait_minutes":2,'
        f'"fare_amount":{fare},"driver_rating":4.0}}}}'
    )


class Landing:
    """Messages written as files, one file per call; offsets go up."""

    def __init__(self, spark, path):
        self.spark, self.path, self.offset = spark, str(path), 0
        spark.createDataFrame([], S.MESSAGE).write.parquet(self.path)

    def add(self, *payloads):
        rows = []
        for payload in payloads:
            at = dt.datetime(2024, 1, 1) + dt.timedelta(seconds=self.offset)
            rows.append((payload, "rides", 0, self.offset, at))
            self.offset += 1
        self.spark.createDataFrame(rows, S.MESSAGE).coalesce(1).write.mode("append").parquet(
            self.path
        )


class Rides:
    def __init__(self, spark, tmp_path):
        self.spark, self.root = spark, tmp_path
        self.landing = Landing(spark, tmp_path / "landing")
        self.table = UpsertFolder(spark, str(tmp_path / "table"))

    def run(self, max_files=None):
        stream = landed_messages(self.spark, self.landing.path, max_files=max_files)
        pipelines.upsert_rides(
            stream, self.table.path, str(self.root / "checkpoint"), every=None
        ).awaitTermination()

    def state(self):
        rows = self.table.current().collect()
        return sorted((r["event_id"], r["event_hour"][-2:], r["fare_amount"]) for r in rows)


@pytest.fixture
def rides(spark, tmp_path):
    return Rides(spark, tmp_path)


def test_last_write_wins_in_a_batch_across_batches_and_by_hour(rides):
    rides.landing.add(ride_json("e1", HOUR0, 1), ride_json("e1", HOUR0, 2), ride_json("e2", HOUR0, 9))
    rides.run()
    assert rides.state() == [("e1", "00", 2.0), ("e2", "00", 9.0)]
    rides.landing.add(ride_json("e1", HOUR0, 3))
    rides.landing.add(ride_json("e1", HOUR1, 4))
    rides.run(max_files=1)
    assert rides.state() == [("e1", "00", 3.0), ("e1", "01", 4.0), ("e2", "00", 9.0)]
    assert rides.table.current().schema.names == S.RIDE_TABLE.names


def test_rejects_are_kept_with_their_reason(rides):
    rides.landing.add("junk", ride_json("e1", HOUR0, 1), '{"event_id":"e2"}')
    rides.run()
    assert sorted(tuple(r) for r in rides.table.rejects().collect()) == [
        ("rides", "junk", "unparseable"),
        ("rides", '{"event_id":"e2"}', "missing:user_id"),
    ]
    assert rides.state() == [("e1", "00", 1.0)]


def test_replay_of_a_batch_changes_nothing(rides):
    rides.landing.add(ride_json("e1", HOUR0, 1), "junk")
    rides.landing.add(ride_json("e1", HOUR0, 2))
    rides.run(max_files=1)
    before, bad = rides.state(), rides.table.rejects().count()
    folder = pathlib.Path(rides.table.path) / "changes" / "batch_id=1"
    files = {p.name: p.stat().st_mtime_ns for p in folder.rglob("*.parquet")}
    reader = rides.table.current()
    # As after a crash between the write and the commit: the last batch runs once more.
    commits = rides.root / "checkpoint" / "commits"
    last = max(int(p.name) for p in commits.iterdir() if p.name.isdigit())
    (commits / str(last)).unlink()
    (commits / f".{last}.crc").unlink(missing_ok=True)
    rides.run(max_files=1)
    assert rides.state() == before and rides.table.rejects().count() == bad
    # The finished batch was left alone, so a reader that had begun before goes on.
    assert {p.name: p.stat().st_mtime_ns for p in folder.rglob("*.parquet")} == files
    assert reader.count() == 1


def test_another_stream_is_refused_before_and_after_a_compaction(rides):
    rides.landing.add(ride_json("e1", HOUR0, 1), ride_json("e2", HOUR0, 2))
    rides.run()
    state = rides.state()
    for compact in (False, True):
        if compact:
            rides.table.compact()
        stream = landed_messages(rides.spark, rides.landing.path)
        lost = pipelines.upsert_rides(
            stream, rides.table.path, str(rides.root / f"new-{compact}"), every=None
        )
        with pytest.raises(Exception, match="is written by stream"):
            lost.awaitTermination()
        assert rides.state() == state
    rides.landing.add(ride_json("e3", HOUR0, 3))
    rides.run()
    assert rides.state() == [*state, ("e3", "00", 3.0)]


def test_a_batch_with_many_hours_is_few_files(rides):
    rides.landing.add(*[ride_json(f"e{i}", HOUR0 + i * 3_600_000, i) for i in range(200)])
    rides.run()
    folder = pathlib.Path(rides.table.path) / "changes" / "batch_id=0"
    assert len(list(folder.rglob("*.parquet"))) <= 2
    one = rides.table.current().where("event_hour = '2024-01-02-00'")
    assert [r["event_id"] for r in one.collect()] == ["e24"]
    plan = one._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line and "fare_amount" in line]
    assert scans and all("EqualTo(event_hour,2024-01-02-00)" in line for line in scans)


def test_upsert_of_text_by_an_order_of_the_payload(spark, tmp_path):
    src = tmp_path / "in"
    write_lines(src, "1.txt", ride_json("e1", HOUR0 + 5, 1), ride_json("e1", HOUR0 + 9, 2), ride_json("e1", HOUR0, 3))
    pipelines.upsert_rides(
        text_messages(spark, str(src), "rides"),
        str(tmp_path / "table"),
        str(tmp_path / "cp"),
        order=("event_timestamp",),
        every=None,
    ).awaitTermination()
    rows = UpsertFolder(spark, str(tmp_path / "table"), ("event_timestamp",)).current().collect()
    assert [(r["event_id"], r["fare_amount"]) for r in rows] == [("e1", 2.0)]


def test_unfinished_batch_is_not_visible(rides):
    rides.landing.add(ride_json("e1", HOUR0, 1))
    rides.run()
    source = f"{rides.table.path}/changes/batch_id=0"
    rides.spark.read.parquet(source).withColumn("fare_amount", F.lit(99.0)).write.partitionBy(
        "route"
    ).parquet(f"{rides.table.path}/changes/batch_id=1")
    assert rides.state() == [("e1", "00", 1.0)]


def test_restart_picks_up_new_files_only(rides):
    rides.landing.add(ride_json("e1", HOUR0, 1))
    rides.run()
    rides.run()
    rides.landing.add(ride_json("e2", HOUR0, 2))
    rides.run()
    assert rides.state() == [("e1", "00", 1.0), ("e2", "00", 2.0)]
    done = rides.table._done().select("batch_id").distinct().count()
    assert done == 2


def test_compaction_keeps_the_state_and_later_changes_win(rides):
    rides.landing.add(ride_json("e1", HOUR0, 1), ride_json("e1", HOUR0, 2), ride_json("f", HOUR1, 5))
    rides.run()
    rides.table.compact()
    assert rides.state() == [("e1", "00", 2.0), ("f", "01", 5.0)]
    rides.landing.add(ride_json("e1", HOUR0, 3), ride_json("e3", HOUR0, 7))
    rides.run()
    want = [("e1", "00", 3.0), ("e3", "00", 7.0), ("f", "01", 5.0)]
    assert rides.state() == want
    rides.table.compact()
    assert rides.state() == want
    rides.table.compact()
    assert rides.state() == want
    gone = UpsertFolder(rides.spark, rides.table.path)._base(1).groupBy("event_hour").count()
    assert {r[0][-2:]: r[1] for r in gone.collect()} == {"00": 2, "01": 1}


def test_state_equals_a_batch_oracle_with_a_hot_key(spark, rides):
    import random

    random.seed(7)
    want = {}
    for _ in range(3):
        payloads = []
        for _ in range(300):
            key = "hot" if random.random() < 0.4 else f"e{random.randrange(40)}"
            ms, fare = random.choice([HOUR0, HOUR1]), random.randrange(100, 800)
            payloads.append(ride_json(key, ms, fare))
            want[(key, "00" if ms == HOUR0 else "01")] = float(fare)
        rides.landing.add(*payloads)
        rides.run()
    assert rides.state() == sorted((k, h, v) for (k, h), v in want.items())


def test_hour_filter_prunes_every_scan(rides):
    rides.landing.add(ride_json("e1", HOUR0, 1), ride_json("f", HOUR1, 5))
    rides.run()
    rides.table.compact()
    rides.landing.add(ride_json("e1", HOUR0, 3))
    rides.run()
    view = rides.table.current().where("event_hour = '2024-01-01-00'")
    assert [r["fare_amount"] for r in view.collect()] == [3.0]
    plan = view._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line and "event_id" in line]
    base = [s for s in scans if "upto" in s]
    assert base and all("event_hour" in s.split("PartitionFilters: [")[1].split("]")[0] for s in base)
    assert all("event_hour" in s.split("PushedFilters: [")[1].split("]")[0] for s in scans if s not in base)


def test_window_limit_runs_before_the_shuffle(spark):
    df = spark.range(10).selectExpr("id % 2 k", "id o", "id v")
    plan = latest_per_key(df, ["k"], ["o"])._jdf.queryExecution().executedPlan().toString()
    assert plan.index("WindowGroupLimit") < plan.index("Exchange") < plan.rindex("WindowGroupLimit")


def write_lines(path, name, *lines):
    path.mkdir(exist_ok=True)
    (path / name).write_text("\n".join(lines) + "\n")


def test_bids_append(spark, tmp_path):
    src = tmp_path / "in"
    line = (
        '{"event_name":"ride_requested","user_id":10001,"city_id":"3","platform":"ios",'
        '"session_id":"s","flow_id":"f","timestamp_ms":1704067200123}'
    )
    write_lines(src, "1.txt", line, line, "junk", "[1]")
    write_lines(src, "2.txt", '{"event_name":"x","city_id":true,"timestamp_ms":9223372036854775807}')
    for _ in range(2):  # the second run is a restart with nothing new
        pipelines.append_bids(
            text_messages(spark, str(src), "bid-events", max_files=1),
            str(tmp_path / "out"),
            str(tmp_path / "cp"),
            every=None,
        ).awaitTermination()
    out = read_appended(spark, S.BID_TABLE, str(tmp_path / "out"))
    rows = sorted((tuple(r)[:-1] for r in out.collect()), key=str)
    one = ("ride_requested", 10001, 3, "ios", "s", dt.datetime(2024, 1, 1, 0, 0, 0, 123000))
    assert rows == sorted([one, one, ("x", None, None, None, None, None)], key=str)
    assert out.where("ingestion_time is null").count() == 0
    assert any(".snappy.parquet" in p.name for p in (tmp_path / "out").iterdir())


def test_flat_rides_by_day(spark, tmp_path):
    src = tmp_path / "in"
    write_lines(src, "1.txt", '{"event_id":"a","event_timestamp":1704067200123,"fare_amount":5}')
    write_lines(src, "2.txt", '{"event_id":"b","event_timestamp":-1}', '{"event_id":"c"}')
    pipelines.append_rides_by_day(
        text_messages(spark, str(src), "rides", max_files=1),
        str(tmp_path / "out"),
        str(tmp_path / "cp"),
        every=None,
    ).awaitTermination()
    out = read_appended(spark, S.RIDE_DAY_TABLE, str(tmp_path / "out"))
    rows = sorted((r["event_id"], r["event_date"]) for r in out.collect())
    assert rows == [("a", "2024-01-01"), ("b", "1970-01-01"), ("c", None)]
    pruned = out.where("event_date = '2024-01-01'")
    assert pruned.count() == 1
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "event_date" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_topics_fan_out_to_their_own_tables(spark, tmp_path):
    def start(topic, table):
        landing = Landing(spark, tmp_path / f"in-{table}")
        landing.add(ride_json(topic, HOUR0, 1))
        return pipelines.upsert_rides(
            landed_messages(spark, landing.path),
            str(tmp_path / table),
            str(tmp_path / f"cp-{table}"),
            every=None,
        )

    queries = runs.fan_out("User.Events, payment-events", start)
    runs.wait_for_all(queries)
    assert list(queries) == ["User.Events", "payment-events"]
    for topic, table in [("User.Events", "user_events"), ("payment-events", "payment_events")]:
        rows = UpsertFolder(spark, str(tmp_path / table)).current().collect()
        assert [r["event_id"] for r in rows] == [topic]


def test_topic_lists():
    assert runs.topic_tables(" user_events ,Pay.Ments") == {
        "user_events": "user_events",
        "Pay.Ments": "pay_ments",
    }
    with pytest.raises(ValueError, match="shares table"):
        runs.topic_tables("a-b,a.b")
    with pytest.raises(ValueError, match="empty"):
        runs.topic_tables("a,,b")


def test_one_failed_query_stops_the_rest(spark, tmp_path):
    def fail(batch, batch_id):
        raise RuntimeError("boom")

    src = tmp_path / "in"
    write_lines(src, "1.txt", "x")
    stream = text_messages(spark, str(src), "t")
    good = stream.writeStream.format("noop").option("checkpointLocation", str(tmp_path / "a")).start()
    bad = (
        stream.writeStream.foreachBatch(fail).option("checkpointLocation", str(tmp_path / "b")).start()
    )
    with pytest.raises(Exception, match="boom"):
        runs.wait_for_any({"good": good, "bad": bad})
    assert not good.isActive and not bad.isActive
