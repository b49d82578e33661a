"""Owners of sinks, change feed, redrive, routed tables, joins by time, sessions, repeats, sketches, census."""

import datetime as dt
import json
import pathlib
import random

import pytest
from pyspark.sql import functions as F
from test_streaming import HOUR0, HOUR1, Landing, Rides, ride_json

from eventlake import schemas as S
from eventlake.operators import (
    as_of,
    estimates,
    field_census,
    first_of_repeats,
    hourly_sketches,
    join_within,
    late_rows,
    merge_sketches,
    open_sessions,
    session_counts,
    undeclared,
    windowed_counts,
)
from eventlake.sources import landed_messages
from eventlake.streaming import pipelines
from eventlake.streaming.append import append_to_path, read_appended, read_updated, update_to_path
from eventlake.streaming.maintained import HourlyCounts
from eventlake.streaming.upsert import UpsertFolder

DAY = dt.datetime(2024, 1, 1)


def at(minutes):
    return DAY + dt.timedelta(minutes=minutes)


@pytest.fixture
def rides(spark, tmp_path):
    return Rides(spark, tmp_path)


class Stream:
    """Rows of one schema as files; each ``run`` is a restart that reads ``per_batch`` files a batch."""

    def __init__(self, spark, path, schema):
        self.spark, self.path, self.schema = spark, str(path), schema
        spark.createDataFrame([], schema).write.parquet(self.path)

    def add(self, *rows):
        self.spark.createDataFrame(rows, self.schema).coalesce(1).write.mode("append").parquet(self.path)

    def read(self, per_batch=1):
        reader = self.spark.readStream.schema(self.schema).option("maxFilesPerTrigger", per_batch)
        return reader.parquet(self.path)


# -- owners --------------------------------------------------------------------------------


def test_an_append_folder_refuses_another_stream_and_loses_nothing(spark, tmp_path):
    source, out = Stream(spark, tmp_path / "in", "name string"), str(tmp_path / "out")

    def run(checkpoint):
        schema = S.T.StructType().add("name", "string")
        append_to_path(source.read(), schema, out, str(tmp_path / checkpoint), every=None).awaitTermination()
        return sorted(r[0] for r in read_appended(spark, schema, out).collect())

    source.add(("a",), ("b",), ("c",))
    assert run("one") == ["a", "b", "c"]
    source.add(("d",), ("e",))
    with pytest.raises(ValueError, match="is written by stream"):
        run("two")
    assert run("one") == ["a", "b", "c", "d", "e"]


def test_a_catalog_table_of_files_refuses_another_stream(spark, tmp_path):
    landing = Landing(spark, tmp_path / "in")
    landing.add('{"event_name":"x","timestamp_ms":1}')

    def run(checkpoint):
        pipelines.append_bids_to_table(
            landed_messages(spark, landing.path), "owned_bids", str(tmp_path / checkpoint),
            provider="parquet", location=str(tmp_path / "table"), every=None,
        ).awaitTermination()
        return spark.table("owned_bids").count()

    assert run("one") == 1
    with pytest.raises(ValueError, match="is written by stream"):
        run("two")
    landing.add('{"event_name":"y","timestamp_ms":2}')
    assert run("one") == 2
    spark.sql("DROP TABLE owned_bids")


def counted(source):
    timed = source.read().select("at", "kind", "value")
    counts = windowed_counts(timed, "at", "kind", F.col("value").cast("decimal(18,2)"), lateness="1 hour")
    return counts.select("window_start", "kind", "n_events")


def test_windows_refuse_another_stream_and_show_whole_batches_only(spark, tmp_path):
    source, out = Stream(spark, tmp_path / "in", "at timestamp, kind string, value double"), str(tmp_path / "out")

    def run(checkpoint):
        counts = counted(source)
        update_to_path(counts, counts.schema, out, str(tmp_path / checkpoint), every=None).awaitTermination()
        return counts.schema

    def state(schema):
        return sorted((r["kind"], r["n_events"]) for r in read_updated(spark, schema, out, ["window_start", "kind"]).collect())

    source.add((at(0), "a", 1.0), (at(1), "b", 1.0))
    schema = run("one")
    assert state(schema) == [("a", 1), ("b", 1)]
    source.add((at(2), "a", 1.0))
    with pytest.raises(Exception, match="is written by stream"):
        run("two")
    assert state(schema) == [("a", 1), ("b", 1)]
    # A batch that was begun by a lost run: nobody sees it, and the next run writes it anew.
    batches = pathlib.Path(out) / "batches"
    begun = batches / f"batch_id={1 + max(int(p.name[9:]) for p in batches.glob('batch_id=*'))}"
    spark.createDataFrame([(at(0), "lost", 9)], schema).write.parquet(str(begun))
    assert state(schema) == [("a", 1), ("b", 1)]
    run("one")
    assert state(schema) == [("a", 2), ("b", 1)]
    # A finished batch is left alone when it is replayed.
    files = {p: p.stat().st_mtime_ns for p in batches.rglob("*.parquet")}
    commits = tmp_path / "one" / "commits"
    last = max(int(p.name) for p in commits.iterdir() if p.name.isdigit())
    (commits / str(last)).unlink()
    (commits / f".{last}.crc").unlink(missing_ok=True)
    run("one")
    assert {p: p.stat().st_mtime_ns for p in batches.rglob("*.parquet")} == files
    assert state(schema) == [("a", 2), ("b", 1)]


# -- change feed ---------------------------------------------------------------------------


def recomputed(table):
    rows = table.current().groupBy("event_hour", "event_type").agg(F.count("*"), F.sum(F.col("fare_amount").cast("decimal(38,6)")))
    return sorted(tuple(r) for r in rows.collect())


def maintained(counts):
    rows = counts.read().select("event_hour", "event_type", "n_rows", "fares").collect()
    return sorted(tuple(r) for r in rows)


def test_maintained_counts_equal_a_recount_after_every_batch(spark, rides, tmp_path):
    rng = random.Random(5)
    counts = HourlyCounts(spark, str(tmp_path / "counts"))
    assert counts.advance(rides.table.create()) == -1 and maintained(counts) == []
    for i in range(4):
        payloads = []
        for _ in range(60):
            key = "hot" if rng.random() < 0.4 else f"e{rng.randrange(15)}"
            payload = ride_json(key, rng.choice([HOUR0, HOUR1]), rng.randrange(100, 800))
            payloads.append(payload.replace("fare_viewed", rng.choice(["fare_viewed", "ride_requested"])))
        rides.landing.add(*payloads, "junk")
        rides.run()
        if i == 1:
            rides.table.compact()
        if i == 2:
            counts.fold()
        assert counts.advance(rides.table) == i
        assert maintained(counts) == recomputed(rides.table)
        # Replays: of the batch that is done, and of an advance that was lost before its marker.
        assert counts.advance(rides.table) == i
        marker = tmp_path / "counts" / "deltas_done" / f"upto={i}"
        marker.rename(tmp_path / f"gone-{i}")
        counts.advance(rides.table)
        assert maintained(counts) == recomputed(rides.table)
    late = HourlyCounts(spark, str(tmp_path / "late"))  # all batches at once, past a compaction
    assert late.advance(rides.table) == 3 and maintained(late) == maintained(counts)


def test_the_feed_has_both_images_and_stays_the_same(rides):
    rides.landing.add(ride_json("a", HOUR0, 1), ride_json("b", HOUR0, 2), ride_json("c", HOUR1, 3))
    rides.run()
    rides.landing.add(ride_json("a", HOUR0, 5), ride_json("b", HOUR0, 2), ride_json("d", HOUR1, 7), ride_json("d", HOUR1, 8))
    rides.run()

    def images():
        rows = rides.table.feed(0, 1).collect()
        return sorted((r["event_id"], r["before"] and r["before"]["fare_amount"], r["after"]["fare_amount"]) for r in rows)

    want = [("a", 1.0, 5.0), ("d", None, 8.0)]  # b was written but is as it was
    assert images() == want
    rides.table.compact()
    rides.landing.add(ride_json("a", HOUR0, 9))
    rides.run()
    assert images() == want
    assert {r["event_id"] for r in rides.table.feed(-1, 1).collect()} == {"a", "b", "c", "d"}
    assert rides.table.feed(2, 2).count() == 0


# -- redrive -------------------------------------------------------------------------------


def mend(refused):
    return refused.withColumn("value", F.concat("value", F.lit("}")))


@pytest.mark.parametrize("first", ["redrive", "write"])
def test_a_repaired_row_takes_its_place_and_not_the_last_word(rides, first):
    broken = ride_json("e1", HOUR0, 1)[:-1]
    rides.landing.add(broken, ride_json("e2", HOUR0, 2)[:-1], "[hopeless")
    rides.run()
    assert rides.state() == [] and rides.table.open_rejects().count() == 3
    steps = [lambda: rides.table.redrive(mend), lambda: rides.landing.add(ride_json("e1", HOUR0, 9))]
    for step in steps if first == "redrive" else steps[::-1]:
        step()
        rides.run()
    want = [("e1", "00", 9.0), ("e2", "00", 2.0)]
    assert rides.state() == want
    assert [r["value"] for r in rides.table.open_rejects().collect()] == ["[hopeless"]
    # Nothing goes twice, nor does the table change with a compaction.
    assert rides.table.redrive(mend) == 0
    rides.table.compact()
    rides.run()
    assert rides.state() == want and rides.table.rejects().count() == 3


def test_rejects_keep_where_they_came_from(rides):
    rides.landing.add(ride_json("e1", HOUR0, 1), "junk")
    rides.run()
    row = rides.table.rejected_messages().first()
    assert (row["topic"], row["partition"], row["offset"], row["value"], row["batch_id"]) == ("rides", 0, 1, "junk", 0)
    assert row["timestamp"] == DAY + dt.timedelta(seconds=1)


# -- routed tables -------------------------------------------------------------------------


def test_one_stream_writes_a_table_for_each_topic(spark, tmp_path):
    source = Stream(spark, tmp_path / "in", S.MESSAGE)
    table = UpsertFolder(spark, str(tmp_path / "tables"), routed=True)

    def run():
        table.start(source.read(100), str(tmp_path / "cp"), every=None).awaitTermination()
        rows = table.current().collect()
        return sorted((r["table_name"], r["event_id"], r["fare_amount"]) for r in rows)

    def message(topic, offset, event, fare):
        return (ride_json(event, HOUR0, fare), topic, 0, offset, at(offset))

    source.add(message("User.Events", 0, "e1", 1), message("pay", 1, "e1", 2), message(None, 2, "e1", 3))
    assert run() == [("pay", "e1", 2.0), ("user_events", "e1", 1.0)]
    # A new topic, a newer row, and a topic that would share a table.
    source.add(message("drivers", 3, "e9", 4), message("pay", 4, "e1", 5), message("user-events", 5, "e1", 6))
    want = [("drivers", "e9", 4.0), ("pay", "e1", 5.0), ("user_events", "e1", 1.0)]
    assert run() == want
    # Two topics for one new table in one batch: the lesser name has it.
    source.add(message("b.c", 6, "e1", 7), message("b-c", 7, "e2", 8))
    want = sorted([*want, ("b_c", "e2", 8.0)])
    assert run() == want
    bad = sorted((r["topic"] or "", r["reject_reason"], r["offset"]) for r in table.rejected_messages().collect())
    assert bad == [("", "no_topic", 2), ("b.c", "shares_table", 6), ("user-events", "shares_table", 5)]
    assert all(r["value"] for r in table.rejects().collect())
    table.compact()
    assert run() == want
    done = table._done().groupBy("batch_id").agg(F.sum("rows").alias("n")).collect()
    assert {r["batch_id"]: r["n"] for r in done} == {0: 3, 1: 3, 2: 2}
    one = table.current().where("table_name = 'pay'")
    plan = one._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line and "fare_amount" in line]
    assert scans and all("table_name" in s.split("PartitionFilters: [")[1].split("]")[0] for s in scans)


# -- joins by time -------------------------------------------------------------------------

SIDE = "id string, ride string, at timestamp"


def pairs_of(left, right):
    out = []
    for i, ride, t in left:
        hits = [j for j, r, u in right if ride is not None and r == ride and t - dt.timedelta(minutes=5) <= u <= t + dt.timedelta(minutes=20)]
        out += [(i, j) for j in hits] or [(i, None)]
    return sorted(out, key=repr)


def joined(left, right):
    bounds = {"before": dt.timedelta(minutes=5), "after": dt.timedelta(minutes=20)}
    pairs = join_within(left, right, "ride", "at", "at", lateness="1 minute", outer=True, **bounds)
    return pairs.select(F.col("left.id").alias("l"), F.col("right.id").alias("r"))


@pytest.mark.parametrize("cut", [1, 3])
def test_a_join_of_streams_does_not_depend_on_batches(spark, tmp_path, cut):
    rng = random.Random(3)
    rows = [[(f"{s}{i}", rng.choice(["hot", "hot", "a", "b", None]), at(i)) for i in range(60)] for s in "lr"]
    rows[0] += [("l-edge", "edge", at(10)), ("l-far", "edge", at(40))]
    rows[1] += [("r-low", "edge", at(5)), ("r-high", "edge", at(30)), ("r-out", "edge", at(31))]
    rows = [sorted(side, key=lambda r: r[2]) for side in rows]
    sides = [Stream(spark, tmp_path / s, SIDE) for s in "lr"]
    queries = []
    for i in range(cut + 1):
        for side, given, name in zip(sides, rows, "lr", strict=True):
            step = -(-len(given) // cut)
            side.add(*(given[i * step : (i + 1) * step] if i < cut else [(f"{name}-end", f"end {name}", at(5000))]))
        out = joined(sides[0].read(), sides[1].read())
        query = append_to_path(out, out.schema, str(tmp_path / "out"), str(tmp_path / "cp"), every=None, stateful=True)
        query.awaitTermination()
        queries.append(query)
        assert late_rows(query) == 0
    got = [tuple(r) for r in read_appended(spark, out.schema, str(tmp_path / "out")).collect()]
    want = pairs_of(*rows)
    assert sorted(got, key=repr) == want
    # What can have no partner any more has left the state.
    held = [s["numRowsTotal"] for q in queries for p in q.recentProgress for s in json.loads(p.json)["stateOperators"]]
    assert max(held) > 60 / cut and held[-1] <= 3
    batch = joined(*(spark.createDataFrame(given, SIDE) for given in rows))
    assert sorted((tuple(r) for r in batch.collect()), key=repr) == want


def test_late_rows_of_a_join_are_counted(spark, tmp_path):
    left, right = (Stream(spark, tmp_path / s, SIDE) for s in "lr")
    late = 0
    for minute in (0, 500, 1):
        left.add((f"l{minute}", "a", at(minute)))
        right.add((f"r{minute}", "a", at(minute)))
        out = joined(left.read(), right.read())
        query = append_to_path(out, out.schema, str(tmp_path / "out"), str(tmp_path / "cp"), every=None, stateful=True)
        query.awaitTermination()
        late += late_rows(query)
    assert late == 3  # the late right row is in two buckets of time


def test_a_hot_key_is_spread_over_time(spark):
    left = spark.range(2000).selectExpr("cast(id as string) id", "'hot' ride", "timestamp_seconds(id * 300) at")
    plan = joined(left, left)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan and "__lb" in plan
    spread = left.selectExpr(f"floor(unix_micros(at) / {25 * 60 * 10**6}) b").groupBy("b").count()
    assert spread.agg(F.max("count")).first()[0] <= 6


def test_versions_as_of_an_event(spark):
    rng = random.Random(4)
    versions = [(rng.choice("ab"), at(rng.randrange(0, 6000, 10)), None if rng.random() < 0.5 else at(rng.randrange(6000)), i) for i in range(80)]
    versions += [("c", at(100), None, 900), ("c", at(100), None, 901), (None, at(5), None, 902), ("c", None, None, 903)]
    facts = [(i, rng.choice("abcd"), at(rng.randrange(0, 9000, 10))) for i in range(300)] + [(500, None, at(9)), (501, "c", None), (502, "c", at(100))]
    facts += facts[:3]

    def found(key, t):
        mine = [v for v in versions if v[0] == key and v[1] is not None and key is not None and t is not None and v[1] <= t]
        if not mine:
            return None
        last = max(mine, key=lambda v: (v[1], v[2] is not None, v[2] or DAY, v[3]))
        return None if last[2] is not None and last[2] <= t else last[3]

    out = as_of(
        spark.createDataFrame(facts, "id int, user string, at timestamp"),
        spark.createDataFrame(versions, "user string, since timestamp, until timestamp, plan int"),
        "user", "at", "since", until="until",
    )
    assert out.columns == ["id", "user", "at", "version"]
    got = [(r["id"], r["version"] and r["version"]["plan"]) for r in out.collect()]
    assert sorted(got, key=repr) == sorted(((i, found(k, t)) for i, k, t in facts), key=repr)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    empty = as_of(out.drop("version").limit(0), spark.createDataFrame([], "user string, since timestamp"), "user", "at", "since")
    assert empty.count() == 0


# -- sessions, repeats, sketches, census ---------------------------------------------------


def test_sessions_close_with_the_watermark_and_open_ones_can_be_read(spark, tmp_path):
    source = Stream(spark, tmp_path / "in", "at timestamp, user string, kind string")
    gap = F.when(F.col("kind") == "long", "60 minutes").otherwise("10 minutes")
    events = [(0, "a", "short"), (10, "a", "short"), (21, "a", "long"), (75, "a", "short"), (30, "b", "short"), (300, "b", "long")]
    for minute, user, kind in sorted(events):
        source.add((at(minute), user, kind), (None, user, kind))
    rows = session_counts(source.read(2), "at", "user", gap, F.lit(1).cast("decimal(18,2)"), lateness="5 minutes")
    append_to_path(rows, rows.schema, str(tmp_path / "out"), str(tmp_path / "cp"), every=None, stateful=True).awaitTermination()

    def plain(df):
        return sorted((r["user"], r["session_start"], r["session_end"], r["n_events"]) for r in df.collect())

    closed = plain(read_appended(spark, rows.schema, str(tmp_path / "out")))
    still = plain(open_sessions(spark, str(tmp_path / "cp"), "user"))
    assert closed == [("a", at(0), at(20), 2), ("a", at(21), at(85), 2), ("b", at(30), at(40), 1)]
    assert still == [("b", at(300), at(360), 1)]
    batch = session_counts(spark.read.parquet(source.path), "at", "user", gap, F.lit(1).cast("decimal(18,2)"), lateness=None)
    assert plain(batch) == sorted(closed + still)


def test_repeats_go_once_across_batches_and_restarts(spark, tmp_path):
    landing = Landing(spark, tmp_path / "in")

    def run(path, once):
        messages = landed_messages(spark, landing.path, max_files=1)
        if once:
            messages = first_of_repeats(messages, ["topic", "value"], "timestamp", "10 minutes")
        pipelines.append_bids(
            messages, str(tmp_path / path), str(tmp_path / f"cp-{path}"), every=None, stateful=once
        ).awaitTermination()
        rows = read_appended(spark, S.BID_TABLE, str(tmp_path / path)).collect()
        return sorted(r["event_name"] for r in rows)

    a, b = ('{"event_name":"%s","timestamp_ms":1}' % n for n in "ab")
    landing.add(a, b, a)
    landing.add(a)
    assert run("once", True) == ["a", "b"] and run("all", False) == ["a", "a", "a", "b"]
    landing.add(b, '{"event_name":"c","timestamp_ms":1}')
    assert run("once", True) == ["a", "b", "c"] and run("all", False) == ["a", "a", "a", "b", "b", "c"]


def test_sketches_merge_in_any_order_and_stay_near(spark, tmp_path):
    df = spark.range(60_000).selectExpr("id % 7 h", "id % 9000 user", "cast(id % 1000 as double) value", "id % 3 part")
    hour = F.concat(F.lit("2024-01-01-0"), F.col("h"))
    stored = hourly_sketches(df, hour, F.col("user"), F.col("value"))
    stored.write.parquet(str(tmp_path / "s"))
    stored = spark.read.parquet(str(tmp_path / "s"))
    whole = estimates(merge_sketches(stored, F.lit(1).alias("all"))).first()
    assert whole["n_events"] == 60_000 and abs(whole["n_members"] - 9000) < 9000 * 0.05
    assert abs(whole["p50"] - 500) < 35 and abs(whole["p95"] - 950) < 35
    # Any way of merging gives the same distinct count: by part first, and from the last hour on.
    parts = hourly_sketches(df, hour, F.col("user"), F.col("value"), ["part"])
    again = merge_sketches(merge_sketches(parts.orderBy(F.desc("event_hour")), "part"), F.lit(1).alias("all"))
    assert estimates(again).first()["n_members"] == whole["n_members"]
    some = merge_sketches(stored.where("event_hour >= '2024-01-01-05'"), F.lit(1).alias("all"))
    assert estimates(some).first()["n_events"] == df.where("h >= 5").count()
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "GreaterThanOrEqual(event_hour" in plan
    nothing = spark.createDataFrame([(None, None)], "user long, value double")
    row = estimates(hourly_sketches(nothing, F.lit("h"), F.col("user"), F.col("value"))).first()
    assert (row["n_events"], row["n_members"], row["p50"]) == (1, 0, None)


def test_census_of_fields(spark):
    payloads = [
        '{"event_id":"a","flow_id":7,"metadata":{"fare_amount":1.5,"extra":[1,{"x":null}]},"empty":{},"none":[]}',
        '{"event_id":5,"metadata":"none","flow_id":8}',
        "junk", "[1]", None, "", '{"flow_id":99999999999999999999,"flow_id":true}',
    ]
    df = spark.createDataFrame([(p, "t", f"h{i}") for i, p in enumerate(payloads)], "v string, topic string, hour string")
    census = field_census(df, "v", F.col("hour"), ["topic"])
    got = {(r["path"], r["kind"]): (r["n"], r["first_hour"], r["last_hour"]) for r in census.collect()}
    assert got == {
        ("$", "unreadable"): (4, "h2", "h5"),
        ("$.event_id", "text"): (1, "h0", "h0"),
        ("$.event_id", "whole number"): (1, "h1", "h1"),
        ("$.flow_id", "whole number"): (2, "h0", "h1"),
        ("$.flow_id", "boolean"): (1, "h6", "h6"),
        ("$.metadata", "object"): (1, "h0", "h0"),
        ("$.metadata", "text"): (1, "h1", "h1"),
        ("$.metadata.fare_amount", "number"): (1, "h0", "h0"),
        ("$.metadata.extra", "array"): (1, "h0", "h0"),
        ("$.metadata.extra[*]", "whole number"): (1, "h0", "h0"),
        ("$.metadata.extra[*]", "object"): (1, "h0", "h0"),
        ("$.empty", "object"): (1, "h0", "h0"),
        ("$.none", "array"): (1, "h0", "h0"),
    }
    more = {r["path"] for r in undeclared(census, S.NESTED_RIDE).collect()}
    assert more == {"$", "$.flow_id", "$.metadata.extra", "$.metadata.extra[*]", "$.empty", "$.none"}
    assert census.where("false").count() == field_census(df.limit(0), "v", F.col("hour")).count() == 0
