"""The registered queries: name to ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventlake import functions as L
from eventlake import schemas as S
from eventlake.checks import shaping
from eventlake.operators import (
    accepted,
    as_of,
    decode_lenient,
    decode_strict,
    enrich,
    estimates,
    field_census,
    first_of_repeats,
    hourly_sketches,
    join_within,
    late_rows,
    latest_per_key,
    merge_sketches,
    open_sessions,
    rejected,
    session_counts,
    synthesize,
    to_messages,
    windowed_counts,
)
from eventlake.operators.synthetic import ID_PREFIX
from eventlake.plans import bid_rows, flat_ride_rows, nested_ride_rows
from eventlake.session import configure, scratch_dir
from eventlake.sources import landed_messages
from eventlake.streaming import pipelines, runs
from eventlake.streaming.append import append_to_path, read_appended, read_updated, update_to_path
from eventlake.streaming.colocated import BucketedUpsertFolder
from eventlake.streaming.maintained import HourlyCounts
from eventlake.streaming.upsert import ARRIVAL, UpsertFolder

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

COERCED = (
    S.flat("a", "string"),
    S.flat("n", "int"),
    S.flat("l", "bigint"),
    S.flat("d", "double"),
)
SEED = 11
LATENESS = "10 minutes"
REPORT_FROM, REPORT_TO, REPORT_DAY = "2024-01-10-00", "2024-01-20-23", "2024-01-15"


def query(run: Query) -> Query:
    def configured(spark: SparkSession, sf_dir: str) -> DataFrame:
        return run(configure(spark), sf_dir)

    configured.__doc__ = run.__doc__
    QUERIES[run.__name__] = configured
    return configured


def _rides(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shaping.messages(shaping.events(spark, sf_dir), shaping.nested_ride())


def _upserts(spark: SparkSession, sf_dir: str) -> DataFrame:
    payload = shaping.nested_ride(shaping.UPSERT_ID)
    return shaping.messages(shaping.events(spark, sf_dir), payload)


# -- decoding ------------------------------------------------------------------------------


@query
def strict_decode_ride(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The good rows of the nested ride decode."""
    return accepted(nested_ride_rows(_rides(spark, sf_dir))).select(*S.RIDE_TABLE.fieldNames())


@query
def decode_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The refused payloads with topic and reason."""
    return rejected(nested_ride_rows(_rides(spark, sf_dir)))


@query
def nested_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D3: fields of the nested object as columns, next to the message coordinates."""
    fields = tuple(f for f in S.NESTED_RIDE if f.path.startswith("$.metadata."))
    rows = accepted(decode_strict(_rides(spark, sf_dir), fields))
    return rows.select("topic", "partition", "offset", *[f.name for f in fields])


@query
def json_coercion_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON token read as text, int, long and double, strictly."""
    rows = shaping.messages(shaping.events(spark, sf_dir), shaping.COERCION, "event_id")
    names = [f.name for f in COERCED]
    return decode_strict(rows, COERCED).select("event_id", *names, "reject_reason")


@query
def json_coercion_lenient(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same tokens, leniently."""
    rows = shaping.messages(shaping.events(spark, sf_dir), shaping.COERCION, "event_id")
    return decode_lenient(rows, COERCED, keep=("event_id",))


@query
def lenient_decode_bid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bid rows; the ingestion time is only checked to be there."""
    bids = bid_rows(shaping.messages(shaping.events(spark, sf_dir), shaping.BID))
    return bids.withColumn("is_stamped", F.col("ingestion_time").isNotNull()).drop(
        "ingestion_time"
    )


@query
def flat_ride_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat rides with their day."""
    return flat_ride_rows(shaping.messages(shaping.events(spark, sf_dir), shaping.FLAT_RIDE))


@query
def lenient_decode_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D5, S7 on the JSON that the table itself holds."""
    fields = (S.flat("k", "int"), S.flat("absent", "string"))
    rows = shaping.table(spark, sf_dir, "events").select("event_id", "props")
    return decode_lenient(rows, fields, value="props", keep=("event_id",))


# -- functions -----------------------------------------------------------------------------


@query
def hour_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F1, also for times before 1970."""
    ms = F.col("ms")
    return shaping.events(spark, sf_dir).select(
        "event_id", L.hour_bucket(ms).alias("hour"), L.hour_bucket(-ms).alias("hour_before_1970")
    )


@query
def event_date_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F5 to F7, also for times before 1970, one by one and in one step."""
    ms = F.col("ms")
    text = L.text_time(L.seconds_of(-ms))
    return shaping.events(spark, sf_dir).select(
        "event_id",
        L.seconds_of(-ms).alias("seconds"),
        text.alias("text_time"),
        L.format_text_time(text).alias("day_of_text"),
        L.day_bucket(-ms).alias("day_before_1970"),
        L.day_bucket(ms).alias("day"),
    )


@query
def event_wall_clock(spark: SparkSession, sf_dir: str) -> DataFrame:
    """epoch ms to wall clock in milliseconds."""
    ms = F.col("ms")
    return shaping.events(spark, sf_dir).select(
        "event_id",
        L.wall_clock(L.event_time(ms)).alias("event_time"),
        L.wall_clock(L.event_time(-ms)).alias("event_time_before_1970"),
    )


@query
def topic_table_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F8 over the page addresses."""
    pages = shaping.table(spark, sf_dir, "pages")
    return pages.select("page_id", L.table_name_column(F.col("url")).alias("table_name"))


# -- upsert --------------------------------------------------------------------------------


@query
def upsert_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K6 in batch: the last row of each key; one key has 40 % of the rows."""
    good = accepted(nested_ride_rows(_upserts(spark, sf_dir)))
    return latest_per_key(good, S.RIDE_KEY, ARRIVAL).select(*S.RIDE_TABLE.fieldNames())


def _arrivals(messages: DataFrame) -> list[DataFrame]:
    """Three arrivals ten days apart; a message without a time comes with the last."""
    days = F.dayofmonth(F.col("timestamp"))
    slot = F.when(days <= 10, 0).when(days <= 20, 1).otherwise(2)
    return [messages.where(slot == i) for i in range(3)]


def _landed(messages: DataFrame, path: str) -> None:
    """Messages as the tasks of a consumer would land them: a file for each core, eight at least."""
    files = max(8, messages.sparkSession.sparkContext.defaultParallelism)
    messages.repartition(files, "offset").write.mode("append").parquet(path)


def _upsert_stream(
    spark: SparkSession,
    sf_dir: str,
    label: str,
    compact_after: int | None = None,
    then: Callable[[UpsertFolder], object] | None = None,
    buckets: int | None = None,
) -> UpsertFolder:
    """J1 as a stream: three arrivals, each a restart from the checkpoint; after each ``then``."""
    work = scratch_dir(spark, label)
    table = UpsertFolder(spark, f"{work}/table")
    if buckets:
        name = f"default.eventlake_rides_{work.rpartition('-')[2]}"
        table = BucketedUpsertFolder(spark, table.path, table=name, buckets=buckets)
    for i, arrival in enumerate(_arrivals(_upserts(spark, sf_dir))):
        _landed(arrival, f"{work}/landing")
        pipelines.upsert_rides(
            landed_messages(spark, f"{work}/landing"), table.path, f"{work}/checkpoint", every=None
        ).awaitTermination()
        if then:
            then(table)
        if i == compact_after:
            table.compact()
    return table


@query
def upsert_stream_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table as it stands after three batches."""
    return _upsert_stream(spark, sf_dir, "current").current()


@query
def upsert_stream_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As above, with the first two batches compacted before the third arrives."""
    return _upsert_stream(spark, sf_dir, "compacted", compact_after=1).current()


@query
def upsert_stream_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As above, compacted into buckets by key, so that the third batch alone is shuffled."""
    return _upsert_stream(spark, sf_dir, "bucketed", compact_after=1, buckets=8).current()


@query
def upsert_stream_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D4 in J1: what the stream refused."""
    return _upsert_stream(spark, sf_dir, "rejects").rejects()


@query
def topic_fan_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A query and a table for each topic that landed, all at once; rows per table and hour."""
    work = scratch_dir(spark, "fanout")
    _rides(spark, sf_dir).write.partitionBy("topic").parquet(f"{work}/landing")
    schema = T.StructType([f for f in S.MESSAGE.fields if f.name != "topic"]).add("topic", "string")
    landed = spark.read.schema(schema).parquet(f"{work}/landing").select("topic").distinct()
    # As many as there are streams to start; a message without a topic is in none.
    topics = sorted(r[0] for r in landed.where("topic IS NOT NULL").collect())
    tables: dict[str, UpsertFolder] = {}

    def start(topic: str, name: str):
        tables[topic] = UpsertFolder(spark, f"{work}/tables/{name}")
        messages = landed_messages(spark, f"{work}/landing/topic={topic}")
        messages = messages.withColumn("topic", F.lit(topic))
        return tables[topic].start(messages, f"{work}/checkpoints/{name}", every=None)

    if topics:
        runs.wait_for_all(runs.fan_out(topics, start))
    counts = spark.createDataFrame([], "topic string, event_hour string, n_rows long")
    for topic, table in tables.items():
        per_hour = table.current().groupBy("event_hour").agg(F.count("*").alias("n_rows"))
        per_hour = per_hour.select(F.lit(topic).alias("topic"), "event_hour", "n_rows")
        counts = counts.unionByName(per_hour)
    return counts


# -- append --------------------------------------------------------------------------------


def _land(spark: SparkSession, sf_dir: str, label: str, payload: str) -> tuple[str, DataFrame]:
    work = scratch_dir(spark, label)
    rows = shaping.messages(shaping.events(spark, sf_dir), payload)
    rows.write.parquet(f"{work}/landing")
    return work, landed_messages(spark, f"{work}/landing")


@query
def bid_stream_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bids appended by a stream and read back."""
    work, messages = _land(spark, sf_dir, "bids", shaping.BID)
    pipelines.append_bids(
        messages, f"{work}/table", f"{work}/checkpoint", every=None
    ).awaitTermination()
    out = read_appended(spark, S.BID_TABLE, f"{work}/table")
    return out.withColumn("is_stamped", F.col("ingestion_time").isNotNull()).drop("ingestion_time")


@query
def append_partitioned_readback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rides appended by day, and the whole table read back."""
    work, messages = _land(spark, sf_dir, "days", shaping.FLAT_RIDE)
    pipelines.append_rides_by_day(
        messages, f"{work}/table", f"{work}/checkpoint", every=None
    ).awaitTermination()
    return read_appended(spark, S.RIDE_DAY_TABLE, f"{work}/table")


def _table_append(spark: SparkSession, sf_dir: str, label: str, payload: str, start) -> DataFrame:
    """Two runs, the second one a restart that finds new files and the table already there."""
    work = scratch_dir(spark, label)
    rows = shaping.messages(shaping.events(spark, sf_dir), payload)
    name = f"eventlake_{label}.t{work.rpartition('-')[2]}"
    for half in (0, 1):
        # Offsets may be negative; a message without one comes first.
        mine = F.pmod(F.coalesce(F.col("offset"), F.lit(0)), F.lit(2)) == half
        rows.where(mine).write.mode("append").parquet(f"{work}/landing")
        start(
            landed_messages(spark, f"{work}/landing"),
            name,
            f"{work}/checkpoint",
            provider="parquet",
            location=f"{work}/table",
            every=None,
        ).awaitTermination()
    return spark.table(name)


@query
def bid_table_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bids appended to a catalog table by two runs."""
    out = _table_append(spark, sf_dir, "bids", shaping.BID, pipelines.append_bids_to_table)
    return out.withColumn("is_stamped", F.col("ingestion_time").isNotNull()).drop("ingestion_time")


@query
def ride_day_table_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rides appended to a catalog table by day, by two runs."""
    start = pipelines.append_rides_by_day_to_table
    return _table_append(spark, sf_dir, "days", shaping.FLAT_RIDE, start)


# -- producers, re-aimed -------------------------------------------------------------------


@query
def synthetic_rides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G1: a user, a payment and a driver event for every row of ``events``."""
    base = shaping.events(spark, sf_dir)
    kinds = None
    for kind in ID_PREFIX:
        rows = synthesize(base, "event_id", "ms", kind, SEED).select(
            F.lit(kind).alias("topic"),
            "event_id",
            "user_id",
            "event_type",
            "timestamp",
            "ride_id",
            "metadata.*",
        )
        kinds = rows if kinds is None else kinds.unionByName(rows)
    return kinds


@query
def synthetic_bids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G1: a bid event for every row of ``events``."""
    return synthesize(shaping.events(spark, sf_dir), "event_id", "ms", "bid_events", SEED)


@query
def publish_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of ``events`` as JSON messages, each routed to the topic of its type."""
    rows = shaping.events(spark, sf_dir)
    return to_messages(rows, F.col("event_type"), ["event_id", "user_id", "value", "ms"])


@query
def publish_decode_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G1, G2, then D1: what the decoder reads back from published synthetic events."""
    made = synthesize(shaping.events(spark, sf_dir), "event_id", "ms", "driver_events", SEED)
    sent = to_messages(made, F.lit("driver_events"), made.columns)
    return accepted(nested_ride_rows(sent)).select("topic", *S.RIDE_TABLE.fieldNames())


# -- analytics -----------------------------------------------------------------------------


def _counted(events: DataFrame, **options) -> DataFrame:
    # Values have two decimals: summed as decimals, the total does not depend on the order.
    amount = F.col("value").cast("decimal(18,2)")
    timed = events.select(F.col("ts").cast("timestamp").alias("at"), "event_type", "value")
    return windowed_counts(timed, "at", "event_type", amount, lateness=LATENESS, **options)


def _plain(counts: DataFrame) -> DataFrame:
    return counts.select(
        F.col("window_start").cast("timestamp_ntz").alias("window_start"),
        F.col("window_end").cast("timestamp_ntz").alias("window_end"),
        "event_type",
        "n_events",
        F.col("total").cast("double").alias("total"),
    )


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The given table as a stream; the pattern matches a file and a folder of part files."""
    schema = shaping.table(spark, sf_dir, "events").schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parquet*")


@query
def windowed_counts_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T1 in batch."""
    return _plain(_counted(shaping.table(spark, sf_dir, "events")))


@query
def windowed_counts_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T1 on a stream: all windows, those still open at the end too."""
    work = scratch_dir(spark, "windows")
    counts = _plain(_counted(_event_stream(spark, sf_dir)))
    query = update_to_path(counts, counts.schema, f"{work}/out", f"{work}/checkpoint", every=None)
    query.awaitTermination()
    if late := late_rows(query):
        raise RuntimeError(f"{late} rows came too late for their window")
    return read_updated(spark, counts.schema, f"{work}/out", ["window_start", "event_type"])


def _with_customer(spark: SparkSession, sf_dir: str, events: DataFrame) -> DataFrame:
    customer = shaping.table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", "c_mktsegment"
    )
    rows = enrich(events, customer, events["user_id"] == customer["c_custkey"])
    return rows.select("event_id", "user_id", "event_type", "c_name", "c_mktsegment")


@query
def enrich_static(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T2 in batch."""
    return _with_customer(spark, sf_dir, shaping.table(spark, sf_dir, "events"))


@query
def enrich_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T2 on a stream: the given table as a stream, joined to a static one, appended."""
    work = scratch_dir(spark, "enrich")
    rows = _with_customer(spark, sf_dir, _event_stream(spark, sf_dir))
    append_to_path(
        rows, rows.schema, f"{work}/out", f"{work}/checkpoint", every=None
    ).awaitTermination()
    return read_appended(spark, rows.schema, f"{work}/out")


@query
def current_state_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An ad-hoc query over a range of hours of an upsert table, through SQL on a view."""
    current = _upsert_stream(spark, sf_dir, "report", compact_after=1).current()
    current.createOrReplaceTempView("eventlake_rides")
    return spark.sql(
        f"""
        SELECT event_hour, count(*) AS n_rows, min(event_timestamp) AS first_ms,
               max(event_timestamp) AS last_ms, max(fare_amount) AS top_fare
        FROM eventlake_rides
        WHERE event_hour BETWEEN '{REPORT_FROM}' AND '{REPORT_TO}' GROUP BY event_hour
        """
    )


@query
def rides_of_a_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One day of the table by day; no other day's files are read."""
    return append_partitioned_readback(spark, sf_dir).where(F.col("event_date") == REPORT_DAY)


def _largest_topics(messages: DataFrame) -> list[str]:
    """The two topics with the most messages."""
    sizes = messages.where("topic IS NOT NULL").groupBy("topic").count()
    found = [r[0] for r in sizes.orderBy(F.desc("count"), "topic").limit(2).collect()]
    return found + [None] * (2 - len(found))


@query
def two_topics_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The two largest topics decoded apart, each filtered before its decode, and put together."""
    rides = _rides(spark, sf_dir)
    parts = [accepted(nested_ride_rows(rides.where(F.col("topic") == topic))) for topic in _largest_topics(rides)]
    return parts[0].unionByName(parts[1]).select("topic", *S.RIDE_TABLE.fieldNames())


# -- joins by time -------------------------------------------------------------------------

JOIN_WITHIN = dt.timedelta(hours=6)


def _pairs(joined: DataFrame) -> DataFrame:
    return joined.select(
        F.col("left.event_id").alias("event_id"),
        F.col("left.ride_id").alias("ride_id"),
        F.col("left.event_timestamp").alias("event_timestamp"),
        F.col("right.event_id").alias("later_id"),
        F.col("right.event_timestamp").alias("later_timestamp"),
    )


def _timed(rides: DataFrame, topic: str | None) -> DataFrame:
    mine = accepted(nested_ride_rows(rides.where(F.col("topic") == topic)))
    return mine.withColumn("at", F.timestamp_millis("event_timestamp"))


def _joined(left: DataFrame, right: DataFrame) -> DataFrame:
    return join_within(left, right, "ride_id", "at", "at", after=JOIN_WITHIN, lateness=LATENESS, outer=True)


@query
def ride_join_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of the largest topic with those of the next one, same ride, up to six hours later."""
    rides = _rides(spark, sf_dir)
    return _pairs(_joined(*[_timed(rides, topic) for topic in _largest_topics(rides)]))


@query
def ride_join_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same as a join of two streams, in three runs; the last brings a far later event of
    each topic, as a heartbeat, so that all that waits for a partner is given up."""
    work = scratch_dir(spark, "ridejoin")
    rides = _rides(spark, sf_dir)
    topics = _largest_topics(rides)
    end = shaping.heartbeats(rides, topics)
    # Arrivals in the order of event time, so that none is late.
    order = _arrivals(rides.where(F.col("topic").isin(*[t for t in topics if t is not None])))
    out = S.struct_of(())
    for i, arrival in enumerate([*order, end]):
        _landed(arrival, f"{work}/landing")
        if i in (0, 1, 3):
            stream = [_timed(landed_messages(spark, f"{work}/landing"), topic) for topic in topics]
            pairs = _pairs(_joined(*stream))
            out = pairs.schema
            query = append_to_path(pairs, out, f"{work}/out", f"{work}/checkpoint", every=None, stateful=True)
            query.awaitTermination()
            if late := late_rows(query):
                raise RuntimeError(f"{late} rows came too late to be joined")
    return read_appended(spark, out, f"{work}/out")


@query
def as_of_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event with its user's plan as of the event. A signup is a new version of the plan, in
    force to the next one or for ``k`` hours at most."""
    events = shaping.events(spark, sf_dir)
    plans = events.where("event_type = 'signup'")
    plans = plans.select("user_id", "ts", (F.col("ts") + F.make_dt_interval(hours=F.col("k"))).alias("until"), "event_id", "value")
    facts = events.where("event_type IS DISTINCT FROM 'signup'").select("event_id", "user_id", "event_type", "ts")
    rows = as_of(facts, plans.withColumnsRenamed({"event_id": "plan_id", "value": "price"}), "user_id", "ts", "ts", until="until")
    return rows.select("event_id", "user_id", "event_type", F.col("version.plan_id").alias("plan_id"), F.col("version.price").alias("price"))


# -- the upsert table's feed, rejects and routes -------------------------------------------


@query
def upsert_feed_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and fares per hour and type, kept from the change feed through three batches, a
    compaction and a fold."""
    counts = HourlyCounts(spark, scratch_dir(spark, "counts"))
    _upsert_stream(spark, sf_dir, "feed", compact_after=0, then=counts.advance)
    counts.fold()
    return counts.read().select("event_hour", "event_type", "n_rows", F.col("fares").cast("double").alias("fares"))


def _mended(refused: DataFrame) -> DataFrame:
    """Close objects that were cut off, take objects out of arrays."""
    value, reason = F.col("value"), F.col("reject_reason")
    whole = F.when(reason == "unparseable", F.concat(value, F.lit("}")))
    whole = whole.when(reason == "not_object", F.substring(value, 2, 1 << 30).substr(F.lit(1), F.length(value) - 2))
    return refused.withColumn("value", whole.otherwise(value))


def _redriven(spark: SparkSession, sf_dir: str, label: str) -> UpsertFolder:
    """Two arrivals, a redrive of what was refused by then, a third arrival, and another redrive."""
    work = scratch_dir(spark, label)
    table = UpsertFolder(spark, f"{work}/table")
    for i, arrival in enumerate([*_arrivals(_upserts(spark, sf_dir)), None]):
        if arrival is not None:
            _landed(arrival, f"{work}/landing")
        pipelines.upsert_rides(
            landed_messages(spark, f"{work}/landing"), table.path, f"{work}/checkpoint", every=None
        ).awaitTermination()
        if i in (1, 2):
            table.redrive(_mended)
    return table


@query
def upsert_redriven(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table after rejects were repaired and read again, each at its place in the order."""
    return _redriven(spark, sf_dir, "redriven").current()


@query
def upsert_open_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What no repair has mended, where and when it came."""
    rows = _redriven(spark, sf_dir, "open").open_rejects()
    return rows.select("topic", "value", "reject_reason", "partition", "offset")


@query
def routed_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One stream, a table for each topic; the least topic first comes with the second run."""
    work = scratch_dir(spark, "routed")
    table = UpsertFolder(spark, f"{work}/tables", routed=True)
    rides = _rides(spark, sf_dir)
    late = F.col("topic").eqNullSafe(F.lit(rides.agg(F.min("topic")).first()[0]))
    for arrival in (~late, late):
        _landed(rides.where(arrival), f"{work}/landing")
        table.start(landed_messages(spark, f"{work}/landing"), f"{work}/checkpoint", every=None).awaitTermination()
    rows = table.current().groupBy("table_name", "event_hour").agg(F.count("*").alias("n_rows"))
    return rows.join(table.topics(), "table_name").select("table_name", "topic", "event_hour", "n_rows")


# -- sessions, repeats, sketches, census ---------------------------------------------------


def _sessions(events: DataFrame) -> DataFrame:
    gap = F.when(F.col("event_type") == "purchase", "6 hours").when(F.col("event_type") == "error", "30 minutes")
    timed = events.select(F.col("ts").cast("timestamp").alias("at"), "user_id", "event_type", "value")
    amount = F.col("value").cast("decimal(18,2)")
    return session_counts(timed, "at", "user_id", gap.otherwise("2 hours"), amount, lateness=LATENESS)


def _plain_sessions(sessions: DataFrame) -> DataFrame:
    return sessions.select(
        F.col("session_start").cast("timestamp_ntz").alias("session_start"),
        F.col("session_end").cast("timestamp_ntz").alias("session_end"),
        "user_id",
        "n_events",
        F.col("total").cast("double").alias("total"),
    )


@query
def sessions_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user's sessions, which an event keeps open for as long as its type says."""
    return _plain_sessions(_sessions(shaping.table(spark, sf_dir, "events")))


@query
def sessions_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T1 on a stream: the sessions that were closed, and those that its state still holds."""
    work = scratch_dir(spark, "sessions")
    closed = _plain_sessions(_sessions(_event_stream(spark, sf_dir)))
    query = append_to_path(closed, closed.schema, f"{work}/out", f"{work}/checkpoint", every=None, stateful=True)
    query.awaitTermination()
    if late := late_rows(query):
        raise RuntimeError(f"{late} rows came too late for their session")
    done = read_appended(spark, closed.schema, f"{work}/out")
    return done.unionByName(_plain_sessions(open_sessions(spark, f"{work}/checkpoint", "user_id")))


@query
def bids_sent_again(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every bid is sent twice, the copy a minute later; one of each is appended."""
    work = scratch_dir(spark, "again")
    rows = shaping.messages(shaping.events(spark, sf_dir), shaping.BID)
    again = rows.withColumn("timestamp", F.col("timestamp") + F.expr("INTERVAL 1 MINUTE"))
    _landed(rows.unionByName(again), f"{work}/landing")
    first = first_of_repeats(landed_messages(spark, f"{work}/landing"), ["topic", "value"], "timestamp", LATENESS)
    pipelines.append_bids(first, f"{work}/table", f"{work}/checkpoint", every=None, stateful=True).awaitTermination()
    out = read_appended(spark, S.BID_TABLE, f"{work}/table")
    return out.withColumn("is_stamped", F.col("ingestion_time").isNotNull()).drop("ingestion_time")


@query
def sketched_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users and values per day from stored hourly sketches, next to what is exact: whether the
    estimates are within three standard errors, and how many hours and events they stand for."""
    path = scratch_dir(spark, "sketches")
    events = shaping.events(spark, sf_dir).where("ts IS NOT NULL")
    hour = F.date_format(F.date_trunc("hour", F.col("ts")), "yyyy-MM-dd-HH")
    hourly_sketches(events, hour, F.col("user_id"), F.col("value")).write.parquet(path)
    day = F.substring("event_hour", 1, 10).alias("day")
    stored = spark.read.parquet(path)
    daily = estimates(merge_sketches(stored, day)).join(stored.groupBy(day).agg(F.count("*").alias("n_hours")), "day")
    exact = events.groupBy(F.date_format("ts", "yyyy-MM-dd").alias("day")).agg(
        F.countDistinct("user_id").alias("users"),
        F.expr("percentile(value, array(0.44, 0.56))").alias("middle"),
    )
    rows = daily.join(exact, "day")
    users = F.abs(F.col("n_members") - F.col("users")) <= F.greatest(F.lit(0.05) * F.col("users"), F.lit(0.5))
    middle = F.col("p50").between(F.col("middle")[0], F.col("middle")[1])
    return rows.select("day", "n_hours", "n_events", users.alias("users_near"), middle.alias("median_near"))


@query
def field_census_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fields of ``props`` and of nested payloads made of all columns, by event type."""
    events = shaping.table(spark, sf_dir, "events").withColumn("ms", F.unix_millis(F.col("ts").cast("timestamp")))
    nested = F.concat(
        F.lit('{"id":'), F.col("event_id"), F.lit(',"about":{"user":'), F.col("user_id"), F.lit(',"props":'),
        F.col("props"), F.lit('},"tags":["'), F.col("event_type"), F.lit('",true],"none":null}'),
    )
    payloads = events.select("event_type", "ms", F.explode(F.array("props", nested)).alias("payload"))
    return field_census(payloads, "payload", L.hour_bucket(F.col("ms")), ["event_type"])
