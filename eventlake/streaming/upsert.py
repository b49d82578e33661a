"""K6: the keyed upsert sink, last write wins.

**Parquet folder** (:class:`UpsertFolder`). Parquet has no row-level update, so each
micro-batch adds its rows as changes and the reader keeps the last one of each key:

- ``owner``: the id of the stream that writes here. Another stream, also one with a new
  checkpoint for the same topic, would count its batches from 0 again and is refused.
- ``changes/batch_id=N/route=accepted|rejected``: one batch, good and bad rows in a single
  write, in files of a fair size whatever number of hours they hold. Rows are sorted by hour,
  so that a filter on it skips row groups and pages.
- ``changes_done/batch_id=N``: the batch's row counts, written after it. Readers see no batch
  without it, and a batch that has it is never written again.
- ``base/upto=N/event_hour=H`` and ``base_done/upto=N``: the hours that ``compact`` rewrote,
  one row per key, and the list of those hours.
- ``redrive``: repaired messages, which the stream reads beside its own source.

A **routed** folder (``routed=True``) holds a table for each topic: ``table_name``, by the naming rule
of topics, is part of every key and one more level of folders, and a batch still is one write with
one marker. A topic that was never seen before gets its table with its first batch.

**Iceberg table** (:func:`upsert_to_table`): the batch is cut to its last row per key, then
merged.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery

from eventlake import schemas as S
from eventlake.functions.names import table_name_column
from eventlake.operators.decode import MESSAGE, REASON, accepted
from eventlake.operators.upsert import latest_per_key
from eventlake.plans.events import nested_ride_rows
from eventlake.session import SETTINGS, SHARED, SPREAD, settings
from eventlake.sources.files import landed_messages
from eventlake.streaming import owners
from eventlake.streaming.runs import COMMIT_INTERVAL, with_trigger
from eventlake.streaming.tables import PARQUET_OPTIONS, REJECTED, conform, rows_near

ARRIVAL = ("timestamp", "partition", "offset")
HOUR = "event_hour"
TABLE = "table_name"
NO_TOPIC, TAKEN = "no_topic", "shares_table"
# Refused rows have no hour to be told apart by; this many shares of them go to different tasks.
REFUSED_SHARES = 32
_SHARE = "__share"

_ROW = [f for f in S.RIDE_TABLE.fields if f.name != HOUR]
_BATCH = T.StructField("batch_id", T.LongType())
_UPTO = T.StructField("upto", T.LongType())
_ROUTE = T.StructField("route", T.StringType())
_HOUR = T.StructField(HOUR, T.StringType())
_N = T.StructField("rows", T.LongType())
_BAD = T.StructField("rejected", T.LongType())

_TABLE = T.StructField(TABLE, T.StringType())
_TOPIC = T.StructField("topic", T.StringType())

CHANGES_DONE = T.StructType([_TABLE, _TOPIC, _N, _BAD, _BATCH])
BASE_DONE = T.StructType([_TABLE, _HOUR, _N, _UPTO])
# What was published again: the repaired message, and the payload that had been refused.
REDRIVEN = T.StructType([*S.MESSAGE.fields, T.StructField("refused", T.StringType())])
_WHERE_FROM = ("topic", "partition", "offset", "timestamp")


def _overwrite(df: DataFrame, path: str, *partition_by: str) -> None:
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .options(**PARQUET_OPTIONS)
        .partitionBy(*partition_by)
        .parquet(path)
    )


@dataclass(frozen=True)
class UpsertFolder:
    """An upsert table of nested ride events in a folder, written by one stream for its whole life.

    ``order`` says which of two rows of a key is the later one, whatever batches they came in:
    columns of the messages or of the table. Of rows that are alike in all of them the one of the
    later batch is. So a message that comes again, or comes late because it had to be repaired,
    never beats one that is newer than itself.
    """

    spark: SparkSession
    path: str
    order: tuple[str, ...] = ARRIVAL
    routed: bool = False

    @property
    def _extra(self) -> list[T.StructField]:
        """Where a row came from, and order columns that the table itself does not have."""
        kinds = {f.name: f for f in S.MESSAGE.fields}
        more = [name for name in self.order if name not in S.RIDE_TABLE.fieldNames()]
        return [kinds[name] for name in dict.fromkeys([*more, *ARRIVAL])]

    @property
    def _tags(self) -> list[str]:
        return [TABLE] if self.routed else []

    @property
    def key(self) -> tuple[str, ...]:
        return (*self._tags, *S.RIDE_KEY)

    @property
    def _state(self) -> list[str]:
        topic = ["topic"] if self.routed else []
        return [*self._tags, *topic, *[f.name for f in _ROW], HOUR, *[f.name for f in self._extra], "batch_id"]

    @property
    def _ranking(self) -> list[str]:
        """What orders the rows of a key, the last word the row itself, so that there are no ties."""
        first = [*self.order, "batch_id"]
        return [*first, *[name for name in self._state if name not in {*first, *self.key}]]

    @property
    def _changes_schema(self) -> T.StructType:
        tag = [_TABLE] if self.routed else []
        return T.StructType(_ROW + [_HOUR] + self._extra + S.REJECTS.fields + [_BATCH, *tag, _ROUTE])

    @property
    def _base_schema(self) -> T.StructType:
        tags = ([_TABLE], [_TOPIC]) if self.routed else ([], [])
        return T.StructType(_ROW + tags[1] + self._extra + [_BATCH, _UPTO, *tags[0], _HOUR])

    def create(self) -> UpsertFolder:
        """K1: lay out the table if it is absent."""
        layout = {
            "owner": (owners.OWNER, ()),
            "changes": (self._changes_schema, ("batch_id", *self._tags, "route")),
            "changes_done": (CHANGES_DONE, ("batch_id",)),
            "base": (self._base_schema, ("upto", *self._tags, HOUR)),
            "base_done": (BASE_DONE, ("upto",)),
            "redrive": (REDRIVEN, ()),
        }
        for name, (schema, partition_by) in layout.items():
            empty = self.spark.createDataFrame([], schema)
            empty.write.mode("ignore").partitionBy(*partition_by).parquet(f"{self.path}/{name}")
        return self

    def _read(self, name: str, schema: T.StructType) -> DataFrame:
        return self.spark.read.schema(schema).parquet(f"{self.path}/{name}")

    # -- writing ---------------------------------------------------------------------------

    def claim(self, stream_id: str) -> None:
        """Bind the table to a stream; raise if it belongs to another one."""
        owners.claim(self.spark, self.path, f"{self.path}/owner", stream_id)

    def _routes(self, decoded: DataFrame) -> DataFrame:
        """``decoded`` with its table; rows without a topic, or of one whose table is another's, are bad.

        Of topics that share a table name the one that came first has the table. A row of a new
        table keeps its payload, in case that another topic of the same batch has it.
        """
        known = self.topics().select(F.col(TABLE).alias("__known"), F.col("topic").alias("__owner"))
        named = decoded.withColumn(TABLE, table_name_column(F.col("topic")))
        named = named.join(known, F.col(TABLE) == F.col("__known"), "left")
        reason = F.when(F.col("topic").isNull(), NO_TOPIC).when(F.col("__owner") != F.col("topic"), TAKEN)
        named = named.withColumn(REASON, F.coalesce(REASON, reason))
        kept = F.when(F.col(REASON).isNotNull() | F.col("__owner").isNull(), F.col("value"))
        return named.withColumn("__kept", kept)

    def write_batch(self, decoded: DataFrame, batch_id: int) -> None:
        """One micro-batch of strictly decoded rows, good and bad, in one pass.

        A batch that was finished before is left alone: readers may be at it. One that was begun
        only is written anew.
        """
        if self._done().where(F.col("batch_id") == batch_id).head(1):
            return
        if self.routed:
            decoded = self._routes(decoded)
        bad = F.col(REASON).isNotNull()
        given = {c: F.col(f"`{c}`") for c in decoded.columns}
        rows = decoded.select(
            *[f.name for f in _ROW],
            F.when(~bad, F.col(HOUR)).alias(HOUR),
            *[given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in self._extra],
            (F.col("topic") if self.routed else F.col(f"{MESSAGE}.topic")).alias("topic"),
            (F.col("__kept") if self.routed else F.col(f"{MESSAGE}.value")).alias("value"),
            REASON,
            *self._tags,
            F.when(bad, "rejected").otherwise("accepted").alias("route"),
        )
        share = F.when(F.col("route") == "rejected", F.pmod(F.hash("partition", "offset", "value"), F.lit(REFUSED_SHARES)))
        near = rows_near(rows.withColumn(_SHARE, share), [*self._tags, "route", HOUR, _SHARE])
        near = near.sortWithinPartitions(*self._tags, "route", HOUR, "event_id").drop(_SHARE)
        folder = f"{self.path}/changes/batch_id={batch_id}"
        with settings(self.spark, SHARED):
            _overwrite(near, folder, *self._tags, "route")
        # Row counts come from the footers: no column is read.
        reader = self.spark.read.schema(self._changes_schema).option("basePath", f"{self.path}/changes")
        counts = [F.count(F.lit(1)).alias("rows"), F.count_if(F.col("route") == "rejected").alias("rejected")]
        nowhere = [F.lit(None).cast("string").alias(name) for name in (TABLE, "topic")]
        if self.routed:
            done = reader.parquet(folder).groupBy(TABLE, "topic").agg(*counts)
            done = done.unionByName(self.spark.range(1).select(*nowhere, F.lit(0).alias("rows"), F.lit(0).alias("rejected")))
        else:
            done = reader.parquet(folder).agg(*counts).select(*nowhere, "rows", "rejected")
        _overwrite(done.coalesce(1), f"{self.path}/changes_done/batch_id={batch_id}")

    def start(
        self, messages: DataFrame, checkpoint: str, *, every: str | None = COMMIT_INTERVAL
    ) -> StreamingQuery:
        """Decode a stream of messages, and what ``redrive`` publishes, and upsert it here."""
        self.create()
        claimed = []

        def write(batch: DataFrame, batch_id: int) -> None:
            table = UpsertFolder(batch.sparkSession, self.path, self.order, self.routed)
            if not claimed:
                table.claim(owners.stream_id(table.spark, checkpoint))
                claimed.append(True)
            table.write_batch(nested_ride_rows(batch), batch_id)

        again = landed_messages(self.spark, f"{self.path}/redrive")
        messages = messages.unionByName(again.select(*[c for c in S.MESSAGE.names]), allowMissingColumns=True)
        writer = messages.writeStream.foreachBatch(write)
        return with_trigger(writer.option("checkpointLocation", checkpoint), every).start()

    # -- reading ---------------------------------------------------------------------------

    def _done(self) -> DataFrame:
        return self._read("changes_done", CHANGES_DONE)

    def _compacted(self) -> DataFrame:
        return self._read("base_done", BASE_DONE)

    def _upto(self, at_most: int | None = None) -> int:
        """The last batch that is compacted, of compactions up to ``at_most``; -1 without any."""
        done = self._compacted()
        done = done if at_most is None else done.where(F.col("upto") <= at_most)
        latest = done.agg(F.max("upto")).first()[0]
        return -1 if latest is None else latest

    def last_batch(self) -> int:
        """The last finished batch; -1 without any."""
        latest = self._done().agg(F.max("batch_id")).first()[0]
        return -1 if latest is None else latest

    def _changes(self, route: str, after: int, upto: int | None = None) -> DataFrame:
        """Rows of finished batches in (after, upto]; other batches' files are not opened."""
        wanted = F.col("batch_id") > after
        if upto is not None:
            wanted = wanted & (F.col("batch_id") <= upto)
        rows = self._read("changes", self._changes_schema).where(wanted & (F.col("route") == route))
        rows = rows.join(self._done().where(wanted).select("batch_id").distinct(), "batch_id", "left_semi")
        if self.routed and route == "accepted":
            # The first topic of a table has it; rows that came before that was known are not in it.
            rows = rows.join(self.topics(), [TABLE, "topic"], "left_semi")
        return rows

    def _base(self, upto: int) -> DataFrame:
        """The newest rewrite, up to ``upto``, of each compacted hour."""
        hour = [*self._tags, HOUR]
        done = self._compacted().where(F.col("upto") <= upto)
        newest = done.groupBy(*hour).agg(F.max("upto").alias("upto"))
        # The plain bound keeps the files of an unfinished compaction out of the scan.
        base = self._read("base", self._base_schema).where(F.col("upto") <= upto)
        return base.join(newest, [*hour, "upto"], "left_semi").select(*self._state)

    def _latest(self, rows: DataFrame) -> DataFrame:
        return latest_per_key(rows, self.key, self._ranking)

    def _merged(self, after: int, upto: int | None = None) -> tuple[DataFrame, DataFrame]:
        """(last row per key of every hour touched by the batches in (after, upto], those hours)."""
        hour = [*self._tags, HOUR]
        fresh = self._changes("accepted", after, upto).select(*self._state)
        touched = fresh.select(*hour).distinct()
        if after < 0:
            return self._latest(fresh), touched
        before = self._base(after).join(touched, hour, "left_semi")
        return self._latest(fresh.unionByName(before)), touched

    def current(self) -> DataFrame:
        """The table as it stands. Hours not touched since the last compaction hold one
        row per key already and are read as they are; only touched hours are shuffled. A filter
        on ``event_hour`` reaches every scan. A routed folder shows all its tables, told apart by
        ``table_name``; a filter on it reads that table's files only."""
        upto = self._upto()
        state, touched = self._merged(upto)
        if upto >= 0:
            state = state.unionByName(self._base(upto).join(touched, [*self._tags, HOUR], "left_anti"))
        return state.select(*self._tags, *S.RIDE_TABLE.fieldNames())

    def topics(self) -> DataFrame:
        """(table_name, topic) of a routed folder: the topic that came first has the table."""
        seen = self._done().where(F.col(TABLE).isNotNull() & F.col("topic").isNotNull())
        return seen.groupBy(TABLE).agg(F.min_by("topic", F.struct("batch_id", "topic")).alias("topic"))

    def feed(self, after: int, upto: int) -> DataFrame:
        """What the batches in (after, upto] changed: the key, and the row ``before`` and ``after``.

        ``before`` is NULL for a new key. A key that was written but is as it was has no row, nor has
        one whose new rows are all older than what it had. The feed is read from the state as of
        ``after``, of the hours that were touched only; it is the same one after later batches,
        compactions and replays.
        """
        hour, row = [*self._tags, HOUR], [*self._tags, *S.RIDE_TABLE.fieldNames()]
        fresh = self._changes("accepted", after, upto).select(*self._state, F.lit(True).alias("__new"))
        touched = fresh.select(*hour).distinct()
        base = self._upto(after)
        old = self._changes("accepted", base, after).select(*self._state)
        if base >= 0:
            old = old.unionByName(self._base(base))
        old = old.join(touched, hour, "left_semi").withColumn("__new", F.lit(False))
        image = F.struct(*self._ranking, *[c for c in row if c not in self._ranking])
        images = old.unionByName(fresh).groupBy(*self.key).agg(
            F.max(F.when(~F.col("__new"), image)).alias("b"),
            F.max(image).alias("a"),
            F.max("__new").alias("__new"),
        )
        shown = {
            name: F.when(F.col(f"{source}.batch_id").isNotNull(), F.struct(*[F.col(f"{source}.{c}").alias(c) for c in row]))
            for name, source in (("before", "b"), ("after", "a"))
        }
        images = images.where("__new").select(*self.key, *[c.alias(name) for name, c in shown.items()])
        return images.where(~F.col("before").eqNullSafe(F.col("after")))

    def rejects(self) -> DataFrame:
        """Payloads that were refused, and why."""
        return self.rejected_messages().select(*S.REJECTS.fieldNames())

    def rejected_messages(self) -> DataFrame:
        """Refused messages as they came, with the reason and their batch."""
        columns = [*S.MESSAGE.names, REASON, "batch_id"]
        bad = self._changes("rejected", -1).select(*columns)
        if self.routed:
            # Rows of a new table whose name another topic of that batch had.
            good = self._read("changes", self._changes_schema).where("route = 'accepted' AND value IS NOT NULL")
            good = good.join(self._done().select("batch_id").distinct(), "batch_id", "left_semi")
            lost = good.join(self.topics(), [TABLE, "topic"], "left_anti").withColumn(REASON, F.lit(TAKEN))
            bad = bad.unionByName(lost.select(*columns))
        return bad

    # -- redrive ---------------------------------------------------------------------------

    def open_rejects(self) -> DataFrame:
        """Refused messages that were not published again so far."""
        done = self._read("redrive", REDRIVEN).select(*_WHERE_FROM, "refused")
        bad = self.rejected_messages().alias("r")
        done = done.alias("d")
        same = F.col("r.value").eqNullSafe(F.col("d.refused"))
        for name in _WHERE_FROM:
            same = same & F.col(f"r.{name}").eqNullSafe(F.col(f"d.{name}"))
        return bad.join(done, same, "left_anti")

    def redrive(self, repair: Callable[[DataFrame], DataFrame]) -> int:
        """Publish repaired messages for the stream to read again; returns how many.

        ``repair`` takes refused messages, with ``reject_reason``, and changes their ``value``. Only
        those that the decode now accepts are published, at the place and time at which they first
        came, so a repaired row takes its turn in the order of arrival and not the last one. The
        others stay open. What was published is not open again; if a run is lost half way, its next
        one may publish a message twice, which changes no row.
        """
        refused = self.open_rejects().withColumn("refused", F.col("value"))
        decoded = accepted(nested_ride_rows(repair(refused).select(*REDRIVEN.names)))
        if self.routed:
            decoded = decoded.where(F.col("topic").isNotNull())
        before = self._read("redrive", REDRIVEN).count()
        rows = conform(decoded, REDRIVEN)
        # The repaired messages are decoded behind the join with those that were published before.
        with settings(self.spark, SHARED):
            rows.write.mode("append").options(**PARQUET_OPTIONS).parquet(f"{self.path}/redrive")
        return self._read("redrive", REDRIVEN).count() - before

    # -- upkeep ----------------------------------------------------------------------------

    def compact(self) -> None:
        """Rewrite the hours touched since the last compaction, one row per key.

        Nothing is deleted and the old files stay readable until ``base_done`` names the new
        ones, so a lost run can simply be repeated. Not to be run twice at the same time. The
        settings of the caller's session stay as they are.
        """
        own = replace(self, spark=self.spark.newSession())
        for key, value in {**SETTINGS, **SPREAD}.items():
            own.spark.conf.set(key, value)
        own._compact()

    def _compact(self) -> None:
        before = self._upto()
        last = self._done().where(F.col("batch_id") > before).agg(F.max("batch_id")).first()[0]
        if last is None:
            return
        hour = [*self._tags, HOUR]
        # Batches that finish meanwhile are left to the next compaction.
        rows = self._rewrite(self._merged(before, last)[0], last)
        hours = rows.groupBy(*hour).agg(F.count(F.lit(1)).alias("rows"))
        if not self.routed:
            hours = hours.withColumn(TABLE, F.lit(None).cast("string"))
        _overwrite(hours.select(TABLE, HOUR, "rows").coalesce(1), f"{self.path}/base_done/upto={last}")

    def _rewrite(self, merged: DataFrame, upto: int) -> DataFrame:
        """Write what a compaction merged; returns the rows as they are read back."""
        hour, folder = [*self._tags, HOUR], f"{self.path}/base/upto={upto}"
        _overwrite(rows_near(merged, hour), folder, *hour)
        reader = self.spark.read.schema(self._base_schema).option("basePath", f"{self.path}/base")
        return reader.parquet(folder)


def _same(table: str, columns: tuple[str, ...]) -> Column:
    return F.expr(" AND ".join(f"{table}.{c} = s.{c}" for c in columns))


def upsert_to_table(
    messages: DataFrame,
    table: str,
    rejects_table: str,
    checkpoint: str,
    *,
    every: str | None = COMMIT_INTERVAL,
) -> StreamingQuery:
    """J1 into an Iceberg table, with MERGE. Both merges may be replayed without effect.

    The table has no columns of arrival, so order holds within a batch only: rows of an older batch
    that comes again after a newer one win. ``UpsertFolder`` compares orders between batches, too.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        decoded = nested_ride_rows(batch).persist()
        try:
            good = latest_per_key(accepted(decoded), S.RIDE_KEY, ARRIVAL)
            (
                conform(good, S.RIDE_TABLE)
                .alias("s")
                .mergeInto(table, _same(table, S.RIDE_KEY))
                .whenMatched()
                .updateAll()
                .whenNotMatched()
                .insertAll()
                .merge()
            )
            bad = decoded.where(F.col(REASON).isNotNull())
            bad = bad.select(f"{MESSAGE}.topic", f"{MESSAGE}.value", REASON, "partition", "offset")
            (
                conform(bad, REJECTED.schema)
                .alias("s")
                .mergeInto(rejects_table, _same(rejects_table, ("topic", "partition", "offset")))
                .whenNotMatched()
                .insertAll()
                .merge()
            )
        finally:
            decoded.unpersist()

    writer = messages.writeStream.foreachBatch(write)
    return with_trigger(writer.option("checkpointLocation", checkpoint), every).start()
