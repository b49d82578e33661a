"""An upsert folder whose compacted rows are dealt by key, so that merging moves changes only."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlake.session import settings
from eventlake.streaming.tables import PARQUET_OPTIONS
from eventlake.streaming.upsert import HOUR, UpsertFolder

BUCKET_BY = "event_id"
# Lists of hours up to this many rows, of some 40 bytes each, are broadcast; longer ones are shuffled.
FEW_HOURS = 200_000


@dataclass(frozen=True)
class BucketedUpsertFolder(UpsertFolder):
    """An upsert folder that compacts into the catalog table ``table``, bucketed by ``event_id``.

    The changes since the last compaction are cut to one row per key and dealt into as many
    buckets, then merged with the table bucket by bucket: however large the table has grown, only
    changes are shuffled. A table is partitioned by hour as well, so a filter on ``event_hour``
    reads that hour's files only. An hour that holds a third of all rows lies in all buckets, and a
    key has one row in each hour at most, so no bucket grows out of its size. ``buckets`` is fixed
    for the table's life; choose it so that an hour's share of a bucket is a file of a fair size.

    The table's files lie in the folder, and ``base_done`` says which of them count, so a lost
    compaction is simply repeated. ``create`` finds the files again if the catalog lost the table.
    """

    table: str = ""
    buckets: int = 64

    @property
    def _partitions(self) -> list[str]:
        return ["upto", *self._tags, HOUR]

    def create(self) -> BucketedUpsertFolder:
        super().create()
        location = f"{self.path}/buckets"
        if self.spark.catalog.tableExists(self.table):
            told = {r["col_name"]: r["data_type"] for r in self.spark.sql(f"DESCRIBE FORMATTED {self.table}").collect()}
            if told["Num Buckets"] != str(self.buckets) or not told["Location"].endswith(location.split(":")[-1]):
                raise ValueError(f"{self.table} has {told['Num Buckets']} buckets in {told['Location']}")
            return self
        # The folder must be there when the catalog looks for partitions.
        empty = self.spark.createDataFrame([], self._base_schema)
        empty.write.mode("ignore").partitionBy(*self._partitions).parquet(location)
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self._base_schema)
        options = ", ".join(f"'{k}' = '{v}'" for k, v in PARQUET_OPTIONS.items())
        self.spark.sql(
            f"CREATE TABLE {self.table} ({columns}) USING parquet OPTIONS ({options})"
            f" PARTITIONED BY ({', '.join(self._partitions)})"
            f" CLUSTERED BY ({BUCKET_BY}) SORTED BY ({BUCKET_BY}) INTO {self.buckets} BUCKETS"
            f" LOCATION '{location}'"
        )
        self.spark.catalog.recoverPartitions(self.table)
        return self

    def compact(self) -> None:
        self.create()
        super().compact()

    def current(self) -> DataFrame:
        self.create()
        return super().current()

    def _few(self, hours: DataFrame) -> DataFrame:
        """``hours`` for a join that leaves the table's rows where they are, if they are few."""
        return F.broadcast(hours) if hours.count() <= FEW_HOURS else hours

    def _base(self, upto: int) -> DataFrame:
        hour = [*self._tags, HOUR]
        newest = self._compacted().where(F.col("upto") <= upto).groupBy(*hour).agg(F.max("upto").alias("upto"))
        base = self.spark.table(self.table).where(F.col("upto") <= upto)
        return base.join(self._few(newest), [*hour, "upto"], "left_semi").select(*self._state)

    def _merged(self, after: int, upto: int | None = None) -> tuple[DataFrame, DataFrame]:
        hour = [*self._tags, HOUR]
        fresh = self._changes("accepted", after, upto).select(*self._state)
        touched = self._few(fresh.select(*hour).distinct())
        # Cut first, so that a hot key is dealt as one row.
        dealt = self._latest(fresh).repartition(self.buckets, BUCKET_BY)
        if after < 0:
            return dealt, touched
        before = self._base(after).join(touched, hour, "left_semi")
        return self._latest(dealt.unionByName(before)), touched

    def _rewrite(self, merged: DataFrame, upto: int) -> DataFrame:
        rows = merged.withColumn("upto", F.lit(upto).cast("long")).select(*self._base_schema.names)
        # Only the hours that were merged are written; those of a lost run are written over.
        with settings(self.spark, {"spark.sql.sources.partitionOverwriteMode": "dynamic"}):
            rows.write.insertInto(self.table, overwrite=True)
        return self.spark.table(self.table).where(F.col("upto") == upto)
