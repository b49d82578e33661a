"""Aggregates of an upsert table that are kept from its change feed and never recomputed.

``HourlyCounts`` holds rows and fares per hour and event type. Each advance reads the images before
and after of what changed since the last one, takes the old images away and adds the new ones, and
writes the difference: ``deltas/upto=N``, finished by ``deltas_done/upto=N``. The cost of an advance
follows what changed; ``fold`` sums up the differences so far.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventlake.session import SHARED, settings
from eventlake.streaming.owners import rows_of
from eventlake.streaming.tables import PARQUET_OPTIONS
from eventlake.streaming.upsert import HOUR, TABLE, UpsertFolder

# Fares are summed as decimals, so that what is added can be taken away without a trace.
FARE = T.DecimalType(38, 6)
_KEY = [T.StructField(name, T.StringType()) for name in (TABLE, HOUR, "event_type")]
DELTAS = T.StructType(
    [*_KEY, T.StructField("n_rows", T.LongType()), T.StructField("fares", FARE), T.StructField("upto", T.LongType())]
)
DONE = T.StructType([T.StructField("after", T.LongType()), T.StructField("upto", T.LongType())])


@dataclass(frozen=True)
class HourlyCounts:
    """Rows and fares of an upsert table per hour and event type, in a folder of their own."""

    spark: SparkSession
    path: str

    def _done(self) -> DataFrame:
        return rows_of(self.spark, f"{self.path}/deltas_done", DONE)

    def _last(self, name: str) -> int:
        last = rows_of(self.spark, f"{self.path}/{name}", DONE).agg(F.max("upto")).first()[0]
        return -1 if last is None else last

    def position(self) -> int:
        """The last batch that is counted; -1 before the first."""
        return self._last("deltas_done")

    def _write(self, rows: DataFrame, name: str, after: int, upto: int) -> None:
        """Sums first, the marker last: readers see none without it, and a run that was lost is
        repeated from where it began."""
        writer = rows.write.mode("overwrite").options(**PARQUET_OPTIONS)
        writer.parquet(f"{self.path}/{name}/upto={upto}")
        done = self.spark.createDataFrame([(after,)], DONE[:1]).coalesce(1)
        done.write.mode("overwrite").options(**PARQUET_OPTIONS).parquet(f"{self.path}/{name}_done/upto={upto}")

    def advance(self, table: UpsertFolder) -> int:
        """Count what ``table`` changed since the last advance; returns the batch counted up to."""
        after, upto = self.position(), table.last_batch()
        if upto > after:
            feed = table.feed(after, upto)
            images = F.array(
                F.struct(F.lit(-1).alias("sign"), F.col("before").alias("row")),
                F.struct(F.lit(1).alias("sign"), F.col("after").alias("row")),
            )
            signed = feed.select(F.explode(images).alias("i")).where("i.row IS NOT NULL").select("i.sign", "i.row.*")
            if TABLE not in signed.columns:
                signed = signed.withColumn(TABLE, F.lit(None).cast("string"))
            fare = (F.col("sign") * F.col("fare_amount").cast(FARE)).cast(FARE)
            sums = _summed(signed, F.sum("sign"), F.sum(fare))
            with settings(table.spark, SHARED):
                self._write(sums.where("n_rows <> 0 OR fares <> 0"), "deltas", after, upto)
        return max(after, upto)

    def _sums(self) -> DataFrame:
        folded, counted = self._last("folded_done"), self.position()
        rows = rows_of(self.spark, f"{self.path}/deltas", DELTAS)
        rows = rows.where((F.col("upto") > folded) & (F.col("upto") <= counted))
        if folded >= 0:
            whole = rows_of(self.spark, f"{self.path}/folded", DELTAS)
            rows = rows.unionByName(whole.where(F.col("upto") == folded))
        sums = _summed(rows, F.sum("n_rows"), F.sum("fares"))
        return sums.where("n_rows <> 0")

    def read(self) -> DataFrame:
        """(table_name, event_hour, event_type, n_rows, fares) as of the last advance.

        ``table_name`` is NULL for a table that is not routed.
        """
        return self._sums()

    def fold(self) -> None:
        """Sum up the differences so far. Nothing is deleted, so readers go on."""
        upto = self.position()
        if upto > self._last("folded_done"):
            self._write(self._sums(), "folded", -1, upto)


def _summed(rows: DataFrame, n: Column, fares: Column) -> DataFrame:
    return rows.groupBy(*[f.name for f in _KEY]).agg(n.cast("long").alias("n_rows"), fares.cast(FARE).alias("fares"))
