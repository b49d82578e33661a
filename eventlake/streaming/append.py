"""K7: the append sink, and the sink of changing rows.

Both belong to one stream for their whole life; another checkpoint is refused (see ``owners``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery

from eventlake.operators.upsert import latest_per_key
from eventlake.streaming import owners
from eventlake.streaming.runs import COMMIT_INTERVAL, with_trigger
from eventlake.streaming.tables import PARQUET_OPTIONS, conform, rows_near


def _writer(rows: DataFrame, checkpoint: str, every: str | None):
    writer = rows.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    return with_trigger(writer, every)


def _begun(spark: SparkSession, path: str) -> bool:
    """Whether there is anything at ``path``."""
    try:
        return bool(spark.read.format("text").option("wholetext", True).load(path).limit(1).head(1))
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return False


def _own(spark: SparkSession, path: str, checkpoint: str) -> None:
    """Claim an append folder before its stream starts.

    The sink keeps a log of batches, in which it would take those of another stream for done. A
    folder that was begun before owners were kept belongs to whoever has a begun checkpoint.
    """
    adopted = _begun(spark, f"{path}/_spark_metadata") and not owners.rows_of(spark, f"{path}/_owner", owners.OWNER).head(1)
    if adopted and not _begun(spark, f"{checkpoint}/metadata"):
        raise ValueError(f"{path} was written by a stream with another checkpoint than {checkpoint}")
    owners.claim(spark, path, f"{path}/_owner", owners.checkpoint_id(spark, checkpoint))


def append_to_path(
    rows: DataFrame,
    schema: T.StructType,
    path: str,
    checkpoint: str,
    *,
    partition_by: Sequence[str] = (),
    every: str | None = COMMIT_INTERVAL,
    stateful: bool = False,
) -> StreamingQuery:
    """Append to a Parquet folder, exactly once; duplicates in the input stay.

    Rows of a ``stateful`` query are written as they come: they are aggregates, so few, and
    adaptive execution does not apply there. A folder that another stream writes, also the same one
    under a new checkpoint, is refused before anything is read.
    """
    path = path.rstrip("/")
    _own(rows.sparkSession, path, checkpoint)
    rows = conform(rows, schema)
    if not stateful:
        rows = rows_near(rows, partition_by)
    writer = _writer(rows, checkpoint, every).format("parquet").options(**PARQUET_OPTIONS)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return writer.start(path)


def append_to_table(
    rows: DataFrame,
    schema: T.StructType,
    table: str,
    checkpoint: str,
    *,
    partition_by: Sequence[str] = (),
    every: str | None = COMMIT_INTERVAL,
) -> StreamingQuery:
    """Append to a catalog table that ``create_table`` made.

    A Parquet table is a folder to the sink, so it is claimed as one; other formats keep track of
    their streams themselves.
    """
    spark = rows.sparkSession
    about = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
    if about.get("Provider", "").lower() == "parquet":
        _own(spark, about["Location"].rstrip("/"), checkpoint)
    rows = rows_near(conform(rows, schema), partition_by)
    return _writer(rows, checkpoint, every).toTable(table)


def update_to_path(
    rows: DataFrame, schema: T.StructType, path: str, checkpoint: str, *, every: str | None = COMMIT_INTERVAL
) -> StreamingQuery:
    """Write what each micro-batch has changed, open windows too, for ``read_updated``.

    ``batches/batch_id=N`` is a batch and ``done/batch_id=N`` says that it is whole. A finished batch
    is left alone when it is replayed, so no reader sees its rows vanish; one that was only begun is
    written anew.
    """
    path, claimed = path.rstrip("/"), []

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if not claimed:
            owners.claim(spark, path, f"{path}/owner", owners.stream_id(spark, checkpoint))
            claimed.append(True)
        if owners.rows_of(spark, f"{path}/done", _DONE).where(F.col("batch_id") == batch_id).head(1):
            # The windows' state still has to take the batch in.
            batch.write.format("noop").mode("overwrite").save()
            return
        writer = conform(batch, schema).write.mode("overwrite").options(**PARQUET_OPTIONS)
        writer.parquet(f"{path}/batches/batch_id={batch_id}")
        done = spark.createDataFrame([(True,)], _DONE[:1]).coalesce(1)
        done.write.mode("overwrite").parquet(f"{path}/done/batch_id={batch_id}")

    writer = rows.writeStream.outputMode("update").foreachBatch(write)
    return with_trigger(writer.option("checkpointLocation", checkpoint), every).start()


_BATCH_ID = T.StructField("batch_id", T.LongType())
_DONE = T.StructType([T.StructField("whole", T.BooleanType()), _BATCH_ID])


def read_updated(spark: SparkSession, schema: T.StructType, path: str, keys: Sequence[str]) -> DataFrame:
    """The latest state of each key that ``update_to_path`` wrote, of whole batches only."""
    path = path.rstrip("/")
    rows = owners.rows_of(spark, f"{path}/batches", T.StructType([*schema.fields, _BATCH_ID]))
    rows = rows.join(owners.rows_of(spark, f"{path}/done", _DONE).select("batch_id"), "batch_id", "left_semi")
    return latest_per_key(rows, keys, ["batch_id"]).select(*[f"`{f.name}`" for f in schema.fields])


def read_appended(spark: SparkSession, schema: T.StructType, path: str) -> DataFrame:
    """Read an append folder. The declared schema keeps day strings from becoming dates."""
    return spark.read.schema(schema).parquet(path)
