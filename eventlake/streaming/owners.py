"""One stream writes a folder for its whole life.

Spark counts a stream's batches from 0 under each new checkpoint. A folder that tells batches by
their numbers would take those of a second stream for its own, done before, and lose or overwrite
rows. So each such folder names its owner, and any other stream is refused before it writes.
"""

from __future__ import annotations

import json
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

OWNER = T.StructType([T.StructField("stream_id", T.StringType())])


def rows_of(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A Parquet folder, empty if there is none."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that a checkpoint has given its stream, the same one after every restart."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata", wholetext=True).head()[0])["id"]


def checkpoint_id(spark: SparkSession, checkpoint: str) -> str:
    """An id of a checkpoint, there before its first batch."""
    path = f"{checkpoint}/eventlake_id"
    if not rows_of(spark, path, OWNER).head(1):
        mine = spark.createDataFrame([(uuid.uuid4().hex,)], OWNER)
        mine.coalesce(1).write.mode("append").parquet(path)
    return min(r[0] for r in rows_of(spark, path, OWNER).head(2))


def claim(spark: SparkSession, path: str, owners: str, mine: str) -> None:
    """Bind the folder ``path`` to the writer ``mine``; raise if it belongs to another one.

    ``owners`` is where its owner is kept. Of two that claim an empty folder at once both see two
    owners, and both stop.
    """
    if not rows_of(spark, owners, OWNER).head(1):
        spark.createDataFrame([(mine,)], OWNER).coalesce(1).write.mode("append").parquet(owners)
    found = {r[0] for r in rows_of(spark, owners, OWNER).distinct().head(2)}
    if found != {mine}:
        raise ValueError(
            f"{path} is written by stream {sorted(found - {mine})[0]}, not {mine}: "
            "a table has one checkpoint for its whole life; start a new table or go on with that one"
        )
