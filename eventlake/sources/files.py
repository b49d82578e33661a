"""Files as streams of messages: the stand-in for a broker in tests and backfills."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.schemas import MESSAGE


def _reader(spark: SparkSession, max_files: int | None):
    reader = spark.readStream
    return reader if max_files is None else reader.option("maxFilesPerTrigger", max_files)


def text_messages(
    spark: SparkSession, path: str, topic: str, *, max_files: int | None = None
) -> DataFrame:
    """Text files, one payload per line. Lines carry no order of arrival: an upsert
    needs one from the payload."""
    lines = _reader(spark, max_files).text(path)
    return lines.select("value", F.lit(topic).alias("topic"))


def landed_messages(
    spark: SparkSession, path: str, *, max_files: int | None = None
) -> DataFrame:
    """Parquet files of whole messages (payload, topic, partition, offset, timestamp)."""
    return _reader(spark, max_files).schema(MESSAGE).parquet(path)
