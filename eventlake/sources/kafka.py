"""One topic as a stream of messages."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from eventlake.schemas import MESSAGE


def starting_offsets(choice: str) -> str:
    """``earliest`` in any case, anything else is ``latest``.

    It only says where a new query starts; a restarted one goes on from its checkpoint.
    """
    return "earliest" if choice.lower() == "earliest" else "latest"


def kafka_options(
    servers: str,
    topic: str,
    *,
    start: str = "earliest",
    client: Mapping[str, str] | None = None,
    max_offsets_per_trigger: int | None = None,
    min_partitions: int | None = None,
) -> dict[str, str]:
    """Reader options. ``client`` settings (security and the like) are passed through.

    ``max_offsets_per_trigger`` bounds a micro-batch when there is a backlog to catch up on.
    ``min_partitions`` splits a hot topic partition over several tasks.
    """
    options = {f"kafka.{k}": v for k, v in (client or {}).items()}
    options["kafka.bootstrap.servers"] = servers
    options["subscribe"] = topic
    options["startingOffsets"] = starting_offsets(start)
    if max_offsets_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    if min_partitions is not None:
        options["minPartitions"] = str(min_partitions)
    return options


def kafka_messages(spark: SparkSession, options: Mapping[str, str]) -> DataFrame:
    """The payload as text, with its arrival coordinates for the upsert order."""
    stream = spark.readStream.format("kafka").options(**options).load()
    return stream.select(*[stream[f.name].cast(f.dataType).alias(f.name) for f in MESSAGE])
