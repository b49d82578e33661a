"""Session settings and the shared scratch folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# The time columns are wall clock in the session zone, repeated JSON keys must resolve to
# the last one, and the skew-splitting writes need adaptive execution. Merged shuffle pieces
# keep to the advisory size rather than to the number of cores, so that a micro-batch on a
# large cluster does not end up as one small file per core. The JVM compiles no method above
# 8000 bytes of bytecode, so a decode of many fields is better split into small ones.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def configure(spark: SparkSession, **overrides: str) -> SparkSession:
    """Apply the settings every operator here relies on."""
    for key, value in {**SETTINGS, **overrides}.items():
        spark.conf.set(key, value)
    return spark


# For writes split by a partition column: each of its values goes to one task anyway, so
# spreading the values over all tasks adds no file.
SPREAD = {
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "true",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1",
}

# For stages whose work is heavy for their size, such as decodes and sorts of wide rows: all cores
# share them as soon as each gets a few megabytes, which still makes a file of a fair size.
SHARED = {
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "true",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "4m",
}


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Apply settings for one action, then put back what was there."""
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def shared_root(spark: SparkSession) -> str:
    """The folder for intermediate tables: ``spark.checkpoint.dir``, else one in the warehouse.

    Both are shared by all executors of a cluster. A warehouse on a local disk is accepted only
    with a local master.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    warehouse = spark.conf.get("spark.sql.warehouse.dir")
    on_disk = warehouse.startswith(("file:", "/")) or ":" not in warehouse
    if on_disk and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return f"{warehouse.rstrip('/')}/_eventlake"


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder under the cluster's shared folder."""
    return f"{shared_root(spark)}/eventlake-{label}-{uuid.uuid4().hex}"
