"""K1 to K5, K8, K9: create tables if absent, in a catalog.

An existing table is left as it is and is not checked against the schema.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventlake import schemas as S

# Table properties of the lake tables.
ICEBERG_PROPERTIES = {
    "format-version": "2",
    "write.format.default": "parquet",
    "write.parquet.compression-codec": "snappy",
}
UPSERT_PROPERTIES = {**ICEBERG_PROPERTIES, "write.upsert.enabled": "true"}
PARQUET_OPTIONS = {"compression": "snappy"}


@dataclass(frozen=True)
class TableSpec:
    schema: T.StructType
    partition_by: tuple[str, ...] = ()
    properties: dict[str, str] = field(default_factory=lambda: dict(ICEBERG_PROPERTIES))


RIDES = TableSpec(S.RIDE_TABLE, ("event_hour",), UPSERT_PROPERTIES)
RIDE_DAYS = TableSpec(S.RIDE_DAY_TABLE, ("event_date",))
BIDS = TableSpec(S.BID_TABLE)
# Rejects are keyed by where they arrived, so that a replayed batch adds nothing.
REJECTED = TableSpec(
    T.StructType(
        S.REJECTS.fields
        + [T.StructField("partition", T.IntegerType()), T.StructField("offset", T.LongType())]
    )
)


def _quoted(entries: dict[str, str]) -> str:
    return ", ".join(f"'{k}' = '{v}'" for k, v in entries.items())


def create_table_sql(
    name: str, spec: TableSpec, provider: str = "iceberg", location: str | None = None
) -> str:
    """The DDL. Parquet tables cannot enforce NOT NULL, so only Iceberg is told of it.

    Without a ``location`` the catalog chooses one, for Parquet in its warehouse folder.
    """
    iceberg = provider == "iceberg"
    columns = ", ".join(
        f"{f.name} {f.dataType.simpleString()}"
        + (" NOT NULL" if iceberg and not f.nullable else "")
        for f in spec.schema
    )
    parts = [f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING {provider}"]
    if not iceberg:
        parts.append(f"OPTIONS ({_quoted(PARQUET_OPTIONS)})")
    if spec.partition_by:
        parts.append(f"PARTITIONED BY ({', '.join(spec.partition_by)})")
    if location:
        parts.append(f"LOCATION '{location}'")
    if iceberg:
        parts.append(f"TBLPROPERTIES ({_quoted(spec.properties)})")
    return " ".join(parts)


def create_namespace(spark: SparkSession, namespace: str) -> None:
    """K4: the catalog itself is named by ``spark.sql.catalog.*`` settings of the caller."""
    spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {namespace}")


def create_table(
    spark: SparkSession,
    name: str,
    spec: TableSpec,
    provider: str = "iceberg",
    location: str | None = None,
) -> None:
    spark.sql(create_table_sql(name, spec, provider, location))


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Bind columns to the table by name; a missing one is an error, extra ones are dropped."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])


def rows_near(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Bring rows of the same partition together before a write, for files of a fair size.

    ``rebalance`` lets adaptive execution merge small pieces and split large ones, so an hour
    or day with a third of all rows is written by many tasks.
    """
    return df.hint("rebalance", *columns)
