"""Declared schemas: wire fields, and the tables they land in. Nothing is inferred."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
}


@dataclass(frozen=True)
class Field:
    """One field read from a JSON document: column name, JSON path, one of ``TYPES``."""

    name: str
    path: str
    type: str

    @property
    def keys(self) -> list[str]:
        return self.path.removeprefix("$.").split(".")

    def of(self, row: str) -> str:
        """The field in a struct read with ``json_struct``, as SQL text."""
        return ".".join([row, *(f"`{key}`" for key in self.keys)])


def flat(name: str, type_: str) -> Field:
    return Field(name, f"$.{name}", type_)


def json_struct(fields: tuple[Field, ...]) -> T.StructType:
    """The declared fields, all as text, in a struct nested like the JSON document."""
    groups: dict[str, list[Field]] = {}
    for f in fields:
        groups.setdefault(f.keys[0], []).append(f)
    struct = T.StructType()
    for key, members in groups.items():
        if members[0].keys == [key]:
            struct.add(key, "string")
        else:
            inner = [Field(f.name, "$." + ".".join(f.keys[1:]), f.type) for f in members]
            struct.add(key, json_struct(tuple(inner)))
    return struct


# Nested ride event. Only these paths are read; `timestamp` is renamed on the way.
NESTED_RIDE = (
    flat("event_id", "string"),
    flat("user_id", "string"),
    flat("event_type", "string"),
    Field("event_timestamp", "$.timestamp", "bigint"),
    flat("ride_id", "string"),
    Field("surge_multiplier", "$.metadata.surge_multiplier", "double"),
    Field("estimated_wait_minutes", "$.metadata.estimated_wait_minutes", "int"),
    Field("fare_amount", "$.metadata.fare_amount", "double"),
    Field("driver_rating", "$.metadata.driver_rating", "double"),
)

# Flat ride event, the same columns at the top level.
FLAT_RIDE = tuple(flat(f.name, f.type) for f in NESTED_RIDE)

# B2: flat bid event. The wire also carries `flow_id`, which is not declared and so not read.
BID = (
    flat("event_name", "string"),
    flat("user_id", "bigint"),
    flat("city_id", "int"),
    flat("platform", "string"),
    flat("session_id", "string"),
    flat("timestamp_ms", "bigint"),
)


def struct_of(fields: tuple[Field, ...], nullable: bool = True) -> T.StructType:
    return T.StructType(
        [T.StructField(f.name, TYPES[f.type], nullable) for f in fields]
    )


# R2: upsert table; every column is required. Key (event_id, event_hour).
RIDE_TABLE = T.StructType(
    struct_of(NESTED_RIDE, nullable=False).fields
    + [T.StructField("event_hour", T.StringType(), False)]
)
RIDE_KEY = ("event_id", "event_hour")

# Append table by day.
RIDE_DAY_TABLE = T.StructType(
    struct_of(FLAT_RIDE).fields + [T.StructField("event_date", T.StringType())]
)

# Append table with event and ingestion time.
BID_TABLE = T.StructType(
    [f for f in struct_of(BID).fields if f.name != "timestamp_ms"]
    + [
        T.StructField("event_time", T.TimestampNTZType()),
        T.StructField("ingestion_time", T.TimestampNTZType()),
    ]
)

# Rows that strict decoding set aside.
REJECTS = T.StructType(
    [
        T.StructField("topic", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("reject_reason", T.StringType()),
    ]
)

# What a topic delivers: the payload, and where and when it arrived.
MESSAGE = T.StructType(
    [
        T.StructField("value", T.StringType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)
