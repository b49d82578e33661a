"""Which fields payloads really have, declared or not."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlake.schemas import Field

DEPTH = 3


def _kind(value: str) -> Column:
    """The JSON type of a variant: whole and other numbers are told apart, their widths are not."""
    schema = F.schema_of_variant(value)
    kind = F.when(schema == "VOID", "null").when(schema == "BOOLEAN", "boolean").when(schema == "STRING", "text")
    kind = kind.when(schema.startswith("OBJECT"), "object").when(schema.startswith("ARRAY"), "array")
    whole = (schema == "BIGINT") | schema.rlike(r"^DECIMAL\(\d+,0\)$")
    return kind.when(whole, "whole number").otherwise("number")


def field_census(
    df: DataFrame, value: str, hour: Column, by: Sequence[str] = (), *, depth: int = DEPTH
) -> DataFrame:
    """(*by, path, kind, n, first_hour, last_hour) over all payloads in ``value``.

    Paths are those of the declared fields (``$.a.b``), elements of arrays are ``[*]``. Objects and
    arrays are listed themselves and looked into, up to ``depth`` levels. A payload that does not
    parse or is no object, and NULL, is listed as ``$`` of kind ``unreadable``. Each payload is
    parsed once; counts are added up per task before the one shuffle.
    """
    rows = df.select(*by, hour.alias("hour"), F.try_parse_json(value).alias("v0"))
    readable = F.coalesce(_kind("v0") == "object", F.lit(False))
    rows = rows.withColumn("v0", F.when(readable, F.col("v0"))).withColumn("path0", F.lit("$"))
    for level in range(1, depth + 1):
        rows = _opened(rows, level)
    # A row is one innermost field; a field around it is listed with its first one only.
    first, nodes = F.lit(True), []
    for level in range(depth, 0, -1):
        place = F.col(f"pos{level}")
        node = F.struct(F.col(f"path{level}").alias("path"), _kind(f"v{level}").alias("kind"))
        nodes.append(F.when(place.isNotNull() & first, node))
        first = first & (F.coalesce(place, F.lit(0)) == 0)
    unreadable = F.struct(F.lit("$").alias("path"), F.lit("unreadable").alias("kind"))
    nodes.append(F.when(F.col("v0").isNull(), unreadable))
    listed = rows.select(*by, "hour", F.explode(F.array_compact(F.array(*nodes))).alias("f"))
    return listed.groupBy(*by, "f.path", "f.kind").agg(
        F.count(F.lit(1)).alias("n"), F.min("hour").alias("first_hour"), F.max("hour").alias("last_hour")
    )


def _opened(rows: DataFrame, level: int) -> DataFrame:
    """One level more: the members of each object or array, or one row without any."""
    inside = rows.sparkSession.tvf.variant_explode_outer(F.col(f"v{level - 1}").outer()).select(
        F.col("pos").alias(f"pos{level}"), F.col("key").alias(f"key{level}"), F.col("value").alias(f"v{level}")
    )
    parent, key = F.col(f"path{level - 1}"), F.col(f"key{level}")
    path = F.when(key.isNull(), F.concat(parent, F.lit("[*]"))).otherwise(F.concat(parent, F.lit("."), key))
    return rows.lateralJoin(inside).withColumn(f"path{level}", path)


def undeclared(census: DataFrame, fields: Sequence[Field]) -> DataFrame:
    """The rows of a census whose path no declared field has or leads through."""
    paths = {f.path for f in fields}
    around = {p.rpartition(".")[0] for p in paths} | {"$"}
    return census.where(~F.col("path").isin(*sorted(paths | around)) | (F.col("kind") == "unreadable"))
