"""What several operators share: reading tables, cutting lineage, connected components."""

from __future__ import annotations

import os
import pathlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.session import shared_root

# Fixed value: the words of the operators' contracts.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def importable(spark: SparkSession) -> SparkSession:
    """Let Python workers import this library from where the driver has it, whatever its folder."""
    root = str(pathlib.Path(__file__).resolve().parents[2])
    environment = spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join(p for p in (root, *paths) if p)
    return spark


def reliable(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder, so that lost executors cost no recomputation."""
    sc = df.sparkSession.sparkContext
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(f"{shared_root(df.sparkSession)}/checkpoints")
    return df.checkpoint()


def least_hashed(rows: DataFrame, n: int, key: str) -> DataFrame:
    """About ``n`` rows, those whose keys have the least hashes: the same ones each time.

    Only hashes are sorted, so whole rows stay where they are; rows that share a key are all in.
    """
    least = rows.select(F.xxhash64(key).alias("h")).orderBy("h").limit(n)
    top = least.agg(F.max("h")).first()[0]
    return rows.where(F.lit(False)) if top is None else rows.where(F.xxhash64(key) <= top)


def text_hash(text: str) -> Column:
    """What tells rows of one key apart: a hash of the text."""
    return F.xxhash64(F.col(f"`{text}`"))


def unused(docs: DataFrame, *names: str) -> list[str]:
    """Names for columns of one's own that no column of ``docs`` has, in any case."""
    taken, out = {c.lower() for c in docs.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def least_rows(docs: DataFrame, named: DataFrame, key: str, text: str) -> DataFrame:
    """``docs`` with one row of each component: the least key's, NULL the last, then the least hash's.

    ``named`` has (key, hash, component), ``hash`` that of ``text_hash``. Rows are told apart by key
    and text, so equal or NULL keys with other texts are rows of their own.
    """
    order = F.struct(F.col("key").isNull().alias("last"), "key", "hash")
    least = named.groupBy("component").agg(F.min(order).alias("r"))
    own_key, own_hash, hashed_as = unused(docs, "_key", "_hash", "_text_hash")
    least = least.select(F.col("r.key").alias(own_key), F.col("r.hash").alias(own_hash))
    names = [f"`{c}`" for c in docs.columns]
    key_as = unused(docs, "_key_of", own_key, own_hash, hashed_as)[0]
    hashed = docs.select(*names, F.col(f"`{key}`").alias(key_as), text_hash(text).alias(hashed_as))
    same = F.col(key_as).eqNullSafe(F.col(own_key)) & (F.col(hashed_as) == F.col(own_hash))
    return hashed.join(least, same, "left_semi").dropDuplicates([key_as, hashed_as]).select(*names)


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of an undirected graph: (node, component), component the least node.

    ``edges`` has two columns of one orderable type. Alternating large-star and small-star rounds
    (Kiveris et al., 2014) turn each component into a star around its least node. A round costs
    two aggregations with map-side combining and two equi-joins, which adaptive execution can split
    at a hub. Nothing reaches the driver but a checksum a round. Nodes without an edge, loops and
    edges with a NULL end give no row or no effect: callers keep single nodes themselves.
    """
    u, v = edges.columns
    pairs = edges.select(F.col(u).alias("u"), F.col(v).alias("v")).where("u <> v")
    star = pairs.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    star, before = reliable(star), None
    for _ in range(max_rounds):
        both = star.union(star.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        large = (
            both.join(least, "u")
            .where("v > u")
            .select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
            .distinct()
        )
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        star = reliable(
            small.select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(small.select("u", F.col("m").alias("v")))
            .where("u <> v")
            .distinct()
        )
        now = star.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            leaves = star.select(F.col("u").alias("node"), F.col("v").alias("component"))
            return leaves.union(leaves.select("component", "component").distinct())
        before = now
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
