"""Mixing sources to target weights by repeating documents. DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventlake.llm.common import WORD, reliable, unused

MAX_REPEAT = 3
SEEDS = 16
# About 100 bytes a source: at most some 10 MB are broadcast.
BROADCAST_SOURCES = 100_000
# 15 hexadecimal digits of an MD5: an integer that both a BIGINT and an exact ratio can hold.
DRAWS = 1 << 60


def words(text: Column) -> Column:
    """Number of words; 0 for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def draw(key: Column, seed: Column) -> Column:
    """A hash of document and seed, uniform on [0, 1)."""
    text = F.concat_ws("|", seed.cast("string"), F.coalesce(key.cast("string"), F.lit("null")))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("double") / F.lit(float(DRAWS))


def weights(sources: DataFrame) -> DataFrame:
    """Add ``weight`` 1, 2, 3, 1, ... by code point of ``source``, NULL last.

    Ranks come from a range partitioning and one small count per partition, so that sources may
    be many: no task holds all of them.
    """
    dealt = sources.repartitionByRange(F.col("source").asc_nulls_last())
    dealt = reliable(dealt.withColumn("part", F.spark_partition_id()))
    counts = {r["part"]: r["n"] for r in dealt.groupBy("part").agg(F.count("*").alias("n")).collect()}
    starts, total = [], 0
    for part in sorted(counts):  # one number for each task, not for each source
        starts.append((part, total))
        total += counts[part]
    schema = T.StructType([T.StructField("part", T.IntegerType()), T.StructField("first", T.LongType())])
    first = sources.sparkSession.createDataFrame(starts, schema)
    order = "row_number() OVER (PARTITION BY part ORDER BY source NULLS LAST)"
    ranked = dealt.join(first, "part").withColumn("rank", F.expr(f"first + {order} - 1"))
    return ranked.withColumn("weight", F.col("rank") % 3 + 1).drop("part", "first", "rank")


def targets(sources: DataFrame, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """Add ``target`` to (source, source_size, weight).

    All sizes are shared by weight. A target above ``max_repeat`` times its source's size stops
    there and its excess is shared again by weight among the others, until none is above. A round
    is one aggregation, and at least one source stops in it; usually two or three rounds do.
    """
    sources = reliable(sources.withColumn("room", max_repeat * F.col("source_size")))
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    share, n, stopped = None, -1, F.lit(False)
    while True:
        sums = sources.agg(
            F.sum(F.when(stopped, F.col("room"))).alias("full"),
            F.sum(F.when(~stopped, F.col("weight"))).alias("weight"),
            F.count_if(stopped).alias("n"),
        ).first()
        if share is not None and sums["n"] == n:
            break
        n = sums["n"]
        # The whole share is an exact integer; only this quotient is rounded, once.
        share = (total - (sums["full"] or 0)) / sums["weight"] if sums["weight"] else 0.0
        stopped = stopped | (F.col("weight") * F.lit(float(share)) > F.col("room"))
    target = F.when(stopped, F.col("room").cast("double")).otherwise(F.col("weight") * F.lit(float(share)))
    return sources.withColumn("target", target).drop("room")


def plan(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source") -> tuple:
    """(sized documents, sources with target, rate and seed).

    A copy is drawn by hash, so a source's total scatters about its target, most where it has few
    documents. Of ``SEEDS`` hash seeds each source takes the one whose draws come nearest, ties
    to the smaller: any one of them gives every document the same chance, and reruns agree.
    """
    sized = reliable(
        docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{source}`").alias("source"), words(F.col(f"`{text}`")).alias("size"))
    )
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    sources = targets(weights(sources))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(1.0))
    sources = reliable(sources.withColumn("rate", rate))
    rates = small(sources.select("source", "rate"))
    trial = sized.join(rates, sized["source"].eqNullSafe(rates["source"]))
    trial = trial.select(sized["source"], "key", "size", "rate")
    got = [
        F.sum(F.col("size") * copies(F.col("key"), F.col("rate"), F.lit(s))).alias(f"got{s}")
        for s in range(SEEDS)
    ]
    took = trial.groupBy("source").agg(*got)
    joined = sources.join(took.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")), "left")
    miss = [
        F.struct(F.abs(F.coalesce(F.col(f"got{s}"), F.lit(0)) - F.col("target")).alias("miss"), F.lit(s).alias("seed"))
        for s in range(SEEDS)
    ]
    best = F.array_min(F.array(*miss))["seed"]
    return sized, reliable(joined.select("source", "source_size", "target", "rate", best.alias("seed")))


def small(sources: DataFrame) -> DataFrame:
    """Broadcast the per-source table if it is small; beyond that Spark joins by shuffle, and
    adaptive execution splits a source that holds most rows."""
    return F.broadcast(sources) if sources.count() <= BROADCAST_SOURCES else sources


def copies(key: Column, rate: Column, seed: Column) -> Column:
    """floor(rate) copies, and one more with the chance of the fraction."""
    whole = F.floor(rate)
    return (whole + (draw(key, seed) < rate - whole).cast("long")).cast("long")


def mix_counts(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """How often the mix takes each row: (key, size, source, source_size, target, n_copies).

    Rows with one key share their draws, so repeated rows are taken alike. A source without any
    word keeps its documents once. NULL text has size 0; NULL is a source of its own, the last.
    An empty table gives no row.
    """
    sized, sources = plan(docs, key, text, source)
    n = copies(F.col("key"), F.col("rate"), F.col("seed"))
    sources = small(sources)
    rows = sized.join(sources, sized["source"].eqNullSafe(sources["source"]))
    return rows.select("key", "size", sized["source"], "source_size", "target", n.alias("n_copies"))


def mix(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it, with its own columns and no other,
    whatever they are called."""
    _, sources = plan(docs, key, text, source)
    name, rate, seed, copy = unused(docs, "_mix_source", "_mix_rate", "_mix_seed", "_mix_copy")
    sources = sources.select(F.col("source").alias(name), F.col("rate").alias(rate), F.col("seed").alias(seed))
    rows = docs.join(small(sources), F.col(f"`{source}`").eqNullSafe(F.col(name)))
    n = copies(F.col(f"`{key}`"), F.col(rate), F.col(seed))
    names = [f"`{c}`" for c in docs.columns]
    rows = rows.select(*names, F.explode(F.array_repeat(F.lit(0), n.cast("int"))).alias(copy))
    return rows.select(*names)
