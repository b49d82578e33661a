"""Joins by time: of two streams within a bound, and with a reference table as of an event."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_MICROS = 1_000_000


def _micros(span: dt.timedelta) -> int:
    return round(span.total_seconds() * _MICROS)


def _at(time: Column | str) -> Column:
    return F.unix_micros((F.col(time) if isinstance(time, str) else time).cast("timestamp"))


def join_within(
    left: DataFrame,
    right: DataFrame,
    key: str,
    left_time: str,
    right_time: str,
    *,
    before: dt.timedelta = dt.timedelta(0),
    after: dt.timedelta,
    lateness: str,
    outer: bool = False,
) -> DataFrame:
    """Pairs (``left``, ``right``) of equal ``key`` with the right time in [left time - ``before``,
    left time + ``after``], both ends included; in batch, or of two streams.

    On streams both sides are kept as state until the watermark says that no partner can come any
    more, so state is as large as what arrives within the bounds and ``lateness``. With ``outer``, a
    left row without a partner is emitted, its right one NULL, when its state expires. Rows that come
    later than ``lateness`` are not joined; ``late_rows`` counts them, a right row once for each of its
    buckets (see below). Which batches rows come in
    makes no difference. A NULL key has no partner. Rows without a time are in no interval and would
    wait for ever: they are left out.

    The key is joined together with a bucket of time as wide as the bounds, and each right row goes
    to the one or two buckets that its partners can be in. So a key with a third of all rows is
    spread over as many tasks as it has busy buckets, and a pair still meets exactly once.
    """
    width = _micros(before + after)
    if width <= 0 or before < dt.timedelta(0) or after < dt.timedelta(0):
        raise ValueError("the bounds must span some time")
    lt, rt = F.unix_micros("__lt"), F.unix_micros("__rt")

    def bucket(at: Column) -> Column:
        return F.floor(at / F.lit(width)).cast("long")

    l = left.select(F.struct(*[f"`{c}`" for c in left.columns]).alias("left"), F.col(key).alias("__lk"), F.col(left_time).alias("__lt"))
    r = right.select(F.struct(*[f"`{c}`" for c in right.columns]).alias("right"), F.col(key).alias("__rk"), F.col(right_time).alias("__rt"))
    l, r = l.where("__lt IS NOT NULL"), r.where("__rt IS NOT NULL AND __rk IS NOT NULL")
    if left.isStreaming:
        l, r = l.withWatermark("__lt", lateness), r.withWatermark("__rt", lateness)
    l = l.withColumn("__lb", bucket(lt))
    first, last = bucket(rt - _micros(after)), bucket(rt + _micros(before))
    r = r.withColumn("__rb", F.explode(F.array_distinct(F.array(first, last))))
    near = F.expr(
        f"__rt >= __lt - INTERVAL {_micros(before)} MICROSECOND AND __rt <= __lt + INTERVAL {_micros(after)} MICROSECOND"
    )
    same = (F.col("__lk") == F.col("__rk")) & (F.col("__lb") == F.col("__rb"))
    return l.join(r, same & near, "left_outer" if outer else "inner").select("left", "right")


def as_of(
    facts: DataFrame,
    versions: DataFrame,
    key: str,
    fact_time: str,
    version_time: str,
    *,
    until: str | None = None,
    name: str = "version",
    slice_width: dt.timedelta = dt.timedelta(days=1),
) -> DataFrame:
    """T2 with a reference that changes: ``facts``, and in ``name`` the version of their key in force.

    A version is in force from its time, that time included, to the next one of its key, and not
    beyond its ``until`` column if that is named and not NULL. Of versions of one key and time the
    greatest row counts. NULL where none is in force, and for a NULL key or time.

    Facts and versions are put in one sorted run per key and slice of time, where the last version
    before a fact is looked up; a slice without one takes the last of the slices before. So each row
    is shuffled once, nothing is multiplied, and a key with a third of all rows is spread over its
    slices.
    """
    width = _micros(slice_width)
    row = F.struct(*[f"`{c}`" for c in facts.columns])
    version = F.struct(*[f"`{c}`" for c in versions.columns])
    kind = versions.select(version.alias("v")).schema["v"].dataType
    fact_kind = facts.select(row.alias("r")).schema["r"].dataType
    f = facts.select(F.col(key).alias("k"), _at(fact_time).alias("t"), F.lit(None).cast(kind).alias("v"), row.alias("r"))
    v = versions.select(F.col(key).alias("k"), _at(version_time).alias("t"), version.alias("v"), F.lit(None).cast(fact_kind).alias("r"))
    known = "k IS NOT NULL AND t IS NOT NULL"
    both = f.where(known).unionByName(v.where(known)).withColumn("b", F.floor(F.col("t") / F.lit(width)).cast("long"))
    newest = F.max(F.when(F.col("v").isNotNull(), F.struct("t", "v")))
    heads = both.groupBy("k", "b").agg(newest.alias("head"))
    past = Window.partitionBy("k").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    heads = heads.withColumn("carried", F.last("head.v", ignorenulls=True).over(past)).select("k", "b", "carried")
    # Versions stand before facts of the same time, the greatest of them last.
    run = Window.partitionBy("k", "b").orderBy("t", F.col("r").isNotNull(), "v").rowsBetween(Window.unboundedPreceding, 0)
    found = both.withColumn("here", F.last("v", ignorenulls=True).over(run)).where("r IS NOT NULL")
    found = found.join(heads, ["k", "b"], "left").withColumn("found", F.coalesce("here", "carried"))
    if until is not None:
        over = _at(F.col("found")[until]) <= F.col("t")
        found = found.withColumn("found", F.when(~F.coalesce(over, F.lit(False)), F.col("found")))
    # Facts without a key or a time have no version, and need not be sorted to know that.
    others = f.where(f"NOT ({known})").select("r", F.col("v").alias("found"))
    return found.select("r", "found").unionByName(others).select("r.*", F.col("found").alias(name))
