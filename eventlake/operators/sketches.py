"""Mergeable sketches per hour, so that a range of hours is answered without its events."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# 2^12 registers: a relative standard error of 1.6 %. 200: a rank error of 1.65 % at most, 99 % of the time.
HLL_LOG2, KLL_K = 12, 200


def hourly_sketches(df: DataFrame, hour: Column, member: Column, value: Column, by: Sequence[str] = ()) -> DataFrame:
    """(event_hour, *by, n_events, members, values): a distinct-count and a quantile sketch for each hour.

    Sketches are built per task and merged after the shuffle, so an hour with a third of all events
    sends one sketch a task. NULL members and values are in no sketch, but counted in ``n_events``.
    """
    return df.groupBy(hour.alias("event_hour"), *by).agg(
        F.count(F.lit(1)).alias("n_events"),
        F.hll_sketch_agg(member, HLL_LOG2).alias("members"),
        F.kll_sketch_agg_double(value.cast("double"), KLL_K).alias("values"),
    )


def merge_sketches(sketches: DataFrame, *by: Column | str) -> DataFrame:
    """Sketches of the same columns, one for each ``by``, in whatever order they are merged."""
    return sketches.groupBy(*by).agg(
        F.sum("n_events").alias("n_events"),
        F.hll_union_agg("members").alias("members"),
        F.kll_merge_agg_double("values").alias("values"),
    )


def estimates(sketches: DataFrame, ranks: Sequence[float] = (0.5, 0.95)) -> DataFrame:
    """``sketches`` with ``n_members`` and the values at ``ranks`` (``p50``, ``p95``) in place of them."""
    some = F.kll_sketch_get_n_double("values") > 0
    quantiles = [
        F.when(some, F.kll_sketch_get_quantile_double("values", F.lit(rank))).alias(f"p{round(100 * rank)}")
        for rank in ranks
    ]
    return sketches.select("*", F.hll_sketch_estimate("members").alias("n_members"), *quantiles).drop("members", "values")
