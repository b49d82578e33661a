"""URL filters from dated lists: validity intervals, and an as-of join of captures with them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventlake.llm.common import reliable, unused

BLOCK, ALLOW = "block", "allow"
# Times are microseconds from 1970, before it negative; an entry that is never taken off ends here.
_END = (1 << 63) - 1
_BASE_BITS = 4
# Enough for every long.
_LEVELS = 64 // _BASE_BITS
# Host and path of an absolute URL.
_HOST = r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]+)"
_PATH = r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)"


def host(url: Column) -> Column:
    """Lower-case host name, NULL without one."""
    found = F.lower(F.regexp_extract(url, _HOST, 1))
    return F.when(F.length(found) > 0, found)


def url_rule(url: Column) -> Column:
    """The rule for one page: host and path, without query and fragment."""
    return F.concat(F.lit("url:"), host(url), F.regexp_extract(url, _PATH, 1))


def host_rule(url: Column) -> Column:
    return F.concat(F.lit("host:"), host(url))


def domain_rule(url: Column, labels: int = 2) -> Column:
    """The rule for a domain and all below it."""
    return F.concat(F.lit("domain:"), F.substring_index(host(url), ".", -labels))


def rules_of(url: Column) -> Column:
    """All rules that can concern a URL: [(rule, rank)], the most specific of the highest rank."""
    parts = F.split(host(url), r"\.")
    domains = F.transform(
        F.filter(F.sequence(F.lit(1), F.size(parts)), lambda i: i >= 2),
        lambda i: F.struct(
            F.concat(F.lit("domain:"), F.array_join(F.slice(parts, F.size(parts) - i + 1, i), ".")).alias("rule"),
            i.cast("int").alias("rank"),
        ),
    )
    own = F.array(
        F.struct(url_rule(url).alias("rule"), F.lit(2000).alias("rank")),
        F.struct(host_rule(url).alias("rule"), F.lit(1000).alias("rank")),
    )
    return F.when(host(url).isNotNull(), F.concat(own, domains))


def intervals(changes: DataFrame) -> DataFrame:
    """(rule, action, since, until) from ``changes`` (rule, at, action); times in microseconds.

    A change is in force from its time to the rule's next one; an action of NULL takes the rule off
    the list. Of several at one time the greatest action counts, NULL the least. Next times are
    looked up within a rule's day first and then among its days, so the changes of a rule are never
    in one task, however many they are. Changes without a rule or time are void.
    """
    day = F.floor(F.col("at") / 86_400_000_000)
    changes = changes.where("rule IS NOT NULL AND at IS NOT NULL").withColumn("day", day)
    changes = changes.groupBy("rule", "day", "at").agg(F.max("action").alias("action"))
    days = changes.groupBy("rule", "day").agg(F.min("at").alias("first"))
    days = days.withColumn("next_day", F.lead("first").over(Window.partitionBy("rule").orderBy("day")))
    within = F.lead("at").over(Window.partitionBy("rule", "day").orderBy("at"))
    rows = changes.withColumn("next", within).join(days.select("rule", "day", "next_day"), ["rule", "day"])
    until = F.coalesce("next", "next_day", F.lit(_END))
    return rows.where("action IS NOT NULL").select("rule", "action", F.col("at").alias("since"), until.alias("until"))


def _blocks(since: Column, until: Column) -> Column:
    """[(level, block)]: aligned blocks of 16^level microseconds that make up [since, until)."""
    out = []
    for level in range(_LEVELS):
        size, up = 1 << (_BASE_BITS * level), 1 << (_BASE_BITS * (level + 1))
        low, high = _ceil(since, size), _floor(until, size)
        if level + 1 < _LEVELS:
            filled = _ceil(since, up) < _floor(until, up)
            # Beyond every long if nothing is filled, so without an overflow check.
            inner_low, inner_high = (F.shiftleft(x, _BASE_BITS) for x in (_ceil(since, up), _floor(until, up)))
        else:
            filled, inner_low, inner_high = F.lit(False), high, high
        left = _span(low, F.when(filled, inner_low).otherwise(high))
        right = _span(F.when(filled, inner_high).otherwise(high), high)
        for span in (left, right):
            out.append(_tagged(span, level))
    return F.concat(*out)


def _tagged(span: Column, level: int) -> Column:
    return F.transform(span, lambda b: F.struct(F.lit(level).alias("level"), b.alias("block")))


def _floor(x: Column, size: int) -> Column:
    return F.shiftright(x, size.bit_length() - 1)


def _ceil(x: Column, size: int) -> Column:
    return _floor(x, size) + (x.bitwiseAND(F.lit(size - 1)) != 0).cast("long")


def _span(low: Column, high: Column) -> Column:
    """low, low + 1, ..., high - 1."""
    empty = F.array().cast("array<bigint>")
    return F.when(low < high, F.sequence(low, high - 1)).otherwise(empty)


def judge(captures: DataFrame, changes: DataFrame) -> DataFrame:
    """``captures`` (key, url, at) with what the lists said at that time.

    Adds ``n_active``, the number of rules in force for the URL at its fetch time, and ``rule`` and
    ``action`` of the most specific one: its page, its host, or the longest domain. Without any,
    without a host or without a time, that is 0 and NULL. Columns of ``captures`` with one of those
    three names give way, all others stay. Repeated captures are judged each. Empty
    tables are fine. Times may be any long, also before 1970 or a far one that stands for never; only
    at the greatest long nothing is in force.

    The as-of join is an equi-join: an interval is cut into aligned blocks of 16^level microseconds,
    at most 30 of each level, and a time lies in one block of each level, so a pair meets exactly
    once. Neither a host with most captures nor a rule with most changes multiplies with the other,
    as a join on the rule alone would.
    """
    verdict = ("n_active", "rule", "action")
    kept = [c for c in captures.columns if c.lower() not in verdict]
    own = unused(captures, "_row")[0]
    captures = reliable(captures.select(*[F.col(f"`{c}`") for c in kept], F.monotonically_increasing_id().alias(own)))
    spans = reliable(intervals(changes).where(F.col("since") < F.col("until")))
    cut = spans.select("rule", "action", F.explode(_blocks(F.col("since"), F.col("until"))).alias("b"))
    cut = cut.select("rule", "action", "b.level", "b.block")
    levels = F.array(*[
        F.struct(F.lit(n).alias("level"), _floor(F.col("at"), 1 << (_BASE_BITS * n)).alias("block"))
        for n in range(_LEVELS)
    ])
    asked = captures.select(F.col(own).alias("row"), "at", F.explode(rules_of(F.col("url"))).alias("r")).where("at IS NOT NULL")
    asked = asked.select("row", "at", "r.rule", "r.rank").join(spans.select("rule").distinct(), "rule", "left_semi")
    asked = asked.select("row", "rule", "rank", F.explode(levels).alias("b")).select("row", "rule", "rank", "b.level", "b.block")
    hits = asked.join(cut, ["rule", "level", "block"])
    verdicts = hits.groupBy("row").agg(
        F.count("*").alias("n_active"), F.max(F.struct("rank", "rule", "action")).alias("top")
    )
    rows = captures.join(verdicts.withColumnRenamed("row", own), own, "left")
    return rows.select(
        *[F.col(f"`{c}`") for c in kept],
        F.coalesce("n_active", F.lit(0)).cast("long").alias("n_active"),
        F.col("top.rule").alias("rule"),
        F.col("top.action").alias("action"),
    )
