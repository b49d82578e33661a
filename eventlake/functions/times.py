"""Time functions over epoch milliseconds. All are read in the session time zone.

An epoch outside years 1..9999 yields NULL instead of failing the query: strict decoding
then rejects the row and lenient decoding keeps it with a NULL time. A day is left free at
both ends so that no session zone can push a value over the edge.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARLIEST_MS = -62_135_596_800_000 + 86_400_000  # 0001-01-02T00:00:00Z
LATEST_MS = 253_402_300_799_999 - 86_400_000  # 9999-12-30T23:59:59.999Z


def _in_range(ms: Column) -> Column:
    return ms.between(EARLIEST_MS, LATEST_MS)


def event_time(ms: Column) -> Column:
    """epoch ms to a zoned timestamp."""
    return F.when(_in_range(ms), F.timestamp_millis(ms))


def wall_clock(zoned: Column) -> Column:
    """zoned timestamp to wall clock without zone, cut to milliseconds."""
    return F.date_trunc("MILLISECOND", zoned).cast("timestamp_ntz")


def ingestion_time() -> Column:
    """time of processing, one value per micro-batch."""
    return wall_clock(F.current_timestamp())


def hour_bucket(ms: Column) -> Column:
    """epoch ms to ``yyyy-MM-dd-HH``; a time before 1970 floors."""
    return F.date_format(event_time(ms), "yyyy-MM-dd-HH")


def seconds_of(ms: Column) -> Column:
    """whole seconds; integer division, truncating toward zero."""
    return F.call_function("div", ms, F.lit(1000))


def text_time(seconds: Column) -> Column:
    """epoch seconds to ``yyyy-MM-dd HH:mm:ss`` text."""
    return F.when(_in_range(seconds * 1000), F.from_unixtime(seconds))


def format_text_time(text: Column, pattern: str = "yyyy-MM-dd") -> Column:
    """reformat a text timestamp; text that is no timestamp yields NULL."""
    return F.date_format(F.try_to_timestamp(text, F.lit("yyyy-MM-dd HH:mm:ss")), pattern)


def day_bucket(ms: Column) -> Column:
    """F5 to F7 in one step: epoch ms to ``yyyy-MM-dd``; -1 ms is 1970-01-01."""
    return F.when(_in_range(ms), F.from_unixtime(seconds_of(ms), "yyyy-MM-dd"))
