import pytest
from pyspark.sql import functions as F

from eventlake import functions as L

TIMES = [
    (1704067200123, "2024-01-01-00", "2024-01-01"),
    (1704067199999, "2023-12-31-23", "2023-12-31"),
    (1709164800000, "2024-02-29-00", "2024-02-29"),
    (0, "1970-01-01-00", "1970-01-01"),
    (-1, "1969-12-31-23", "1970-01-01"),
    (-1001, "1969-12-31-23", "1969-12-31"),
    (None, None, None),
    (9223372036854775807, None, None),
    (-9223372036854775808, None, None),
]


@pytest.fixture
def zone(spark):
    yield lambda name: spark.conf.set("spark.sql.session.timeZone", name)
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_buckets(spark):
    df = spark.createDataFrame([(t[0],) for t in TIMES], "ms bigint")
    ms = F.col("ms")
    seconds_text = L.format_text_time(L.text_time(L.seconds_of(ms)))
    rows = df.select("ms", L.hour_bucket(ms), L.day_bucket(ms), seconds_text).collect()
    assert [tuple(r) for r in rows] == [t + (t[2],) for t in TIMES]


def test_buckets_follow_the_session_zone(spark, zone):
    zone("Asia/Kolkata")
    df = spark.createDataFrame([(1704067200123,), (-1,)], "ms bigint")
    ms = F.col("ms")
    rows = df.select(L.hour_bucket(ms), L.day_bucket(ms), L.wall_clock(L.event_time(ms))).collect()
    assert [tuple(r)[:2] for r in rows] == [
        ("2024-01-01-05", "2024-01-01"),
        ("1970-01-01-05", "1970-01-01"),
    ]
    assert str(rows[0][2]) == "2024-01-01 05:30:00.123000"


@pytest.mark.parametrize("ms,seconds", [(1999, 1), (0, 0), (-1, 0), (-1001, -1), (None, None)])
def test_seconds_truncate_toward_zero(spark, ms, seconds):
    df = spark.createDataFrame([(ms,)], "ms bigint")
    assert df.select(L.seconds_of(F.col("ms"))).collect()[0][0] == seconds


def test_text_times(spark):
    df = spark.createDataFrame([(1704067200, "2024-01-01 00:00:00"), (0, "nonsense")], "s bigint, t string")
    rows = df.select(L.text_time(F.col("s")), L.format_text_time(F.col("t"))).collect()
    assert [tuple(r) for r in rows] == [
        ("2024-01-01 00:00:00", "2024-01-01"),
        ("1970-01-01 00:00:00", None),
    ]


def test_ingestion_time_has_milliseconds_and_no_zone(spark):
    df = spark.range(1).select(L.ingestion_time().alias("t"))
    assert df.schema["t"].dataType.simpleString() == "timestamp_ntz"
    assert df.collect()[0][0].microsecond % 1000 == 0


@pytest.mark.parametrize(
    "topic,table",
    [("Ride.User-Events", "ride_user_events"), ("a-b", "a_b"), ("a.b", "a_b"), ("plain", "plain")],
)
def test_table_names(spark, topic, table):
    assert L.table_name(topic) == table
    df = spark.createDataFrame([(topic,)], "t string")
    assert df.select(L.table_name_column(F.col("t"))).collect()[0][0] == table
