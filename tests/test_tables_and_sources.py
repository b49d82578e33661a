import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from eventlake import schemas as S
from eventlake.session import SPREAD, scratch_dir, settings
from eventlake.sources import kafka_messages, kafka_options, starting_offsets, text_messages
from eventlake.plans import flat_ride_rows
from eventlake.streaming import tables as K
from eventlake.streaming.append import append_to_table


def parses(spark, sql):
    spark._jsparkSession.sessionState().sqlParser().parsePlan(sql)


def test_iceberg_ddl(spark):
    sql = K.create_table_sql("lake.sink.rides", K.RIDES)
    parses(spark, sql)
    assert sql.startswith("CREATE TABLE IF NOT EXISTS lake.sink.rides (event_id string NOT NULL")
    assert "event_hour string NOT NULL" in sql and "PARTITIONED BY (event_hour)" in sql
    for entry in (
        "'format-version' = '2'",
        "'write.format.default' = 'parquet'",
        "'write.parquet.compression-codec' = 'snappy'",
        "'write.upsert.enabled' = 'true'",
    ):
        assert entry in sql
    bids = K.create_table_sql("lake.sink.bids", K.BIDS)
    parses(spark, bids)
    assert "PARTITIONED" not in bids and "NOT NULL" not in bids and "upsert" not in bids
    assert "event_time timestamp_ntz" in bids


def test_parquet_table_is_created_once_appended_to_and_pruned(spark, tmp_path):
    K.create_namespace(spark, "sink")
    K.create_table(spark, "sink.user_events", K.RIDE_DAYS, provider="parquet")
    K.create_table(spark, "sink.user_events", K.BIDS, provider="parquet")  # left as it is
    assert spark.table("sink.user_events").columns == S.RIDE_DAY_TABLE.fieldNames()
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "1.txt").write_text(
        '{"event_id":"a","event_timestamp":1704067200123}\n{"event_id":"b","event_timestamp":0}\n'
    )
    append_to_table(
        flat_ride_rows(text_messages(spark, str(tmp_path / "in"), "user_events")),
        S.RIDE_DAY_TABLE,
        "sink.user_events",
        str(tmp_path / "cp"),
        partition_by=["event_date"],
        every=None,
    ).awaitTermination()
    day = spark.table("sink.user_events").where("event_date = '2024-01-01'")
    assert [r["event_id"] for r in day.collect()] == ["a"]
    assert day.schema["event_date"].dataType.simpleString() == "string"
    spark.sql("DROP TABLE sink.user_events")


def test_columns_are_bound_by_name(spark):
    df = spark.sql("SELECT 'x' extra, 5 user_id, 'n' event_name, 1 city_id, 'p' platform, 's' session_id")
    times = {c: F.current_timestamp() for c in ("event_time", "ingestion_time")}
    out = K.conform(df.withColumns(times), S.BID_TABLE)
    assert out.schema.fieldNames() == S.BID_TABLE.fieldNames()
    assert [f.dataType for f in out.schema] == [f.dataType for f in S.BID_TABLE]
    with pytest.raises(AnalysisException):
        K.conform(df, S.BID_TABLE)


def test_start_offsets():
    assert [starting_offsets(c) for c in ("earliest", "EARLIEST", "latest", "other")] == [
        "earliest",
        "earliest",
        "latest",
        "latest",
    ]


def test_kafka_options():
    options = kafka_options(
        "b1:9098,b2:9098",
        "user_events",
        start="Latest",
        client={"security.protocol": "SASL_SSL", "sasl.mechanism": "X"},
        max_offsets_per_trigger=1000,
        min_partitions=64,
    )
    assert options == {
        "kafka.security.protocol": "SASL_SSL",
        "kafka.sasl.mechanism": "X",
        "kafka.bootstrap.servers": "b1:9098,b2:9098",
        "subscribe": "user_events",
        "startingOffsets": "latest",
        "maxOffsetsPerTrigger": "1000",
        "minPartitions": "64",
    }


def test_kafka_needs_its_connector(spark):
    with pytest.raises(AnalysisException, match="kafka"):
        kafka_messages(spark, kafka_options("b:1", "t"))


def test_scratch_lies_in_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    first, second = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert first.startswith(shared + "/") and first != second


def test_settings_are_put_back(spark):
    before = {k: spark.conf.get(k, None) for k in SPREAD}
    with pytest.raises(RuntimeError), settings(spark, SPREAD):
        assert all(spark.conf.get(k) == v for k, v in SPREAD.items())
        raise RuntimeError
    assert {k: spark.conf.get(k, None) for k in SPREAD} == before


def test_a_hot_hour_is_written_by_many_tasks_and_small_ones_by_few(spark, tmp_path):
    rows = spark.range(0, 300_000, 1, 8).selectExpr(
        "CASE WHEN id % 3 > 0 THEN 'hot' ELSE 'h' || (id % 50) END event_hour", "uuid() v"
    )
    advisory = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "1MB"}
    with settings(spark, advisory):
        K.rows_near(rows, ["event_hour"]).write.partitionBy("event_hour").parquet(str(tmp_path / "t"))
    files = {p.name: len(list(p.glob("*.parquet"))) for p in (tmp_path / "t").glob("event_hour=*")}
    assert files.pop("event_hour=hot") > 4
    # An hour that hashes next to the hot one is split along with it; the others are not.
    assert len(files) == 50 and sum(n == 1 for n in files.values()) > 35
    assert spark.read.parquet(str(tmp_path / "t")).count() == 300_000
