"""Every decode rule, strict and lenient, on one text field `a` and one number field `n`."""

import pytest
from pyspark.sql import functions as F

from eventlake.operators import accepted, decode_lenient, decode_strict, rejected
from eventlake.plans import nested_ride_rows
from eventlake import schemas as S
from eventlake.schemas import Field, flat

MISSING_A = "missing:a"
MISSING_N = "missing:n"

# payload, strict (a, n) or reject reason, lenient (a, n) or None for a skipped row
INT_CASES = [
    ('{"a":"x","n":5}', ("x", 5), ("x", 5)),
    ('{"a":null,"n":null}', ("null", 0), (None, None)),
    ('{"n":"7"}', MISSING_A, (None, 7)),
    ('{"a":"x","n":" 7 "}', ("x", 7), ("x", 7)),
    ('{"a":{"q":1},"n":"abc"}', ("", 0), ('{"q":1}', None)),
    ('{"a":[1,2],"n":{"z":1}}', ("", 0), ("[1,2]", None)),
    ('{"a":1,"n":2.9}', ("1", 2), ("1", 2)),
    ('{"a":1.0,"n":-2.9}', ("1.0", -2), ("1.0", -2)),
    ('{"a":1.5,"n":1e2}', ("1.5", 100), ("1.5", 100)),
    ('{"a":12345678901234567890,"n":1}', ("12345678901234567890", 1), ("12345678901234567890", 1)),
    ('{"a":true,"n":true}', ("true", 1), ("true", None)),
    ('{"a":false,"n":false}', ("false", 0), ("false", None)),
    ('{"a":"true","n":0}', ("true", 0), ("true", 0)),
    ('{"a":"{x","n":1}', ("{x", 1), ("{x", 1)),
    ('{"a":"7","n":1.0}', ("7", 1), ("7", 1)),
    ('{"a":"","n":1}', ("", 1), ("", 1)),
    ('{"a":"éa","n":1}', ("éa", 1), ("éa", 1)),
    ('{"a":"x","n":5} junk', ("x", 5), ("x", 5)),
    ('{"a":"x","a":"y","n":1}', ("y", 1), ("y", 1)),
    ("", "unparseable", None),
    ("   ", "unparseable", None),
    ("not json", "unparseable", None),
    ('{"a":"x","n":5', "unparseable", None),
    (None, "unparseable", None),
    ("null", "not_object", None),
    ("123", "not_object", None),
    ('[{"a":"z","n":1}]', "not_object", None),
    (' \t\n{"a":"x","n":5}', ("x", 5), ("x", 5)),
    ("{}", MISSING_A, (None, None)),
    ('{"A":"up","n":1}', MISSING_A, (None, 1)),
    ('{"a":"x"}', MISSING_N, ("x", None)),
    ('{"a":"x","n":99999999999}', "out_of_range:n", ("x", None)),
    ('{"a":"x","n":1e12}', "out_of_range:n", ("x", None)),
    ('{"a":"x","n":"99999999999"}', ("x", 0), ("x", None)),
    ('{"a":"x","n":"7.9"}', ("x", 7), ("x", None)),
    ('{"a":"x","n":""}', ("x", 0), ("x", None)),
]

# payload, strict d, lenient d
DOUBLE_CASES = [
    ('{"d":300}', 300.0, 300.0),
    ('{"d":2.5}', 2.5, 2.5),
    ('{"d":1e3}', 1000.0, 1000.0),
    ('{"d":" 2.5 "}', 2.5, 2.5),
    ('{"d":"abc"}', 0.0, None),
    ('{"d":null}', 0.0, None),
    ('{"d":true}', 1.0, None),
    ('{"d":false}', 0.0, None),
    ('{"d":0}', 0.0, 0.0),
    ('{"d":1}', 1.0, 1.0),
    ('{"d":[1]}', 0.0, None),
]

# payload, strict l or reject reason, lenient l
LONG_CASES = [
    ('{"l":99999999999}', 99999999999, 99999999999),
    ('{"l":9223372036854775807}', 9223372036854775807, 9223372036854775807),
    ('{"l":9223372036854775808}', "out_of_range:l", None),
    ('{"l":1e30}', "out_of_range:l", None),
    ('{"l":"7.9"}', 7, None),
    ('{"l":true}', 1, None),
]


def frame(spark, payloads):
    rows = [(i, "t", v) for i, v in enumerate(payloads)]
    return spark.createDataFrame(rows, "id int, topic string, value string")


@pytest.mark.parametrize(
    "fields,cases",
    [
        ((flat("a", "string"), flat("n", "int")), INT_CASES),
        ((flat("d", "double"),), [(v, (s,), (n,)) for v, s, n in DOUBLE_CASES]),
        (
            (flat("l", "bigint"),),
            [(v, s if isinstance(s, str) else (s,), (n,)) for v, s, n in LONG_CASES],
        ),
    ],
    ids=["text-int", "double", "long"],
)
def test_coercions(spark, fields, cases):
    names = [f.name for f in fields]
    df = frame(spark, [c[0] for c in cases])
    strict = {r["id"]: r for r in decode_strict(df, fields).collect()}
    lenient = {r["id"]: r for r in decode_lenient(df, fields, keep=("id",)).collect()}
    for i, (payload, want_strict, want_lenient) in enumerate(cases):
        row = strict[i]
        got = row["reject_reason"] or tuple(row[n] for n in names)
        assert got == want_strict, payload
        got = tuple(lenient[i][n] for n in names) if i in lenient else None
        assert got == want_lenient, payload


def ride(metadata, timestamp="1704067200123"):
    return (
        '{"event_id":"evt_1","user_id":"user_1","event_type":"fare_viewed",'
        f'"timestamp":{timestamp},"ride_id":"ride_1"{metadata}}}'
    )


GOOD = (
    ',"metadata":{"surge_multiplier":1.5,"estimated_wait_minutes":4,'
    '"fare_amount":300,"driver_rating":4.5}'
)


def test_nested_ride(spark):
    row = accepted(nested_ride_rows(frame(spark, [ride(GOOD)]))).drop("id", "topic", "value")
    assert row.collect()[0].asDict() == {
        "event_id": "evt_1",
        "user_id": "user_1",
        "event_type": "fare_viewed",
        "event_timestamp": 1704067200123,
        "ride_id": "ride_1",
        "surge_multiplier": 1.5,
        "estimated_wait_minutes": 4,
        "fare_amount": 300.0,
        "driver_rating": 4.5,
        "event_hour": "2024-01-01-00",
    }


@pytest.mark.parametrize("metadata", ["", ',"metadata":null', ',"metadata":"x"', ',"metadata":[1]'])
def test_bad_metadata_is_rejected(spark, metadata):
    bad = rejected(nested_ride_rows(frame(spark, [ride(metadata)]))).collect()
    assert [tuple(r) for r in bad] == [("t", ride(metadata), "missing:surge_multiplier")]


def test_extreme_time_is_rejected_and_does_not_fail(spark):
    payloads = [ride(GOOD, t) for t in ("9223372036854775807", "-9223372036854775808", "-1")]
    rows = nested_ride_rows(frame(spark, payloads)).orderBy("id").collect()
    assert [r["reject_reason"] for r in rows] == ["out_of_range:event_timestamp"] * 2 + [None]
    assert [r["event_hour"] for r in rows] == [None, None, "1969-12-31-23"]


def test_payload_is_read_once_whatever_the_filter(spark):
    decoded = accepted(nested_ride_rows(frame(spark, [ride(GOOD)])))
    decoded = decoded.where("event_hour = '2024-01-01-00' and user_id like 'user%'")
    plan = decoded._jdf.queryExecution().executedPlan().toString()
    assert plan.count("parseJson(") == 1 and plan.count("from_json(") == 1
    lenient = decode_lenient(frame(spark, [ride(GOOD)]), (flat("user_id", "string"),))
    plan = lenient.where("user_id = 'x'")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("parseJson(") == 1 and plan.count("from_json(") == 1


def test_only_declared_fields_are_read(spark):
    fields = (Field("b", "$.x.b", "int"),)
    out = decode_lenient(frame(spark, ['{"x":{"b":3},"flow_id":"f"}']), fields)
    assert out.columns == ["b"] and out.collect()[0][0] == 3


def test_counts_are_observed(spark):
    from pyspark.sql import Observation

    seen = Observation("seen")
    df = frame(spark, ['{"a":"x"}', "bad", '{"b":1}'])
    decode_strict(df, (flat("a", "string"),), metrics=seen).write.format("noop").mode(
        "overwrite"
    ).save()
    assert seen.get == {"rows": 3, "rejected": 2}


def test_fields_named_like_message_columns(spark):
    fields = tuple(S.flat(n, "string") for n in ("value", "topic", "timestamp", "a"))
    good = '{"value":null,"topic":"t2","timestamp":"now","a":"x"}'
    rows = spark.createDataFrame([(good, "t"), ('{"value":"v","a":"y"}', "t"), ("junk", "t")], "value string, topic string")
    decoded = decode_strict(rows, fields)
    got = [tuple(r) for r in accepted(decoded).select("value", "topic", "timestamp", "a").collect()]
    assert got == [("null", "t2", "now", "x")]
    assert sorted(tuple(r) for r in rejected(decoded).collect()) == [
        ("t", "junk", "unparseable"),
        ("t", '{"value":"v","a":"y"}', "missing:topic"),
    ]


def test_two_decodes_in_one_query(spark):
    rows = spark.createDataFrame([('{"a":"x"}', "t")], "value string, topic string")
    fields = (S.flat("a", "string"),)
    both = accepted(decode_strict(rows, fields)).unionByName(accepted(decode_strict(rows, fields)))
    assert both.count() == 2
    assert decode_lenient(rows, fields).unionByName(decode_lenient(rows, fields)).count() == 2


def test_filters_on_the_message_reach_the_scan(spark, tmp_path):
    rows = spark.createDataFrame([('{"a":"x"}', "t", 0)], "value string, topic string, partition int")
    rows.write.parquet(str(tmp_path / "m"))
    part = spark.read.parquet(str(tmp_path / "m")).where("topic = 't' AND partition = 0")
    plan = decode_strict(part, (S.flat("a", "string"),))._jdf.queryExecution().executedPlan().toString()
    pushed = plan.split("PushedFilters: [")[1].split("]")[0]
    assert "EqualTo(topic,t)" in pushed and "EqualTo(partition,0)" in pushed
