"""The quick text read and the document read must agree, whatever the payload."""

import json
import random

import pytest
from eventlake.functions import json_values as J
from eventlake.operators import decode_lenient, decode_strict
from eventlake.schemas import Field, flat

FIELDS = (
    flat("a", "string"),
    flat("n", "int"),
    flat("l", "bigint"),
    flat("d", "double"),
    Field("b", "$.m.b", "string"),
    Field("i", "$.m.i", "int"),
)

TOKENS = [
    '"x"', '"X y"', '""', '" 7 "', '"7"', '"7.9"', '"1e3"', '"-0"', '"007"', '"{x"', '"[1"', '"3.5z"',
    '"true"', '"null"', '"NaN"', '"é"', '"\\u0041b"', '"\\n"', '"a\\"b"', "0", "-0", "1", "-1", "7",
    "2.0", "1.50", "-2.9", "1e2", "1E-3", "1e400", "99999999999", "9223372036854775807",
    "9223372036854775808", "12345678901234567890123", "0.1234567890123456789", "true", "false",
    "null", "{}", '{"q":1}', "[]", "[1,2]", '[{"z":null}]', "NaN", "01", "+1", "'x'", "",
]


def payloads(n):
    rng = random.Random(5)

    def member(name, usual):
        token = usual if rng.random() < 0.6 else rng.choice(TOKENS)
        return f'"{name}":{token}'

    def obj(members):
        members = [m for m in members if rng.random() > 0.04]
        if rng.random() < 0.1 and members:
            members.append(rng.choice(members).split(":")[0] + ":" + rng.choice(TOKENS))
        rng.shuffle(members)
        return "{" + ",".join(members) + "}"

    out = []
    for i in range(n):
        inner = obj([member("b", '"in"'), member("i", str(i % 50))])
        outer = inner if rng.random() < 0.9 else rng.choice(TOKENS)
        text = obj(
            [
                member("a", json.dumps(rng.choice(["abc", "Z", "12", "x-1"]))),
                member("n", str(i % 100)),
                member("l", str(1704067200000 + i)),
                member("d", str(i / 10)),
                f'"m":{outer}',
                member("extra", "1"),
            ]
        )
        if rng.random() < 0.03:
            text = text[: rng.randrange(len(text))]
        if rng.random() < 0.03:
            text = rng.choice([" \n", "[", "x", ""]) + text + rng.choice(["", "]", " tail"])
        out.append(text)
    return out


@pytest.mark.parametrize("decode", [decode_strict, decode_lenient])
def test_both_paths_agree(spark, monkeypatch, decode):
    rows = list(enumerate(payloads(4000)))
    df = spark.createDataFrame(rows, "id int, value string").repartition(8)

    def read():
        out = decode(df, FIELDS) if decode is decode_strict else decode(df, FIELDS, keep=("id",))
        names = ["id", *[f.name for f in FIELDS], *(["reject_reason"] if decode is decode_strict else [])]
        # A rejected row has no values to compare, only its reason.
        keep = [str(tuple(r)) if r[-1] is None or decode is decode_lenient else (r[0], r[-1])
                for r in out.select(*names).orderBy("id").collect()]
        return keep

    quick = read()
    # With no text ever settled, every row with a field in it takes the document read.
    monkeypatch.setattr(J, "quick", lambda text, field: f"cast(NULL AS {field.type})")
    assert quick == read()
