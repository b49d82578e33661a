"""Every registered query against its oracle SQL, on the smallest tables."""

import datetime as dt
import math
import pathlib

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract

SF_DIR = pathlib.Path("/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float) and not math.isnan(value):
        return repr(value)
    if isinstance(value, dt.datetime):
        return value.isoformat()
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def test_every_query_has_an_oracle():
    assert contract.QUERIES.keys() == contract.ORACLES.keys()


GIVEN = ("events", "customer", "pages")
# The generated events stand on the values of each row, so a row without any is not for them.
GENERATED = ("synthetic_rides", "synthetic_bids", "publish_decode_roundtrip")


def written(spark, root, change):
    """The tables changed, as folders of four part files each, and a connection that has them."""
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in GIVEN:
        change(name, spark.read.parquet(f"{SF_DIR}/{name}.parquet")).repartition(4).write.parquet(f"{root}/{name}.parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{root}/{name}.parquet/*.parquet'")
    return root, con


@pytest.fixture(scope="module")
def folders(spark, tmp_path_factory):
    return written(spark, tmp_path_factory.mktemp("folders"), lambda name, table: table)


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    """With a row of NULLs in each table, and events of negative ids."""

    def change(name, table):
        if name == "events":
            negative = {"event_id": -F.col("event_id") - 1, "user_id": -F.col("user_id") - 1}
            table = table.union(table.where("event_id < 60").withColumns(negative).select(*table.columns))
        return table.union(spark.createDataFrame([tuple(None for _ in table.columns)], table.schema))

    return written(spark, tmp_path_factory.mktemp("odd"), change)


@pytest.fixture(scope="module")
def empty(spark, tmp_path_factory):
    return written(spark, tmp_path_factory.mktemp("empty"), lambda name, table: table.limit(0))


@pytest.mark.parametrize("name", contract.QUERIES)
def test_query_matches_oracle(spark, oracle, name):
    check(spark, oracle, name, SF_DIR)


@pytest.mark.parametrize("name", contract.QUERIES)
def test_query_matches_oracle_on_folders_with_odd_rows(spark, folders, odd, name):
    root, con = folders if name in GENERATED else odd
    check(spark, con, name, root)


@pytest.mark.parametrize("name", contract.QUERIES)
def test_query_gives_nothing_of_nothing(spark, empty, name):
    root, _ = empty
    assert contract.queries()[name](spark, str(root)).count() == 0


def check(spark, oracle, name, sf_dir):
    df = contract.queries()[name](spark, str(sf_dir))
    result = oracle.execute(contract.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    expected = result.fetchall()
    assert sorted(df.columns) == sorted(columns)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    want = rows_of(columns, expected)
    assert len(got) == len(want)
    assert got == want
    assert got
    plan = df._jdf.queryExecution().executedPlan().toString()
    for slow in ("EvalPython", "InPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert slow not in plan


def test_entry(spark):
    assert contract.entry(spark).count() > 0
