"""Batches of some megabytes are shared by the cores, whatever number of files they make."""

import pathlib
import random

import pytest
from pyspark.sql import functions as F
from test_streaming import HOUR0, Rides, ride_json

from eventlake.session import SHARED
from eventlake.streaming.maintained import HourlyCounts

N = 3000


@pytest.fixture
def rides(spark, tmp_path):
    return Rides(spark, tmp_path)


def wide(i):
    """A ride of one of 24 hours with 4 KB that do not compress."""
    filler = random.Random(i).randbytes(2048).hex()
    return ride_json(f"e{i}", HOUR0 + i % 24 * 3_600_000, i % 700).replace("user_1", f"user_{filler}")


def files(path):
    return len(list(pathlib.Path(path).rglob("*.parquet")))


def test_accepted_rows_of_a_batch_and_their_feed_are_shared(spark, rides, tmp_path):
    rides.landing.add(*[wide(i) for i in range(N)])
    rides.run()
    written = pathlib.Path(rides.table.path) / "changes" / "batch_id=0"
    assert 2 <= files(written) <= 4  # 12 MB in pieces of 4 MB or more
    before = {key: spark.conf.get(key, None) for key in SHARED}
    counts = HourlyCounts(spark, str(tmp_path / "counts"))
    assert counts.advance(rides.table) == 0
    assert {key: spark.conf.get(key, None) for key in SHARED} == before
    assert files(tmp_path / "counts" / "deltas") == 1
    assert rides.table.feed(-1, 0).count() == N and counts.read().agg(F.sum("n_rows")).first()[0] == N
    rides.landing.add(ride_json("a", HOUR0, 1), ride_json("b", HOUR0 + 3_600_000, 1))
    rides.run()
    assert files(written.with_name("batch_id=1")) == 1


def test_refused_rows_of_a_batch_and_their_redrive_are_shared(rides):
    rides.landing.add(*[wide(i)[:-1] for i in range(N)], "junk")
    rides.run()
    assert 2 <= files(pathlib.Path(rides.table.path) / "changes" / "batch_id=0") <= 4
    empty = files(pathlib.Path(rides.table.path) / "redrive")

    def closed(refused):
        return refused.withColumn("value", F.concat("value", F.lit("}")))

    assert rides.table.redrive(closed) == N
    assert files(pathlib.Path(rides.table.path) / "redrive") - empty >= 2
    rides.run()
    assert rides.table.current().count() == N
    assert [r["value"] for r in rides.table.open_rejects().collect()] == ["junk"]
