"""Lookups by time: the rows, and the files that are opened for them."""

import datetime as dt
import random

import pytest

from lazaret.sources import zones

SCHEMA = "topic string, status string, timestamp timestamp, n long"
START = dt.datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(1)
    topics = ["hot"] * 8 + ["a", "b", None]
    return [(rng.choice(topics), rng.choice(["PENDING", "RESOLVED", None]), START + dt.timedelta(minutes=rng.randint(0, 1000)) if rng.random() < 0.95 else None, i) for i in range(4000)]


@pytest.fixture(scope="module")
def clustered(spark, rows, tmp_path_factory):
    path = f"{tmp_path_factory.mktemp('zones')}/c"
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert zones.cluster(df, path, ["topic", "status"], "timestamp", files=20) and not zones.cluster(df, path, ["topic", "status"], "timestamp")
    return path, df.schema


@pytest.mark.parametrize("topic", ["hot", None])
@pytest.mark.parametrize("status", ["PENDING"])
@pytest.mark.parametrize("span", [(None, None), (100, 160), (None, 30), (970, None)])
def test_rows_and_files(spark, rows, clustered, topic, status, span):
    path, schema = clustered
    since, until = (None if m is None else START + dt.timedelta(minutes=m) for m in span)
    found = zones.lookup(spark, path, schema, {"topic": topic, "status": status}, "timestamp", since, until)
    fits = [
        r for r in rows if r[0] == topic and r[1] == status
        and (since is None or (r[2] is not None and r[2] >= since)) and (until is None or (r[2] is not None and r[2] < until))
    ]
    assert sorted(r["n"] for r in found.collect()) == sorted(r[3] for r in fits)
    opened = {f.rsplit("_part=", 1)[1].split("/")[0] for f in found.inputFiles()} if fits else set()
    assert len(opened) <= (10 if span == (None, None) else 4)


def test_nothing_to_cluster(spark, tmp_path):
    none = spark.createDataFrame([], SCHEMA)
    zones.cluster(none, f"{tmp_path}/c", ["topic"], "timestamp")
    assert zones.lookup(spark, f"{tmp_path}/c", none.schema, {"topic": "a"}, "timestamp").collect() == []
