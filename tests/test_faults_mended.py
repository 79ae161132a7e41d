"""Cases that once gave wrong values, lost rows or stopped a job."""

from types import SimpleNamespace

import pandas as pd
import pytest
from pyspark.sql import functions as F

from lazaret.catalog.files import jdbc_append
from lazaret.contracts import schema_of
from lazaret.functions.cleaning import Policy
from lazaret.functions.codec import decode
from lazaret.operators.repair import repair
from lazaret.plans import jobs
from lazaret.plans.loop import resolve
from lazaret.plans.presets import EVENTS
from lazaret.sources import readers
from lazaret.sources.tables import scan
from lazaret.sources.topics import Topic, topic_table

BIG = 9007199254740993  # 2^53 + 1, which double precision does not have


def test_valid_64_bit_values_stay_beside_a_repair(spark):
    rows = spark.createDataFrame(
        [(1, "2024-01-01", BIG, "view", -5.0, None), (BIG, "2024-01-01", BIG + 2, "view", None, None)],
        "event_id long, ts string, user_id long, event_type string, value double, props string",
    )
    ends = {r["event_id"]: r for r in resolve(rows, EVENTS.rules, EVENTS.policies).collect()}
    assert (ends[1]["user_id"], ends[1]["value"]) == (BIG, 5.0)
    assert ends[BIG]["user_id"] == BIG + 2


def test_texts_of_long_integers_are_read_exactly(spark):
    schema = schema_of(id="long", n="long", small="integer", price="double")
    values = [
        f'{{"id":{BIG},"n":"{BIG}","small":"7.9","price":"$1.50"}}',
        f'{{"id":{BIG},"n":"9,007,199,254,740,993","small":"x","price":-2.5}}',
        f'{{"id":"no {BIG}","n":{BIG},"small":2147483648,"price":"1e3"}}',
    ]
    df = spark.createDataFrame([(v, "t", 0, i) for i, v in enumerate(values)], "value string, topic string, partition int, offset long")
    policies = [Policy("id", clean="exponent", to="bigint"), Policy("n", clean="exponent", to="bigint"),
                Policy("small", clean="exponent", to="int", default=1), Policy("price", clean="exponent", to="double", absolute=True)]
    found = repair(decode(df, schema), policies).orderBy("message.offset").select("id", "n", "small", "price").collect()
    assert [tuple(r) for r in found] == [(BIG, BIG, 7, 1.5), (BIG, BIG, 1, 2.5), (BIG, BIG, 1, 1000.0)]


def test_typed_numbers_that_are_none_are_repaired(spark):
    df = spark.createDataFrame([(float("nan"),), (float("inf"),), (None,), (1e300,)], "x double")
    found = repair(df, [Policy("x", clean="exponent", to="double", default=0.0)]).collect()
    assert [r["x"] for r in found] == [0.0, 0.0, 0.0, 1e300]


def test_decimals_are_not_rounded(spark):
    df = spark.sql("SELECT CAST('12345678901234567890.12' AS DECIMAL(38,2)) AS x")
    assert str(repair(df, [Policy("x", clean="exponent")]).first()["x"]) == "12345678901234567890.12"


TEXTS = ['say "hi", ok', "two\nlines", 'a,"b', "", " blanks ", "plain", "back\\slash", '""']


@pytest.mark.parametrize("typed", [True, False])
def test_csv_as_other_tools_write_it(spark, folder, typed):
    pd.DataFrame({"n": range(len(TEXTS)), "t": TEXTS}).to_csv(f"{folder}/a.csv", index=False, quoting=2)
    schema = schema_of(n="long", t="string") if typed else None
    rows = readers.read_csv(spark, f"{folder}/a.csv", schema).orderBy("n").collect()
    assert [r["t"] or "" for r in rows] == TEXTS


def test_options_come_before_the_defaults(spark, folder):
    with open(f"{folder}/a.csv", "w") as f:
        f.write("n;t\n1;a\n2;b\n")
    rows = readers.read_csv(spark, f"{folder}/a.csv", schema_of(n="long", t="string"), options={"sep": ";", "multiLine": False})
    assert [tuple(r) for r in rows.collect()] == [(1, "a"), (2, "b")]


def test_published_csv_keeps_quoted_texts(spark, folder):
    rows = pd.DataFrame({"event_id": [1, 2], "ts": ["x", "y"], "user_id": [BIG, 2], "event_type": ["view", "view"], "value": [1.0, 2.0], "props": TEXTS[:2]})
    rows.to_csv(f"{folder}/events.csv", index=False)
    topic = Topic("events", f"{folder}/topic")
    summary = jobs.publish_csv(spark, f"{folder}/events.csv", EVENTS, topic)
    read = decode(topic_table(spark, topic), EVENTS.schema).orderBy("event_id").collect()
    assert [(r["event_id"], r["user_id"], r["props"]) for r in read] == [(1, BIG, TEXTS[0]), (2, 2, TEXTS[1])]
    assert summary["records"] == 2 and summary["damaged"] == 0


def test_nothing_is_damaged_unless_asked_for(spark):
    rows = spark.range(20_000).select(
        F.col("id").alias("event_id"), F.lit("t").alias("ts"), F.col("id").alias("user_id"), F.lit("view").alias("event_type"),
        F.lit(1.0).alias("value"), F.lit("p").alias("props"),
    )
    assert jobs.messages(rows, EVENTS, "events").filter("fault").count() == 0


@pytest.mark.parametrize("path", ["topic", "validate/batch=*/route=dlq"])
def test_jobs_before_the_first_message(spark, folder, path):
    topic, table = Topic("events_dlq", f"{folder}/{path}"), jobs.dlq_table(f"{folder}/dlq")
    assert jobs.record_quarantine(spark, topic, table) in (None, {"offered": 0, "rejected": 0})
    assert scan(spark, table).count() == 0
    assert [tuple(r) for r in jobs.check_depth(spark, topic, f"{folder}/log").collect()] == [(None, None, 0)]
    assert '"dlq_size":0' in spark.read.text(f"{folder}/log").first()["value"].replace(" ", "")


def test_landing_names_the_stores_it_reaches(spark):
    assert readers.SCHEMES["s3a"] == "s3"
    with pytest.raises(ValueError, match="wasbs"):
        readers._located("wasbs://container@account/path")


@pytest.mark.parametrize("master", ["local-cluster[3,2,3000]", "spark://host:7077", "yarn"])
def test_executors_of_their_own_need_a_database_that_they_reach(master):
    with pytest.raises(ValueError, match="spark.lazaret.jdbc.url"):
        jdbc_append(SimpleNamespace(conf={"spark.master": master}), "unread")
