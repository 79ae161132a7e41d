"""The plans are what they should be at scale: no shuffle where none is needed, each costly
expression once, code the JVM compiles, and hot keys reduced before the shuffle."""

import pytest
from pyspark.sql import functions as F
from trips import envelope

from lazaret.contracts import PROCESSED, enforce
from lazaret.operators import faults, metrics
from lazaret.operators.repair import overlay
from lazaret.operators.routing import triage
from lazaret.plans.loop import resolve, visit
from lazaret.plans.presets import LINEITEM, TRIP
from lazaret.streaming.streams import Hub, Pipeline, repaired, validated

# HotSpot leaves a method above this many bytes to the interpreter.
JIT_LIMIT = 8000


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def method_sizes(df):
    stages = df._jdf.queryExecution().debug().codegenToSeq().iterator()
    sizes = []
    while stages.hasNext():
        sizes.append(stages.next()._3().maxMethodCodeSize())
    return sizes


@pytest.fixture
def messages(spark, folder):
    envelope(spark).write.parquet(f"{folder}/messages")
    return spark.read.parquet(f"{folder}/messages")


@pytest.fixture
def items(spark, folder):
    row = (
        "id AS l_orderkey, id AS l_partkey, id AS l_suppkey, cast(id % 7 AS int) AS l_linenumber,"
        " 1.0D AS l_quantity, 1.0D AS l_extendedprice, 0.1D AS l_discount, 0.1D AS l_tax,"
        " 'N' AS l_returnflag, 'F' AS l_linestatus, '2024-01-01' AS l_shipdate"
    )
    spark.range(50).selectExpr(*row.split(", ")).write.parquet(f"{folder}/items")
    stored = spark.read.parquet(f"{folder}/items")
    return faults.inject(
        faults.plan(stored, LINEITEM.key, LINEITEM.fault_fields, 0.5), LINEITEM.fault_fields
    )


def pipeline():
    return Pipeline.of(TRIP, Hub("/nowhere"), "/nowhere")


@pytest.mark.parametrize(
    "build",
    [
        lambda d: resolve(d, LINEITEM.rules, LINEITEM.policies),
        lambda d: resolve(d, LINEITEM.rules, LINEITEM.policies).filter("outcome = 'failed'"),
        lambda d: visit(d.withColumn("retry_count", F.lit(0)), LINEITEM.rules, LINEITEM.policies),
        lambda d: triage(d, LINEITEM.rules).filter("route = 'dlq'"),
    ],
)
def test_rows_stay_where_they_are(items, build):
    df = build(items)
    text = plan(df)
    assert "Exchange" not in text and "Python" not in text
    assert text.count("md5(") == 1
    assert max(method_sizes(df)) < JIT_LIMIT


@pytest.mark.parametrize("build", [validated, repaired])
@pytest.mark.parametrize("kept", ["true", "route IN ('processed', 'retry')"])
def test_messages_are_parsed_once(messages, build, kept):
    df = build(messages, pipeline()).filter(kept)
    text = plan(df)
    # once into types, once more as text, which runs for unfit messages alone, and once more to see
    # whether anything follows, which runs for those with braces inside
    assert text.count("from_json(") == 3
    assert "Exchange" not in text and "Python" not in text
    assert max(method_sizes(df)) < JIT_LIMIT


def test_copies_are_dropped_before_the_shuffle(spark):
    rows = spark.range(100).selectExpr(
        "cast(id % 3 AS string) AS message_id", "'t' AS topic", "0 AS partition", "id AS msg_offset"
    )
    above, between, below = plan(enforce(rows, PROCESSED)).split("WindowGroupLimit")
    assert "Exchange" in between and "Exchange" not in above + below


def test_fixes_are_reduced_before_the_shuffle(spark):
    rows = spark.range(10).selectExpr("cast(id AS string) AS message_id", "id AS a")
    text = plan(overlay(rows, rows, ["a"]))
    assert "Partial" in text.split("WindowGroupLimit", 2)[2]
    # nothing is broadcast by decree
    assert not overlay(rows, rows, ["a"])._jdf.queryExecution().logical().toString().count("hint")


def test_depth_shuffles_partial_results(messages):
    text = plan(metrics.depth_totals(messages))
    assert "Expand" in text and text.count("partial_max") == 1
    # the grouping sets are expanded above the first aggregate, not over the messages
    assert text.index("Expand") < text.index("partial_max")
    assert "value" not in text.split("ReadSchema")[1]


def test_wide_rule_sets_stay_compiled(messages):
    rules = [*TRIP.rules, *TRIP.rules]
    p = Pipeline(TRIP.schema, rules, TRIP.policies, Hub("/nowhere"), "/nowhere")
    df = validated(messages, p).filter(F.col("route") == "dlq")
    assert max(method_sizes(df)) < 2 * JIT_LIMIT
