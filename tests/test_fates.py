"""Every literal message comes to its end: in one pass, in rounds and through the streams."""

import pytest
from pyspark.sql import functions as F
from trips import FATES, NAMES, envelope

from lazaret.contracts import FAILED
from lazaret.functions.codec import decode
from lazaret.plans.loop import iterate, resolve
from lazaret.plans.presets import TRIP, with_cleaning
from lazaret.sources.tables import Table
from lazaret.sources.topics import Topic, append_topic
from lazaret.streaming.streams import Hub, Pipeline, Separate, drain, processed_contract

EXPECTED = {name: (end, count) for name, (_, end, count, _) in FATES.items()}


def ends(df):
    rows = df.select("offset", "outcome", "retry_count").collect()
    found = {NAMES[r["offset"]]: (r["outcome"], r["retry_count"]) for r in rows}
    assert len(found) == len(rows)
    return found


def with_offset(df):
    return df.withColumn("offset", F.col("message.offset"))


def test_reasons_agree_between_one_pass_and_streams(spark, folder):
    ended = resolve(decode(envelope(spark), TRIP.schema), TRIP.rules, TRIP.policies)
    sinks = hub(folder)
    run(spark, sinks, folder)
    columns = ["message_id", "retry_count", "failed_rules", "error"]
    streamed = sinks.table(spark, "processed", TRIP.schema).unionByName(
        sinks.table(spark, "failed", TRIP.schema)
    )
    once, streamed = ended.select(*columns), streamed.select(*columns)
    assert once.exceptAll(streamed).isEmpty() and streamed.exceptAll(once).isEmpty()


def test_one_pass(spark):
    ended = resolve(decode(envelope(spark), TRIP.schema), TRIP.rules, TRIP.policies)
    assert ends(with_offset(ended)) == EXPECTED


def test_rounds(spark, folder):
    decoded = decode(envelope(spark), TRIP.schema)
    ended = iterate(decoded, TRIP.rules, TRIP.policies, folder)
    assert ends(with_offset(ended)) == EXPECTED


def test_one_pass_and_rounds_agree_on_all_columns(spark, folder):
    decoded = decode(envelope(spark), TRIP.schema)
    a = resolve(decoded, TRIP.rules, TRIP.policies)
    b = iterate(decoded, TRIP.rules, TRIP.policies, folder).select(*a.columns)
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def hub(folder):
    return Hub(f"{folder}/hub", "trips")


def separate(folder):
    return Separate(
        Topic("trips", f"{folder}/trips"),
        Topic("trips_dlq", f"{folder}/trips_dlq"),
        Table(processed_contract(TRIP.schema), f"{folder}/processed"),
        Table(FAILED, f"{folder}/failed"),
    )


def tables(spark, sinks):
    if isinstance(sinks, Hub):
        found = [sinks.table(spark, r, TRIP.schema) for r in ("processed", "failed")]
        return [
            df.select("*", "data.*").withColumn("msg_offset", F.col("offset")) for df in found
        ]
    return [sinks.table(spark, r) for r in ("processed", "failed")]


def run(spark, sinks, folder, **options):
    topic = sinks.published() if isinstance(sinks, Hub) else sinks.source()
    append_topic(envelope(spark), topic, 0, "publisher")
    p = Pipeline.of(TRIP, sinks, f"{folder}/checkpoints", **options)
    drain(spark, p)
    processed, failed = tables(spark, sinks)
    outcome = F.when(F.col("retry_count") > 0, "repaired").otherwise("processed")
    columns = [F.col("msg_offset").alias("offset"), "outcome", "retry_count"]
    return ends(
        processed.withColumn("outcome", outcome)
        .select(*columns)
        .union(failed.withColumn("outcome", F.lit("failed")).select(*columns))
    )


@pytest.mark.parametrize("sinks", [hub, separate])
def test_streams(spark, folder, sinks):
    assert run(spark, sinks(folder), folder) == EXPECTED


def test_streams_three_valued_and_typed(spark, folder):
    """With every loss switched on, the messages of the last column are gone."""
    policies = with_cleaning(TRIP.policies, "strip")
    sinks = hub(folder)
    topic = sinks.published()
    append_topic(envelope(spark), topic, 0, "publisher")
    p = Pipeline(
        TRIP.schema,
        TRIP.rules,
        policies,
        sinks,
        f"{folder}/checkpoints",
        mode="typed",
        null_verdict="drop",
        null_count="drop",
    )
    drain(spark, p)
    processed, failed = tables(spark, sinks)
    found = {}
    for r in processed.select("msg_offset", "retry_count").collect():
        found[NAMES[r["msg_offset"]]] = "repaired" if r["retry_count"] else "processed"
    for r in failed.select("msg_offset").collect():
        found[NAMES[r["msg_offset"]]] = "failed"
    expected = {n: end for n, (_, _, _, end) in FATES.items() if end not in (None, "lost")}
    found.pop("fare_nan", None)
    assert found == expected


def test_failed_rows_keep_reasons_and_text(spark, folder):
    sinks = hub(folder)
    run(spark, sinks, folder)
    failed = {
        NAMES[r["offset"]]: r
        for r in sinks.table(spark, "failed", TRIP.schema).collect()
    }
    assert failed["not_json"]["failed_rules"] == "decode"
    assert failed["not_json"]["value"] == "{not json"
    assert failed["fare_nan"]["failed_rules"] == "decode"
    assert "NaN" in failed["fare_nan"]["value"]
    assert failed["null_value"]["value"] == ""
    assert failed["null_value"]["failed_rules"] == "decode"
    assert failed["count_large"]["failed_rules"] == "passenger_count:between"
    assert failed["count_large"]["error"] == "Max retries exceeded"
    assert failed["fare_text"]["failed_rules"] == "fare_amount:at_least"
    assert '"fare_amount":"invalid_value"' in failed["fare_text"]["value"]
    # repairing a number with an exponent keeps it
    assert failed["fare_large_bad_count"]["data"]["fare_amount"] == pytest.approx(1e7)
    assert failed["fare_small_bad_count"]["data"]["fare_amount"] == pytest.approx(5e-4)
    missing = failed["empty_object"]["failed_rules"].split(",")
    assert "tpep_pickup_datetime:not_null" in missing and "VendorID:not_null" not in missing


def test_repaired_values(spark, folder):
    sinks = hub(folder)
    run(spark, sinks, folder)
    rows = {
        NAMES[r["offset"]]: r
        for r in sinks.table(spark, "processed", TRIP.schema).collect()
    }
    assert rows["fare_dollars"]["data"]["fare_amount"] == 12.5
    assert rows["fare_negative"]["data"]["fare_amount"] == 12.0
    assert rows["count_missing"]["data"]["passenger_count"] == 1
    assert rows["vendor_text"]["data"]["VendorID"] == 1
    # what was wrong stays on record
    assert rows["fare_negative"]["failed_rules"] == "fare_amount:at_least"
    assert rows["base"]["failed_rules"] is None


def test_the_loop_of_no_rows(spark, folder):
    from lazaret.functions.rules import not_null
    from lazaret.plans.loop import iterate

    ended = iterate(spark.createDataFrame([], "id int, name string"), [not_null("id")], [], f"{folder}/rounds")
    assert ended.count() == 0
