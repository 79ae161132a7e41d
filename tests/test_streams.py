"""Restart, replay and arrival in several batches."""

import os
from dataclasses import replace

import pytest
from pyspark.sql import functions as F
from trips import envelope

from lazaret.contracts import FAILED
from lazaret.plans import jobs
from lazaret.plans.presets import EVENTS, TRIP
from lazaret.sources.tables import Table
from lazaret.sources.topics import Topic, append_topic, topic_table
from lazaret.streaming.streams import (
    Hub,
    Pipeline,
    Separate,
    drain,
    processed_contract,
    retry_stream,
    validate_stream,
    validating,
)


def start(spark, folder):
    hub = Hub(f"{folder}/hub", "trips")
    append_topic(envelope(spark), hub.published(), 0, "publisher")
    return hub, Pipeline.of(TRIP, hub, f"{folder}/checkpoints")


def rows(spark, hub):
    return {
        (r["message_id"], route, r["retry_count"], r["failed_rules"])
        for route in ("processed", "failed")
        for r in hub.table(spark, route, TRIP.schema).collect()
    }


def counted(spark, hub):
    return sum(hub.table(spark, r, TRIP.schema).count() for r in ("processed", "failed"))


def test_restart_and_late_messages(spark, folder):
    """Stopped between runs and fed in parts, the streams end where one run ends."""
    one, p = start(spark, f"{folder}/one")
    drain(spark, p)
    expected = rows(spark, one)
    assert counted(spark, one) == len(expected)

    late = Hub(f"{folder}/late", "trips")
    q = Pipeline.of(TRIP, late, f"{folder}/late/checkpoints")
    messages = envelope(spark)
    append_topic(messages.filter("offset < 10"), late.published(), 0, "publisher")
    validate_stream(spark, q, availableNow=True).awaitTermination()
    append_topic(messages.filter("offset >= 10"), late.published(), 1, "publisher")
    retry_stream(spark, q, availableNow=True).awaitTermination()
    drain(spark, q)
    assert rows(spark, late) == expected and counted(spark, late) == len(expected)


def test_replayed_batch_changes_nothing(spark, folder):
    hub, p = start(spark, folder)
    validate_stream(spark, p, availableNow=True).awaitTermination()
    before = counted(spark, hub)
    # the commit of the batch is lost, as when the driver dies right after the sink's write
    commits = f"{folder}/checkpoints/validate/commits"
    for name in os.listdir(commits):
        os.remove(os.path.join(commits, name))
    validate_stream(spark, p, availableNow=True).awaitTermination()
    assert counted(spark, hub) == before
    drain(spark, p)
    assert counted(spark, hub) == envelope(spark).count()


def test_two_publishes_are_two_sets_of_messages(spark, folder):
    first = spark.range(100).selectExpr(
        "id AS event_id", "'2024-01-01 00:00:00' AS ts", "id AS user_id", "'click' AS event_type",
        "1.0D AS value", "'x' AS props",
    )
    sinks = Separate(
        Topic("events", f"{folder}/events"),
        Topic("events_dlq", f"{folder}/events_dlq"),
        Table(processed_contract(EVENTS.schema), f"{folder}/processed"),
        Table(FAILED, f"{folder}/failed"),
    )
    p = Pipeline.of(EVENTS, sinks, f"{folder}/checkpoints")
    for rows in (first, first.withColumn("event_id", F.col("event_id") + 100)):
        jobs.publish(rows, EVENTS, sinks.source(), rate=0.0)
    drain(spark, p)
    stored = sinks.table(spark, "processed")
    assert stored.count() == 200 and stored.select("message_id").distinct().count() == 200
    jobs.publish(first, EVENTS, sinks.source(), "named", rate=0.0)
    with pytest.raises(FileExistsError):
        jobs.publish(first, EVENTS, sinks.source(), "named", rate=0.0)


def test_new_checkpoint_reads_on(spark, folder):
    """A stream with a new checkpoint does not take the batches of an earlier one for its own."""
    hub, p = start(spark, folder)
    validate_stream(spark, p, availableNow=True).awaitTermination()
    before = counted(spark, hub)
    q = Pipeline.of(TRIP, hub, f"{folder}/others")
    late = envelope(spark).withColumn("offset", F.col("offset") + 1000)
    append_topic(late, hub.published(), 1, "publisher")
    validate_stream(spark, q, availableNow=True).awaitTermination()
    ids = {m for m, *_ in rows(spark, hub)}
    assert len(ids) == 2 * before


def test_drain_stops_when_nothing_goes_back(spark, folder):
    hub, p = start(spark, folder)
    drain(spark, p)
    assert len(drain(spark, p)) == 2
    assert counted(spark, hub) == envelope(spark).count()


def test_reprocess_counts_every_batch(spark, folder):
    hub, p = start(spark, folder)
    validate_stream(spark, p, availableNow=True).awaitTermination()
    held = topic_table(spark, hub.quarantine())
    n = held.count()
    hub.emit("validate", held.withColumn("route", F.lit("dlq")), "more")
    slow = replace(p, sinks=OneFileAtATime(hub.root, hub.name))
    done = jobs.reprocess(spark, slow)
    assert done["records"] == 2 * n and done["retry"] == done["records"]


class OneFileAtATime(Hub):
    def quarantine(self):
        topic = super().quarantine()
        return Topic(topic.name, topic.path, options={"maxFilesPerTrigger": "1"})


def test_retry_stream_may_start_first(spark, folder):
    hub, p = start(spark, folder)
    retry_stream(spark, p, availableNow=True).awaitTermination()
    assert counted(spark, hub) == 0
    assert validating(spark, p).isStreaming
