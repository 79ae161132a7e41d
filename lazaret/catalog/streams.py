"""The two coupled streams over event messages, run until nothing is left to read."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lazaret.catalog.inputs import EVENT_RULES, event_ctes, event_place, events, reasons_sql
from lazaret.contracts import FAILED, PROCESSED
from lazaret.functions.codec import decode
from lazaret.plans import jobs
from lazaret.plans.presets import EVENTS
from lazaret.sources.storage import work_folder
from lazaret.sources.tables import Table, append_table, scan
from lazaret.sources.topics import Topic, topic_table
from lazaret.streaming import logged
from lazaret.streaming.streams import (
    Hub,
    Pipeline,
    Separate,
    drain,
    processed_contract,
    progress,
    validate_stream,
)

_RATE = 0.25


def _publish(spark: SparkSession, sf_dir: str, topic: Topic) -> None:
    jobs.publish(events(spark, sf_dir), EVENTS, topic, rate=_RATE, **event_place())


def _hub(spark: SparkSession, sf_dir: str, label: str) -> Pipeline:
    root = work_folder(spark, label)
    hub = Hub(root, "events")
    _publish(spark, sf_dir, hub.published())
    return Pipeline.of(EVENTS, hub, f"{root}/checkpoints")


def stream_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run of the validate stream: the processed rows and the quarantined messages."""
    p = _hub(spark, sf_dir, "stream_validate")
    validate_stream(spark, p, availableNow=True).awaitTermination()
    columns = ["message_id", "retry_count", "failed_rules"]
    processed = p.sinks.table(spark, "processed", p.schema)
    held = decode(topic_table(spark, p.sinks.quarantine()), p.schema)
    return (
        processed.withColumn("route", F.lit("processed"))
        .select("route", "data.event_id", *columns)
        .unionByName(held.withColumn("route", F.lit("dlq")).select("route", "event_id", *columns))
    )


def stream_reprocess(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quarantine reprocessed once: what goes back to the source topic."""
    p = _hub(spark, sf_dir, "stream_reprocess")
    validate_stream(spark, p, availableNow=True).awaitTermination()
    jobs.reprocess(spark, p)
    back = Topic("events", f"{p.sinks.root}/repair/batch=*/route=retry")
    sent = decode(topic_table(spark, back), p.schema)
    return sent.select(
        "message_id", "retry_count", "failed_rules", "user_id", "event_type", "value", "props"
    )


def _ends(processed: DataFrame, failed: DataFrame) -> DataFrame:
    """Both ends of the loop; a message processed after a retry counts as repaired."""
    outcome = F.when(F.col("retry_count") > 0, "repaired").otherwise("processed")
    columns = ["message_id", "outcome", "retry_count", "failed_rules", "error"]
    return (
        processed.withColumn("outcome", outcome)
        .select(*columns)
        .unionByName(failed.withColumn("outcome", F.lit("failed")).select(*columns))
    )


def stream_loop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both streams in turn until the loop is empty, all routes in one folder."""
    p = _hub(spark, sf_dir, "stream_loop")
    drain(spark, p)
    return _ends(
        p.sinks.table(spark, "processed", p.schema), p.sinks.table(spark, "failed", p.schema)
    )


def stream_loop_separate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with a topic or table of its own for each route."""
    root = work_folder(spark, "stream_loop_separate")
    sinks = Separate(
        Topic("events", f"{root}/events"),
        Topic("events_dlq", f"{root}/events_dlq"),
        Table(processed_contract(EVENTS.schema), f"{root}/processed"),
        Table(FAILED, f"{root}/failed"),
    )
    _publish(spark, sf_dir, sinks.source())
    p = Pipeline.of(EVENTS, sinks, f"{root}/checkpoints")
    drain(spark, p)
    processed = sinks.table(spark, "processed").withColumn("error", F.lit(None).cast("string"))
    return _ends(processed, sinks.table(spark, "failed"))


def publish_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two publishes into one topic, places left to the publisher: where every message ends, once."""
    root = work_folder(spark, "publish_twice")
    hub = Hub(root, "events")
    rows = events(spark, sf_dir)
    for half in (0, 1):
        part = rows.filter(F.col("event_id") % 2 == half)
        jobs.publish(part, EVENTS, hub.published(), rate=0.0)
    p = Pipeline.of(EVENTS, hub, f"{root}/checkpoints")
    drain(spark, p)
    ends = _ends(hub.table(spark, "processed", p.schema), hub.table(spark, "failed", p.schema))
    return ends.groupBy("outcome").agg(F.countDistinct("message_id").alias("messages"))


def stream_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The loop run on one checkpoint three times, messages published in between and none before the last run: every message,
    with how often it was processed or failed."""
    root = work_folder(spark, "stream_restart")
    hub = Hub(root, "events")
    p = Pipeline.of(EVENTS, hub, f"{root}/checkpoints")
    rows = events(spark, sf_dir)
    for third in (0, 1, None):
        if third is not None:
            part = rows.filter(F.col("event_id") % 2 == third)
            jobs.publish(part, EVENTS, hub.published(), rate=_RATE, **event_place())
        drain(spark, p)
    ends = _ends(hub.table(spark, "processed", p.schema), hub.table(spark, "failed", p.schema))
    return ends.groupBy("message_id").agg(F.count(F.lit(1)).alias("times"), F.max("outcome").alias("outcome"))


def record_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quarantine recorded in the DLQ table, twice: its messages, each once."""
    p = _hub(spark, sf_dir, "record_quarantine")
    validate_stream(spark, p, availableNow=True).awaitTermination()
    target = jobs.dlq_table(f"{p.sinks.root}/dlq_table")
    for _ in range(2):
        jobs.record_quarantine(spark, p.sinks.quarantine(), target)
    return scan(spark, target).select("message_id", "partition", "msg_offset", "error", "retry_count", "status")


def reprocess_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The summary of a reprocessing run: messages taken from the quarantine, sent back and given up."""
    p = _hub(spark, sf_dir, "reprocess_totals")
    validate_stream(spark, p, availableNow=True).awaitTermination()
    summary = jobs.reprocess(spark, p)
    kept = ("records", "retry", "failed", "retry_percent")
    return spark.createDataFrame(
        [tuple(summary[k] for k in kept)], "records bigint, retry bigint, failed bigint, retry_percent double"
    )


def publish_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A CSV file as other tools write it (doubled quotes, line ends in values) published whole, some of its rows damaged, and
    read back from the topic."""
    root = work_folder(spark, "publish_csv")
    said = F.concat(F.lit('say "hi",\n'), "props")
    events(spark, sf_dir).withColumn("props", said).write.options(header=True, escape='"', quoteAll=True).csv(f"{root}/events.csv")
    topic = Topic("events", f"{root}/topic")
    jobs.publish_csv(spark, f"{root}/events.csv", EVENTS, topic, rate=_RATE)
    read = decode(topic_table(spark, topic), EVENTS.schema)
    return read.select(*EVENTS.schema.fieldNames(), "retry_count")


def _log_hub(spark: SparkSession, label: str) -> Pipeline:
    root = work_folder(spark, label)
    return Pipeline.of(EVENTS, logged.LogHub(root, "events"), f"{root}/checkpoints")


def stream_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The loop over commit logs, followed as streams: half of the messages, the logs folded, the other half with some of the first again,
    the logs folded once more and read."""
    p = _log_hub(spark, "stream_compacted")
    rows = events(spark, sf_dir)
    for part in (rows.filter("event_id % 2 = 0"), rows.filter("event_id % 2 = 1 OR event_id % 10 = 0")):
        jobs.publish(part, EVENTS, p.sinks.published(), rate=_RATE, **event_place())
        for stage in logged.ROUTES:
            logged.follow(spark, p, stage, availableNow=True).awaitTermination()
        logged.drain(spark, p)
        p.sinks.compact(spark, p.schema)
    return _ends(
        p.sinks.table(spark, "processed", p.schema), p.sinks.table(spark, "failed", p.schema)
    )


def unique_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overlapping batches of the same messages into a hub of commit logs and into a table: how often each identity is there."""
    p = _log_hub(spark, "unique_index")
    rows = events(spark, sf_dir)
    target = Table(PROCESSED, f"{p.sinks.root}/table")
    for batch, part in enumerate(("event_id % 3 != 0", "event_id % 3 != 1", "event_id % 3 != 2")):
        jobs.publish(rows.filter(part), EVENTS, p.sinks.published(), batch, **event_place())
        sent = decode(jobs.messages(rows.filter(part), EVENTS, "events", **event_place()), EVENTS.schema)
        stored = sent.select("message_id", "message.topic", "message.partition", F.col("message.offset").alias("msg_offset"))
        append_table(stored, target, batch)
    logged.drain(spark, p)
    ends = [p.sinks.table(spark, r, p.schema).select("message_id") for r in ("processed", "failed")]
    places = [("hub", ends[0].unionByName(ends[1])), ("table", scan(spark, target).select("message_id"))]
    counted = [ids.groupBy("message_id").agg(F.count(F.lit(1)).alias("times")).withColumn("place", F.lit(place)) for place, ids in places]
    return counted[0].unionByName(counted[1])


def stream_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages sent twice, in one batch, over batches and over a restart: how often each was processed or failed."""
    root = work_folder(spark, "stream_dedupe")
    hub = Hub(root, "events")
    p = Pipeline.of(EVENTS, hub, f"{root}/checkpoints", dedupe="1 hour")
    rows = events(spark, sf_dir)
    for part in ("event_id % 2 = 0", "event_id % 3 = 0 OR event_id % 2 = 1"):
        sent = rows.filter(part)
        jobs.publish(sent.union(sent.filter("event_id % 7 = 0")), EVENTS, hub.published(), rate=_RATE, **event_place())
        drain(spark, p)
    ends = _ends(hub.table(spark, "processed", p.schema), hub.table(spark, "failed", p.schema))
    return ends.groupBy("message_id").agg(F.count(F.lit(1)).alias("times"), F.max("outcome").alias("outcome"))


def run_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the micro-batches of a loop noted while they ran, over a restart: the rows of each route in all, and whether a batch was noted twice."""
    p = _hub(spark, sf_dir, "run_progress")
    p = replace(p, progress=f"{p.sinks.root}/progress")
    validate_stream(spark, p, availableNow=True).awaitTermination()
    drain(spark, p)
    rows = progress(spark, p.progress)
    once = rows.groupBy("stage", "run", "batch").count().filter("count > 1").count() == 0
    routes = rows.select("stage", F.explode("counts").alias("route", "n")).groupBy("stage", "route").agg(F.sum("n").alias("n"))
    return routes.withColumn("once", F.lit(once))


def stream_repaired(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fields of every message at the end of the loop."""
    p = _hub(spark, sf_dir, "stream_repaired")
    drain(spark, p)
    ends = [p.sinks.table(spark, r, p.schema).select("data.*") for r in ("processed", "failed")]
    return ends[0].unionByName(ends[1]).drop("ts")


QUERIES = {
    "stream_validate": stream_validate,
    "stream_reprocess": stream_reprocess,
    "stream_loop": stream_loop,
    "stream_loop_separate": stream_loop_separate,
    "stream_repaired": stream_repaired,
    "publish_twice": publish_twice,
    "stream_restart": stream_restart,
    "record_quarantine": record_quarantine,
    "reprocess_totals": reprocess_totals,
    "publish_csv": publish_csv,
    "stream_compacted": stream_compacted,
    "unique_index": unique_index,
    "stream_dedupe": stream_dedupe,
    "run_progress": run_progress,
}

_FIXED = {"user_id": "coalesce(user_id, 1)", "value": "abs(value)"}
_FIXED_RULES = EVENT_RULES
for _name, _sql in _FIXED.items():
    _FIXED_RULES = _FIXED_RULES.replace(_name, _sql)

_JUDGED = f"""{event_ctes(_RATE)},
judged AS (
  SELECT *, sha256('events|' || (event_id % 3) || '|' || (event_id // 3)) AS message_id,
    coalesce({EVENT_RULES}, false) AS ok, coalesce({_FIXED_RULES}, false) AS ok_fixed,
    {reasons_sql("events")} AS why, {reasons_sql("events", _FIXED)} AS why_fixed
  FROM damaged)"""

_LOOP = f"""
WITH {_JUDGED}
SELECT message_id,
  CASE WHEN ok THEN 'processed' WHEN ok_fixed THEN 'repaired' ELSE 'failed' END AS outcome,
  CASE WHEN ok THEN 0 WHEN ok_fixed THEN 1 ELSE 3 END AS retry_count,
  CASE WHEN ok THEN NULL WHEN ok_fixed THEN why ELSE why_fixed END AS failed_rules,
  CASE WHEN NOT ok AND NOT ok_fixed THEN 'Max retries exceeded' END AS error
FROM judged"""

_TIMES = f"""
WITH {_JUDGED}
SELECT message_id, CAST(1 AS BIGINT) AS times,
  CASE WHEN ok THEN 'processed' WHEN ok_fixed THEN 'repaired' ELSE 'failed' END AS outcome
FROM judged"""

ORACLES = {
    "stream_validate": f"""
WITH {_JUDGED}
SELECT CASE WHEN ok THEN 'processed' ELSE 'dlq' END AS route, event_id, message_id,
  0 AS retry_count, why AS failed_rules
FROM judged""",
    "stream_reprocess": f"""
WITH {_JUDGED}
SELECT message_id, 1 AS retry_count, why AS failed_rules, {_FIXED["user_id"]} AS user_id,
  event_type, {_FIXED["value"]} AS value, props
FROM judged WHERE NOT ok""",
    "stream_loop": _LOOP,
    "stream_loop_separate": _LOOP,
    "publish_twice": f"""
WITH {event_ctes(0.0)},
ends AS (
  SELECT CASE WHEN coalesce({EVENT_RULES}, false) THEN 'processed'
    WHEN coalesce({_FIXED_RULES}, false) THEN 'repaired' ELSE 'failed' END AS outcome
  FROM damaged)
SELECT outcome, count(*) AS messages FROM ends GROUP BY outcome""",
    "stream_restart": _TIMES,
    "record_quarantine": f"""
WITH {_JUDGED}
SELECT message_id, CAST(event_id % 3 AS INTEGER) AS partition, event_id // 3 AS msg_offset,
  why AS error, 0 AS retry_count, 'PENDING' AS status
FROM judged WHERE NOT ok""",
    "reprocess_totals": f"""
WITH {_JUDGED}
SELECT count(*) AS records, count(*) AS retry, CAST(0 AS BIGINT) AS failed, 100.0::DOUBLE AS retry_percent
FROM judged WHERE NOT ok""",
    "publish_csv": f"""
WITH {event_ctes(_RATE)}
SELECT event_id, ts, user_id, event_type, value,
  CASE WHEN props = 'invalid_value' THEN props ELSE 'say "hi",' || chr(10) || props END AS props, 0 AS retry_count
FROM damaged""",
    "stream_compacted": _LOOP,
    "stream_dedupe": _TIMES,
    "run_progress": f"""
WITH {_JUDGED},
n AS (
  SELECT count(*) FILTER (WHERE ok) AS good, count(*) FILTER (WHERE NOT ok AND ok_fixed) AS fixed,
    count(*) FILTER (WHERE NOT ok AND NOT ok_fixed) AS bad FROM judged)
SELECT 'validate' AS stage, 'processed' AS route, good + fixed AS n, true AS once FROM n
UNION ALL SELECT 'validate', 'dlq', fixed + 3 * bad, true FROM n
UNION ALL SELECT 'repair', 'retry', fixed + 2 * bad, true FROM n
UNION ALL SELECT 'repair', 'failed', bad, true FROM n""",
    "unique_index": f"""
WITH {_JUDGED}
SELECT message_id, CAST(1 AS BIGINT) AS times, place FROM judged, (VALUES ('hub'), ('table')) p(place)""",
    "stream_repaired": f"""
WITH {_JUDGED}
SELECT event_id, CASE WHEN ok THEN user_id ELSE {_FIXED["user_id"]} END AS user_id, event_type,
  CASE WHEN ok THEN value ELSE {_FIXED["value"]} END AS value, props
FROM judged""",
}
