"""Depth, status, alerts, run summaries and the event log."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lazaret.catalog.inputs import (
    RATE,
    event_ctes,
    event_messages,
    event_place,
    events,
    table,
)
from lazaret.operators import events as log
from lazaret.operators import metrics
from lazaret.plans import jobs
from lazaret.plans.presets import EVENTS
from lazaret.sources.commits import CommitLog
from lazaret.sources.storage import work_folder
from lazaret.sources.topics import Topic, append_topic
from lazaret.streaming import monitor


def topic_depth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Depth per topic partition by offsets, with totals."""
    return metrics.depth_totals(event_messages(spark, sf_dir, rate=0.0))


def depth_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The depth job over a stored topic, which logs the total; the log read back."""
    root = work_folder(spark, "depth_check")
    topic = Topic("events", f"{root}/events")
    append_topic(event_messages(spark, sf_dir), topic, 0)
    jobs.check_depth(spark, topic, f"{root}/log")
    logged = spark.read.schema("data struct<event string, record struct<dlq_size bigint>>").json(
        f"{root}/log"
    )
    return logged.select("data.event", "data.record.dlq_size")


def status_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages per kind and day."""
    counts = metrics.status(table(spark, sf_dir, "events"), ["event_type"], "ts")
    return counts.withColumn("bucket", F.date_format("bucket", "yyyy-MM-dd"))


def failure_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six-hour windows in which more than a quarter of the messages are errors."""
    found = metrics.alerts(
        table(spark, sf_dir, "events"), "ts", F.col("event_type") == "error", 0.25, "6 hours"
    )
    times = {c: F.date_format(c, "yyyy-MM-dd HH:mm") for c in ("window_start", "window_end")}
    return found.withColumns(times)


def status_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily counts by type kept up by batches, one of them of late rows and one repeated, the log folded in between; and whether
    the sketch is near the number of different events."""
    log = CommitLog(work_folder(spark, "status_incremental"))
    rows = table(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "event_type")
    late = "event_id % 10 = 0"
    parts = {"a": f"NOT {late} AND ts < '2024-01-15'", "b": f"NOT {late} AND ts >= '2024-01-15'", "late": late}
    schema = T.StructType([T.StructField("event_type", T.StringType()), T.StructField("bucket", T.TimestampType())])
    for batch in ("a", "b", "a", "late"):
        metrics.append_status(rows.filter(parts[batch]), log, batch, ("event_type",), "ts", key="event_id")
        log.compact(spark, {"status": T.StructType([*schema.fields, *metrics.PARTIAL.fields])})
    found = metrics.merged_status(spark, log, schema)
    near = F.abs(F.col("different") - F.col("messages")) <= F.col("messages") * 0.1 + 1
    return found.select("event_type", F.date_format("bucket", "yyyy-MM-dd").alias("bucket"), "messages", near.alias("near"))


def stream_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same alerts from a stream, in two runs on one checkpoint: the events, then copies of early ones that come too late and a
    message that closes the last window. With the late rows of each window."""
    root = work_folder(spark, "stream_alerts")
    rows = table(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "event_type")
    rows.write.parquet(f"{root}/topic/part=0")
    schema, failed = rows.schema, F.col("event_type") == "error"

    def run() -> None:
        stream = spark.readStream.schema(schema).option("recursiveFileLookup", True).parquet(f"{root}/topic")
        query = monitor.totals_stream(stream, "ts", failed, f"{root}/totals", f"{root}/checkpoint", "6 hours", availableNow=True)
        query.awaitTermination()

    run()
    behind = rows.filter("event_id % 50 = 0 AND ts < '2024-01-20'")
    last = rows.agg(F.lit(None).cast("long").alias("event_id"), F.expr("max(ts) + INTERVAL 2 DAYS").alias("ts"), F.lit("view").alias("event_type"))
    behind.unionByName(last).write.parquet(f"{root}/topic/part=1")
    run()
    closed = monitor.totals(spark, f"{root}/totals")
    stored = spark.read.schema(schema).option("recursiveFileLookup", True).parquet(f"{root}/topic")
    late = monitor.late(closed, stored, "ts", failed, "6 hours")
    found = monitor.alerts(closed, 0.25).join(late, "window_start", "left").withColumn("late", F.coalesce("late", F.lit(0).cast("long")))
    return found.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm") for c in ("window_start", "window_end")})


def publish_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a publish run reports about itself, observed while it writes."""
    topic = Topic("events", work_folder(spark, "publish_summary"))
    summary = jobs.publish(events(spark, sf_dir), EVENTS, topic, rate=RATE, **event_place())
    kept = ("records", "damaged", "damaged_percent")
    return spark.createDataFrame(
        [tuple(summary[k] for k in kept)], "records bigint, damaged bigint, damaged_percent double"
    )


def log_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log documents cleaned up: documents per daily index."""
    documents = table(spark, sf_dir, "events").select(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"),
        F.lit("1").alias("@version"),
        F.lit("shipped").alias("@timestamp"),
        F.col("event_type").alias("message"),
    )
    cleaned = log.normalise(documents)
    assert "@version" not in cleaned.columns
    return cleaned.groupBy("index").agg(
        F.count(F.lit(1)).alias("n"), F.count("timestamp").alias("timed")
    )


def log_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A log document per event, written as JSON lines by day and read back."""
    root = work_folder(spark, "log_documents")
    rows = table(spark, sf_dir, "events")
    documents = log.log_rows(
        rows.withColumn("ts", F.col("ts").cast("timestamp")),
        now=F.col("ts").cast("timestamp"),
    )
    by_day = documents.withColumn("index", F.substring("`@timestamp`", 1, 10))
    log.write_log(by_day, root)
    record = "struct<event_id: bigint, event_type: string, value: double>"
    read = spark.read.schema(
        "`@timestamp` string, level string, message string,"
        f" data struct<event: string, record: {record}, timestamp: bigint>, `index` string"
    ).json(root)
    return read.select(
        F.col("`@timestamp`").alias("at"),
        F.col("index").alias("day"),
        "level",
        "message",
        "data.event",
        F.col("data.timestamp").alias("millis"),
        "data.record.event_id",
        "data.record.event_type",
        "data.record.value",
    )


QUERIES = {
    "topic_depth": topic_depth,
    "depth_check": depth_check,
    "status_rollup": status_rollup,
    "failure_alerts": failure_alerts,
    "stream_alerts": stream_alerts,
    "status_incremental": status_incremental,
    "publish_summary": publish_summary,
    "log_daily": log_daily,
    "log_documents": log_documents,
}

ORACLES = {
    "topic_depth": """
WITH placed AS (SELECT event_id % 3 AS p, event_id // 3 AS o FROM events),
depths AS (
  SELECT 'events' AS topic, CAST(p AS INTEGER) AS partition, max(o) - min(o) + 1 AS depth
  FROM placed GROUP BY p)
SELECT topic, partition, CAST(sum(depth) AS BIGINT) AS depth
FROM depths GROUP BY ROLLUP (topic, partition)""",
    "depth_check": "SELECT 'dlq_size' AS event, count(*) AS dlq_size FROM events",
    "status_rollup": """
SELECT event_type, strftime(ts, '%Y-%m-%d') AS bucket, count(*) AS messages
FROM events GROUP BY 1, 2""",
    "failure_alerts": """
WITH counted AS (
  SELECT time_bucket(INTERVAL 6 HOURS, ts) AS w, count(*) AS messages,
    count(*) FILTER (WHERE event_type = 'error') AS failures
  FROM events GROUP BY 1)
SELECT strftime(w, '%Y-%m-%d %H:%M') AS window_start,
  strftime(w + INTERVAL 6 HOURS, '%Y-%m-%d %H:%M') AS window_end,
  messages, failures, failures / messages AS ratio
FROM counted WHERE failures > messages * 0.25""",
    "status_incremental": """
SELECT event_type, strftime(ts, '%Y-%m-%d') AS bucket, count(*) AS messages, true AS near
FROM events GROUP BY 1, 2""",
    "stream_alerts": """
WITH counted AS (
  SELECT time_bucket(INTERVAL 6 HOURS, ts) AS w, count(*) AS messages,
    count(*) FILTER (WHERE event_type = 'error') AS failures,
    count(*) FILTER (WHERE event_id % 50 = 0 AND ts < TIMESTAMP '2024-01-20') AS late
  FROM events GROUP BY 1)
SELECT strftime(w, '%Y-%m-%d %H:%M') AS window_start,
  strftime(w + INTERVAL 6 HOURS, '%Y-%m-%d %H:%M') AS window_end,
  messages, failures, failures / messages AS ratio, late
FROM counted WHERE failures > messages * 0.25""",
    "publish_summary": f"""
WITH {event_ctes()}
SELECT count(*) AS records, count(*) FILTER (WHERE fault) AS damaged,
  100.0::DOUBLE * count(*) FILTER (WHERE fault) / count(*) AS damaged_percent
FROM damaged""",
    "log_daily": """
SELECT 'dlq-logs-' || strftime(ts, '%Y.%m.%d') AS "index", count(*) AS n, count(ts) AS timed
FROM events GROUP BY 1""",
    "log_documents": """
SELECT strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS at, strftime(ts, '%Y-%m-%d') AS day,
  'INFO' AS level, 'DLQ processing event' AS message, 'stream_processing' AS event,
  epoch_us(ts) // 1000 AS millis, event_id, event_type, value
FROM events""",
}
