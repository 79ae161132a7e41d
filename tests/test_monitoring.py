import json
import os

from pyspark.sql import functions as F
from trips import envelope

from lazaret.functions.codec import decode
from lazaret.operators import events, metrics
from lazaret.plans import jobs
from lazaret.plans.presets import EVENTS, TRIP
from lazaret.sources.tables import scan
from lazaret.sources.topics import Topic, append_topic, topic_table
from lazaret.streaming.streams import Hub, Pipeline, validate_stream


def offsets(spark):
    return spark.createDataFrame(
        [("t", 0, 5), ("t", 0, 9), ("t", 1, 0), ("u", 0, 3)],
        "topic string, partition int, offset bigint",
    )


def test_depth(spark):
    got = {(r["topic"], r["partition"]): r["depth"] for r in metrics.depth(offsets(spark)).collect()}
    assert got == {("t", 0): 5, ("t", 1): 1, ("u", 0): 1}
    rows = metrics.depth_totals(offsets(spark), "rows").collect()
    got = {(r["topic"], r["partition"]): r["depth"] for r in rows}
    assert got[("t", None)] == 3 and got[(None, None)] == 4


def test_alerts(spark):
    df = spark.createDataFrame(
        [(f"2024-01-01 0{h}:10:00", e) for h, e in [(0, 1), (0, 0), (1, 1), (1, 1), (2, 0)]],
        "ts string, e int",
    ).withColumn("ts", F.col("ts").cast("timestamp"))
    found = metrics.alerts(df, "ts", F.col("e") == 1, 0.5, "1 hour").collect()
    assert [(r["messages"], r["failures"], r["ratio"]) for r in found] == [(2, 2, 1.0)]
    assert metrics.alerts(df, "ts", F.col("e") == 1, 0.5, "1 hour", at_least=3).count() == 0


def test_status(spark):
    rows = metrics.status(offsets(spark).withColumn("status", F.lit("PENDING"))).collect()
    assert {r["topic"]: r["messages"] for r in rows} == {"t": 3, "u": 1}


def test_rule_counts(spark):
    read = decode(envelope(spark), TRIP.schema)
    got = {r["rule"]: r["n"] for r in metrics.rule_counts(read, TRIP.rules).collect()}
    assert got["decode"] == 3 and got["RateCodeID:one_of"] == 3
    assert got["fare_amount:at_least"] == 5


def test_run_summary():
    got = metrics.run_summary({"records": 200, "damaged": 3}, 4.0)
    assert got["records_per_second"] == 50.0 and got["damaged_percent"] == 1.5
    assert metrics.run_summary({"records": 0}, 0.0)["records_per_second"] == 0.0


def test_log_documents(spark, folder):
    df = spark.createDataFrame([(1, "x")], "id int, s string")
    now = F.lit("2024-01-02 03:04:05.678901").cast("timestamp")
    logged = events.log_rows(df, now=now)
    document = json.loads(logged.toJSON().first())
    data = document.pop("data")
    assert document == {"@timestamp": "2024-01-02T03:04:05.678901", "level": events.LEVEL, "message": events.MESSAGE}
    assert data == {"event": events.EVENT, "record": {"id": 1, "s": "x"}, "timestamp": 1704164645678}
    assert events.log_rows(df).first()["@timestamp"] is not None


def test_normalise(spark):
    df = spark.createDataFrame(
        [("2024-01-02T03:04:05.678Z", "1", "x", "m"), ("nonsense", "1", "x", "m")],
        "timestamp string, `@version` string, `@timestamp` string, message string",
    )
    rows = events.normalise(df).collect()
    assert set(rows[0].asDict()) == {"timestamp", "message", "index"}
    assert [r["index"] for r in rows] == ["dlq-logs-2024.01.02", "dlq-logs-unknown"]


def test_quarantine_is_recorded_checked_and_backed_up(spark, folder):
    hub = Hub(f"{folder}/hub", "events")
    rows = spark.range(100).selectExpr(
        "id AS event_id", "'2024-01-01 00:00:00' AS ts", "id AS user_id", "'click' AS event_type",
        "cast(-id AS double) AS value", "'{\"k\": 1}' AS props",
    )
    summary = jobs.publish(rows, EVENTS, hub.published(), rate=0.0)
    assert summary["records"] == 100 and summary["damaged"] == 0
    p = Pipeline.of(EVENTS, hub, f"{folder}/checkpoints")
    validate_stream(spark, p, availableNow=True).awaitTermination()

    dlq = jobs.dlq_table(f"{folder}/dlq")
    jobs.record_quarantine(spark, hub.quarantine(), dlq)
    held = scan(spark, dlq)
    assert held.count() == 99
    first = held.first()
    assert first["error"] == "value:at_least" and first["status"] == "PENDING"
    assert json.loads(first["payload"])["event_type"] == "click"

    depth = jobs.check_depth(spark, hub.quarantine(), f"{folder}/log")
    assert depth.filter("topic IS NULL").first()["depth"] == 99
    logged = spark.read.json(f"{folder}/log").first()
    assert logged["data"]["record"]["dlq_size"] == 99

    path = jobs.backup(spark, dlq, folder, "20240101_000000")
    assert path.endswith("dlq_backups/20240101_000000") and os.path.isdir(path)
    assert spark.read.option("header", True).option("escape", '"').csv(path).count() == 99

    done = jobs.reprocess(spark, p)
    assert done["records"] == 99


def test_depth_of_a_folder_topic_counts_rows(spark, folder):
    topic = Topic("t", f"{folder}/t")
    rows = offsets(spark).selectExpr(
        "'k' AS key", "'{}' AS value", "topic", "partition", "offset",
        "current_timestamp() AS timestamp",
    )
    append_topic(rows, topic, 0)
    assert jobs.check_depth(spark, topic).filter("topic IS NULL").first()["depth"] == 4


def test_publish_csv(spark, folder):
    rows = spark.range(50).selectExpr(
        "id AS event_id", "'2024-01-01 00:00:00' AS ts", "id AS user_id", "'click' AS event_type",
        "cast(id AS double) AS value", "'x' AS props",
    )
    rows.write.option("header", True).csv(f"{folder}/csv")
    topic = Topic("events", f"{folder}/events")
    summary = jobs.publish_csv(spark, f"{folder}/csv", EVENTS, topic, limit=20, rate=1.0)
    assert (summary["records"], summary["damaged"]) == (20, 20)
    summary = jobs.publish_csv(spark, f"{folder}/csv", EVENTS, topic, None, batch_id=1)
    assert summary["records"] == 50 and topic_table(spark, topic).count() == 70
    # places are unique and messages carry a retry count
    stored = topic_table(spark, topic)
    assert stored.filter("value LIKE '%\"retry_count\":0%'").count() == 70
