"""Versioned fixes, statuses kept by batch, bounded heads, and what streams note about themselves."""

import datetime as dt
import random
from dataclasses import replace

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lazaret.operators import metrics
from lazaret.operators.repair import overlay_as_of
from lazaret.plans import jobs
from lazaret.plans.presets import EVENTS
from lazaret.sources import readers, storage
from lazaret.sources.commits import CommitLog
from lazaret.streaming import monitor, streams
from lazaret.streaming.streams import Hub, Pipeline, validate_stream
from tests.test_logs import events, place

START = dt.datetime(2024, 1, 1)


def at(minutes):
    return None if minutes is None else START + dt.timedelta(minutes=minutes)


def test_fixes_as_of_a_time(spark):
    rng = random.Random(1)
    keys = ["hot"] * 400 + [f"k{i}" for i in range(20)] + [None]
    rows = [(i, rng.choice(keys), at(rng.randint(0, 300)) if rng.random() < 0.97 else None, rng.choice([None, -1.0]), "t") for i in range(1500)]
    fixes = [(rng.choice(keys), at(rng.randint(0, 300)), rng.choice([None, float(i)]), f"u{i}") for i in range(200)]
    df = spark.createDataFrame(rows, "id long, message_id string, timestamp timestamp, price double, corrected_by string").repartition(7)
    known = spark.createDataFrame([*fixes, (None, at(1), 5.0, "x"), ("hot", None, 6.0, "y"), fixes[0]], "message_id string, valid_from timestamp, price double, corrected_by string")
    found = {r["id"]: (r["price"], r["corrected_by"], r["corrected"]) for r in overlay_as_of(df, known, ["price", "corrected_by"]).collect()}

    def order(fix):
        return fix[1], fix[2] is not None, fix[2] or 0, fix[3]

    for i, key, time, price, by in rows:
        held = [f for f in fixes if f[0] == key and key is not None and time is not None and f[1] <= time]
        fix = max(held, key=order) if held else None
        assert found[i] == ((price, by, False) if fix is None else (price if fix[2] is None else fix[2], fix[3], True))


def test_no_fixes(spark):
    df = spark.createDataFrame([(1, "a", at(1), 2.0)], "id long, message_id string, timestamp timestamp, price double")
    none = spark.createDataFrame([], "message_id string, valid_from timestamp, price double")
    assert [tuple(r) for r in overlay_as_of(df, none, ["price"]).collect()] == [(1, "a", at(1), 2.0, False)]
    assert overlay_as_of(df.limit(0), none, ["price"]).collect() == []


@pytest.mark.parametrize("n", [0, 1, 999, 1000, 2500, 10_000])
def test_heads_of_exactly_so_many_rows(spark, folder, n):
    path = f"{folder}/rows"
    spark.range(3000).repartition(7).write.parquet(path)
    first = readers.head(spark.read.parquet(path), n)
    assert "Exchange" not in first._jdf.queryExecution().executedPlan().toString()
    assert first.count() == first.distinct().count() == min(n, 3000)


def test_status_by_batches(spark, folder):
    log = CommitLog(f"{folder}/status")
    schema = T.StructType([T.StructField("topic", T.StringType()), T.StructField("status", T.StringType())])
    assert metrics.merged_status(spark, log, schema).collect() == []
    rows = [(f"m{i}", "t" if i % 3 else None, "PENDING", i) for i in range(300)]
    for batch, part, new in (("a", rows[:200], True), ("b", rows[100:], True), ("a", rows[:200], False)):
        df = spark.createDataFrame(part, "message_id string, topic string, status string, sketch int")
        assert metrics.append_status(df, log, batch) is new
    found = {r["topic"]: (r["messages"], r["different"]) for r in metrics.merged_status(spark, log, schema).collect()}
    assert {t: n for t, (n, _) in found.items()} == {"t": sum(bool(i % 3) for i in range(200)) + sum(bool(i % 3) for i in range(100, 300)), None: 67 + 67 - 1}
    assert abs(found["t"][1] - 200) <= 10 and abs(found[None][1] - 100) <= 5


def test_a_batch_that_was_not_noted_is_counted(spark, folder):
    hub = Hub(f"{folder}/hub", "events")
    p = Pipeline.of(EVENTS, hub, f"{folder}/checkpoints", progress=f"{folder}/progress")
    assert streams.progress(spark, p.progress).collect() == []
    jobs.publish(events(spark, 0, 30), EVENTS, hub.published(), **place())
    validate_stream(spark, p, availableNow=True).awaitTermination()
    (row,) = streams.progress(spark, p.progress).collect()
    # the note is lost, and the batch is offered again
    (name,) = storage.names(spark, p.progress)
    storage.remove(spark, f"{p.progress}/{name}")
    streams._note(spark, p, row["stage"], row["run"], row["batch"], None, 0.0)
    (again,) = streams.progress(spark, p.progress).collect()
    assert again["counts"] == row["counts"] and again["repeated"] and not row["repeated"]
    streams._note(spark, replace(p), row["stage"], row["run"], row["batch"], {"processed": 0}, 0.0)  # noted once
    assert streams.progress(spark, p.progress).collect() == [again]


def test_windows_are_reported_once_and_late_rows_told(spark, folder):
    schema = "t timestamp, bad boolean"

    def send(part, rows):
        spark.createDataFrame([(at(m), b) for m, b in rows], schema).coalesce(1).write.parquet(f"{folder}/topic/part={part}")
        stream = spark.readStream.schema(schema).option("recursiveFileLookup", True).parquet(f"{folder}/topic")
        monitor.totals_stream(stream, "t", F.col("bad"), f"{folder}/totals", f"{folder}/checkpoint", delay="5 minutes", availableNow=True).awaitTermination()

    assert monitor.totals(spark, f"{folder}/totals").collect() == []
    send(0, [(1, True), (2, False), (61, True), (130, False), (None, True)])
    send(1, [(3, True), (62, True), (4, None), (125, True), (200, False)])
    closed = monitor.totals(spark, f"{folder}/totals")
    found = {r["window_start"]: (r["messages"], r["failures"]) for r in closed.collect()}
    assert found == {at(0): (2, 1), at(60): (1, 1), at(120): (2, 1)}
    assert [r["window_start"] for r in monitor.alerts(closed, 0.5).collect()] == [at(60)]
    stored = spark.read.schema(schema).option("recursiveFileLookup", True).parquet(f"{folder}/topic")
    late = {r["window_start"]: r["late"] for r in monitor.late(closed, stored, "t", F.col("bad")).collect()}
    assert late == {at(0): 2, at(60): 1}


def test_300_files_of_three_headers_in_few_jobs(spark, folder):
    heads = [("a,b,c", "{i},{i}.5,x"), ("c,a", "y,{big}"), ('"b" ,a', "n/a,7")]
    paths = []
    for i in range(300):
        header, row = heads[i % 3]
        paths.append(f"{folder}/f{i} x.csv")
        with open(paths[-1], "w") as f:
            f.write(f"{header}\n{row.format(i=i, big=2**40 + i)}\n")
    spark.sparkContext.setJobGroup("many", "many")
    jobs.batch_load(spark, paths, f"{folder}/out", allow_missing=True)
    spark.sparkContext.setJobGroup("other", "other")
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("many")) <= 30  # listings included; one per file would be 300
    loaded = spark.read.parquet(f"{folder}/out")
    assert dict(loaded.dtypes) == {"a": "bigint", "b": "string", "c": "string"}  # n/a makes b a text in all files
    assert loaded.count() == 300 and loaded.agg(F.max("a")).first()[0] == 2**40 + 298


def test_types_that_hold_both():
    kinds = {
        "int": T.IntegerType(), "long": T.LongType(), "double": T.DoubleType(), "date": T.DateType(), "time": T.TimestampType(), "text": T.StringType(), "none": T.NullType(),
    }
    cases = {("int", "long"): "long", ("double", "int"): "double", ("date", "time"): "time", ("date", "int"): "text", ("none", "int"): "int", ("text", "none"): "text"}
    for (a, b), c in cases.items():
        assert readers.wider(kinds[a], kinds[b]) == readers.wider(kinds[b], kinds[a]) == kinds[c]


def test_only_changed_files_are_copied(spark, folder):
    import os

    os.makedirs(f"{folder}/in/sub")
    for name, text in (("a.csv", "1"), ("sub/b.csv", "2"), ("c.txt", "3")):
        with open(f"{folder}/in/{name}", "w") as f:
            f.write(text)

    def land():
        return {r["path"].rsplit("/", 1)[1]: r["copied"] for r in readers.land_changed(spark, f"{folder}/in", f"{folder}/out").collect()}

    assert land() == {"a.csv": True, "b.csv": True} and land() == {}
    os.utime(f"{folder}/in/a.csv", (1_000_000, 1_000_000))  # another time, the same bytes
    with open(f"{folder}/in/sub/b.csv", "w") as f:
        f.write("22")
    assert land() == {"a.csv": False, "b.csv": True} and land() == {}
    assert open(f"{folder}/out/raw/sub/b.csv").read() == "22"
    os.remove(f"{folder}/in/a.csv")
    assert land() == {} and os.path.exists(f"{folder}/out/raw/a.csv")
    assert {r["path"].rsplit("/", 1)[1]: r["length"] for r in readers.manifest(spark, f"{folder}/out").collect()} == {"a.csv": 1, "b.csv": 2}


def test_chain_of_backups(spark, folder):
    from lazaret.contracts import Contract, schema_of
    from lazaret.sources.tables import Table, append_table

    table = Table(Contract("t", schema_of(message_id="string", n="long")), f"{folder}/t")
    assert jobs.backup_chain(spark, table, folder, "empty") == {"rows": 0}
    for i in range(3):
        append_table(spark.createDataFrame([(f"{i}-{k}", k) for k in range(i + 2)], "message_id string, n long"), table, i)
        assert jobs.backup_chain(spark, table, folder, f"link {i}") == {"rows": i + 2}
    assert jobs.backup_chain(spark, table, folder, "link 1") is None
    assert [jobs.restore_chain(spark, table, folder, f"link {i}").count() for i in range(3)] == [2, 5, 9]
    assert jobs.restore_chain(spark, table, folder).count() == 9 and jobs.restore_chain(spark, table, folder, "empty").count() == 0
    with pytest.raises(ValueError, match="no link"):
        jobs.restore_chain(spark, table, folder, "other")
