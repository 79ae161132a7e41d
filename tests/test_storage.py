"""Sources, sinks, tables and contracts."""

import os

import pytest
from pyspark.sql import functions as F

from lazaret import contracts
from lazaret.contracts import DLQ, FAILED, PROCESSED, conform, enforce, schema_of, violations
from lazaret.operators.routing import fan_out, fan_out_to
from lazaret.operators.unions import union_all
from lazaret.plans import jobs
from lazaret.sources import readers, storage, tables
from lazaret.sources.tables import Table, append_table, scan, snapshot, write_dataset
from lazaret.sources.topics import Topic, append_topic, read_options, topic_table, write_options

PLACED = "message_id string, topic string, partition int, msg_offset bigint, n int"


def placed(spark, ids):
    return spark.createDataFrame([(f"m{i}", "t", i % 3, i, i) for i in ids], PLACED)


def write_text(folder, name, text):
    path = os.path.join(folder, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)
    return path


def test_csv_types_are_inferred_or_given(spark, folder):
    path = write_text(folder, "a.csv", "a,b,c\n1,x,1.5\n2,y,\n")
    inferred = readers.read_csv(spark, path)
    assert [t for _, t in inferred.dtypes] == ["int", "string", "double"]
    given = readers.read_csv(spark, path, schema_of(a="byte", b="string", c="float"), limit=1)
    assert [t for _, t in given.dtypes] == ["tinyint", "string", "float"] and given.count() == 1


def test_union_by_name(spark, folder):
    a = write_text(folder, "a.csv", "a,b\n1,x\n1,x\n")
    b = write_text(folder, "b.csv", "B,A\ny,2.5\n")
    united = union_all(readers.read_many(spark, [a, b]))
    # names match without case, types widen, duplicates stay
    assert united.dtypes == [("a", "double"), ("b", "string")] and united.count() == 3
    c = write_text(folder, "c.csv", "a\n3\n")
    with pytest.raises(Exception, match="(?i)column|b"):
        union_all(readers.read_many(spark, [a, c])).count()
    assert union_all(readers.read_many(spark, [a, c]), allow_missing=True).count() == 3


def test_batch_load_replaces(spark, folder):
    a = write_text(folder, "a.csv", "a,b\n1,x\n")
    for _ in range(2):
        assert jobs.batch_load(spark, [a], f"{folder}/out").count() == 1


def test_a_declared_schema_is_found_by_name(spark, folder):
    a = write_text(folder, "a.csv", "a,b,more\n1,x,9\n")
    b = write_text(folder, "b.csv", "B,A\ny,2\n")
    schema = schema_of(a="integer", b="string")
    loaded = jobs.batch_load(spark, [a, b], f"{folder}/out", schema)
    assert loaded.dtypes == [("a", "int"), ("b", "string")]
    assert sorted(map(tuple, loaded.collect())) == [(1, "x"), (2, "y")]
    c = write_text(folder, "c.csv", "b\nz\n")
    with pytest.raises(Exception, match="(?i)column|a"):
        jobs.batch_load(spark, [a, c], f"{folder}/out2", schema)
    assert jobs.batch_load(spark, [a, c], f"{folder}/out3", schema, allow_missing=True).count() == 2
    with pytest.raises(Exception, match="(?i)header|schema"):
        readers.read_csv(spark, [a, b], schema).collect()


def csv_names(folder, below):
    """The CSV files below a folder, by their place in it."""
    root = os.path.join(folder, below)
    found = (os.path.join(at, name) for at, _, names in os.walk(root) for name in names)
    return [os.path.relpath(path, root) for path in found if path.endswith(".csv")]


def test_discovery_and_landing(spark, folder):
    write_text(folder, "in/x/a.csv", "a,b\n001,x\n")
    write_text(folder, "in/readme.txt", "no")
    spark.range(3).write.parquet(f"{folder}/in/y/z/ids.parquet")
    assert readers.any_files(spark, f"{folder}/in")
    # quotes, blanks and line ends inside values, and one name in two folders
    text = 'a,b\r\n"say ""hi"", ok"," x "\n"two\nlines",\n\n'
    for place in ("y=1/q.csv", "y=2/q.csv", "odd name/ä%20+.csv"):
        write_text(folder, f"in/{place}", text + place)
    for _ in range(2):
        landed = readers.land_raw(spark, f"{folder}/in", f"{folder}/out")
        found = {r["landed"].split("/out/raw/")[1]: r["length"] for r in landed.collect()}
        csv = {name for name in found if name.endswith(".csv")}
        assert csv == {name for name in csv_names(folder, "in")} == set(csv_names(folder, "out/raw"))
        for name, length in found.items():
            with open(f"{folder}/in/{name}", "rb") as a, open(f"{folder}/out/raw/{name}", "rb") as b:
                data = a.read()
                assert data == b.read() and len(data) == length
    assert spark.read.parquet(f"{folder}/out/raw/y/z/ids.parquet").count() == 3
    assert readers.land_raw(spark, f"{folder}/in/odd name", f"{folder}/new", ["parquet"]).count() == 0


def test_nothing_found(spark, folder):
    write_text(folder, "in/readme.txt", "no")
    assert not readers.any_files(spark, f"{folder}/in")


def test_conform_projects_and_fills_defaults(spark):
    row = conform(placed(spark, [1]).withColumn("helper", F.lit(1)), DLQ).first()
    assert row.asDict().keys() == set(DLQ.schema.fieldNames())
    assert (row["status"], row["retry_count"]) == ("PENDING", 0)
    assert row["created_at"] is not None and row["payload"] is None


def test_enforce(spark):
    rows = placed(spark, [1, 2, 3]).union(placed(spark, [1, 1, 1]))
    rows = rows.withColumn("topic", F.when(F.col("n") != 3, F.col("topic")))
    kept = enforce(rows, PROCESSED, placed(spark, [2]))
    assert [r["message_id"] for r in kept.collect()] == ["m1"]
    assert [r["violation"] for r in violations(rows, PROCESSED).collect()] == ["topic"]


def test_contract_refuses_a_clash():
    with pytest.raises(ValueError):
        PROCESSED.with_fields(schema_of(topic="string"))
    assert set(contracts.FAILED.required) >= {"error", "retry_count"}


def test_append_table_once_per_batch(spark, folder):
    table = Table(PROCESSED.with_fields(schema_of(n="integer")), f"{folder}/t")
    assert scan(spark, table).count() == 0
    append_table(placed(spark, [1, 2]), table, 0)
    append_table(placed(spark, [1, 2]), table, 0)
    append_table(placed(spark, [3]), table, 1)
    assert sorted(r["n"] for r in scan(spark, table).collect()) == [1, 2, 3]


def test_unfinished_batch_is_not_read_and_is_written_again(spark, folder):
    table = Table(PROCESSED.with_fields(schema_of(n="integer")), f"{folder}/t")
    placed(spark, [1]).write.parquet(f"{folder}/t/_staging/broken_off")
    assert scan(spark, table).count() == 0
    append_table(placed(spark, [1, 2]), table, 0)
    assert scan(spark, table).count() == 2
    topic = Topic("t", f"{folder}/t")
    assert topic_table(spark, topic).count() == 2


def test_identity_is_unique_over_batches(spark, folder):
    table = Table(PROCESSED.with_fields(schema_of(n="integer")), f"{folder}/t")
    assert append_table(placed(spark, [1, 2, 2]), table, 0) == {"offered": 3, "rejected": 0}
    append_table(placed(spark, [2, 3]), table, 1)
    append_table(placed(spark, [1, 2, 3]), table)
    append_table(placed(spark, [4]), table)
    assert sorted(r["n"] for r in scan(spark, table).collect()) == [1, 2, 3, 4]


def test_refused_rows_are_kept(spark, folder):
    table = Table(PROCESSED.with_fields(schema_of(n="integer")), f"{folder}/t")
    rows = placed(spark, [1, 2, 3]).withColumn("topic", F.when(F.col("n") > 1, "t"))
    assert tables.rejects(spark, table).count() == 0
    assert append_table(rows, table, 0) == {"offered": 3, "rejected": 1}
    assert append_table(rows, table, 0) is None
    assert scan(spark, table).count() == 2
    found = tables.rejects(spark, table).collect()
    assert [(r["n"], r["violation"]) for r in found] == [(1, "topic")]


def test_same_identity_at_another_place_in_a_database(spark, folder):
    url = "jdbc:derby:memory:" + os.path.basename(folder).replace("-", "_") + ";create=true"
    table = Table(PROCESSED, url=url)
    rows = placed(spark, range(3))
    append_table(rows, table)
    append_table(rows.withColumn("msg_offset", F.col("msg_offset") + 100), table)
    assert scan(spark, table).count() == 3
    append_table(rows.withColumn("partition", F.lit(None).cast("int")), table)
    assert tables.rejects(spark, table).count() == 3


def test_lookup_prunes_folders(spark, folder):
    table = jobs.dlq_table(f"{folder}/dlq")
    rows = placed(spark, range(6)).withColumns(
        {
            "topic": F.concat(F.lit("t"), F.col("partition")),
            "timestamp": F.current_timestamp(),
            "payload": F.lit("{}"),
            "status": F.when(F.col("n") > 2, "RESOLVED"),
        }
    )
    append_table(rows, table, 0)
    pending = scan(spark, table).filter("topic = 't1' AND status = 'PENDING'")
    assert [r["message_id"] for r in pending.collect()] == ["m1"]
    plan = pending._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "topic" in filters and "status" in filters


def test_jdbc_table(spark, folder):
    url = "jdbc:derby:memory:" + os.path.basename(folder).replace("-", "_") + ";create=true"
    failed = Table(FAILED, url=url)
    rows = placed(spark, range(5)).withColumns(
        {"error": F.lit("Max retries exceeded"), "retry_count": F.lit(3), "own": F.lit(1)}
    )
    append_table(rows.filter("n < 3"), failed, 0)
    append_table(rows, failed, 1)
    append_table(rows, failed, 1)
    stored = scan(spark, failed).collect()
    assert sorted(r["message_id"] for r in stored) == [f"m{i}" for i in range(5)]
    assert all(r["failed_at"] is not None for r in stored)


def test_topic_in_a_folder(spark, folder):
    topic = Topic("t", f"{folder}/t")
    rows = spark.range(4).selectExpr(
        "'k' AS key", "'{}' AS value", "'other' AS topic", "0 AS partition", "id AS offset",
        "current_timestamp() AS timestamp",
    )
    append_topic(rows, topic, 0)
    append_topic(rows, topic, 0)
    append_topic(rows, topic, 0, "second")
    stored = topic_table(spark, topic)
    assert stored.count() == 8 and stored.select("topic").distinct().collect() == [("t",)]


def test_kafka_options():
    topic = Topic("t", servers="broker:9092", options={"minPartitions": "64"})
    assert topic.is_kafka and not Topic("t", "/x").is_kafka
    assert read_options(topic) == {
        "kafka.bootstrap.servers": "broker:9092",
        "subscribe": "t",
        "startingOffsets": "earliest",
        "minPartitions": "64",
    }
    assert write_options(topic) == {"kafka.bootstrap.servers": "broker:9092", "topic": "t"}


def test_fan_out_is_idempotent(spark, folder):
    rows = placed(spark, range(10)).withColumn(
        "route", F.when(F.col("n") < 3, "a").when(F.col("n") < 9, "b")
    )
    assert fan_out(rows, folder, 0, ("a", "b")) == {"a": 3, "b": 6}
    assert fan_out(rows, folder, 0, ("a", "b")) is None
    assert spark.read.parquet(folder).count() == 9


def test_fan_out_to_skips_empty_routes(spark):
    rows = placed(spark, range(4)).withColumn("route", F.lit("a"))
    calls = []
    counts = fan_out_to(
        rows, {"a": lambda d: calls.append(d.count()), "b": lambda d: calls.append("never")}
    )
    assert calls == [4] and counts == {"a": 4, "b": 0}
    assert fan_out_to(rows.filter("n > 9"), {"a": lambda d: calls.append("never")}) == {"a": 0}


def test_snapshot_and_dataset(spark, folder):
    rows = placed(spark, range(3)).withColumn("p", F.lit('{"a": "b, \\"c\\""}'))
    path = snapshot(rows, folder)
    name = os.path.basename(path)
    assert len(name) == 15 and name[8] == "_"
    back = spark.read.option("header", True).option("escape", '"').csv(path)
    assert back.select("p").distinct().first()[0] == '{"a": "b, \\"c\\""}'
    write_dataset(rows, f"{folder}/d", ["partition"])
    write_dataset(rows, f"{folder}/d", ["partition"])
    assert spark.read.parquet(f"{folder}/d").count() == 3


def test_work_folder_is_under_the_shared_root(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    path = storage.work_folder(spark, "x")
    assert path != storage.work_folder(spark, "x")
    if named:
        assert path.startswith(named)


def test_a_snapshot_keeps_blanks_and_line_ends(spark, folder):
    from lazaret.sources.tables import snapshot

    rows = [(1, '  {bad "'), (2, "a\nb "), (3, "x,y")]
    path = snapshot(spark.createDataFrame(rows, "id int, payload string"), folder, "backup")
    read = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    assert sorted((int(r.id), r.payload) for r in read.collect()) == rows
