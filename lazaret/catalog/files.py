"""Sources, sinks and tables: each query writes into a new folder under the shared root and reads
back what it wrote."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lazaret.catalog.inputs import (
    LINEITEM_RULES,
    damaged_lineitem,
    event_place,
    events,
    lineitem_ctes,
    reasons_sql,
    table,
)
from lazaret.contracts import DLQ, PROCESSED, Contract, enforce, schema_of, violations
from lazaret.functions.codec import decode
from lazaret.functions.identity import message_id
from lazaret.operators import faults
from lazaret.operators.routing import fan_out, triage
from lazaret.operators.unions import union_all
from lazaret.plans import jobs
from lazaret.plans.presets import LINEITEM
from lazaret.sources import zones
from lazaret.sources.readers import discover, land_changed, land_raw, read_csv
from lazaret.sources.storage import files_below, work_folder
from lazaret.sources.tables import Table, append_table, rejects, scan
from lazaret.sources.topics import Topic, topic_table

_ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]


def _order_halves(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Even and odd orders, the latter with their columns the other way round."""
    orders = table(spark, sf_dir, "orders").withColumn(
        "o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd")
    )
    even, odd = (orders.filter(F.col("o_orderkey") % 2 == k) for k in (0, 1))
    return [even, odd.select(*reversed(orders.columns))]


def union_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The halves united by column name: the orders again."""
    return union_all(_order_halves(spark, sf_dir))


def union_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One half lacks a column, which is filled with NULL."""
    even, odd = _order_halves(spark, sf_dir)
    united = union_all([even, odd.drop("o_orderpriority")], allow_missing=True)
    return united.select(*_ORDER_COLUMNS)


def _write_order_csv(spark: SparkSession, sf_dir: str, root: str) -> list[str]:
    paths = []
    for i, half in enumerate(_order_halves(spark, sf_dir)):
        paths.append(f"{root}/orders_{i}.csv")
        half.write.option("header", True).csv(paths[-1])
    return paths


def batch_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV files with columns in different orders, loaded into one Parquet dataset."""
    root = work_folder(spark, "batch_load")
    loaded = jobs.batch_load(spark, _write_order_csv(spark, sf_dir, root), f"{root}/orders")
    return loaded.select(
        F.col("o_orderkey").cast("bigint").alias("o_orderkey"),
        F.col("o_custkey").cast("bigint").alias("o_custkey"),
        "o_orderstatus",
        "o_totalprice",
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_orderdate"),
        "o_orderpriority",
    )


def batch_load_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many CSV files of three headers, given one by one and without a schema, loaded into one dataset; keys fit an integer in some files only."""
    root = work_folder(spark, "batch_load_many")
    even, odd = _order_halves(spark, sf_dir)
    big = even.withColumn("o_orderkey", F.col("o_orderkey") + F.lit(2**40)).filter("o_custkey % 2 = 0").drop("o_orderpriority")
    for i, part in enumerate((even, odd, big)):
        part.repartition(10).write.options(header=True, escape='"').csv(f"{root}/in{i}")
    paths = [path for path, _ in files_below(spark, root) if path.endswith(".csv")]
    loaded = jobs.batch_load(spark, paths, f"{root}/orders", allow_missing=True)
    return loaded.select(*_ORDER_COLUMNS).withColumns({c: F.col(c).cast("bigint") for c in ("o_orderkey", "o_custkey")})


def land_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files landed, one of the two datasets written anew, and landed again: what each run copied, and the orders that are landed then."""
    root = work_folder(spark, "land_changed")
    halves = _order_halves(spark, sf_dir)
    for i, half in enumerate(halves):
        half.write.parquet(f"{root}/in/{i}.parquet")
    runs = [land_changed(spark, f"{root}/in", root)]
    halves[1].filter("o_orderstatus = 'O'").write.mode("overwrite").parquet(f"{root}/in/1.parquet")
    runs.append(land_changed(spark, f"{root}/in", root))
    runs.append(land_changed(spark, f"{root}/in", root))
    dataset = F.regexp_extract("path", r"/([01])\.parquet/", 1)
    copied = [r.filter("copied").select(F.lit(i).alias("run"), dataset.alias("dataset")).distinct() for i, r in enumerate(runs)]
    landed = spark.read.parquet(f"{root}/raw/0.parquet").agg(F.count("o_orderkey").alias("n"))
    return union_all(copied).crossJoin(landed)


def lookup_by_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of one type in ten days, from a copy clustered by type and time."""
    path = f"{work_folder(spark, 'lookup_by_time')}/events"
    rows = table(spark, sf_dir, "events").select("event_type", F.col("ts").cast("timestamp").alias("ts"), "event_id", "value")
    zones.cluster(rows, path, ["event_type"], "ts", files=16)
    found = zones.lookup(spark, path, rows.schema, {"event_type": "error"}, "ts", "2024-01-10", "2024-01-20")
    return found.select("event_id", "event_type", "value")


def backup_in_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table backed up in a chain of three links while it grows, and restored as of each of them: its rows by link."""
    root = work_folder(spark, "backup_chain")
    target = Table(DLQ, f"{root}/table", partition_by=("topic", "status"))
    rows = table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("message_id"), F.lit("events").alias("topic"), F.lit(0).alias("partition"),
        F.col("event_id").alias("msg_offset"), F.col("ts").cast("timestamp").alias("timestamp"), F.col("props").alias("payload"),
    )
    for k in range(3):
        append_table(rows.filter(F.col("msg_offset") % 3 <= k), target, k)
        jobs.backup_chain(spark, target, root, f"link{k}")
    restored = [jobs.restore_chain(spark, target, root, f"link{k}").select(F.lit(k).alias("link"), "message_id", "payload", "status") for k in range(3)]
    return union_all(restored)


def csv_head(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A bounded scan of typed CSV: the number of rows it gives."""
    root = work_folder(spark, "csv_head")
    path = f"{root}/events.csv"
    rows = events(spark, sf_dir).drop("props")
    rows.write.option("header", True).csv(path)
    first = read_csv(spark, path, rows.schema, limit=700)
    return first.agg(
        F.count(F.lit(1)).alias("n"), F.count("event_id").alias("typed"), F.count("value").alias("v")
    )


def csv_head_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of a bounded scan, each with all its values among the events: how many there are."""
    path = f"{work_folder(spark, 'csv_head_rows')}/events.csv"
    rows = events(spark, sf_dir).drop("props")
    rows.write.option("header", True).csv(path)
    first = read_csv(spark, path, rows.schema, limit=700)
    return first.join(rows, rows.columns, "left_semi").agg(F.count(F.lit(1)).alias("n"))


def csv_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV files with columns in different orders, loaded under one declared schema."""
    root = work_folder(spark, "csv_by_name")
    schema = schema_of(
        o_orderkey="long", o_custkey="long", o_orderstatus="string",
        o_totalprice="double", o_orderdate="string", o_orderpriority="string",
    )
    return jobs.batch_load(spark, _write_order_csv(spark, sf_dir, root), f"{root}/orders", schema)


def csv_quoted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV as other tools write it, quotes doubled and line ends inside values, read with inferred and with declared types."""
    path = f"{work_folder(spark, 'csv_quoted')}/orders.csv"
    remark = F.concat(F.lit('say "'), "o_orderpriority", F.lit('", ok\n'), "o_orderstatus")
    rows = table(spark, sf_dir, "orders").select("o_orderkey", remark.alias("remark"), "o_totalprice")
    rows.write.options(header=True, escape='"', quoteAll=True).csv(path)
    inferred = read_csv(spark, path).select(F.lit("inferred").alias("types"), F.col("o_orderkey").cast("long").alias("o_orderkey"), "remark", "o_totalprice")
    return inferred.unionByName(read_csv(spark, path, rows.schema).withColumn("types", F.lit("declared")))


def raw_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV and Parquet found below a folder and landed in the raw zone, all values; the CSV datasets of two folders share
    a name and have texts with quotes, blanks at both ends and line ends."""
    root = work_folder(spark, "raw_landing")
    remark = F.concat(F.lit(' "'), "o_orderpriority", F.lit('",\n'), "o_orderstatus", F.lit(" "))
    for i, half in enumerate(_order_halves(spark, sf_dir)):
        kept = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
        written = half.withColumn("remark", remark).write.option("header", True).option("escape", '"')
        written.options(**kept).csv(f"{root}/in/half={i}/orders.csv")
    table(spark, sf_dir, "customer").write.parquet(f"{root}/in/b/c/customer.parquet")
    land_raw(spark, f"{root}/in", root)
    texts = {"header": True, "multiLine": True, "escape": '"'}
    orders = [
        spark.read.options(**texts).csv(f"{root}/raw/half={i}/orders.csv").select(
            F.lit(f"orders {i}").alias("dataset"),
            F.col("o_orderkey").cast("bigint").alias("id"),
            F.col("o_totalprice").cast("double").alias("amount"),
            F.col("remark"),
        )
        for i in (0, 1)
    ]
    customers = spark.read.parquet(f"{root}/raw/b/c/customer.parquet").select(
        F.lit("customer").alias("dataset"),
        F.col("c_custkey").alias("id"),
        F.col("c_acctbal").alias("amount"),
        F.col("c_name").alias("remark"),
    )
    return union_all([*orders, customers])


def file_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Datasets found below a folder, by format; a file of another kind is not found."""
    root = work_folder(spark, "file_listing")
    _write_order_csv(spark, sf_dir, f"{root}/a")
    table(spark, sf_dir, "customer").write.parquet(f"{root}/b/c/customer.parquet")
    table(spark, sf_dir, "nation").write.json(f"{root}/nation.json")
    parts = F.split("path", "/")
    found = discover(spark, root).filter("length > 0")
    return found.select(F.element_at(parts, -2).alias("dataset")).distinct()


def topic_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items published as messages, some damaged, and read back from the topic."""
    topic = Topic("lineitem", work_folder(spark, "topic_publish"))
    rows = table(spark, sf_dir, "lineitem").withColumn(
        "l_shipdate", F.date_format("l_shipdate", "yyyy-MM-dd")
    )
    jobs.publish(rows, LINEITEM, topic, rate=faults.FAILURE_RATE)
    read = decode(topic_table(spark, topic), LINEITEM.schema)
    return read.select(*LINEITEM.schema.fieldNames(), "retry_count")


def fan_out_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All routes of a batch written in one pass, the batch repeated, and the routes read back."""
    root = work_folder(spark, "fan_out")
    routed = triage(damaged_lineitem(spark, sf_dir), LINEITEM.rules)
    for _ in range(2):
        fan_out(routed, root, 0, ("processed", "dlq"))
    written = spark.read.option("basePath", root).parquet(f"{root}/batch=*")
    return written.select("l_orderkey", "l_partkey", "route", "failed_rules")


def _identified_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        events(spark, sf_dir)
        .withColumns({"topic": F.lit("events"), **event_place()})
        .withColumnRenamed("offset", "msg_offset")
        .withColumn("message_id", message_id("topic", "partition", "msg_offset"))
    )


_EVENTS_TABLE = PROCESSED.with_fields(schema_of(event_id="long", event_type="string"))
_APPENDED = ["message_id", "topic", "partition", "msg_offset", "event_id", "event_type"]


def _append_twice(rows: DataFrame, target: Table) -> None:
    """Three batches that overlap, the second one sent twice; the last one holds every row."""
    even = rows.filter("event_id % 2 = 0")
    append_table(rows.filter("event_id % 3 != 0"), target, 0)
    append_table(even, target, 1)
    append_table(even, target, 1)
    append_table(rows, target)


def table_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches appended to the processed table, one of them repeated."""
    target = Table(_EVENTS_TABLE, work_folder(spark, "table_append"))
    _append_twice(_identified_events(spark, sf_dir), target)
    return scan(spark, target).filter("processed_at IS NOT NULL").select(*_APPENDED)


def _one_process(spark: SparkSession) -> bool:
    """Whether tasks run in the driver's process. ``local-cluster`` starts executors of its own."""
    master = spark.conf.get("spark.master")
    return master == "local" or master.startswith("local[")


def jdbc_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same into a database.

    The address is ``spark.lazaret.jdbc.url``. In local mode alone an in-memory database serves
    where it is unset: only the process that holds it sees it, so executors elsewhere would not.
    """
    url = spark.conf.get("spark.lazaret.jdbc.url", None)
    if url is None:
        if not _one_process(spark):
            raise ValueError("set spark.lazaret.jdbc.url to a database that all executors reach")
        name = work_folder(spark, "jdbc").rsplit("/", 1)[1].replace("-", "_")
        url = f"jdbc:derby:memory:{name};create=true"
    target = Table(_EVENTS_TABLE, url=url)
    _append_twice(_identified_events(spark, sf_dir), target)
    return scan(spark, target).filter("processed_at IS NOT NULL").select(*_APPENDED)


def contract_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replayed messages, a third of all copies of a single one, against a table that has some."""
    rows = _identified_events(spark, sf_dir)
    replayed = rows.withColumn("timestamp", F.col("timestamp") + F.expr("INTERVAL 1 DAY"))
    one = F.lit("hot")
    copies = rows.withColumns({"message_id": one, "partition": F.lit(9)})
    stored = rows.filter("event_id % 10 = 3")
    arrived = union_all([rows, replayed, copies])
    kept = enforce(arrived, PROCESSED, stored)
    return kept.select("message_id", "partition", "msg_offset", "event_id")


def _incomplete_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _identified_events(spark, sf_dir).withColumns(
        {
            "topic": F.when(F.col("event_type") != "view", F.col("topic")),
            "msg_offset": F.when(F.col("user_id") % 4 != 0, F.col("msg_offset")),
        }
    )


def contract_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with missing values appended: what the table holds, and what it refused with the reason."""
    target = Table(_EVENTS_TABLE, work_folder(spark, "contract_rejects"))
    append_table(_incomplete_events(spark, sf_dir), target)
    held = scan(spark, target).withColumn("violation", F.lit(None).cast("string"))
    columns = ["event_id", "topic", "msg_offset", "violation"]
    return held.select(*columns).unionByName(rejects(spark, target).select(*columns))


def contract_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows the table would refuse, by the columns they lack."""
    rows = _incomplete_events(spark, sf_dir)
    return violations(rows, PROCESSED).groupBy("violation").agg(F.count(F.lit(1)).alias("n"))


def _quarantine_table(spark: SparkSession, sf_dir: str, root: str) -> Table:
    """The invalid line items in the DLQ table, a topic per return flag."""
    routed = triage(damaged_lineitem(spark, sf_dir), LINEITEM.rules).filter("route = 'dlq'")
    key = F.concat_ws("|", "l_orderkey", "l_partkey", "l_returnflag", "l_shipdate")
    rows = routed.select(
        F.sha2(F.concat_ws("|", key, *LINEITEM.fault_fields), 256).alias("message_id"),
        F.concat(F.lit("lineitem_"), "l_returnflag").alias("topic"),
        F.lit(0).alias("partition"),
        F.col("l_orderkey").alias("msg_offset"),
        F.col("l_shipdate").cast("timestamp").alias("timestamp"),
        # texts that came in need not be tidy
        F.concat(F.lit("  "), F.to_json(F.struct("l_orderkey", "l_partkey")), F.lit(' ""\n ')).alias("payload"),
        F.col("failed_rules").alias("error"),
        F.when(F.col("l_linestatus") == "F", "RESOLVED").alias("status"),
    )
    target = jobs.dlq_table(root)
    append_table(rows, target, 0)
    return target


def dlq_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pending rows of one topic in the DLQ table, found by folder; defaults were filled in."""
    target = _quarantine_table(spark, sf_dir, work_folder(spark, "dlq_lookup"))
    pending = scan(spark, target).filter("topic = 'lineitem_R' AND status = 'PENDING'")
    return pending.groupBy("topic", "status", "error", "retry_count").agg(
        F.count(F.lit(1)).alias("n"), F.count("created_at").alias("created")
    )


def backup_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A CSV snapshot of the DLQ table, read back, and whether all columns of each row are those of the table."""
    root = work_folder(spark, "backup_csv")
    target = _quarantine_table(spark, sf_dir, f"{root}/dlq")
    path = jobs.backup(spark, target, root)
    contract: Contract = DLQ
    texts = {"header": True, "multiLine": True, "escape": '"'}
    saved = spark.read.options(**texts).schema(contract.schema).option("enforceSchema", False).csv(path)
    stored = scan(spark, target)
    whole = F.struct(*contract.schema.fieldNames())
    both = saved.select("*", whole.alias("_saved")).join(
        stored.select("message_id", whole.alias("_stored")), "message_id", "left"
    )
    read = both.withColumn("p", F.from_json("payload", "l_orderkey bigint, l_partkey bigint"))
    return read.select(
        "p.l_orderkey", "p.l_partkey", "topic", "status", "error", "retry_count", "payload",
        F.col("_saved").eqNullSafe(F.col("_stored")).alias("intact"),
    )


QUERIES = {
    "union_by_name": union_by_name,
    "union_missing": union_missing,
    "batch_load": batch_load,
    "csv_head": csv_head,
    "csv_head_rows": csv_head_rows,
    "csv_by_name": csv_by_name,
    "batch_load_many": batch_load_many,
    "land_changed": land_twice,
    "backup_chain": backup_in_links,
    "lookup_by_time": lookup_by_time,
    "csv_quoted": csv_quoted,
    "raw_landing": raw_landing,
    "file_listing": file_listing,
    "topic_publish": topic_publish,
    "fan_out_routes": fan_out_routes,
    "table_append": table_append,
    "jdbc_append": jdbc_append,
    "contract_dedupe": contract_dedupe,
    "contract_violations": contract_violations,
    "contract_rejects": contract_rejects,
    "dlq_lookup": dlq_lookup,
    "backup_csv": backup_csv,
}

_ORDERS = """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
  strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_orderpriority
FROM orders"""

_IDENTIFIED = """
rows AS (
  SELECT event_id, event_type, user_id, 'events' AS topic,
    CAST(event_id % 3 AS INTEGER) AS partition, event_id // 3 AS msg_offset,
    sha256('events|' || (event_id % 3) || '|' || (event_id // 3)) AS message_id
  FROM events)"""

_LANDED = """
SELECT 'orders ' || (o_orderkey % 2) AS dataset, o_orderkey AS id, o_totalprice AS amount,
  ' "' || o_orderpriority || '",' || chr(10) || o_orderstatus || ' ' AS remark
FROM orders
UNION ALL SELECT 'customer', c_custkey, c_acctbal, c_name FROM customer"""

_DATASETS = """
SELECT 'orders_0.csv' AS dataset, count(*) AS n FROM orders WHERE o_orderkey % 2 = 0
UNION ALL SELECT 'orders_1.csv', count(*) FROM orders WHERE o_orderkey % 2 = 1
UNION ALL SELECT 'customer.parquet', count(*) FROM customer"""

_TABLE = f"""
WITH {_IDENTIFIED}
SELECT message_id, topic, partition, msg_offset, event_id, event_type FROM rows"""

_QUARANTINED = f"""{lineitem_ctes()},
dead AS (
  SELECT *, {reasons_sql("lineitem")} AS error, 'lineitem_' || l_returnflag AS topic,
    CASE WHEN l_linestatus = 'F' THEN 'RESOLVED' ELSE 'PENDING' END AS status
  FROM damaged WHERE NOT coalesce({LINEITEM_RULES}, false))"""

ORACLES = {
    "union_by_name": _ORDERS,
    "union_missing": """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
  CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority END AS o_orderpriority
FROM orders""",
    "batch_load": _ORDERS,
    "csv_head": """
SELECT least(700, count(*)) AS n, least(700, count(*)) AS typed, least(700, count(*)) AS v
FROM events""",
    "csv_head_rows": "SELECT least(700, count(*)) AS n FROM events",
    "csv_by_name": _ORDERS,
    "batch_load_many": """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders
UNION ALL
SELECT o_orderkey + 1099511627776, o_custkey, o_orderstatus, o_totalprice, NULL
FROM orders WHERE o_orderkey % 2 = 0 AND o_custkey % 2 = 0""",
    "land_changed": """
SELECT run, dataset, (SELECT count(*) FROM orders WHERE o_orderkey % 2 = 0) AS n
FROM (VALUES (0, '0'), (0, '1'), (1, '1')) r(run, dataset)""",
    "lookup_by_time": """
SELECT event_id, event_type, value FROM events
WHERE event_type = 'error' AND ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-20'""",
    "backup_chain": """
SELECT CAST(link AS INTEGER) AS link, CAST(event_id AS VARCHAR) AS message_id, props AS payload, 'PENDING' AS status
FROM events, range(3) l(link) WHERE event_id % 3 <= link""",
    "csv_quoted": """
SELECT types, o_orderkey, 'say "' || o_orderpriority || '", ok' || chr(10) || o_orderstatus AS remark, o_totalprice
FROM orders, (VALUES ('inferred'), ('declared')) t(types)""",
    "raw_landing": _LANDED,
    "file_listing": f"SELECT dataset FROM ({_DATASETS}) WHERE n > 0",
    "topic_publish": f"""
WITH {lineitem_ctes(0.01)}
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount,
  l_tax, l_returnflag, l_linestatus, strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate,
  0 AS retry_count
FROM damaged""",
    "fan_out_routes": f"""
WITH {lineitem_ctes()}
SELECT l_orderkey, l_partkey,
  CASE WHEN {LINEITEM_RULES} THEN 'processed' ELSE 'dlq' END AS route,
  {reasons_sql("lineitem")} AS failed_rules
FROM damaged""",
    "table_append": _TABLE,
    "jdbc_append": _TABLE,
    "contract_dedupe": f"""
WITH {_IDENTIFIED}, timed AS (SELECT rows.*, e.ts FROM rows JOIN events e USING (event_id)),
arrived AS (
  SELECT message_id, partition, msg_offset, event_id, ts FROM timed
  UNION ALL
  SELECT message_id, partition, msg_offset, event_id, ts + INTERVAL 1 DAY FROM timed
  UNION ALL SELECT 'hot', 9, msg_offset, event_id, ts FROM timed),
firsts AS (
  SELECT * FROM arrived
  QUALIFY row_number() OVER (PARTITION BY message_id ORDER BY ts, partition, msg_offset) = 1)
SELECT message_id, partition, msg_offset, event_id FROM firsts
WHERE message_id NOT IN (SELECT message_id FROM rows WHERE event_id % 10 = 3)""",
    "contract_violations": """
WITH lacking AS (
  SELECT nullif(concat_ws(',', CASE WHEN event_type = 'view' THEN 'topic' END,
    CASE WHEN user_id % 4 = 0 THEN 'msg_offset' END), '') AS violation
  FROM events)
SELECT violation, count(*) AS n FROM lacking WHERE violation IS NOT NULL GROUP BY violation""",
    "contract_rejects": """
WITH lacking AS (
  SELECT event_id, CASE WHEN event_type != 'view' THEN 'events' END AS topic,
    CASE WHEN user_id % 4 != 0 THEN event_id // 3 END AS msg_offset
  FROM events)
SELECT *, nullif(concat_ws(',', CASE WHEN topic IS NULL THEN 'topic' END,
  CASE WHEN msg_offset IS NULL THEN 'msg_offset' END), '') AS violation
FROM lacking""",
    "dlq_lookup": f"""
WITH {_QUARANTINED}
SELECT topic, status, error, 0 AS retry_count, count(*) AS n, count(*) AS created
FROM dead WHERE topic = 'lineitem_R' AND status = 'PENDING' GROUP BY topic, status, error""",
    "backup_csv": f"""
WITH {_QUARANTINED}
SELECT l_orderkey, l_partkey, topic, status, error, 0 AS retry_count,
  '  {{"l_orderkey":' || l_orderkey || ',"l_partkey":' || l_partkey || '}} ""' || chr(10) || ' ' AS payload,
  true AS intact
FROM dead""",
}
