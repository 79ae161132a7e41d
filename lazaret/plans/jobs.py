"""Whole jobs: load, publish, reprocess, check and back up."""

from __future__ import annotations

import time
import uuid
from collections import Counter
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lazaret.contracts import DLQ
from lazaret.functions.codec import decode, encode
from lazaret.functions.identity import message_id
from lazaret.operators import events, faults, metrics
from lazaret.operators.unions import union_all
from lazaret.plans.presets import Preset
from lazaret.sources import storage
from lazaret.sources.commits import PLACE, CommitLog
from lazaret.sources.readers import read_csv, read_grouped
from lazaret.sources.tables import Table, append_table, scan, snapshot, write_dataset
from lazaret.sources.topics import Topic, append_topic, topic_table
from lazaret.streaming.streams import Pipeline, retry_stream

# Fixed value: how many rows a bounded publish run of a file takes, for callers that want one.
MAX_RECORDS = 100_000


def batch_load(
    spark: SparkSession,
    paths: Sequence[str],
    target: str,
    schema: T.StructType | str | None = None,
    allow_missing: bool = False,
    csv: Mapping[str, str | bool] | None = None,
) -> DataFrame:
    """Read CSV files, unite them by column name, replace the Parquet dataset; returns it.

    Files with the same header are read together, so any number of files makes few reads. No shuffle of rows. Giving the schema
    spares the pass that infers types; ``csv`` are options of the reader.
    """
    write_dataset(union_all(read_grouped(spark, paths, schema, csv), allow_missing), target)
    return spark.read.parquet(target)


def messages(
    df: DataFrame,
    preset: Preset,
    topic: str,
    partition: Column | None = None,
    offset: Column | None = None,
    timestamp: Column | None = None,
    rate: float = 0.0,
    seed: int = 42,
    partitions: int = 3,
    publication: str | None = None,
) -> DataFrame:
    """Rows as messages with a retry count of 0, with the envelope's columns; ``rate`` of them are damaged on purpose, by default none.

    ``fault`` stays as a column for counting. A folder has no broker to assign places, so partition
    and offset are columns of the caller or a hash of the key and a running number. Such a number
    starts anew in each run, so these messages carry an identity from the number and the name of the
    ``publication``, by default a new one.
    """
    running = offset is None
    key = F.xxhash64(*preset.key)
    placed = df.withColumns(
        {
            "partition": (F.pmod(key, F.lit(partitions)) if partition is None else partition).cast(
                "int"
            ),
            "offset": F.monotonically_increasing_id() if offset is None else offset.cast("bigint"),
            "timestamp": (F.current_timestamp() if timestamp is None else timestamp).cast(
                "timestamp"
            ),
        }
    )
    if rate > 0:
        planned = faults.plan(placed, preset.key, preset.fault_fields, rate, seed)
        damaged = faults.inject(planned, preset.fault_fields)
    else:  # no digest of each key for nothing
        damaged = placed.withColumn("fault", F.lit(False))
    counted = damaged.withColumn("retry_count", F.lit(0))
    if running:
        place = F.lit(f"{topic}|{publication or uuid.uuid4().hex}")
        counted = counted.withColumn("message_id", message_id(place))
    if rate > 0:
        wire = faults.wire_record(counted, preset.schema, preset.fault_fields)
    else:
        wire = encode(counted, preset.schema)
    return counted.select(
        F.lit(None).cast("string").alias("key"),
        wire.alias("value"),
        F.lit(topic).alias("topic"),
        "partition",
        "offset",
        "timestamp",
        "fault",
    )


def publish(
    df: DataFrame, preset: Preset, topic: Topic, batch_id: int | str | None = None, **options
) -> dict:
    """Publish a table as messages; returns the run's summary with the count and share damaged.

    Each call is a batch of its own. A job that may be repeated gives its batch a name; a name that
    is in the topic already raises ``FileExistsError``, as the rows may be others.
    """
    batch = uuid.uuid4().hex if batch_id is None else batch_id
    seen = Observation()
    rows = messages(df, preset, topic.name, publication=f"publisher/{batch}", **options).observe(
        seen, F.count(F.lit(1)).alias("records"), F.count_if("fault").alias("damaged")
    )
    start = time.monotonic()
    if not append_topic(rows.drop("fault"), topic, batch, "publisher"):
        raise FileExistsError(f"batch {batch} of the publisher is in topic {topic.name} already")
    return metrics.run_summary(seen.get, time.monotonic() - start)


def publish_csv(
    spark: SparkSession,
    path: str,
    preset: Preset,
    topic: Topic,
    limit: int | None = None,
    csv: Mapping[str, str | bool] | None = None,
    **options,
) -> dict:
    """Publish a CSV file or folder, all of it unless ``limit`` bounds the rows; ``csv`` are options of the reader."""
    return publish(read_csv(spark, path, preset.schema, limit, options=csv), preset, topic, **options)


def quarantine_rows(df: DataFrame) -> DataFrame:
    """Quarantine messages as rows of the DLQ table, with their text, reasons and retry count."""
    place = ("topic", "partition", "timestamp")
    message = F.col("message")
    return decode(df, T.StructType([])).select(
        "message_id",
        *(message[c].alias(c) for c in place),
        message["offset"].alias("msg_offset"),
        F.coalesce("raw", message["value"], F.lit("")).alias("payload"),
        F.coalesce("failed_rules", F.when(F.col("malformed"), "decode")).alias("error"),
        "retry_count",
    )


def record_quarantine(
    spark: SparkSession, topic: Topic, table: Table, batch_id: int | str | None = None
) -> dict[str, int] | None:
    """Store what is in the quarantine topic and not yet in the DLQ table."""
    return append_table(quarantine_rows(topic_table(spark, topic)), table, batch_id)


def reprocess(spark: SparkSession, pipeline: Pipeline) -> dict:
    """Repair and retry what is in the quarantine now, then stop; returns the run's summary."""
    totals: Counter = Counter()
    start = time.monotonic()
    retry_stream(spark, pipeline, totals, availableNow=True).awaitTermination()
    routes = {route: totals[route] for route in ("retry", "failed")}
    counts = {"records": sum(routes.values()), **routes}
    return metrics.run_summary(counts, time.monotonic() - start)


def check_depth(
    spark: SparkSession, topic: Topic, log: str | None = None, count: str | None = None
) -> DataFrame:
    """Depth of a topic per partition and in total, also appended to the event log when one is named.

    A folder keeps a message's first place, so there rows are counted; Kafka numbers its messages. The messages are read
    once; the depths, a row per topic partition, are kept. A topic without messages has a total of 0.
    """
    totals = metrics.depth_totals(
        topic_table(spark, topic), count or ("offsets" if topic.is_kafka else "rows")
    )
    rows = totals.collect()
    if not any(r["topic"] is None for r in rows):
        rows.append((None, None, 0))
    counted = spark.createDataFrame(rows, totals.schema)
    if log is not None:
        total = counted.filter("topic IS NULL").select(F.col("depth").alias("dlq_size"))
        documents = events.log_rows(total, event="dlq_size")
        documents.withColumn("day", F.current_date()).write.mode("append").partitionBy("day").json(
            log
        )
    return counted


def backup(spark: SparkSession, table: Table, root: str, name: str | None = None) -> str:
    """Snapshot a table as CSV below ``root/dlq_backups``; returns the folder."""
    return snapshot(scan(spark, table), f"{root}/dlq_backups", name)


def backup_chain(spark: SparkSession, table: Table, root: str, name: str) -> dict[str, int] | None:
    """Back up what a folder table got since the last link of the chain below ``root``, the first time all of it; None if ``name`` is a link already.

    A link is a commit of a log, named and whole; it holds the rows of the batches that no link before it has.
    """
    log = CommitLog(f"{root}/dlq_chain")
    state = log.state(spark)
    if state.has(name):
        return None
    held = {b for c in state.commits for b in c.batches}
    batches = [n for n in sorted(storage.names(spark, table.path)) if n.startswith("batch=") and n not in held]
    schema = table.contract.schema
    rows = spark.createDataFrame([], schema)
    if batches:
        rows = spark.read.schema(schema).option("basePath", table.path).parquet(*(f"{table.path}/{n}" for n in batches)).select(*schema.fieldNames())
    folder, counts = log.write(rows.withColumn("route", F.lit("rows")), ["rows"])
    log.commit(spark, state, folder, counts, (name, *batches))
    return counts


def restore_chain(spark: SparkSession, table: Table, root: str, name: str | None = None) -> DataFrame:
    """The table's rows as of a link of its chain, by default the last."""
    log = CommitLog(f"{root}/dlq_chain")
    commits = log.state(spark).commits
    if name is not None:
        at = next((i for i, c in enumerate(commits) if name in c.batches), None)
        if at is None:
            raise ValueError(f"no link {name} below {root}")
        commits = commits[: at + 1]
    return log.read(spark, table.contract.schema, "rows", commits).drop(PLACE)


def dlq_table(path: str) -> Table:
    """The DLQ table as files, laid out by the columns it is looked up by."""
    return Table(DLQ, path, partition_by=("topic", "status"))

