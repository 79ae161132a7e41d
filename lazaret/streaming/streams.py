"""Validate-and-quarantine and repair-and-retry as micro-batch streams.

    source topic -> validate -> processed table
         ^             |
         |             v
       retry <- repair and count <- quarantine topic
                     |
                     v  retries used up
                failed table

Either stream may stop and start at any time: offsets are in its checkpoint, and a batch that is
repeated after a loss finds its output or writes the same place again. Output is named after the
checkpoint's identity and the batch, so a stream with a new checkpoint never takes the batches of an
earlier one for its own.

``Hub`` and ``Separate`` say where the routes end; a pipeline takes either.
"""

from __future__ import annotations

import contextlib
import json
import time
from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from lazaret.contracts import ENVELOPE, PROCESSED, Contract, schema_of
from lazaret.functions.cleaning import Policy
from lazaret.functions.codec import decode, encode
from lazaret.functions.rules import Rule
from lazaret.operators.repair import repair
from lazaret.operators.routing import (
    MAX_RETRIES,
    RETRIES_EXCEEDED,
    fan_out,
    fan_out_to,
    retry_split,
    triage,
)
from lazaret.plans.presets import Preset
from lazaret.sources import storage
from lazaret.sources.tables import Table, append_table, scan
from lazaret.sources.topics import Topic, append_topic, topic_stream

HISTORY = schema_of(
    message_id="string",
    retry_count="integer",
    failed_rules="string",
    error="string",
)


@dataclass(frozen=True)
class Hub:
    """All topics and tables in one folder of Parquet files.

    Each batch is one pass and one job: ``fan_out`` writes every route, and they appear together by one rename.
    Readers of a route read its folders alone, and only the columns they use.
    """

    root: str
    name: str = "messages"

    def _folders(self, stage: str, route: str) -> str:
        return f"{stage}/batch=*/route={route}"

    def published(self) -> Topic:
        """The topic a publisher appends to."""
        return Topic(self.name, f"{self.root}/published")

    def source(self) -> Topic:
        return Topic(
            self.name,
            f"{self.root}/{{published/producer=*/batch=*,{self._folders('repair', 'retry')}}}",
        )

    def quarantine(self) -> Topic:
        return Topic(f"{self.name}_dlq", f"{self.root}/{self._folders('validate', 'dlq')}")

    def emit(self, stage: str, df: DataFrame, batch_id: int | str) -> dict[str, int] | None:
        routes = ("processed", "dlq") if stage == "validate" else ("retry", "failed")
        return fan_out(df, f"{self.root}/{stage}", batch_id, routes)

    def counted(self, spark: SparkSession, stage: str, batch_id: int | str) -> dict[str, int]:
        """The rows per route of a batch that is there."""
        found = spark.read.schema("route string").parquet(f"{self.root}/{stage}/batch={batch_id}")
        return {r["route"]: r["count"] for r in found.groupBy("route").count().collect()}

    def table(self, spark: SparkSession, route: str, schema: T.StructType) -> DataFrame:
        """The processed or the failed rows: envelope, retry history and the fields as ``data``."""
        stage = "validate" if route == "processed" else "repair"
        root = f"{self.root}/{stage}"
        stored = T.StructType(
            [*ENVELOPE.fields, *HISTORY.fields, T.StructField("data", schema)]
        )
        if not storage.has_match(spark, f"{root}/batch=*"):
            return spark.createDataFrame([], stored)
        rows = spark.read.schema(stored).option("basePath", root).parquet(f"{root}/batch=*")
        # the route is a folder name, so this filter leaves the other route's files unlisted
        return rows.filter(F.col("route") == route).drop("route", "batch")


@dataclass(frozen=True)
class Separate:
    """A sink of its own per route: topics in Kafka or folders, tables in a database or folders."""

    source_topic: Topic
    dlq_topic: Topic
    processed: Table
    failed: Table

    def source(self) -> Topic:
        return self.source_topic

    def quarantine(self) -> Topic:
        return self.dlq_topic

    def emit(self, stage: str, df: DataFrame, batch_id: int | str) -> dict[str, int]:
        def stored(rows: DataFrame) -> DataFrame:
            own = [f"data.{f}" for f in rows.schema["data"].dataType.fieldNames()]
            return rows.select(
                *("message_id", "topic", "partition", "retry_count", "failed_rules", "error"),
                F.col("offset").alias("msg_offset"),
                F.col("value").alias("payload"),
                *(own if stage == "validate" else []),
            )

        if stage == "validate":
            branches = {
                "processed": lambda d: append_table(stored(d), self.processed, batch_id),
                "dlq": lambda d: append_topic(d, self.dlq_topic, batch_id, stage),
            }
        else:
            branches = {
                "retry": lambda d: append_topic(d, self.source_topic, batch_id, stage),
                "failed": lambda d: append_table(stored(d), self.failed, batch_id),
            }
        return fan_out_to(df, branches)

    def table(self, spark: SparkSession, route: str) -> DataFrame:
        return scan(spark, self.processed if route == "processed" else self.failed)


@dataclass(frozen=True)
class Pipeline:
    """What both streams share. ``mode``, ``null_verdict`` and ``null_count`` are described in
    ``functions.codec``, ``functions.rules`` and ``operators.routing``.

    ``progress`` names a folder that gets a row per micro-batch (``progress``). ``dedupe`` is a time, such as ``1 hour``: a message that
    comes again on the same visit within that time of processing is left out, over batches and restarts. Its state holds
    the identities of that time, spread by identity; ``logged.LogHub`` keeps them for good instead.
    """

    schema: T.StructType
    rules: Sequence[Rule]
    policies: Sequence[Policy]
    sinks: Hub | Separate
    checkpoint: str
    max_retries: int = MAX_RETRIES
    mode: str = "text"
    null_verdict: str = "quarantine"
    null_count: str = "zero"
    starting: str = "earliest"
    progress: str | None = None
    dedupe: str | None = None

    @classmethod
    def of(cls, preset: Preset, sinks: Hub | Separate, checkpoint: str, **options: Any) -> Pipeline:
        return cls(preset.schema, preset.rules, preset.policies, sinks, checkpoint, **options)


def processed_contract(schema: T.StructType, contract: Contract = PROCESSED) -> Contract:
    """The processed table with the message's own fields and its retry history."""
    history = schema_of(retry_count="integer", failed_rules="string")
    return contract.with_fields(T.StructType([*history.fields, *schema.fields]))


def validated(df: DataFrame, p: Pipeline) -> DataFrame:
    """Messages of the source topic, decoded and routed."""
    return _outgoing(triage(decode(df, p.schema, p.mode), p.rules, p.null_verdict), p)


def repaired(df: DataFrame, p: Pipeline) -> DataFrame:
    """Messages of the quarantine, repaired, counted and routed."""
    fixed = repair(decode(df, p.schema, p.mode), p.policies)
    return _outgoing(retry_split(fixed, p.max_retries, p.null_count), p)


def _outgoing(df: DataFrame, p: Pipeline) -> DataFrame:
    """What the sinks take: the envelope, the retry history and the fields as ``data``.

    A message that travels on gets its wire record as value. A failed one keeps its text, for a
    malformed message the text that came in rather than its wrapping. A processed row needs none.
    """
    route, final = F.col("route"), F.col("route").isin("processed", "failed")
    value = F.when(route == "processed", F.lit(None)).when(
        F.col("malformed") & final, F.col("raw")
    )
    fields = F.struct(*p.schema.fieldNames())
    return df.select(
        "route",
        F.col("message_id").alias("key"),
        value.otherwise(encode(df, p.schema)).alias("value"),
        *(F.col("message")[c].alias(c) for c in ("topic", "partition", "offset", "timestamp")),
        "message_id",
        F.coalesce("retry_count", F.lit(0)).alias("retry_count"),
        "failed_rules",
        F.when(route == "failed", F.lit(RETRIES_EXCEEDED)).alias("error"),
        F.when(final, fields).alias("data"),
    )


def validating(spark: SparkSession, p: Pipeline) -> DataFrame:
    """The source topic as a stream of routed rows."""
    rows = validated(topic_stream(spark, p.sinks.source(), p.starting), p)
    if p.dedupe is None:
        return rows
    # The time of processing, as a message that is sent back keeps its first time and would count as late.
    arrived = rows.withColumn("_arrived", F.current_timestamp()).withWatermark("_arrived", p.dedupe)
    return arrived.dropDuplicatesWithinWatermark(["message_id", "retry_count"]).drop("_arrived")


def retrying(spark: SparkSession, p: Pipeline) -> DataFrame:
    """The quarantine topic as a stream of repaired, counted and routed rows."""
    return repaired(topic_stream(spark, p.sinks.quarantine(), p.starting), p)


def _start(
    rows: DataFrame, stage: str, p: Pipeline, trigger: dict, totals: Counter | None = None
) -> StreamingQuery:
    """The rows are transformed as a stream, so the plan is made once; a batch is only fanned out.

    ``totals`` takes up the rows of each route over all batches, and ``repeated`` batches.
    """
    checkpoint = f"{p.checkpoint}/{stage}"
    run: list[str] = []

    def emit(batch: DataFrame, batch_id: int) -> None:
        if not run:
            run.append(_checkpoint_id(batch.sparkSession, checkpoint))
        name, start = f"{run[0]}-{batch_id}", time.monotonic()
        counts = p.sinks.emit(stage, batch, name)
        if p.progress is not None:
            _note(batch.sparkSession, p, stage, run[0], batch_id, counts, time.monotonic() - start)
        if totals is not None:
            totals.update({"repeated": 1} if counts is None else counts)

    writer = rows.writeStream.foreachBatch(emit).option("checkpointLocation", checkpoint)
    return (writer.trigger(**trigger) if trigger else writer).start()


PROGRESS = "stage string, run string, batch long, counts map<string, long>, seconds double, repeated boolean"


def _note(spark: SparkSession, p: Pipeline, stage: str, run: str, batch: int, counts: dict[str, int] | None, seconds: float) -> None:
    """Keep what a micro-batch did, once. A batch that was there, from a run that broke off before it was noted, is counted where it lies."""
    repeated = counts is None
    if repeated:
        counts = p.sinks.counted(spark, stage, f"{run}-{batch}")
    row = {"stage": stage, "run": run, "batch": batch, "counts": counts, "seconds": seconds, "repeated": repeated}
    with contextlib.suppress(FileExistsError):
        storage.put_text(spark, f"{p.progress}/{stage}-{run}-{batch}.json", json.dumps(row))


def progress(spark: SparkSession, folder: str) -> DataFrame:
    """A row per micro-batch so far: stage, run, batch, counts by route, seconds, and whether it was counted afterwards."""
    if not storage.has_match(spark, f"{folder}/*.json"):
        return spark.createDataFrame([], PROGRESS)
    return spark.read.schema(PROGRESS).json(f"{folder}/*.json")


def _checkpoint_id(spark: SparkSession, checkpoint: str) -> str:
    """The identity Spark gives a checkpoint when it is first used; it stays over restarts."""
    return spark.read.schema("id string").json(f"{checkpoint}/metadata").first()["id"]


def validate_stream(
    spark: SparkSession, p: Pipeline, totals: Counter | None = None, **trigger: Any
) -> StreamingQuery:
    """Start the validate stream; without a trigger batches follow each other at once."""
    return _start(validating(spark, p), "validate", p, trigger, totals)


def retry_stream(
    spark: SparkSession, p: Pipeline, totals: Counter | None = None, **trigger: Any
) -> StreamingQuery:
    """Start the repair-and-retry stream."""
    return _start(retrying(spark, p), "repair", p, trigger, totals)


def drain(spark: SparkSession, p: Pipeline) -> list[StreamingQuery]:
    """Run both streams in turn over what is there until no message is left in the loop.

    That is so when a run of the repair stream sends nothing back. Every visit raises a message's
    count, so it ends.
    """
    stages = {"validate": validating(spark, p), "repair": retrying(spark, p)}
    runs: list[StreamingQuery] = []
    while True:
        totals: Counter = Counter()
        for stage, rows in stages.items():
            query = _start(rows, stage, p, {"availableNow": True}, totals)
            query.awaitTermination()
            runs.append(query)
        if not totals["retry"] and not totals["repeated"]:
            return runs
