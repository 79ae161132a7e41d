"""The same two streams over commit logs: no folder of data is listed, small batches are folded, and no message runs the loop twice.

``LogHub`` keeps three logs below one root: ``published``, ``validate`` (routes ``processed`` and ``dlq``) and ``repair`` (``retry`` and
``failed``). A step reads what the logs before it have beyond its place, routes it, and commits the rows and its new places as one, so a step
that broke off is simply done again. Steps are driven by a stream over the small commit files (``follow``), or one after the other (``drain``).

A message that comes again on the same visit (same identity and retry count, from a second publish or a producer's repetition) is
left out at the validate step by an identity index, so every end holds an identity once. Stores need no rename of folders.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from lazaret.contracts import ENVELOPE, first_of_each
from lazaret.sources import storage
from lazaret.sources.commits import PLACE, Commit, CommitLog
from lazaret.sources.identities import IdentityIndex
from lazaret.sources.topics import Topic
from lazaret.streaming.streams import HISTORY, Pipeline, repaired, validated

ROUTES = {"validate": ("processed", "dlq"), "repair": ("retry", "failed")}
_INPUTS = {"validate": (("published", "published"), ("repair", "retry")), "repair": (("validate", "dlq"),)}


@dataclass(frozen=True)
class LogHub:
    """All topics and tables as commit logs in one folder. ``commits`` bounds how many commits of a log one step takes."""

    root: str
    name: str = "messages"
    unique: bool = True
    commits: int = 100

    def log(self, stage: str) -> CommitLog:
        return CommitLog(f"{self.root}/{stage}")

    def published(self) -> Topic:
        """The topic a publisher appends to."""
        return Topic(self.name, self.log("published").path, route="published")

    def quarantine(self) -> Topic:
        return Topic(f"{self.name}_dlq", self.log("validate").path, route="dlq")

    def index(self) -> IdentityIndex:
        return IdentityIndex(f"{self.root}/seen")

    def table(self, spark: SparkSession, route: str, schema: T.StructType) -> DataFrame:
        """The processed or the failed rows: envelope, retry history and the fields as ``data``."""
        log = self.log("validate" if route == "processed" else "repair")
        return log.read(spark, stored(schema), route, log.state(spark).commits).drop(PLACE)

    def compact(self, spark: SparkSession, schema: T.StructType, **sizes: int) -> dict[str, int]:
        """Fold the commits of each log; how many went."""
        published = self.log("published").compact(spark, {"published": ENVELOPE}, **sizes)
        return {"published": published} | {
            stage: self.log(stage).compact(spark, dict.fromkeys(routes, stored(schema)), **sizes) for stage, routes in ROUTES.items()
        }


def stored(schema: T.StructType) -> T.StructType:
    return T.StructType([*ENVELOPE.fields, *HISTORY.fields, T.StructField("data", schema)])


def step(spark: SparkSession, p: Pipeline, stage: str) -> dict[str, int] | None:
    """Take what lies beyond the stage's places; the rows per route, None where there is nothing."""
    hub: LogHub = p.sinks
    log = hub.log(stage)
    state = log.state(spark)
    rows, consumed = None, {}
    for name, route in _INPUTS[stage]:
        source, place = hub.log(name), state.consumed.get(name, -1)
        # A commit without rows of the route is no work, or the stages would wake each other for ever.
        commits = [c for c in source.state(spark).after(place) if c.rows.get(route)][: hub.commits]
        if commits:
            part = source.read(spark, ENVELOPE, route, commits, place).drop(PLACE)
            rows = part if rows is None else rows.unionByName(part)
            consumed[name] = commits[-1].last
    if rows is None:
        return None
    routed = (validated if stage == "validate" else repaired)(rows, p)
    folder, counts = log.write(routed, ROUTES[stage])
    if stage == "validate" and hub.unique and any(counts.values()):
        folder, counts = _without_seen(spark, hub, p, folder, counts)
    log.commit(spark, state, folder, counts, consumed=consumed)
    return counts


def _visit() -> Column:
    return F.concat_ws("#", "message_id", "retry_count").alias("id")


def _without_seen(spark: SparkSession, hub: LogHub, p: Pipeline, folder: str, counts: dict[str, int]) -> tuple[str, dict[str, int]]:
    """A written batch less the visits seen before or earlier in it; the folder itself if there are none.

    Only identities are read to find out. The index first takes up what the log has beyond it, as a rule the batch before.
    """
    log, index = hub.log("validate"), hub.index()
    state = log.state(spark)
    slim = T.StructType([f for f in HISTORY.fields if f.name in ("message_id", "retry_count")])

    def beyond(place: int) -> DataFrame:
        commits: list[Commit] = state.after(place)
        parts = [log.read(spark, slim, route, commits, place).select(_visit()) for route in ROUTES["validate"]]
        return parts[0].union(parts[1])

    index.follow(spark, state.last, beyond)
    schema = T.StructType([*stored(p.schema).fields, T.StructField("route", T.StringType())])
    batch = spark.read.schema(schema).parquet(folder).withColumn("id", _visit())
    again = index.known(batch.select("id"))
    if again is None and batch.select("id").distinct().count() == sum(counts.values()):
        return folder, counts
    fresh = first_of_each(batch, "id", ["topic", "partition", "offset", "timestamp", "route"])
    if again is not None:
        fresh = fresh.join(again, "id", "left_anti")
    return log.write(fresh.select(*schema.fieldNames()), ROUTES["validate"])


def follow(spark: SparkSession, p: Pipeline, stage: str, totals: Counter | None = None, **trigger: Any) -> StreamingQuery:
    """Start a stage as a stream over the commit files before it; each trigger lists these folders and nothing else.

    A commit file is only the sign that there is work: places are in the stage's own log, so the checkpoint may be lost.
    """
    hub: LogHub = p.sinks
    folders = [hub.log(name).folder for name, _ in _INPUTS[stage]]
    for folder in folders:
        storage.make_folder(spark, folder)
    names = ",".join(name for name, _ in _INPUTS[stage])
    signs = (
        spark.readStream.schema("last long")
        .option("ignoreMissingFiles", True)
        .option("maxFileAge", "36500d")
        .json(f"{hub.root}/{{{names}}}/commits" if len(folders) > 1 else folders[0])
    )

    def work(_: DataFrame, __: int) -> None:
        while (counts := step(spark, p, stage)) is not None:
            if totals is not None:
                totals.update(counts)

    writer = signs.writeStream.foreachBatch(work).option("checkpointLocation", f"{p.checkpoint}/{stage}")
    return (writer.trigger(**trigger) if trigger else writer).start()


def drain(spark: SparkSession, p: Pipeline) -> Counter:
    """Both stages in turn until neither has anything left; the rows per route."""
    totals: Counter = Counter()
    while True:
        found = [step(spark, p, stage) for stage in ("validate", "repair")]
        for counts in found:
            totals.update(counts or {})
        if not any(found):
            return totals
