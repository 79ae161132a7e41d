"""Topics: message streams in Kafka, or in folders of Parquet rows with the envelope's columns."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lazaret.contracts import ENVELOPE
from lazaret.sources import storage
from lazaret.sources.commits import PLACE, CommitLog


@dataclass(frozen=True)
class Topic:
    """A topic by name.

    With ``servers`` it is a Kafka topic. Otherwise ``path`` is its folder; a reader may name
    several folders in a glob pattern. ``options`` are passed on to the reader: for Kafka for
    instance ``minPartitions`` to split a hot partition over tasks and ``maxOffsetsPerTrigger``, for
    a folder ``maxFilesPerTrigger`` and ``maxFileAge``, which stands for the topic's retention.
    With ``route`` the folder is a commit log (``commits``), of which the topic is that route.
    """

    name: str
    path: str | None = None
    servers: str | None = None
    options: Mapping[str, str] = field(default_factory=dict)
    route: str | None = None

    @property
    def is_kafka(self) -> bool:
        return self.servers is not None


def read_options(topic: Topic, starting: str = "earliest") -> dict[str, str]:
    """Options of a Kafka read."""
    return {
        "kafka.bootstrap.servers": topic.servers or "",
        "subscribe": topic.name,
        "startingOffsets": starting,
        **topic.options,
    }


def write_options(topic: Topic) -> dict[str, str]:
    """Options of a Kafka write."""
    return {"kafka.bootstrap.servers": topic.servers or "", "topic": topic.name}


def topic_stream(spark: SparkSession, topic: Topic, starting: str = "earliest") -> DataFrame:
    """An unbounded read with the envelope's columns, from the earliest message by default."""
    if topic.is_kafka:
        raw = spark.readStream.format("kafka").options(**read_options(topic, starting)).load()
        return _as_envelope(raw)
    if topic.route is not None:
        raise ValueError(f"topic {topic.name} is a commit log, which streaming.logged follows")
    if not storage.is_pattern(topic.path):
        storage.make_folder(spark, topic.path)
    return (
        spark.readStream.schema(ENVELOPE)
        .option("recursiveFileLookup", True)
        # Files are read however late they are published; a retention is the caller's choice.
        .option("maxFileAge", "36500d")
        .options(**topic.options)
        .parquet(topic.path)
    )


def topic_table(spark: SparkSession, topic: Topic) -> DataFrame:
    """All messages now in the topic, as a batch; none where nothing was ever sent."""
    if topic.is_kafka:
        raw = spark.read.format("kafka").options(**read_options(topic)).load()
        return _as_envelope(raw)
    if topic.route is not None:
        log = CommitLog(topic.path)
        return log.read(spark, ENVELOPE, topic.route, log.state(spark).commits).drop(PLACE)
    if not storage.has_match(spark, topic.path):
        return spark.createDataFrame([], ENVELOPE)
    return spark.read.schema(ENVELOPE).option("recursiveFileLookup", True).parquet(topic.path)


def _as_envelope(raw: DataFrame) -> DataFrame:
    return raw.select(*(F.col(f.name).cast(f.dataType) for f in ENVELOPE.fields))


def append_topic(
    df: DataFrame, topic: Topic, batch_id: int | str, producer: str = "main"
) -> bool:
    """Write messages to a topic; False if the batch is there already.

    Kafka sends are at least once: a repeated batch sends again, and the tables at the end drop the
    copies by message identity. A folder keeps one subfolder per producer and batch, which appears
    whole, and leaves one that is there alone, so there a repeated batch adds nothing.
    """
    if topic.is_kafka:
        rows = df.select("key", "value")
        rows.write.format("kafka").options(**write_options(topic)).save()
        return True
    rows = df.withColumn("topic", F.lit(topic.name)).select(*ENVELOPE.fieldNames())
    if topic.route is not None:
        routed = rows.withColumn("route", F.lit(topic.route))
        return CommitLog(topic.path).append(routed, [topic.route], f"{producer}/{batch_id}") is not None
    return storage.write_whole(
        df.sparkSession,
        f"{topic.path}/producer={producer}/batch={batch_id}",
        lambda path: rows.write.parquet(path),
    )
