"""Event log: rows as log documents, written by the executors, and the clean-up of such documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lazaret.functions.identity import epoch_millis, iso_text

# The constant parts of a log document.
LEVEL = "INFO"
MESSAGE = "DLQ processing event"
EVENT = "stream_processing"
INDEX_PREFIX = "dlq-logs-"


def log_rows(
    df: DataFrame,
    event: str = EVENT,
    message: str = MESSAGE,
    level: str = LEVEL,
    now: Column | None = None,
) -> DataFrame:
    """One log document per row: ``@timestamp``, ``level``, ``message`` and ``data`` with the record."""
    return df.select(
        iso_text(now).alias("@timestamp"),
        F.lit(level).alias("level"),
        F.lit(message).alias("message"),
        F.struct(
            F.lit(event).alias("event"),
            F.struct(*df.columns).alias("record"),
            epoch_millis(now).alias("timestamp"),
        ).alias("data"),
    )


def normalise(df: DataFrame, time: str = "timestamp", prefix: str = INDEX_PREFIX) -> DataFrame:
    """Read the ISO-8601 time, drop the shipper's own fields and name the daily index.

    A time that cannot be read stays in the document with a NULL index date, named ``unknown``.
    """
    parsed = F.try_to_timestamp(F.col(time).cast("string"))
    day = F.coalesce(F.date_format(parsed, "yyyy.MM.dd"), F.lit("unknown"))
    return (
        df.drop("@version", "@timestamp")
        .withColumn("index", F.concat(F.lit(prefix), day))
        .withColumn(time, parsed)
    )


def write_log(df: DataFrame, path: str, by: str = "index") -> None:
    """JSON lines, a folder per value of ``by``, appended.

    Rebalancing gathers each day into few files and, unlike a repartition by the day, splits a day
    that holds much of the data over several tasks.
    """
    df.hint("rebalance", by).write.mode("append").partitionBy(by).json(path)
