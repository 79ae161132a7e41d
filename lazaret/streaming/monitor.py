"""Failure alerts while messages stream in: event-time windows behind a watermark, each written once when it is closed.

``totals_stream`` appends the messages and failures of every closed window to a folder, through Spark's own file sink with its commit log. Alerts are a
filter on these rows, so a threshold may change later. A row that comes after its window was closed does not change what was
reported; ``late`` tells how many there were, by window, from what the topic holds.
"""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lazaret.operators.metrics import above, window_totals
from lazaret.sources import storage

TOTALS = "window_start timestamp, window_end timestamp, messages long, failures long"


def totals_stream(
    rows: DataFrame, time: str, failed: Column, path: str, checkpoint: str, width: str = "1 hour", delay: str = "10 minutes", **trigger: Any
) -> StreamingQuery:
    """Start writing the totals of closed windows; a window is closed when a row ``delay`` past its end has come. Rows without a time are left out."""
    totals = window_totals(rows.withWatermark(time, delay), time, failed, width)
    writer = totals.writeStream.format("parquet").outputMode("append").option("path", path).option("checkpointLocation", checkpoint)
    return (writer.trigger(**trigger) if trigger else writer).start()


def totals(spark: SparkSession, path: str) -> DataFrame:
    """The windows closed so far."""
    return spark.read.schema(TOTALS).parquet(path) if storage.exists(spark, path) else spark.createDataFrame([], TOTALS)


def alerts(closed: DataFrame, threshold: float, at_least: int = 1) -> DataFrame:
    """Closed windows in which the share of failed messages is above the threshold."""
    return above(closed, threshold, at_least)


def late(closed: DataFrame, rows: DataFrame, time: str, failed: Column, width: str = "1 hour") -> DataFrame:
    """(window_start, late): rows of the topic that came after their window was closed, without windows that had none."""
    held = window_totals(rows, time, failed, width).select("window_start", F.col("messages").alias("_all"))
    found = closed.join(held, "window_start").select("window_start", (F.col("_all") - F.col("messages")).alias("late"))
    return found.filter("late > 0")
