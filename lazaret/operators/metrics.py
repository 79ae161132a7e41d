"""Counts over topics, quarantine tables and runs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lazaret.functions.once import with_columns_once
from lazaret.functions.rules import Rule, place
from lazaret.operators.routing import DECODE, broken, columns_of
from lazaret.sources.commits import CommitLog


def depth(df: DataFrame, count: str = "offsets") -> DataFrame:
    """Messages per topic partition.

    ``offsets`` is highest minus lowest offset plus one, as a broker's marks give it; ``rows``
    counts what is stored. Only partial aggregates are shuffled, a row per topic partition and task.
    """
    if count == "offsets":
        messages = F.max("offset") - F.min("offset") + 1
    elif count == "rows":
        messages = F.count(F.lit(1))
    else:
        raise ValueError(f"count must be 'offsets' or 'rows', not {count!r}")
    return df.groupBy("topic", "partition").agg(messages.alias("depth"))


def depth_totals(df: DataFrame, count: str = "offsets") -> DataFrame:
    """``depth`` with totals per topic (partition NULL) and overall (topic NULL too).

    The roll-up runs over the per-partition result, not over the messages, so no message is
    expanded into three grouping sets.
    """
    per_partition = depth(df, count)
    return per_partition.rollup("topic", "partition").agg(F.sum("depth").alias("depth"))


def status(df: DataFrame, by: Sequence[str] = ("topic", "status"), time: str | None = None,
           unit: str = "day") -> DataFrame:
    """Message counts by ``by``, and by time bucket when a time column is named."""
    keys: list[str | Column] = list(by)
    if time is not None:
        keys.append(F.date_trunc(unit, F.col(time)).alias("bucket"))
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("messages"))


PARTIAL = T.StructType([T.StructField("messages", T.LongType()), T.StructField("sketch", T.BinaryType())])


def append_status(
    df: DataFrame, log: CommitLog, batch: str, by: Sequence[str] = ("topic", "status"), time: str | None = None, unit: str = "day", key: str = "message_id"
) -> bool:
    """Add a batch's counts to a status kept by batch; False if that batch is there already.

    What is kept of a batch is one row per group: the messages and a sketch of their different keys. Late rows are rows as any, in whichever batch.
    """
    partial = status_partials(df, by, time, unit, key).withColumn("route", F.lit("status"))
    return log.append(partial, ["status"], batch) is not None


def status_partials(df: DataFrame, by: Sequence[str], time: str | None, unit: str, key: str) -> DataFrame:
    keys: list[Column] = [F.col(c) for c in by]
    if time is not None:
        keys.append(F.date_trunc(unit, F.col(time)).alias("bucket"))
    sketch = F.hll_sketch_agg(F.coalesce(F.col(key).cast("string"), F.lit("")))
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("messages"), sketch.alias("sketch"))


def merged_status(spark: SparkSession, log: CommitLog, schema: T.StructType) -> DataFrame:
    """The status of all batches: messages, and about how many different keys; ``schema`` has the group columns. The messages are not read again."""
    rows = log.read(spark, T.StructType([*schema.fields, *PARTIAL.fields]), "status", log.state(spark).commits)
    merged = rows.groupBy(*schema.fieldNames()).agg(F.sum("messages").alias("messages"), F.hll_union_agg("sketch").alias("_sketch"))
    return merged.withColumn("different", F.hll_sketch_estimate("_sketch")).drop("_sketch")


def alerts(
    df: DataFrame,
    time: str,
    failed: Column,
    threshold: float,
    width: str = "1 hour",
    at_least: int = 1,
) -> DataFrame:
    """Time windows in which the share of failed messages is above the threshold."""
    return above(window_totals(df, time, failed, width), threshold, at_least)


def window_totals(df: DataFrame, time: str, failed: Column, width: str = "1 hour") -> DataFrame:
    """(window_start, window_end, messages, failures) of each time window, of a table or of a stream with a watermark."""
    totals = df.groupBy(F.window(time, width)).agg(F.count(F.lit(1)).alias("messages"), F.count_if(failed).alias("failures"))
    return totals.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "messages", "failures")


def above(totals: DataFrame, threshold: float, at_least: int = 1) -> DataFrame:
    """The windows with a share of failures above the threshold, with the ``ratio``."""
    return (
        totals.filter(F.col("messages") >= at_least)
        # compared as integers times the threshold, so no rounded ratio decides
        .filter(F.col("failures") > F.col("messages") * F.lit(threshold))
        .withColumn("ratio", F.col("failures") / F.col("messages"))
    )


def rule_counts(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows per broken rule, without the rules nobody broke.

    One row of counters per task is shuffled; no row is expanded into its reasons. Malformed
    messages count under ``decode``.
    """
    labels = [rule.name for rule in rules]
    if "malformed" in df.columns:
        labels.append(DECODE)
    counters = []
    for number, label in enumerate(labels):
        mask, bit = place(number)
        counters.append(F.count_if(F.col(f"_broken{mask}").bitwiseAND(bit) != 0).alias(label))
    counted = with_columns_once(df, columns_of(broken(df, rules), "_broken")).agg(*counters)
    tall = counted.unpivot([], [F.col(f"`{label}`") for label in labels], "rule", "n")
    return tall.filter("n > 0")


def share(part: int, whole: int) -> float:
    """Percentage, 0 for an empty whole."""
    return 100.0 * part / whole if whole else 0.0


def run_summary(counts: Mapping[str, int], seconds: float, of: str = "records") -> dict:
    """Summary of a finished run from its observed counts."""
    total = counts[of]
    summary = {name: n for name, n in counts.items() if name != of}
    return {
        "records": total,
        "seconds": seconds,
        "records_per_second": total / seconds if seconds > 0 else 0.0,
        **summary,
        **{f"{name}_percent": share(n, total) for name, n in summary.items()},
    }
