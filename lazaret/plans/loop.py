"""The repair loop: validate, quarantine, repair, count, try again, until each row has an end.

A row is validated. If valid it is processed. Otherwise it is repaired and its count goes up by
one; below the limit it is validated again, at the limit it is failed without another check.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lazaret.functions.cleaning import Policy
from lazaret.functions.rules import Rule, none_broken
from lazaret.functions.once import with_columns_once
from lazaret.operators.repair import with_repairs
from lazaret.operators.routing import (
    MAX_RETRIES,
    RETRIES_EXCEEDED,
    broken,
    broken_names,
    columns_of,
    fan_out,
    next_count,
    retry_route,
)

_FIXED = "_fixed_"


def resolve(
    df: DataFrame,
    rules: Sequence[Rule],
    policies: Sequence[Policy],
    max_retries: int = MAX_RETRIES,
) -> DataFrame:
    """Where the loop ends for each row, in one pass over the rows without a shuffle.

    Policies have to be idempotent; then a row that is invalid after its first repair stays invalid, and the
    loop needs no rounds. Others are refused: ``iterate`` takes them. Adds ``outcome`` (processed, repaired, failed), the final ``retry_count``,
    ``failed_rules`` of the last failed check and ``error``; repaired columns carry repaired values.
    """
    unstable = [p.column for p in policies if not p.idempotent]
    if unstable:
        raise ValueError(f"repairing {', '.join(unstable)} again may change the value again; use iterate")
    if "retry_count" not in df.columns:
        df = df.withColumn("retry_count", F.lit(0))
    fixed = [p.column for p in policies]

    def after(name: str):
        return F.col(_FIXED + name) if name in fixed else F.col(name)

    mended = with_repairs(df, policies, _FIXED)
    marks = columns_of(broken(df, rules), "_now"), columns_of(broken(df, rules, after), "_then")
    checked = with_columns_once(mended, marks[0] | marks[1])
    now, then = ([F.col(c) for c in side] for side in marks)
    count = next_count()
    valid, last_visit, cured = none_broken(now), count >= max_retries, none_broken(then)
    earlier = F.col("failed_rules") if "failed_rules" in df.columns else F.lit(None)
    # the masks of the last check that failed
    last = [F.when(last_visit | cured, a).otherwise(b) for a, b in zip(now, then, strict=True)]
    return checked.withColumns(
        {
            "outcome": F.when(valid, "processed")
            .when(last_visit, "failed")
            .when(cured, "repaired")
            .otherwise("failed"),
            "retry_count": F.when(valid, F.coalesce("retry_count", F.lit(0)))
            .when(last_visit | cured, count)
            .otherwise(F.lit(max_retries)),
            "failed_rules": F.when(valid, earlier.cast("string")).otherwise(
                broken_names(last, rules)
            ),
            "error": F.when(~valid & (last_visit | ~cured), F.lit(RETRIES_EXCEEDED)),
            **{name: F.when(valid, F.col(name)).otherwise(after(name)) for name in fixed},
        }
    ).drop(*marks[0], *marks[1], *(_FIXED + name for name in fixed))


def visit(
    df: DataFrame,
    rules: Sequence[Rule],
    policies: Sequence[Policy],
    max_retries: int = MAX_RETRIES,
) -> DataFrame:
    """One round: validate, and repair and count what is invalid.

    Adds ``route``: processed, retry or failed.
    """
    earlier = F.col("failed_rules") if "failed_rules" in df.columns else F.lit(None)
    mended = with_repairs(df, policies, _FIXED)
    marks = columns_of(broken(df, rules), "_now")
    judged = with_columns_once(mended, marks)
    now, count = [F.col(c) for c in marks], next_count()
    valid = none_broken(now)
    fixed = {
        p.column: F.when(valid, F.col(p.column)).otherwise(F.col(_FIXED + p.column))
        for p in policies
    }
    return judged.withColumns(
        {
            "route": F.when(valid, "processed").otherwise(retry_route(count, max_retries)),
            "retry_count": F.when(valid, F.coalesce("retry_count", F.lit(0))).otherwise(count),
            "failed_rules": F.when(valid, earlier.cast("string")).otherwise(
                broken_names(now, rules)
            ),
            **fixed,
        }
    ).drop(*marks, *(_FIXED + name for name in fixed))


def iterate(
    df: DataFrame,
    rules: Sequence[Rule],
    policies: Sequence[Policy],
    root: str,
    max_retries: int = MAX_RETRIES,
) -> DataFrame:
    """The loop in rounds, for policies that are not idempotent; the result is that of ``resolve``.

    A round is one pass over what is still pending, written to ``root`` by route; the next round
    reads the ``retry`` folder alone. The written rounds cut the lineage, and one that is complete
    is kept when the loop is started again on the same folder. Ends after ``max_retries`` rounds at
    the latest, since every round raises the count of what it sends on.
    """
    spark = df.sparkSession
    pending = df if "retry_count" in df.columns else df.withColumn("retry_count", F.lit(0))
    routes = ("processed", "retry", "failed")
    for n in range(max_retries + 1):
        visited = visit(pending, rules, policies, max_retries)
        # The schema is known, so a round without rows can be read too.
        schema = T.StructType([f for f in visited.schema if f.name != "batch"]).add("batch", T.IntegerType())
        counts = fan_out(visited, root, n, routes)
        done = spark.read.schema(schema).option("basePath", root).parquet(f"{root}/batch={n}")
        pending = done.filter(F.col("route") == "retry").drop("route", "batch")
        if counts is not None and counts["retry"] == 0:
            break
        if counts is None and pending.isEmpty():
            break
    ended = (
        spark.read.schema(schema)
        .option("basePath", root)
        .parquet(*(f"{root}/batch={i}" for i in range(n + 1)))
        .filter(F.col("route") != "retry")
    )
    outcome = F.when(F.col("route") == "failed", "failed").when(
        F.col("batch") == 0, "processed"
    )
    return ended.withColumns(
        {
            "outcome": outcome.otherwise("repaired"),
            "error": F.when(F.col("route") == "failed", F.lit(RETRIES_EXCEEDED)).cast("string"),
        }
    ).drop("route", "batch")


