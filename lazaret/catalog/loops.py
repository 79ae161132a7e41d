"""The retry split and the repair loop."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lazaret.catalog.inputs import (
    LINEITEM_RULES,
    damaged_lineitem,
    lineitem_ctes,
    reasons_sql,
    table,
)
from lazaret.operators.routing import MAX_RETRIES, retry_split
from lazaret.plans.loop import iterate, resolve
from lazaret.plans.presets import LINEITEM
from lazaret.sources.storage import work_folder


def _earlier_visits() -> Column:
    """A retry count of 0 to 4 by line number, none for line 7."""
    return F.when(F.col("l_linenumber") < 7, (F.col("l_linenumber") - 1) % 5).cast("int")


def _split(spark: SparkSession, sf_dir: str, null_count: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").withColumn("retry_count", _earlier_visits())
    return retry_split(rows, MAX_RETRIES, null_count).select(
        *LINEITEM.key, "retry_count", "route", "error"
    )


def retry_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Retry or fail by the visits so far; a missing count starts at 0."""
    return _split(spark, sf_dir, "zero")


def retry_routes_lossy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same where a missing count stays missing and the row has no route."""
    return _split(spark, sf_dir, "drop")


_KEPT = [
    "l_orderkey",
    "l_partkey",
    *LINEITEM.fault_fields,
    "retry_count",
    "outcome",
    "failed_rules",
    "error",
]


def loop_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where the loop ends for every row, in one pass."""
    ended = resolve(damaged_lineitem(spark, sf_dir), LINEITEM.rules, LINEITEM.policies)
    return ended.select(*_KEPT)


def loop_iterate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same by rounds that are written out."""
    root = work_folder(spark, "loop_iterate")
    ended = iterate(damaged_lineitem(spark, sf_dir), LINEITEM.rules, LINEITEM.policies, root)
    return ended.select(*_KEPT)


def loop_earlier_visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The loop over rows that have been in the quarantine before."""
    hurt = damaged_lineitem(spark, sf_dir)
    visits = F.when(F.col("l_partkey") % 6 < 5, F.col("l_partkey") % 6).cast("int")
    counted = hurt.withColumn("retry_count", visits)
    return resolve(counted, LINEITEM.rules, LINEITEM.policies).select(*_KEPT)


def loop_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per outcome; they add up to the table."""
    ended = resolve(damaged_lineitem(spark, sf_dir), LINEITEM.rules, LINEITEM.policies)
    return ended.groupBy("outcome", "retry_count").agg(F.count(F.lit(1)).alias("n"))


QUERIES = {
    "retry_routes": retry_routes,
    "retry_routes_lossy": retry_routes_lossy,
    "loop_resolve": loop_resolve,
    "loop_iterate": loop_iterate,
    "loop_earlier_visits": loop_earlier_visits,
    "loop_outcomes": loop_outcomes,
}

_REPAIRED = {
    "l_suppkey": "coalesce(l_suppkey, 1)",
    "l_linenumber": "coalesce(l_linenumber, 1)",
    "l_extendedprice": "abs(l_extendedprice)",
}


def _resolved(visits: str) -> str:
    """CTEs up to ``resolved`` for an incoming retry count."""
    fixed_rules = LINEITEM_RULES
    for name, sql in _REPAIRED.items():
        fixed_rules = fixed_rules.replace(name, sql)
    return f"""{lineitem_ctes()},
counted AS (SELECT *, CAST({visits} AS INTEGER) AS rc FROM damaged),
judged AS (
  SELECT *, coalesce({LINEITEM_RULES}, false) AS ok, coalesce({fixed_rules}, false) AS ok_fixed,
    coalesce(rc, 0) + 1 AS rc1, {reasons_sql("lineitem")} AS why,
    {reasons_sql("lineitem", _REPAIRED)} AS why_fixed
  FROM counted),
ended AS (
  SELECT *, CASE WHEN ok THEN 'processed' WHEN rc1 >= 3 THEN 'failed' WHEN ok_fixed THEN 'repaired'
    ELSE 'failed' END AS outcome
  FROM judged),
resolved AS (
  SELECT l_orderkey, l_partkey,
    CASE WHEN ok THEN l_suppkey ELSE {_REPAIRED["l_suppkey"]} END AS l_suppkey,
    CASE WHEN ok THEN l_linenumber ELSE {_REPAIRED["l_linenumber"]} END AS l_linenumber,
    l_quantity,
    CASE WHEN ok THEN l_extendedprice ELSE {_REPAIRED["l_extendedprice"]} END AS l_extendedprice,
    l_discount, l_tax,
    CASE WHEN ok THEN coalesce(rc, 0) WHEN rc1 >= 3 OR ok_fixed THEN rc1 ELSE 3 END AS retry_count,
    outcome,
    CASE WHEN ok THEN NULL WHEN rc1 >= 3 OR ok_fixed THEN why ELSE why_fixed END AS failed_rules,
    CASE WHEN outcome = 'failed' THEN 'Max retries exceeded' END AS error
  FROM ended)"""


_SPLIT = """
WITH counted AS (
  SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
    CAST({count} AS INTEGER) AS retry_count
  FROM lineitem)
SELECT *,
  CASE WHEN retry_count < 3 THEN 'retry' WHEN retry_count >= 3 THEN 'failed' END AS route,
  CASE WHEN retry_count >= 3 THEN 'Max retries exceeded' END AS error
FROM counted"""

ORACLES = {
    "retry_routes": _SPLIT.format(
        count="CASE WHEN l_linenumber < 7 THEN (l_linenumber - 1) % 5 ELSE 0 END + 1"
    ),
    "retry_routes_lossy": _SPLIT.format(
        count="CASE WHEN l_linenumber < 7 THEN (l_linenumber - 1) % 5 END + 1"
    ),
    "loop_resolve": f"WITH {_resolved('0')} SELECT * FROM resolved",
    "loop_iterate": f"WITH {_resolved('0')} SELECT * FROM resolved",
    "loop_earlier_visits": f"""
WITH {_resolved("CASE WHEN l_partkey % 6 < 5 THEN l_partkey % 6 END")} SELECT * FROM resolved""",
    "loop_outcomes": f"""
WITH {_resolved("0")}
SELECT outcome, retry_count, count(*) AS n FROM resolved GROUP BY outcome, retry_count""",
}
