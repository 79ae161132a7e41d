"""Verdicts, reasons, splits and faults."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lazaret.catalog.inputs import (
    LINEITEM_RULES,
    damaged_lineitem,
    lineitem_ctes,
    reasons_sql,
    table,
)
from lazaret.functions.rules import reasons, verdict
from lazaret.operators import faults
from lazaret.operators.metrics import rule_counts
from lazaret.operators.routing import split, triage
from lazaret.plans.presets import CUSTOMER, LINEITEM


def verdict_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per route."""
    routed = triage(damaged_lineitem(spark, sf_dir), LINEITEM.rules)
    return routed.groupBy("route").agg(F.count(F.lit(1)).alias("n"))


def verdict_three_valued(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TRUE, FALSE and NULL verdicts: the NULL ones are what a three-valued split loses."""
    outcome = verdict(LINEITEM.rules, "drop")
    label = F.when(outcome, "true").when(~outcome, "false").otherwise("null")
    return (
        damaged_lineitem(spark, sf_dir)
        .groupBy(label.alias("verdict"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def split_lossy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid, invalid and lost rows of a three-valued split."""
    routed = triage(damaged_lineitem(spark, sf_dir), LINEITEM.rules, "drop")
    return routed.groupBy(F.coalesce("route", F.lit("lost")).alias("route")).agg(
        F.count(F.lit(1)).alias("n")
    )


def valid_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The valid side of the split of a stored table; the rules reach the Parquet scan."""
    valid, _ = split(table(spark, sf_dir, "lineitem"), LINEITEM.rules)
    return valid.select(*LINEITEM.key, "l_quantity", "l_extendedprice", "l_discount")


def invalid_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The invalid side of the split of a stored table."""
    _, invalid = split(table(spark, sf_dir, "customer"), CUSTOMER.rules)
    return invalid.select("c_custkey", "c_acctbal")


def rule_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per broken rule."""
    return rule_counts(damaged_lineitem(spark, sf_dir), LINEITEM.rules)


def reason_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per list of broken rules."""
    listed = damaged_lineitem(spark, sf_dir).select(reasons(LINEITEM.rules).alias("broken"))
    return listed.groupBy(F.array_join("broken", " ").alias("broken")).agg(
        F.count(F.lit(1)).alias("n")
    )


def row_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each quarantined row with its reasons."""
    routed = triage(damaged_lineitem(spark, sf_dir), LINEITEM.rules)
    # the key fields are themselves damaged at times, so the order and part identify the row
    return routed.filter("route = 'dlq'").select("l_orderkey", "l_partkey", "failed_rules")


def fault_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Planned faults by kind and field, at the default rate."""
    planned = faults.plan(table(spark, sf_dir, "lineitem"), LINEITEM.key, LINEITEM.fault_fields)
    return (
        planned.filter("fault").groupBy("kind", "field").agg(F.count(F.lit(1)).alias("n"))
    )


def fault_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row after injection."""
    return damaged_lineitem(spark, sf_dir).select(
        "l_orderkey", "l_partkey", *LINEITEM.fault_fields, "fault", "kind", "field"
    )


QUERIES = {
    "verdict_split": verdict_split,
    "verdict_three_valued": verdict_three_valued,
    "split_lossy": split_lossy,
    "valid_scan": valid_scan,
    "invalid_scan": invalid_scan,
    "rule_failures": rule_failures,
    "reason_lists": reason_lists,
    "row_reasons": row_reasons,
    "fault_plan": fault_plan,
    "fault_rows": fault_rows,
}

ORACLES = {
    "verdict_split": f"""
WITH {lineitem_ctes()}
SELECT CASE WHEN {LINEITEM_RULES} THEN 'processed' ELSE 'dlq' END AS route, count(*) AS n
FROM damaged GROUP BY 1""",
    "verdict_three_valued": f"""
WITH {lineitem_ctes()}, judged AS (SELECT ({LINEITEM_RULES}) AS v FROM damaged)
SELECT CASE WHEN v THEN 'true' WHEN NOT v THEN 'false' ELSE 'null' END AS verdict, count(*) AS n
FROM judged GROUP BY 1""",
    "split_lossy": f"""
WITH {lineitem_ctes()}, judged AS (SELECT ({LINEITEM_RULES}) AS v FROM damaged)
SELECT CASE WHEN v THEN 'processed' WHEN NOT v THEN 'dlq' ELSE 'lost' END AS route, count(*) AS n
FROM judged GROUP BY 1""",
    "valid_scan": f"""
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount
FROM lineitem WHERE {LINEITEM_RULES}""",
    "invalid_scan": "SELECT c_custkey, c_acctbal FROM customer WHERE NOT c_acctbal >= 0",
    "rule_failures": f"""
WITH {lineitem_ctes()},
broken AS (SELECT unnest(string_split({reasons_sql("lineitem")}, ',')) AS rule FROM damaged)
SELECT rule, count(*) AS n FROM broken GROUP BY rule""",
    "reason_lists": f"""
WITH {lineitem_ctes()}
SELECT coalesce(replace({reasons_sql("lineitem")}, ',', ' '), '') AS broken, count(*) AS n
FROM damaged GROUP BY 1""",
    "row_reasons": f"""
WITH {lineitem_ctes()}
SELECT l_orderkey, l_partkey, {reasons_sql("lineitem")} AS failed_rules
FROM damaged WHERE NOT coalesce({LINEITEM_RULES}, false)""",
    "fault_plan": f"""
WITH {lineitem_ctes(faults.FAILURE_RATE)}
SELECT kind, field, count(*) AS n FROM planned WHERE fault GROUP BY kind, field""",
    "fault_rows": f"""
WITH {lineitem_ctes()}
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount,
  l_tax, fault, kind, field
FROM damaged""",
}
