"""Inputs shared by the queries, and the same inputs as SQL common table expressions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lazaret.operators import faults
from lazaret.plans import jobs
from lazaret.plans.presets import EVENTS, LINEITEM, Preset

RATE = 0.25


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def damaged(df: DataFrame, preset: Preset, rate: float = RATE) -> DataFrame:
    return faults.inject(
        faults.plan(df, preset.key, preset.fault_fields, rate), preset.fault_fields
    )


def damaged_lineitem(spark: SparkSession, sf_dir: str, rate: float = RATE) -> DataFrame:
    return damaged(table(spark, sf_dir, "lineitem"), LINEITEM, rate)


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with their time as text, as the message contract has it."""
    return table(spark, sf_dir, "events").withColumn(
        "ts", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    )


def event_place() -> dict:
    """Where an event sits in its topic: three partitions, numbered in order."""
    return {
        "partition": (F.col("event_id") % 3).cast("int"),
        "offset": F.expr("event_id div 3"),
        "timestamp": F.col("ts").cast("timestamp"),
    }


def event_messages(spark: SparkSession, sf_dir: str, rate: float = RATE) -> DataFrame:
    return jobs.messages(events(spark, sf_dir), EVENTS, "events", rate=rate, **event_place())


def _fault_ctes(
    source: str, key: tuple[str, ...], fields: dict[str, str | None], rate: float
) -> str:
    """``damaged``: the source with the planned faults carried out.

    ``fields`` maps a field to its SQL for an invalid value, None for a number.
    """
    names = "[" + ", ".join(f"'{f}'" for f in fields) + "]"
    chosen = f"{names}[CAST('0x' || substr(h, 10, 8) AS BIGINT) * {len(fields)} // 4294967296 + 1]"
    hit = f"CAST('0x' || substr(h, 1, 8) AS BIGINT) < {rate} * 4294967296.0"
    replaced = ",\n".join(
        f"CASE WHEN field = '{f}' AND kind = 'missing_field' THEN NULL"
        f" WHEN field = '{f}' AND kind = 'invalid_value' THEN {invalid or f'-abs({f})'}"
        f" ELSE {f} END AS {f}"
        for f, invalid in fields.items()
    )
    digest = " || ':' || ".join(key)
    return f"""
hashed AS (SELECT *, md5('42:' || {digest}) AS h FROM {source}),
planned AS (
  SELECT *, {hit} AS fault,
    CASE WHEN {hit} THEN
      CASE WHEN substr(h, 9, 1) < '8' THEN 'missing_field' ELSE 'invalid_value' END END AS kind,
    CASE WHEN {hit} THEN {chosen} END AS field
  FROM hashed),
damaged AS (SELECT * REPLACE ({replaced}) FROM planned)"""


def lineitem_ctes(rate: float = RATE, source: str = "lineitem") -> str:
    return _fault_ctes(source, LINEITEM.key, dict.fromkeys(LINEITEM.fault_fields), rate)


def event_ctes(rate: float = RATE) -> str:
    """``ev`` (events with text time) and ``damaged``."""
    texts = {"event_type": "'invalid_value'", "props": "'invalid_value'"}
    fields = {f: texts.get(f) for f in EVENTS.fault_fields}
    ev = "ev AS (SELECT * REPLACE (strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts) FROM events),"
    return ev + _fault_ctes("ev", EVENTS.key, fields, rate)


# The conjunction of a preset's rules in SQL.
LINEITEM_RULES = (
    "l_suppkey IS NOT NULL AND l_shipdate IS NOT NULL AND l_quantity BETWEEN 1 AND 50"
    " AND l_extendedprice >= 0 AND l_discount >= 0 AND l_linenumber IN (1, 2, 3, 4, 5, 6)"
    " AND l_linestatus IN ('F', 'O')"
)
EVENT_RULES = (
    "event_id IS NOT NULL AND ts IS NOT NULL AND user_id IS NOT NULL"
    " AND event_type IN ('click', 'error', 'purchase', 'signup', 'view') AND value >= 0"
)


def reasons_sql(kind: str, renamed: dict[str, str] | None = None) -> str:
    """Comma-separated names of broken rules; NULL when none is broken."""
    tests = {
        "lineitem": {
            "l_suppkey:not_null": "{l_suppkey} IS NOT NULL",
            "l_shipdate:not_null": "{l_shipdate} IS NOT NULL",
            "l_quantity:between": "{l_quantity} BETWEEN 1 AND 50",
            "l_extendedprice:at_least": "{l_extendedprice} >= 0",
            "l_discount:at_least": "{l_discount} >= 0",
            "l_linenumber:one_of": "{l_linenumber} IN (1, 2, 3, 4, 5, 6)",
            "l_linestatus:one_of": "{l_linestatus} IN ('F', 'O')",
        },
        "events": {
            "event_id:not_null": "{event_id} IS NOT NULL",
            "ts:not_null": "{ts} IS NOT NULL",
            "user_id:not_null": "{user_id} IS NOT NULL",
            "event_type:one_of": (
                "{event_type} IN ('click', 'error', 'purchase', 'signup', 'view')"
            ),
            "value:at_least": "{value} >= 0",
        },
    }[kind]

    class Names(dict):
        def __missing__(self, key: str) -> str:
            return (renamed or {}).get(key, key)

    cases = ", ".join(
        f"CASE WHEN NOT coalesce({test.format_map(Names())}, false) THEN '{name}' END"
        for name, test in tests.items()
    )
    return f"nullif(concat_ws(',', {cases}), '')"
