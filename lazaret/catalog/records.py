"""Decoding, encoding, identity and repair of records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lazaret.catalog.inputs import RATE, event_messages, event_place, events, lineitem_ctes, table
from lazaret.contracts import schema_of
from lazaret.functions import cleaning, identity
from lazaret.functions.cleaning import Policy
from lazaret.functions.codec import decode, encode
from lazaret.operators import faults
from lazaret.operators.repair import overlay, repair
from lazaret.operators.repair import overlay_as_of as repair_overlay_as_of
from lazaret.operators.routing import broken, broken_names
from lazaret.plans.loop import resolve
from lazaret.plans.presets import CUSTOMER, EVENTS, LINEITEM

_EVENT_FIELDS = EVENTS.schema.fieldNames()


def json_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events encoded as JSON messages and decoded again: the rows that went in."""
    rows = events(spark, sf_dir)
    wire = rows.select(encode(rows, EVENTS.schema).alias("value"))
    return decode(wire, EVENTS.schema).select(*_EVENT_FIELDS)


def json_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A field of the JSON text column, summed."""
    wire = table(spark, sf_dir, "events").select("event_type", F.col("props").alias("value"))
    read = decode(wire, schema_of(k="integer"), "typed")
    return read.groupBy("event_type").agg(F.sum("k").alias("sum_k"), F.count("k").alias("n"))


def _half_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as messages; returned ones have no quantity, so a fault there writes a text."""
    rows = table(spark, sf_dir, "lineitem").withColumns(
        {
            "l_quantity": F.when(F.col("l_returnflag") != "R", F.col("l_quantity")),
            "l_shipdate": F.date_format("l_shipdate", "yyyy-MM-dd"),
        }
    )
    fields = LINEITEM.fault_fields
    hurt = faults.inject(faults.plan(rows, LINEITEM.key, fields, RATE), fields)
    return hurt.select(faults.wire_record(hurt, LINEITEM.schema, fields).alias("value"))


def decode_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Straight into types: a text in a number field is NULL and gone, the other fields survive."""
    read = decode(_half_typed(spark, sf_dir), LINEITEM.schema, "typed")
    return read.select("l_orderkey", "l_partkey", *LINEITEM.fault_fields, "malformed")


def decode_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text first: the same fields, and the text that does not fit is still there."""
    read = decode(_half_typed(spark, sf_dir), LINEITEM.schema)
    unfit = F.when(F.col("l_quantity").isNull(), F.col("text.l_quantity"))
    return read.select("l_orderkey", "l_partkey", *LINEITEM.fault_fields, unfit.alias("unfit"))


def decode_malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages cut short, empty, absent or with a bare NaN, next to good ones."""
    sent = event_messages(spark, sf_dir, rate=0.0)
    number = F.col("offset") % 7
    value = (
        F.when(number == 0, F.expr("left(value, length(value) - 1)"))
        .when(number == 1, F.lit("{}"))
        .when(number == 2, F.lit(None))
        .when(number == 3, F.lit('{"event_id": NaN}'))
        .otherwise(F.col("value"))
    )
    read = decode(sent.withColumn("value", value), EVENTS.schema)
    return read.select(
        F.col("message.partition").alias("partition"),
        F.col("message.offset").alias("offset"),
        "malformed",
        F.col("raw").isNotNull().alias("has_raw"),
        broken_names(broken(read, EVENTS.rules), EVENTS.rules).alias("failed_rules"),
        "event_id",
    )


def message_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The identity of each event from its place in the topic."""
    placed = events(spark, sf_dir).withColumns(event_place())
    return placed.select(
        "event_id", identity.message_id(F.lit("events"), "partition", "offset").alias("message_id")
    )


def random_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A random identifier for each line item: no two are alike."""
    ids = table(spark, sf_dir, "lineitem").select(identity.random_id().alias("id"))
    return ids.agg(F.countDistinct("id").alias("ids"), F.min(F.length("id")).alias("length"))


def time_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ISO text, compact stamp and epoch milliseconds of each event's time."""
    ts = F.col("ts").cast("timestamp")
    return table(spark, sf_dir, "events").select(
        "event_id",
        identity.iso_text(ts).alias("iso"),
        identity.stamp(ts).alias("stamp"),
        identity.epoch_millis(ts).alias("millis"),
    )


def _price_text() -> Column:
    """The price as dirty text: currency signs, thousands commas, exponents, or nothing readable."""
    cents = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    parts = {
        "thousands": F.floor(cents / 100000).cast("string"),
        "units": F.lpad((F.floor(cents / 100) % 1000).cast("string"), 3, "0"),
        "cents": F.lpad((cents % 100).cast("string"), 2, "0"),
    }
    grouped = F.concat(
        parts["thousands"], F.lit(","), parts["units"], F.lit("."), parts["cents"]
    )
    form = F.col("l_linenumber")
    return (
        F.when(form == 7, F.lit("n/a"))
        .when(form % 3 == 0, F.concat(F.lit("$"), grouped))
        .when(form % 3 == 1, F.concat(F.lit("USD "), grouped, F.lit(" ")))
        .otherwise(F.concat(cents.cast("string"), F.lit("e-2")))
    )


def _priced(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        *LINEITEM.key, _price_text().alias("price_text")
    )


def repair_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers out of dirty text, exponents kept."""
    priced = _priced(spark, sf_dir)
    return priced.withColumn("price", cleaning.clean_number(F.col("price_text")))


def repair_numbers_strip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with the stripping pattern and single precision: exponents are destroyed."""
    priced = _priced(spark, sf_dir)
    price = cleaning.clean_number(F.col("price_text"), "strip").cast("double")
    return priced.withColumn("price", price)


def repair_integers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Truncation to an integer, and a default where there is none."""
    text = F.when(
        F.col("l_linenumber") != 7,
        F.concat(F.col("l_quantity").cast("int").cast("string"), F.lit(".7 pcs")),
    )
    rows = table(spark, sf_dir, "lineitem").select(
        *LINEITEM.key,
        F.lit(None).cast("int").alias("quantity"),
        F.struct(text.alias("quantity")).alias("text"),
    )
    fixed = repair(rows, [Policy("quantity", clean="exponent", to="int", default=1)])
    return fixed.drop("text")


def repair_long_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with 64-bit user ids beyond double precision beside values to be repaired, through the loop; some ids are text with commas."""
    big = F.col("user_id") + F.lit(2**53 + 1)
    grouped = F.concat(F.substring(big.cast("string"), 1, 1), F.lit(","), F.substring(big.cast("string"), 2, 30))
    rows = table(spark, sf_dir, "events").select(
        "event_id",
        F.lit("t").alias("ts"),
        F.when(F.col("event_id") % 3 != 0, big).alias("user_id"),
        F.lit("view").alias("event_type"),
        F.when(F.col("event_id") % 2 == 0, -F.col("value")).otherwise(F.col("value")).alias("value"),
        F.lit("p").alias("props"),
        F.struct(F.when(F.col("event_id") % 3 == 0, grouped).alias("user_id")).alias("text"),
    )
    return resolve(rows, EVENTS.rules, EVENTS.policies).select("event_id", "user_id", "value")


def abs_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Negative balances repaired."""
    fixed = repair(table(spark, sf_dir, "customer"), CUSTOMER.policies)
    return fixed.select("c_custkey", "c_acctbal")


def manual_overlay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Open orders without a price, corrected by hand: of several fixes the latest shipment counts."""
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("message_id"),
        "o_orderstatus",
        F.when(F.col("o_orderstatus") != "O", F.col("o_totalprice")).alias("price"),
    )
    fixes = (
        table(spark, sf_dir, "lineitem")
        .filter("l_linestatus = 'O'")
        .withColumnsRenamed({"l_orderkey": "message_id", "l_extendedprice": "price"})
    )
    newest = [
        F.col(c).desc() for c in ("l_shipdate", "l_partkey", "l_suppkey", "l_linenumber", "price")
    ]
    corrected = overlay(orders, fixes, ["price"], newest=newest)
    return corrected.withColumnRenamed("message_id", "o_orderkey")


def overlay_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Errors corrected by hand with versioned fixes: for each event the last purchase of its user up to then, a third of the users one hot key."""
    user = F.when(F.col("user_id") % 3 == 0, F.lit(-1)).otherwise(F.col("user_id"))
    rows = table(spark, sf_dir, "events").select("event_id", user.alias("message_id"), F.col("ts").cast("timestamp").alias("timestamp"), "event_type", "value")
    fixes = rows.filter("event_type = 'purchase'").select("message_id", F.col("timestamp").alias("valid_from"), "value")
    found = repair_overlay_as_of(rows.filter("event_type = 'error'"), fixes, ["value"])
    return found.select("event_id", "message_id", "value", "corrected")


QUERIES = {
    "json_round_trip": json_round_trip,
    "json_props": json_props,
    "decode_typed": decode_typed,
    "decode_text": decode_text,
    "decode_malformed": decode_malformed,
    "message_identity": message_identity,
    "random_ids": random_ids,
    "time_texts": time_texts,
    "repair_numbers": repair_numbers,
    "repair_numbers_strip": repair_numbers_strip,
    "repair_integers": repair_integers,
    "repair_long_ids": repair_long_ids,
    "abs_repair": abs_repair,
    "manual_overlay": manual_overlay,
    "overlay_as_of": overlay_as_of,
}

_HALF_TYPED = (
    "src AS (SELECT * REPLACE (CASE WHEN l_returnflag <> 'R' THEN l_quantity END AS l_quantity)"
    f" FROM lineitem),{lineitem_ctes(source='src')}"
)

_PRICED = """
cents AS (
  SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
    CAST(round(l_extendedprice * 100) AS BIGINT) AS c
  FROM lineitem),
grouped AS (
  SELECT *, CAST(c // 100000 AS VARCHAR) || ',' || lpad(CAST((c // 100) % 1000 AS VARCHAR), 3, '0')
    || '.' || lpad(CAST(c % 100 AS VARCHAR), 2, '0') AS g
  FROM cents),
priced AS (
  SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
    CASE WHEN l_linenumber = 7 THEN 'n/a' WHEN l_linenumber % 3 = 0 THEN '$' || g
      WHEN l_linenumber % 3 = 1 THEN 'USD ' || g || ' ' ELSE CAST(c AS VARCHAR) || 'e-2'
    END AS price_text
  FROM grouped)"""

ORACLES = {
    "overlay_as_of": """
WITH rows AS (
  SELECT event_id, CASE WHEN user_id % 3 = 0 THEN -1 ELSE user_id END AS message_id, ts, event_type, value FROM events),
fixes AS (SELECT message_id, ts, max(value) AS fixed FROM rows WHERE event_type = 'purchase' GROUP BY message_id, ts)
SELECT event_id, r.message_id, coalesce(fixed, value) AS value, f.ts IS NOT NULL AS corrected
FROM (SELECT * FROM rows WHERE event_type = 'error') r
ASOF LEFT JOIN fixes f ON r.message_id = f.message_id AND r.ts >= f.ts""",
    "repair_long_ids": """
SELECT event_id, user_id + 9007199254740993 AS user_id,
  CASE WHEN event_id % 2 = 0 OR event_id % 3 = 0 THEN abs(value) ELSE value END AS value
FROM events""",
    "random_ids": "SELECT count(*) AS ids, 36 AS length FROM lineitem",
    "json_round_trip": """
SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, user_id, event_type, value, props
FROM events""",
    "json_props": """
SELECT event_type, CAST(sum(CAST(props ->> '$.k' AS INTEGER)) AS BIGINT) AS sum_k,
  count(props ->> '$.k') AS n
FROM events GROUP BY event_type""",
    "decode_typed": f"""
WITH {_HALF_TYPED}
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount,
  l_tax, false AS malformed
FROM damaged""",
    "decode_text": f"""
WITH {_HALF_TYPED}
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount,
  l_tax, CASE WHEN l_quantity IS NULL AND field = 'l_quantity' AND kind = 'invalid_value'
    THEN 'invalid_value' END AS unfit
FROM damaged""",
    "decode_malformed": """
WITH placed AS (
  SELECT event_id, CAST(event_id % 3 AS INTEGER) AS partition, event_id // 3 AS "offset",
    (event_id // 3) % 7 AS k
  FROM events)
SELECT partition, "offset", k IN (0, 2, 3) AS malformed, k IN (0, 2, 3) AS has_raw,
  CASE WHEN k IN (0, 2, 3) THEN 'decode' WHEN k = 1 THEN
    'event_id:not_null,ts:not_null,user_id:not_null,event_type:one_of,value:at_least' END
    AS failed_rules,
  CASE WHEN k > 3 THEN event_id END AS event_id
FROM placed""",
    "message_identity": """
SELECT event_id, sha256('events|' || (event_id % 3) || '|' || (event_id // 3)) AS message_id
FROM events""",
    "time_texts": """
SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS iso,
  strftime(ts, '%Y%m%d_%H%M%S') AS stamp, epoch_us(ts) // 1000 AS millis
FROM events""",
    "repair_numbers": f"""
WITH {_PRICED}
SELECT *, TRY_CAST(regexp_replace(price_text, '[^0-9.eE+-]', '', 'g') AS DOUBLE) AS price
FROM priced""",
    "repair_numbers_strip": f"""
WITH {_PRICED}
SELECT *, CAST(TRY_CAST(regexp_replace(price_text, '[^0-9.-]', '', 'g') AS FLOAT) AS DOUBLE)
  AS price
FROM priced""",
    "repair_integers": """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
  CASE WHEN l_linenumber = 7 THEN 1 ELSE CAST(trunc(l_quantity + 0.7) AS INTEGER) END AS quantity
FROM lineitem""",
    "abs_repair": "SELECT c_custkey, abs(c_acctbal) AS c_acctbal FROM customer",
    "manual_overlay": """
WITH fixes AS (
  SELECT l_orderkey, l_extendedprice FROM lineitem WHERE l_linestatus = 'O'
  QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC, l_partkey DESC,
    l_suppkey DESC, l_linenumber DESC, l_extendedprice DESC) = 1)
SELECT o_orderkey, o_orderstatus,
  coalesce(l_extendedprice, CASE WHEN o_orderstatus <> 'O' THEN o_totalprice END) AS price,
  l_orderkey IS NOT NULL AS corrected
FROM orders LEFT JOIN fixes ON o_orderkey = l_orderkey""",
}
