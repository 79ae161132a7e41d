import json

import pytest
from pyspark.sql import functions as F
from trips import BASE, envelope, trip

from lazaret.contracts import TRIP as SCHEMA
from lazaret.contracts import schema_of
from lazaret.functions import identity
from lazaret.functions.cleaning import Policy, clean_number, to_int
from lazaret.functions.codec import decode, encode
from lazaret.operators import faults
from lazaret.operators.repair import overlay, repair
from lazaret.plans.presets import TRIP, with_cleaning


def messages(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_decode_encode_round_trip(spark):
    first = decode(messages(spark, trip(), trip(fare_amount=None), trip(RateCodeID="x")), SCHEMA)
    wire = first.select(encode(first, SCHEMA).alias("value"))
    second = decode(wire, SCHEMA)
    columns = SCHEMA.fieldNames()
    assert first.select(*columns).collect() == second.select(*columns).collect()
    again = second.select(encode(second, SCHEMA).alias("value"))
    assert wire.collect() == again.collect()


def test_binary_values_are_read(spark):
    df = messages(spark, trip()).withColumn("value", F.col("value").cast("binary"))
    assert decode(df, SCHEMA).first()["fare_amount"] == 12.0


def test_text_mode_keeps_what_does_not_fit(spark):
    r = decode(messages(spark, trip(fare_amount="$12.50", passenger_count=1.0)), SCHEMA).first()
    assert r["fare_amount"] is None and r["text"]["fare_amount"] == "$12.50"
    assert r["passenger_count"] is None and r["text"]["passenger_count"] == "1.0"
    assert r["total_amount"] == pytest.approx(17.05) and not r["malformed"]
    assert decode(messages(spark, trip()), SCHEMA).first()["text"] is None


def test_typed_mode_loses_it(spark):
    r = decode(messages(spark, trip(fare_amount="$12.50")), SCHEMA, "typed").first()
    assert r["fare_amount"] is None and r["total_amount"] == pytest.approx(17.05)
    assert not r["malformed"] and "text" not in r


@pytest.mark.parametrize("mode", ["text", "typed"])
def test_malformed(spark, mode):
    bad = ["{not json", None, "", "[]", "1", '{"fare_amount": NaN}', "{'fare_amount': 1}"]
    read = decode(messages(spark, *bad, "{}"), SCHEMA, mode).collect()
    flags = [r["malformed"] for r in read]
    if mode == "text":
        assert flags == [True] * 7 + [False]
    else:
        # an array or a number is JSON, only not an object: typed reading sees empty records
        assert flags == [True, True, True, False, False, True, True, False]
    assert read[0]["raw"] == "{not json" and read[-1]["raw"] is None


def test_null_fields_are_left_out(spark):
    df = decode(messages(spark, trip(extra=None)), SCHEMA)
    assert "extra" not in json.loads(df.select(encode(df, SCHEMA)).first()[0])


def test_reserved_names_are_refused(spark):
    with pytest.raises(ValueError):
        decode(messages(spark, "{}"), schema_of(raw="string"))


def test_identity_is_stable(spark):
    ids = [decode(envelope(spark), SCHEMA).select("message_id").collect() for _ in range(2)]
    assert ids[0] == ids[1] and len(set(ids[0])) == len(ids[0])
    assert spark.range(2).select(identity.random_id()).distinct().count() == 2


def test_clean_number(spark):
    texts = ["$12.50", "1,234.5", "1.0E7", "5.0E-4", "invalid_value", "", None, "-3", "1e400"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    kept = [r[0] for r in df.select(clean_number(F.col("t"))).collect()]
    assert kept == [12.5, 1234.5, 1e7, 5e-4, None, None, None, -3.0, float("inf")]
    stripped = [r[0] for r in df.select(clean_number(F.col("t"), "strip")).collect()]
    assert stripped[:5] == [12.5, 1234.5, pytest.approx(1.07), None, None]


def test_to_int(spark):
    df = spark.createDataFrame([("3.7",), ("-3.7",), ("1e99",), ("x",)], "t string")
    assert [r[0] for r in df.select(to_int(F.col("t"))).collect()] == [3, -3, None, None]


@pytest.mark.parametrize("clean", ["exponent", "strip"])
def test_repair_is_idempotent(spark, clean):
    values = [
        trip(fare_amount="-$1,000.5", VendorID="x", passenger_count=3.7),
        trip(fare_amount=1e7, total_amount=5e-4),
        trip(trip_distance=16777217, extra=0.1),
    ]
    policies = with_cleaning(TRIP.policies, clean)
    once = repair(decode(messages(spark, *values), SCHEMA), policies)
    again = repair(
        decode(once.select(encode(once, SCHEMA).alias("value")), SCHEMA), policies
    )
    columns = [c for c in SCHEMA.fieldNames()]
    if clean == "exponent":
        assert once.select(*columns).collect() == again.select(*columns).collect()
        r = once.first()
        assert (r["fare_amount"], r["VendorID"], r["passenger_count"]) == (1000.5, 1, 3)
    else:
        # stripping is not: 1.0E7 is read as 1.07, which is why it is no default
        assert once.collect()[1]["fare_amount"] == pytest.approx(1.07)


def test_policies(spark):
    df = spark.createDataFrame([(None, -2.5), (7, 1.0)], "a int, b double")
    fixed = repair(df, [Policy("a", default=1), Policy("b", absolute=True)]).collect()
    assert [tuple(r) for r in fixed] == [(1, 2.5), (7, 1.0)]


def test_overlay(spark):
    rows = spark.createDataFrame([("x", 1, 1), ("y", 2, 2), ("z", 3, 3)], "message_id string, a int, b int")
    fixes = spark.createDataFrame(
        [("x", 10, None, 1), ("x", 11, None, 2), ("y", None, 20, 1), ("q", 0, 0, 1), (None, 9, 9, 1)],
        "message_id string, a int, b int, version int",
    )
    found = overlay(rows, fixes, ["a", "b"], newest=[F.col("version").desc()])
    got = {r["message_id"]: (r["a"], r["b"], r["corrected"]) for r in found.collect()}
    assert got == {"x": (11, 1, True), "y": (2, 20, True), "z": (3, 3, False)}


def test_fault_plan_is_repeatable_and_near_its_rate(spark):
    df = spark.range(20000).selectExpr("id", "id AS a", "cast(id AS string) AS b")
    planned = faults.plan(df, ["id"], ["a", "b"], 0.1)
    n = planned.filter("fault").count()
    assert 1800 < n < 2200
    again = faults.plan(df.repartition(7), ["id"], ["a", "b"], 0.1)
    assert planned.exceptAll(again).isEmpty()
    assert planned.filter("NOT fault AND (kind IS NOT NULL OR field IS NOT NULL)").isEmpty()
    assert faults.plan(df, ["id"], ["a", "b"], 1.0).filter("NOT fault").isEmpty()
    assert faults.plan(df, ["id"], ["a", "b"], 0.0).filter("fault").isEmpty()


def test_fault_constants():
    assert faults.rate_limit(0.01) == "028f5c29" and faults.rate_limit(0.25) == "40000000"
    assert faults.field_limits(list("abcdef")) == [
        "2aaaaaab", "55555556", "80000000", "aaaaaaab", "d5555556", "g"
    ]


def test_injection_on_the_wire(spark):
    df = spark.createDataFrame(
        [
            (1, 5.0, "t", "missing_field", "n"),
            (2, 5.0, "t", "invalid_value", "n"),
            (3, None, "t", "invalid_value", "n"),
            (4, 5.0, "t", "invalid_value", "s"),
            (5, 5.0, "t", None, None),
        ],
        "id int, n double, s string, kind string, field string",
    )
    hurt = faults.inject(df, ["n", "s"])
    schema = schema_of(id="integer", n="double", s="string")
    wire = [json.loads(r[0]) for r in hurt.select(faults.wire_record(hurt, schema, ["n", "s"])).collect()]
    assert wire == [
        {"id": 1, "s": "t"},
        {"id": 2, "n": -5.0, "s": "t"},
        {"id": 3, "n": "invalid_value", "s": "t"},
        {"id": 4, "n": 5.0, "s": "invalid_value"},
        {"id": 5, "n": 5.0, "s": "t"},
    ]


def test_base_message_has_the_contract_fields():
    assert list(BASE)[:-1] == SCHEMA.fieldNames()


def test_texts_with_letters_and_several_numbers(spark):
    texts = {
        "2 passengers": 2.0,
        "3 people": 3.0,
        "12.50 EUR": 12.5,
        "-$5": -5.0,
        "$1,234.50": 1234.5,
        "1.5e3": 1500.0,
        "2016-01-02": None,
        "1.2.3": None,
        "n/a": None,
    }
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    found = {r.t: r.n for r in rows.select("t", clean_number(F.col("t")).alias("n")).collect()}
    assert found == texts


def test_long_integers_stay(spark):
    rows = spark.sql("SELECT 9007199254740993L AS n, '9007199254740993' AS t, '7.9' AS u")
    row = rows.select(*(to_int(F.col(c), "bigint").alias(c) for c in rows.columns)).first()
    assert (row.n, row.t, row.u) == (9007199254740993, 9007199254740993, 7)


def test_only_one_object_is_a_message(spark):
    """Anything behind the object makes a message malformed; a record's own fields are no bookkeeping."""
    whole = ['{"id":1}', ' {"id":1} \n', '{"id":1,"o":{"a":"}"}}', '{"id":1,"raw":"x","message_id":"m"}']
    broken = [
        '{"id":1}{"id":2}', '{"id":1} x', '{"id":1},{"id":2}', '{"id":1}}', '{"id":1}]', '{"id":1}]}',
        '{"id":1,"o":{"a":1}} {', '', None, '[{"id":1}]', '1',
    ]
    rows = [(v, "t", 0, i) for i, v in enumerate(whole + broken)]
    df = spark.createDataFrame(rows, "value string, topic string, partition int, offset bigint")
    for mode in ("text", "typed"):
        read = decode(df, schema_of(id="integer"), mode)
        found = read.select("message.offset", "malformed", "id", "message_id").orderBy("offset").collect()
        # typed reading takes an array or a number for a record without fields
        refused = [True] * (len(broken) - 2) + [mode == "text"] * 2
        assert [r["malformed"] for r in found] == [False] * len(whole) + refused
        assert all(r["id"] == 1 for r in found[: len(whole)])
        assert len({r["message_id"] for r in found}) == len(found)


def test_small_rates_and_many_fields(spark):
    """Rates below one in 65,536 damage rows, and each of 400 fields is chosen."""
    rare = faults.plan(spark.range(3_000_000), ["id"], ["id"], 1e-5).filter("fault").count()
    assert 10 <= rare <= 60
    names = [f"f{i}" for i in range(400)]
    wide = spark.range(20_000).select("id")
    chosen = faults.plan(wide, ["id"], names, 1.0).select("field").distinct().count()
    assert chosen == 400
