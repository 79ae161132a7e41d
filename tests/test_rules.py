import pytest
from pyspark.sql import functions as F

from lazaret.functions.cleaning import Policy
from lazaret.functions.rules import (
    Rule,
    at_least,
    between,
    failures,
    names,
    not_nan,
    not_null,
    one_of,
    reasons,
    verdict,
)
from lazaret.operators import metrics
from lazaret.operators.routing import retry_split, split, triage
from lazaret.plans.loop import resolve

RULES = [not_null("a"), between("b", 0, 9), at_least("c", 0), one_of("d", ["Y", "N"])]
ROWS = [
    (1, 1, 1, 1.0, "Y"),
    (2, None, 1, 1.0, "Y"),
    (3, 1, None, 1.0, "N"),
    (4, 1, 10, -1.0, "Y"),
    (5, 1, 9, None, "X"),
    (6, 1, 0, 0.0, None),
    (7, 1, 0, float("nan"), "N"),
]


@pytest.fixture
def rows(spark):
    return spark.createDataFrame(ROWS, "id int, a int, b int, c double, d string")


def by_id(df, column):
    return {r["id"]: r[column] for r in df.collect()}


def test_verdicts(rows):
    total = by_id(rows.withColumn("v", verdict(RULES)), "v")
    assert total == {1: True, 2: False, 3: False, 4: False, 5: False, 6: False, 7: True}
    plain = by_id(rows.withColumn("v", verdict(RULES, "drop")), "v")
    assert plain == {1: True, 2: False, 3: None, 4: False, 5: False, 6: None, 7: True}


def test_verdict_modes_are_checked():
    with pytest.raises(ValueError):
        verdict(RULES, "other")


def test_reasons_and_mask_agree(rows):
    found = rows.withColumn("r", F.concat_ws(",", reasons(RULES))).withColumn(
        "n", F.coalesce(names(failures(RULES), RULES), F.lit(""))
    )
    for r in found.collect():
        assert r["r"] == r["n"]
    assert by_id(found, "r")[4] == "b:between,c:at_least"


def test_not_nan(rows):
    assert by_id(rows.withColumn("v", verdict([*RULES, not_nan("c")])), "v")[7] is False


def test_split_is_complete_by_default(rows):
    valid, invalid = split(rows, RULES)
    assert set(by_id(valid, "a")) | set(by_id(invalid, "a")) == {r[0] for r in ROWS}
    valid, invalid = split(rows, RULES, "drop")
    assert set(by_id(invalid, "a")) == {2, 4, 5}


def test_triage(rows):
    total = by_id(triage(rows, RULES), "route")
    assert {i for i, route in total.items() if route == "processed"} == {1, 7}
    assert None not in total.values()
    lossy = by_id(triage(rows, RULES, "drop"), "route")
    assert {i for i, route in lossy.items() if route is None} == {3, 6}


def test_retry_split(spark):
    rows = spark.createDataFrame([(0,), (1,), (2,), (3,), (None,)], "retry_count int")
    found = retry_split(rows, 3).collect()
    assert [(r["retry_count"], r["route"]) for r in found] == [
        (1, "retry"), (2, "retry"), (3, "failed"), (4, "failed"), (1, "retry"),
    ]
    assert found[2]["error"] == "Max retries exceeded" and found[0]["error"] is None
    lossy = retry_split(rows, 3, "drop").collect()
    assert (lossy[4]["retry_count"], lossy[4]["route"]) == (None, None)


def test_conjunction_reaches_the_scan(spark, rows, folder):
    rows.write.parquet(f"{folder}/t")
    spark.conf.set("spark.sql.maxMetadataStringLength", 1000)
    try:
        valid, _ = split(spark.read.parquet(f"{folder}/t"), RULES)
        plan = valid._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    pushed = plan.split("PushedFilters: [")[1]
    assert "GreaterThanOrEqual(b,0)" in pushed and "In(d, [N,Y])" in pushed


def test_many_rules(spark, rows):
    """Bits above the range of an int."""
    many = [between("b", i, 100) for i in range(40)]
    (mask,) = failures(many)
    found = rows.filter("id = 1").select(mask.alias("mask"))
    assert found.first()["mask"] == sum(1 << i for i in range(2, 40))
    assert rows.select(names(failures(many), many).alias("n")).first()["n"].count(",") == 37


@pytest.mark.parametrize("n", [61, 62, 63, 124, 150])
def test_more_rules_than_a_mask_holds(rows, n):
    """Each broken rule is named by all operators, and a malformed message by its own name only."""
    many = [between("b", i, 100) for i in range(n)]
    marked = rows.filter("id = 1").withColumn("malformed", F.lit(False))
    listed = [m.name for m in many[2:]]
    assert triage(marked, many).first()["failed_rules"].split(",") == listed
    assert resolve(marked, many, []).first()["failed_rules"].split(",") == listed
    counts = {r["rule"]: r["n"] for r in metrics.rule_counts(marked, [Rule("b", f"r{i}", m.test) for i, m in enumerate(many)]).collect()}
    assert counts == {f"b:r{i}": 1 for i in range(2, n)}
    malformed = marked.withColumn("malformed", F.lit(True))
    assert triage(malformed, many).first()["failed_rules"] == "decode"
    assert triage(marked, [between("b", 0, 100 + i) for i in range(n)]).first()["route"] == "processed"


def test_unstable_repairs_have_no_closed_form(rows):
    """Stripping 10000000.0 gives 1.07 in the first round and would give something else in the next."""
    with pytest.raises(ValueError, match="iterate"):
        resolve(rows, RULES, [Policy("c", clean="strip", to="double")])
