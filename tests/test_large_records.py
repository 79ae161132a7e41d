"""Steps whose cost per row or per task once grew for nothing."""

import json

import pytest
from pyspark.sql import functions as F

from lazaret.contracts import schema_of
from lazaret.functions import codec
from lazaret.sources.tables import ROWS_PER_FILE, snapshot

SCHEMA = schema_of(a="long", b="string")
WHOLE = [
    '{"a":1,"b":"x"}',
    '{"a":1,"b":"{\\"k\\": 76}"}',  # an object as text, as in the props of events
    '{"a":1,"b":"x","retry_count":0,"_lazaret":{"message_id":"f0"}}',
    '{"a":1,"b":"}} \\\\","_lazaret":{"message_id":"f0","failed_rules":"{\\"a\\":"}}',
    ' \n{"a":1,\n"b":"x"} \n',
    '{"a":1,"b":"' + "{}" * 50_000 + '"}',
    '{"a":1,"b":"x","c":{"d":{"e":[{}]}}}',
    '{"a":1,"b":"é}"}',
]
MORE = [
    '{"a":1}{"a":2}',
    '{"a":1,"b":"x"}}',
    '{"a":1,"b":"{"}}',
    '{"a":1,"b":"\\"_lazaret\\":{"}}',
    '{"a":1,"b":"x","_lazaret":{"message_id":"f0"}}}',
    '{"a":1,"_lazaret":{"message_id":"f0"}} {}',
    '{"a":1} "b"',
    '{"a":1,"b":"x"} x}',
    '[{"a":1}]',
    '1 {"a":1}',
]


@pytest.mark.parametrize("mode", ["text", "typed"])
def test_what_follows_a_record_makes_it_malformed(spark, mode):
    rows = [(i, text) for i, text in enumerate(WHOLE + MORE)]
    frame = spark.createDataFrame(rows, "n long, value string")
    found = {r["n"]: r for r in codec.decode(frame, SCHEMA, mode).select("n", "a", "malformed").collect()}
    typed = {8 + MORE.index(x) for x in MORE if x.startswith("[")} if mode == "typed" else set()
    assert [found[n]["malformed"] for n, _ in rows if n not in typed] == [n >= len(WHOLE) for n, _ in rows if n not in typed]
    assert all(found[n]["a"] == 1 for n in range(len(WHOLE)))


def test_a_record_of_the_engine_is_parsed_once(spark, monkeypatch):
    """What takes the second parse is told apart by a parse that calls everything malformed."""
    monkeypatch.setattr(codec.F, "array_position", lambda *_: F.lit(9))
    frame = spark.createDataFrame([(n, x) for n, x in enumerate(WHOLE)], "n long, value string")
    twice = {r["n"] for r in codec.decode(frame, SCHEMA).filter("malformed").collect()}
    assert twice == {n for n, x in enumerate(WHOLE) if json.loads(x).get("c")}


def test_files_of_a_snapshot_are_bounded(spark, folder):
    rows = spark.range(2 * ROWS_PER_FILE + 7).coalesce(1).withColumn("text", F.concat(F.lit('a "b"\n'), "id"))
    path = snapshot(rows, folder, "one")
    read = spark.read.schema("id long, text string").options(header=True, multiLine=True, escape='"').csv(path)
    files = {r["count"] for r in read.groupBy(F.input_file_name()).count().collect()}
    assert files == {ROWS_PER_FILE, 7}
    assert read.exceptAll(rows).isEmpty() and read.count() == rows.count()
