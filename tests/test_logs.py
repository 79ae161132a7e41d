"""Commit logs and the identity index: what they hold, what they open, and that nothing is lost or doubled."""

import os
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lazaret.contracts import Contract, schema_of
from lazaret.plans import jobs
from lazaret.plans.presets import EVENTS
from lazaret.sources import identities, storage
from lazaret.sources.commits import CommitLog
from lazaret.sources.identities import IdentityIndex
from lazaret.sources.tables import Table, append_table, scan
from lazaret.streaming import logged
from lazaret.streaming.logged import LogHub
from lazaret.streaming.streams import Pipeline

ROWS = schema_of(n="long")


def rows(spark, numbers, route="a"):
    return spark.createDataFrame([(n, route) for n in numbers], "n long, route string").repartition(2)


def held(spark, log, route="a", after=-1):
    state = log.state(spark)
    return sorted(r["n"] for r in log.read(spark, ROWS, route, state.after(after), after).collect())


def test_log_is_read_by_place_before_and_after_folding(spark, folder):
    log = CommitLog(f"{folder}/log")
    assert log.state(spark).last == -1 and held(spark, log) == []
    for i in range(6):
        batch = rows(spark, [10 * i, 10 * i + 1]).union(rows(spark, [100 + i], "b"))
        assert log.append(batch, ["a", "b"], f"x{i}", {"source": i}) == {"a": 2, "b": 1}
    assert log.append(rows(spark, [7]), ["a"], "x3") is None  # a name that is there
    assert log.state(spark).last == 5 and log.state(spark).consumed == {"source": 5}
    before = {after: (held(spark, log, "a", after), held(spark, log, "b", after)) for after in range(-1, 6)}
    assert before[3] == ([40, 41, 50, 51], [104, 105])
    assert log.compact(spark, {"a": ROWS, "b": ROWS}) == 5
    assert {after: (held(spark, log, "a", after), held(spark, log, "b", after)) for after in range(-1, 6)} == before
    assert storage.names(spark, log.folder) == ["00000000000000000005.all.json"]
    log.append(rows(spark, [60]), ["a"], "x6")
    log.append(rows(spark, []), ["a"], "x7")
    assert log.compact(spark, {"a": ROWS, "b": ROWS}) == 2 and log.compact(spark, {"a": ROWS, "b": ROWS}) == 0
    assert held(spark, log, "a", 4) == [50, 51, 60] and log.state(spark).consumed == {"source": 5}
    assert log.append(rows(spark, [7]), ["a"], "x0") is None
    files = {f.path for c in log.state(spark).commits for f in c.files}
    assert log.vacuum(spark) > 0 and log.vacuum(spark) == 0
    assert all(os.path.exists(f.removeprefix("file:")) for f in files) and held(spark, log, "a", 4) == [50, 51, 60]


def test_large_commits_stay_as_they_are(spark, folder):
    log = CommitLog(f"{folder}/log")
    for i in range(4):
        log.append(rows(spark, range(1000 * (i % 2) + 1)), ["a"])
    assert log.compact(spark, {"a": ROWS}, commit_bytes=1) == 0
    assert len(log.state(spark).commits) == 4


def test_a_batch_that_broke_off_is_not_there(spark, folder):
    log = CommitLog(f"{folder}/log")
    log.append(rows(spark, [1]), ["a"])
    log.write(rows(spark, [2]), ["a"])  # written, never committed
    assert held(spark, log) == [1]
    state = log.state(spark)
    log.append(rows(spark, [3]), ["a"])
    with pytest.raises(FileExistsError):  # a second writer that took the same place
        log.commit(spark, state, log.write(rows(spark, [4]), ["a"])[0], {"a": 1})
    assert held(spark, log) == [1, 3]


def test_filters_miss_nothing_and_pass_little():
    rng = np.random.default_rng(1)
    own, other = (rng.integers(-(2**63), 2**63, 50_000, dtype=np.int64) for _ in range(2))
    bits = identities.bloom(own)
    assert identities.passing(own, bits).all() and identities.passing(other, bits).mean() < 1e-3


def ids(spark, names):
    return spark.createDataFrame([(n,) for n in names], "id string").coalesce(1)


def test_500_batches_open_only_candidate_files(spark, folder):
    index = IdentityIndex(f"{folder}/index", fanout=3)
    stored = [[f"{i}-{k}" for k in range(4)] for i in range(500)]
    names = [f"batch={i}" for i in range(500)]

    def of(missing):
        return ids(spark, [x for n in missing for x in stored[int(n[6:])]])

    for upto in (1, 2, 3, 4, 490, 491, 500):  # one by one, after a gap as if the index had fallen behind, and many at once
        index.catch_up(spark, names[:upto], of)
    index.catch_up(spark, names, of)
    manifest = index.manifest(spark)
    assert sum(r["rows"] for r in manifest["runs"]) == 2000 and len(manifest["covered"]) == 500
    assert max(Counter(r["level"] for r in manifest["runs"]).values()) < 3
    files = [f for r in manifest["runs"] for f in r["files"]]
    assert index.candidates(ids(spark, [f"fresh {i}" for i in range(50)])) == []
    one = index.candidates(ids(spark, [stored[2][0], "fresh"]))
    assert len(one) == 1 < len(files)
    again = [stored[i][i % 4] for i in range(0, 500, 7)]
    assert {r["id"] for r in index.known(ids(spark, [*again, "x", None])).collect()} == set(again)
    assert index.known(ids(spark, ["x"])) is None
    # more ids than are sent to the tasks
    small = IdentityIndex(f"{folder}/index", sent=10)
    assert {r["id"] for r in small.known(ids(spark, [*again, *map(str, range(50))])).collect()} == set(again)


def test_runs_in_many_files(spark, folder):
    index = IdentityIndex(f"{folder}/index", parts=10)
    names = [f"id {i}" for i in range(950)]
    index.catch_up(spark, ["a"], lambda _: ids(spark, names + names))
    (run,) = index.manifest(spark)["runs"]
    assert run["rows"] == 950 and len(run["files"]) == 10
    assert len(index.candidates(ids(spark, ["id 5"]))) == 1
    assert index.known(ids(spark, names[:300] + ["no"])).count() == 300


def test_overlapping_batches_into_a_table(spark, folder):
    table = Table(Contract("t", schema_of(message_id="string", n="long"), ("message_id",)), f"{folder}/t")
    for b in range(4):
        batch = spark.createDataFrame([(f"id {i}", b) for i in range(10 * b, 10 * b + 30)] * 2, "message_id string, n long")
        append_table(batch, table, b)
    found = scan(spark, table).collect()
    assert Counter(r["message_id"] for r in found) == Counter(f"id {i}" for i in range(60))
    assert all(r["n"] == max(0, (int(r["message_id"][3:]) - 20) // 10) for r in found)


def hub(folder, **options):
    return Pipeline.of(EVENTS, LogHub(f"{folder}/hub", "events", **options), f"{folder}/checkpoints")


def events(spark, first, n):
    return spark.range(first, first + n).select(
        F.col("id").alias("event_id"), F.lit("2024").alias("ts"), F.when(F.col("id") % 5 != 0, F.col("id")).alias("user_id"),
        F.when(F.col("id") % 7 == 0, "odd").otherwise("view").alias("event_type"), F.when(F.col("id") % 3 == 0, -1.0).otherwise(1.0).alias("value"), F.lit("p").alias("props"),
    )



def place():
    return {"partition": F.lit(0), "offset": F.col("event_id"), "timestamp": F.lit("2024-01-01").cast("timestamp")}


def ends(spark, p):
    out = {}
    for route in ("processed", "failed"):
        for r in p.sinks.table(spark, route, p.schema).select("message_id", "retry_count", "data.event_id").collect():
            assert r["message_id"] not in out  # each identity once
            out[r["message_id"]] = (route, r["event_id"])
    return sorted((e, r) for r, e in out.values())


def expected(n):
    return sorted((i, "failed" if i % 7 == 0 else "processed") for i in range(n))


def test_messages_published_twice_end_once(spark, folder):
    p = hub(folder)
    for name in ("first", "second"):
        jobs.publish(events(spark, 0, 40), EVENTS, p.sinks.published(), name, **place())
    logged.drain(spark, p)
    jobs.publish(events(spark, 20, 40), EVENTS, p.sinks.published(), "third", **place())
    logged.drain(spark, p)
    assert ends(spark, p) == expected(60)


def test_a_stage_that_broke_off_is_done_again(spark, folder, monkeypatch):
    p = hub(folder)
    jobs.publish(events(spark, 0, 30), EVENTS, p.sinks.published(), **place())
    with monkeypatch.context() as m:
        m.setattr(CommitLog, "commit", lambda *a, **k: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            logged.step(spark, p, "validate")
    assert p.sinks.log("validate").state(spark).last == -1
    logged.drain(spark, p)
    assert ends(spark, p) == expected(30)


def test_followed_as_streams_with_folding_in_between(spark, folder):
    p = hub(folder)
    for part in range(2):
        jobs.publish(events(spark, 20 * part, 20), EVENTS, p.sinks.published(), **place())
        for _ in range(2):
            for stage in ("validate", "repair"):
                logged.follow(spark, p, stage, availableNow=True).awaitTermination()
        logged.drain(spark, p)
        p.sinks.compact(spark, p.schema)
        assert all(len(storage.names(spark, p.sinks.log(s).folder)) <= 2 for s in ("published", "validate", "repair"))
    assert ends(spark, p) == expected(40)
    # a lost checkpoint loses nothing, as places are in the logs
    q = Pipeline.of(EVENTS, p.sinks, f"{folder}/other")
    logged.follow(spark, q, "validate", availableNow=True).awaitTermination()
    assert ends(spark, p) == expected(40)


def test_stores_that_do_not_rename_are_refused(spark, folder, monkeypatch):
    monkeypatch.setattr(storage, "OBJECT_STORES", {"file"})
    with pytest.raises(ValueError, match="commit log"):
        storage.write_whole(spark, f"{folder}/x", lambda path: spark.range(1).write.parquet(path))
    log = CommitLog(f"{folder}/log")
    log.append(rows(spark, [1, 2]), ["a"])
    assert held(spark, log) == [1, 2]
