"""Toxicity: folding, matching, what is learned from labels, and accuracy on rows held out."""

import os
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lazaret.llm import toxicity
from lazaret.llm.text import texts_of
from tests.llm.test_operators import prose


def test_folding():
    said = {
        "1d1ot IDIOT ídïöt": "idiot idiot idiot",
        "mогоn ѕtupіd": "moron stupid",  # Cyrillic letters
        "ｍｏｒｏｎ 𝐦𝐨𝐫𝐨𝐧": "moron moron",
        "id​i­ot": "idiot",
        "$tupid!!! th$$$ of%%% tr@sh|": "stupid th of trash",
        "stupid,idiot": "stupid idiot",
        "漢字 x": "~~ x",
        "": "",
        " \n%": "",
    }
    assert {t: toxicity.folded_text(t) for t in said} == said


def test_rows_do_not_run_together():
    words = toxicity.folded(texts_of(pa.array(["ab", None, "", "c$", "d"])))
    line = words.data.tobytes().decode()
    assert [line[a:b].split() for a, b in zip(words.offsets, words.offsets[1:])] == [["ab"], [], [], ["c"], ["d"]]


def found(text, model):
    n, hits, density = toxicity.measured(texts_of(pa.array([text])), model)
    return int(n[0]), int(hits[0]), float(density[0])


def test_matches_by_words_beginnings_and_phrases():
    model = toxicity.Model((("idiot", 2.0), ("trash", 3.0), ("vequ*", 1.0), ("vequxa", 4.0)), ("trash can",))
    assert found("an idiot, idiot! idiotic", model) == (4, 2, 4 / 14)
    assert found("trash can trash", model) == (3, 1, 3 / 13)
    assert found("vequa vequxa xvequ", model) == (3, 2, 5 / 13)
    assert found("", model) == (0, 0, 0.0)
    assert found("trash " * 5000, model)[:2] == (5000, 5000)
    # the same words among more others weigh less
    assert found("trash " + "word " * 500, model)[2] < found("trash word", model)[2]
    assert found("trash", toxicity.Model((), ())) == (1, 0, 0.0)


def test_longest_beginnings_stay():
    kept = toxicity._trimmed({"vequ*": (5.0, 100), "vequx*": (5.0, 98), "vequxa": (5.1, 20), "other": (3.0, 9), "othe*": (3.0, 9)})
    assert kept == {"vequx*": 5.0, "other": 3.0}


@pytest.fixture(scope="module")
def labelled():
    rng = random.Random(9)
    docs, labels = [], []
    for i in range(1200):
        words = prose(rng, rng.randint(20, 150)).split()
        toxic = i % 4 == 0
        for _ in range(max(1, len(words) // 30) if toxic else 0):
            words.insert(rng.randrange(len(words)), rng.choice(["Zounder!", "z0under", "FRAB", "qualm" + rng.choice("abcdefghij") + rng.choice("xyz")]))
        if not toxic and rng.random() < 0.05:
            words.insert(0, "frab stone")
        docs.append((i, " ".join(words), "en", i, 0.5))
        labels.append((i, int(toxic)))
    return docs, labels


SCHEMA = "doc_id long, text string, lang string, toxic int, score double"


def test_learned_and_held_out(spark, labelled):
    docs, labels = labelled
    extra = [(None, "z0under", "en", 1, 0.1), (5000, None, "", 0, 0.0), (5001, "", "", 0, 0.0), docs[4], (5002, "word " * 100_000, "", 1, 0.0)]
    frame = spark.createDataFrame([*docs, *extra], SCHEMA).repartition(4)
    # labels of rows that are held out are wrong, and must not matter
    marks = [(i, t if zlib.crc32(str(i).encode()) % 3 != 1 else 1 - t) for i, t in labels]
    model = toxicity.fit(frame, spark.createDataFrame([*marks, (None, 1), (7, None)], "doc_id long, toxic int"))
    entries = dict(model.entries)
    assert {"zounder", "frab", "quaim*"} <= set(entries) and "frab stone" in model.exceptions
    rows = toxicity.score(frame, model).collect()
    assert len(rows) == len(docs) + len(extra) and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in rows)
    truth = dict(labels)
    for r in rows:
        assert r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)
        if r["doc_id"] in truth:
            assert r["predicted"] == truth[r["doc_id"]]
    assert {r["predicted"] for r in rows if r["doc_id"] in (5000, 5001, 5002)} == {0} and [r["predicted"] for r in rows if r["doc_id"] is None] == [1]


def test_without_labels(spark):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    docs = spark.createDataFrame([(1, "you idiot"), (2, "you friend")], "doc_id long, text string")
    model = toxicity.fit(docs, none)
    assert {r["doc_id"]: r["predicted"] for r in toxicity.score(docs, model).collect()} == {1: 1, 2: 0}
    assert toxicity.score(docs.limit(0), toxicity.fit(docs.limit(0), none)).collect() == []


def test_curve_follows_the_prior():
    x = np.concatenate([np.full(100, -3.0), np.full(100, 0.0)])
    slope, height = toxicity._curve(x, x > -1, 0.1)
    assert slope * -3 + height < -1 and slope * 0 + height > 1


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.1"), reason="no test tables here")
def test_held_out_rows_of_the_given_tables(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    rows = toxicity.score(docs, toxicity.fit(docs, labels)).filter("held_out").join(labels, "doc_id")
    got = {(r["toxic"], r["predicted"]): r["count"] for r in rows.groupBy("toxic", "predicted").agg(F.count("*").alias("count")).collect()}
    assert got[1, 1] >= 0.9 * (got[1, 1] + got[1, 0]) and got.get((0, 1), 0) <= 0.01 * got[0, 0]
