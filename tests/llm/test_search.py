"""Ranked search against a plain reading of its rules."""

import math
import random
import re

import numpy as np
import pytest

from lazaret.llm import search
from tests.llm.test_operators import prose


def terms(text):
    return [w.translate({c: c + 32 for c in range(65, 91)}) for w in re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text or "")]


def ranked(docs, items, k=20):
    held = [(d[0], terms(d[1])) for d in docs]
    held = [(i, t) for i, t in held if t]
    n, length = len(held), sum(len(t) for _, t in held)
    out = []
    for item in items:
        scores = []
        for doc_id, t in held:
            m = 75 + (25 * len(t) * n) // length
            score = 0
            for w in terms(item[1]):
                if w in t:
                    df = sum(w in x for _, x in held)
                    weight = math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))
                    score += weight * ((10**9 * t.count(w)) // (1000 * t.count(w) + 12 * m))
            if score > 0:
                scores.append((-score, doc_id is None, doc_id))
        best = sorted(scores, key=lambda x: x if x[2] is not None else x[:2])[:k]
        out += [(item[0], r, i, -s) for r, (s, _, i) in enumerate(best, 1)]
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def docs():
    rng = random.Random(5)
    vocabulary = prose(rng, 60).split()
    texts = [None, "", " .-\n", "ONE two-two\x0bé漢", "one"]
    texts += [" ".join(rng.choices(vocabulary, k=rng.randint(1, 30))) for _ in range(120)]
    texts += [texts[40]] * 30 + [" ".join(rng.choices(vocabulary, k=20_000))]
    rows = [(i, t, "item_id", i) for i, t in enumerate(texts)]
    return [*rows, rows[50], (None, texts[40], "x", 1), (None, texts[60], "x", 1)]


@pytest.fixture(scope="module")
def items(docs):
    rng = random.Random(6)
    texts = [None, "", "nowhere to be found", "One TWO é漢", docs[40][1], "one one one two"]
    texts += [" ".join(rng.choices(docs[-4][1].split(), k=25)) for _ in range(8)]
    return [*((i, t, 1) for i, t in enumerate(texts)), (4, docs[40][1], 2)]


SCHEMA = "doc_id long, text string, item_id string, rank int"


def test_same_ranks_as_by_the_rules(spark, docs, items):
    found = search.search(spark.createDataFrame(docs, SCHEMA).repartition(5), spark.createDataFrame(items, "item_id long, text string, doc_id int"))
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, found.collect()), key=repr) == ranked(docs, items)


def test_in_blocks_of_items_and_with_a_pilot(spark, docs, items, monkeypatch):
    monkeypatch.setattr(search, "BLOCK_TERMS", 150)
    monkeypatch.setattr(search, "HELD_TERMS", 250)
    monkeypatch.setattr(search, "PILOT", 4)
    monkeypatch.setattr(search, "PILOT_ROWS", 2)
    found = search.search(spark.createDataFrame(docs, SCHEMA).repartition(3), spark.createDataFrame(items, "item_id long, text string, doc_id int"), k=3)
    assert sorted(map(tuple, found.collect()), key=repr) == ranked(docs, items, 3)


def test_nothing_to_search(spark, docs, items):
    none, no_items = spark.createDataFrame([], SCHEMA), spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame(items, "item_id long, text string, doc_id int")
    assert search.search(none, some).collect() == []
    assert search.search(spark.createDataFrame(docs, SCHEMA), no_items).collect() == []
    assert search.search(spark.createDataFrame([(1, None, "", 1)], SCHEMA), some).columns == ["item_id", "rank", "doc_id", "score"]


def test_blocks_hold_like_documents_and_are_skipped_by_their_bounds():
    rng = np.random.default_rng(1)
    # ten themes of 40 terms each; term 0 is in all documents
    theme = rng.integers(0, 10, 1500)
    pairs = {(i, 0) for i in range(1500)} | {(i, 1 + 40 * int(theme[i]) + int(t)) for i in range(1500) for t in rng.integers(0, 40, 30)}
    row, term = (np.array(x) for x in zip(*sorted(pairs), strict=True))
    chunk = search.Chunk(row, term, np.full(len(row), 400_000), 1500, 401)
    rows, sizes, summaries = chunk.blocks(0)
    assert sorted(rows) == list(range(1500)) and sizes.sum() == 1500
    ends = np.cumsum(sizes)
    for a, b, summary in zip(ends - sizes, ends, summaries, strict=True):
        assert (chunk.vectors[rows[a:b]].max(axis=0) <= summary.astype(int) * search.UNIT).all()
    pure = [len(set(theme[rows[a:b]].tolist())) for a, b in zip(ends - sizes, ends, strict=True)]
    assert np.mean(pure) < 2

    lists = [(np.array([0, *range(1, 41)]), np.array([5000, *[4000] * 40]))]
    found = search.Search(lists, 20, np.zeros(1, np.int64))
    found.add(chunk, list(range(1500)))
    first = found.seen_blocks
    found.add(chunk, list(range(1500, 3000)))
    exact = sorted(-int(s) for s in (chunk.vectors[:, lists[0][0]] @ lists[0][1]) for _ in range(2))[:20]
    assert [s for s, _, _ in found.best[0]] == exact
    assert found.skipped_blocks > 0.3 * (found.seen_blocks - first)
