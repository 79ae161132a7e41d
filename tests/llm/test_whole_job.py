"""Inputs on which an operator once did less than the whole job."""

import random
import time
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lazaret.llm import decontaminate, html_crf, ngram_join, packing, sharding, warc
from lazaret.llm.text import NOT_ALNUM, texts_of, words_of
from tests.llm.test_operators import prose


def test_near_copies_behind_many_empty_rows(spark):
    rng = random.Random(1)
    base = prose(rng, 60)
    empty = spark.range(70_000).select(F.col("id").alias("doc_id"), F.lit("").alias("text"))
    pair = spark.createDataFrame([(70_000, base), (70_001, base + " end")], "doc_id long, text string")
    found = ngram_join.near_duplicates(empty.union(pair).coalesce(1)).filter("id >= 70000").collect()
    assert {(r["id"], r["component_id"]) for r in found} == {(70_000, 70_000), (70_001, 70_000)}


@pytest.mark.parametrize(("share", "first"), [(1 / 3, -9000), (1 / 2, 1500)])
def test_shards_beside_a_hot_group_are_even(spark, share, first):
    rng = random.Random(8)
    rows = [(i, prose(rng, 6), f"s{i % 4}") for i in range(4000)]
    copies = int(sum(len(t) + 1 for _, t, _ in rows) * share / (1 - share) / 101)
    rows += [(first + i, "x" * 100, "s1") for i in range(copies)]
    sizes, hot = Counter(), set()
    for r in sharding.shard(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect():
        sizes[r["shard"]] += r["size"]
        if r["size"] == 101:
            hot.add(r["shard"])
    assert set(sizes) == set(range(8)) and len(hot) == 1
    even = [n for s, n in sizes.items() if s not in hot]
    assert max(even) - min(even) <= 0.05 * sum(even) / len(even)


def test_few_groups_have_a_shard_each(spark):
    rows = [(i, "abc"[i % 3] * (10 + i % 3), "s") for i in range(30)]
    found = sharding.shard(spark.createDataFrame(rows, "doc_id long, text string, source string"), 8).collect()
    assert Counter(Counter(r["shard"] for r in found).values()) == {10: 3}


def test_one_of_each_goes_by_row(spark):
    rng = random.Random(2)
    a, b, c, d = (prose(rng, 60) for _ in range(4))
    rows = [
        (1, a), (1, b),  # one id, two texts
        (2, a + " end"), (2, c), (9, c + " end"),  # 2 is a copy in one class and the first of another
        (None, d), (None, d + " end"), (None, d),  # a class without ids
        (None, b + " end"), (5, ""), (5, ""),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    kept = [tuple(r) for r in ngram_join.one_of_each(docs).collect()]
    assert Counter(r[0] for r in kept) == Counter([1, 1, 2, None, 5, 5])
    assert {r for r in kept if r[0] in (1, 2)} == {(1, a), (1, b), (2, c)}


@pytest.mark.parametrize(("n", "replaced"), [(6, 1), (8, 2), (12, 1), (12, 3), (13, 1), (15, 2), (15, 3), (16, 3), (20, 4), (24, 5), (24, 6), (6, 0)])
def test_short_items_are_found_with_words_replaced(n, replaced):
    rng = random.Random(n)
    found = 0
    for _ in range(200):
        item = prose(rng, n).split()
        for i in rng.sample(range(n), replaced):
            item[i] = f"x{i}"
        text = f"{prose(rng, 20)} {' '.join(item)} {prose(rng, 20)}"
        for i in range(n):
            if item[i] == f"x{i}":
                item[i] = f"was{i}"
        block = decontaminate.Block.of([1], [" ".join(item)])
        found += bool(list(block.overlaps(words_of(texts_of(pa.array([text])), NOT_ALNUM))))
    assert found == 200


def test_short_items_are_not_found_by_chance():
    rng = random.Random(3)
    vocabulary = prose(rng, 30).split()
    items = [" ".join(rng.choices(vocabulary, k=15)) for _ in range(200)]
    text = " ".join(rng.choices(vocabulary, k=5000))
    block = decontaminate.Block.of(list(range(200)), items)
    assert not list(block.overlaps(words_of(texts_of(pa.array([text])), NOT_ALNUM)))


def test_part_of_a_long_item_beside_a_worse_stretch():
    rng = random.Random(4)
    item = prose(rng, 80).split()
    # 14 of 14 words, then two of three: the best stretch holds both and misses the share
    said = [w if i < 14 or (i - 14) % 10 in (3, 4, 5, 6, 7, 8, 9) else "other" for i, w in enumerate(item)]
    block = decontaminate.Block.of([1], [" ".join(item)])
    assert list(block.overlaps(words_of(texts_of(pa.array([" ".join(said)])), NOT_ALNUM)))


def test_every_source_has_its_queue(spark):
    texts = [(i, "some words to pack here " * 4, f"s{i % 1500}" if i % 1500 else None) for i in range(3000)]
    docs = spark.createDataFrame(texts, "doc_id long, text string, source string").repartition(3)
    pieces = packing.pack(docs, "word_bpe_49k.json", window=256, targets={"s17": 2.0, None: 1.0, "not there": 1.0}).collect()
    assert {r["queue"] for r in pieces} == {t[2] for t in texts}
    tokens, early = Counter(), Counter()
    for r in pieces:
        tokens[r["queue"]] += r["length"]
    # the two with targets come first, two tokens to one until the heavier ends
    for r in pieces:
        if r["sequence_id"] * 256 + r["offset"] < tokens[None] + tokens["s17"]:
            early[r["queue"]] += r["length"]
    assert len(set(tokens.values())) == 1 and set(early) == {"s17", None}
    assert sum(tokens.values()) == sum(r["length"] for r in pieces)


def test_pages_whose_url_looks_like_a_version_block(spark):
    rows = [(i, f"filedesc://page{i}.arc" if i % 2 else "http://a/", f"<p>{i // 3}</p>", 0) for i in range(40)]
    found = warc.round_trip(spark.createDataFrame(rows, "page_id long, url string, html string, record_type int").repartition(2))
    assert {r["page_id"]: r["payload_bytes"] for r in found.collect()} == {r[0]: len(r[2]) for r in rows}


def test_version_blocks_in_the_middle_of_a_file():
    def record(version, url, content):
        return warc.arc_record(version, {"url": url, "ip": "192.0.2.1", "date": "20010203040506", "type": "text/html", "code": "200"}, content)

    data = b"".join(
        [
            warc.version_block(1, "a.arc", "20010203040506"), record(1, "filedesc://b", b"HTTP/1.1 200 OK\r\n\r\nx"),
            warc.version_block(2, "c.arc", "20010203040506"), record(2, "filedesc://d", b"1 0 x\nno block"), record(2, "http://e/", b"y"),
        ]
    )
    found = [(v, h["url"], "definition" in h) for v, _, h, _ in warc.read_arc(data)]
    assert found == [(1, "filedesc://a.arc", True), (1, "filedesc://b", False), (2, "filedesc://c.arc", True), (2, "filedesc://d", False), (2, "http://e/", False)]


def test_one_of_each_leaves_all_columns_as_they_are(spark):
    rng = random.Random(12)
    a = prose(rng, 60)
    rows = [(1, a, 77, 78, "x"), (2, a + " end", 1, 2, "y"), (3, prose(rng, 60), 3, 4, "z"), (4, None, 5, 6, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _row long, _Row_ long, _class string")
    assert {tuple(r) for r in ngram_join.one_of_each(docs).collect()} == {rows[0], rows[2], rows[3]}


def overlapping(items, *texts):
    block = decontaminate.Block.of(list(range(len(items))), items)
    return [(row, item) for row, item, *_ in block.overlaps(words_of(texts_of(pa.array(texts)), NOT_ALNUM))]


def test_items_of_a_few_words_are_found_as_a_whole():
    items = ["two plus two is four", "Paris", "one two three", "", None, " ".join(f"w{i}" for i in range(40)), "a b c d e f g"]
    texts = ["so two plus two is FOUR, they say", "two plus two was four", "in Paris.", "one two", "zero one two three four", None, "w1 w2 w3", "a b c d e f g"]
    assert sorted(overlapping(items, *texts)) == [(0, 0), (2, 1), (4, 2), (7, 6)]


def test_words_that_repeat(monkeypatch):
    item = "buffalo " * 40
    few = overlapping([item], "buffalo " * 500, "bison " * 500)
    assert few and {row for row, _ in few} == {0}
    monkeypatch.setattr(decontaminate, "HITS", 100)
    assert overlapping([item], "buffalo " * 500, "bison " * 500) == few


@pytest.mark.parametrize(
    "page",
    [
        "<a " * 350_000, "<div>x" * 100_000, "<div>" * 100_000 + "</span>" * 70_000, "<b>" * 150_000 + "<li></li>" * 60_000, '<a "' * 250_000 + ">",
        "<a><nav>" + "<div>" * 50_000 + "</a>" * 100_000, "<!--" * 250_000, "<script>" * 120_000,
    ],
    ids=["open", "nested", "closed", "items", "quotes", "links", "comments", "scripts"],
)
def test_odd_markup_costs_no_more_than_its_length(page):
    def seconds(text):
        start = time.process_time()
        for b in html_crf.blocks_of(text):
            html_crf.features(b)
        return time.process_time() - start

    part, whole = seconds(page[: len(page) // 4]), seconds(page)
    assert whole < 2 or whole < 8 * part  # 16 times, were it quadratic


def test_elements_and_their_places():
    page = "<main><div class='nav'><p>a<p>b<ul><li>c<li>d</ul></div><p>e</span><b>f</b></main>g <a href='x>y'>h</a><!-- i -->j<!-- k"
    found = [(b.text, b.linked, b.place.tag, b.place.marks) for b in html_crf.blocks_of(page)]
    assert found == [
        ("a", 0, "p", (0, 2)), ("b", 0, "p", (0, 2)), ("c", 0, "li", (0, 2)), ("d", 0, "li", (0, 2)), ("ef", 0, "p", (0, 1)), ("g hj", 1, "", (0, 0)),
    ]


def test_shingles_are_dealt_evenly(spark):
    """Every task gets its share of the blocks, whose hashes would put several buckets into one task and none into another."""
    rng = random.Random(12)
    docs = spark.createDataFrame([(i, prose(rng, 300)) for i in range(200)], "doc_id long, text string")
    for tasks in (8, 12, 51):
        blocks = ngram_join._shingle_blocks(docs, "doc_id", "text", 5, ngram_join.FINE * tasks)
        dealt = ngram_join._dealt(blocks, tasks).withColumn("task", F.spark_partition_id())
        held = dealt.filter("bucket IS NOT NULL").groupBy("task").agg(F.sum(F.length("shingles")).alias("n"), F.countDistinct("bucket").alias("buckets"))
        found = held.collect()
        assert len(found) == tasks and {r["buckets"] for r in found} == {ngram_join.FINE}
        assert max(r["n"] for r in found) <= 1.3 * sum(r["n"] for r in found) / tasks
