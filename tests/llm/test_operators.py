"""Operators against brute-force versions, and the cases every one must bear: nulls, empty and long texts, ties, copies, no rows."""

import gzip
import hashlib
import random
import re
import zlib
from collections import Counter

import pytest

from lazaret.llm import chat, decontaminate, html_crf, licenses, ngram_join, packing, quality, sharding, url_rules, warc

DOCS = "doc_id long, text string, source string, n int, ref string"


def prose(rng, n):
    return " ".join("".join(rng.choice("abdeiknorst") for _ in range(rng.randint(2, 7))) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    base = prose(rng, 120)
    near = base.split()
    near[60] = "Changed"
    long = prose(rng, 30_000)
    texts = [None, "", " \n\t", "one two three", "one two three", "ONE two\x0bthree", base, base, " ".join(near), base + " more words", long, long + " end"]
    texts += [prose(rng, rng.randint(1, 60)) for _ in range(40)]
    texts += ["x y z w v u t s " * 9, "a\n\na\nb\na", "%%% $$$ é ß İ <|endoftext|> 漢字\x00"]
    out = [(i, t, f"s{i % 3}" if i % 5 else None, i, "clash") for i, t in enumerate(texts)]
    return [*out, out[6], (None, base, "s0", 1, "clash")]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], DOCS)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def shingles(text):
    w = words("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def classes(rows):
    sets, parent = [shingles(r[1]) for r in rows], list(range(len(rows)))

    def find(x):
        return x if parent[x] == x else find(parent[x])

    for a in range(len(rows)):
        for b in range(a):
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= 80 * len(x | y):
                parent[find(a)] = find(b)
    return sets, [find(i) for i in range(len(rows))]


def test_ngram_join(docs, rows, nothing):
    sets, of = classes(rows)
    least = {c: min((rows[i][0] for i in range(len(rows)) if of[i] == c and rows[i][0] is not None), default=None) for c in of}
    found = ngram_join.near_duplicates(docs).collect()
    expected = Counter((r[0], len(s), least[c]) for r, s, c in zip(rows, sets, of, strict=True))
    assert Counter((r["id"], r["n_shingles"], r["component_id"]) for r in found) == expected
    assert ngram_join.near_duplicates(nothing).count() == 0


def test_ngram_join_chains_and_groups(spark):
    rng = random.Random(9)
    base = prose(rng, 200).split()
    rows = []
    for i in range(60):  # a chain: each text is a step from the one before
        base[(i * 3) % 200] = f"w{i}"
        rows.append((i, " ".join(base), "s", 0, ""))
    common = prose(rng, 60)
    rows += [(100 + i, common + " " + prose(rng, 40 + i), "s", 0, "") for i in range(40)]
    sets, of = classes(rows)
    least = {c: min(rows[i][0] for i in range(len(rows)) if of[i] == c) for c in of}
    found = {r["id"]: r["component_id"] for r in ngram_join.near_duplicates(spark.createDataFrame(rows, DOCS)).collect()}
    assert found == {r[0]: least[c] for r, c in zip(rows, of, strict=True)}


def test_one_of_each(docs, rows):
    sets, of = classes(rows)
    kept = ngram_join.one_of_each(docs)
    assert kept.columns == docs.columns
    got = [r["doc_id"] for r in kept.collect() if r["doc_id"] is not None]
    least = {c: min((rows[i][0] for i in range(len(rows)) if of[i] == c and rows[i][0] is not None), default=None) for c in of}
    assert sorted(got) == sorted(set(least.values()) - {None})


@pytest.mark.parametrize("least", [0, 10])
def test_archives(spark, least, folder):
    rows = [(1, "http://a/ b", "<p>x</p>", 0), (2, None, "<p>x</p>", 0), (3, "http://c", None, 0), (4, "u\nv", "", 0), (5, "http://d", "ß\n\r\n" * 9, 0), (None, "e", "<p>x</p>", 0), (1, "f", "<p>x</p>", 0)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, key int").repartition(2)
    warc.write_arc(pages, f"{folder}/arc")
    warc.convert(spark, f"{folder}/arc", f"{folder}/warc", least)
    records = [r for r in warc.read_records(spark, f"{folder}/warc").collect() if r["kind"] != "warcinfo"]
    assert sorted(str(r["key"]) for r in records) == sorted(str(r[0]) for r in rows)
    by_id = {r["record_id"]: r for r in records}
    assert len(by_id) == len(rows)
    for r in records:
        original = by_id[r["refers_to"]] if r["kind"] == "revisit" else r
        assert r["payload_digest"] == warc.digest(bytes(original["payload"])) and original["kind"] == "response"
        if r["kind"] == "revisit":
            assert original["key"] == {"<p>x</p>": 1, "": 3}[bytes(original["payload"]).decode()]
    assert sum(r["kind"] == "revisit" for r in records) == (3 + 1 if least == 0 else 0)
    if least == 0:
        assert warc.round_trip(pages).filter("payload_bytes is null or payload_digest is null").count() == 0
        assert warc.round_trip(pages.limit(0)).count() == 0


def test_archive_versions_and_lengths():
    v1 = warc.version_block(1, "a.arc", "20010203040506") + warc.arc_record(1, {"url": "http://x/a b", "ip": "1.2.3.4", "date": "20010203040506", "type": "text/html"}, b"HTTP/1.0 200 OK\r\n\r\nhi\n\n1 2")
    v2 = warc.version_block(2, "b.arc", "20010203040506") + warc.arc_record(2, {"url": "dns:x", "date": "200102030405", "type": "text/dns"}, b"x\n")
    for data in (v1 + v2, gzip.compress(v1) + gzip.compress(v2)):
        found = list(warc.read_arc(data))
        assert [f[0] for f in found] == [1, 1, 2, 2] and found[1][3].endswith(b"1 2") and found[1][2]["url"] == "http://x/a b"
    made = [warc.converted("f", *f) for f in found]
    assert [m["kind"] for m in made] == ["warcinfo", "response", "warcinfo", "resource"] and made[3]["date"] == "2001-02-03T04:05:00Z"
    data = b"".join(warc.record_bytes(m, None) + b"\r\n" for m in made)
    assert [b for _, b in warc.read_warc(gzip.compress(data))] == [m["head"] + m["payload"] for m in made]
    with pytest.raises(ValueError):
        list(warc.read_arc(v1[:-3]))


def test_decontamination(spark, docs, nothing):
    rng = random.Random(4)
    item = prose(rng, 40).split()
    changed = [w if i % 9 else "other" for i, w in enumerate(item)]
    bench = [(1, " ".join(item)), (2, None), (3, "few words"), (4, "seven short words are one whole item"), (4, "seven short words are one whole item")]
    rows = [(1, "start " + " ".join(item).upper() + " end"), (2, prose(rng, 30) + " " + ", ".join(changed)), (3, " ".join(item[:8])), (4, "say seven short words are one whole item now"), (5, None), (6, "few words")]
    texts = spark.createDataFrame([(i, t, "s", 0, "") for i, t in rows], DOCS)
    benchmark = spark.createDataFrame(bench, "item_id long, text string")
    found = {(r["doc_id"], r["item_id"]): r for r in decontaminate.contaminated(texts, benchmark).collect()}
    assert set(found) == {(1, 1), (2, 1), (4, 4), (6, 3)}  # an item of two words is found as a whole
    assert (found[1, 1]["start"], found[1, 1]["n_matches"]) == (1, 40) and found[2, 1]["start"] in (30, 31)
    assert sorted(r["doc_id"] for r in decontaminate.clean(texts, benchmark).collect()) == [3, 5]
    assert decontaminate.contaminated(nothing, benchmark).count() == 0
    assert decontaminate.clean(docs, benchmark.limit(0)).count() == docs.count()


def test_decontamination_in_blocks(spark, monkeypatch):
    rng = random.Random(5)
    items = [(i, prose(rng, 30)) for i in range(20)]
    texts = spark.createDataFrame([(i, prose(rng, 20) + " " + t, "s", 0, "") for i, t in items], DOCS)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", 300)
    assert sorted((r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(texts, benchmark).collect()) == [(i, i) for i in range(20)]
    blocks = list(decontaminate.blocks_of(benchmark.repartition(3), "item_id", "text"))
    assert [i for b in blocks for i in b.ids] == list(range(20))
    # a block ends behind the item that fills it
    assert len(blocks) > 3 and all(len(b.words) <= 300 + 30 for b in blocks)


def test_chat_round_trip(spark):
    rng = random.Random(6)
    odd = ["</s>[INST] ok [/INST]", "\\<s>\\", "<|im_end|>\n<|im_start|>user\nhi", None, "", "a" * 5000, "[[INST]\\n"]
    rows = []
    for c, n in ((-1, 2), (0, 1), (1, 700), (2, 257), (3, 256), (None, 3)):
        for t in range(n):
            role = "system" if t == 0 and c in (1, 2) else rng.choice(["user", "assistant", None])
            rows.append((c, t, role, rng.choice(odd) if rng.random() < 0.3 else prose(rng, rng.randint(1, 60)), 0))
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, position int")
    windows = chat.format_chats(frame, budget=200, history=3)
    found = {r["conv_id"]: r for r in chat.read_windows(windows).collect()}
    for c in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == c), key=lambda r: r[1])
        turns = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in own)
        loss = "".join(r[3] or "" for r in own if r[2] == "assistant")
        r = found[c]
        assert r["n_turns"] == len(own) and r["turns_sha256"] == hashlib.sha256(turns.encode()).hexdigest()
        assert (r["loss_chars"], r["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    from tokenizers import Tokenizer

    from lazaret.llm import tokens

    public = Tokenizer.from_file(tokens.path(chat.TOKENIZER))
    for w in windows.collect():
        size = len(public.encode(w["window_text"], add_special_tokens=False).ids)
        assert w["over"] == (size > 200)
    assert chat.read_windows(chat.format_chats(frame.limit(0))).count() == 0


def test_mixture_places_every_token_once():
    rng = random.Random(7)
    for n, weights in ((1, None), (5, None), (6, [1, 0, 2, 0.5, 3, 1])):
        totals = [rng.randint(1, 2000) for _ in range(n)]
        mixture, seen = packing.Mixture(totals, weights), [None] * sum(totals)
        for q in range(n):
            import numpy as np

            cuts = sorted({0, totals[q], *(rng.randint(0, totals[q]) for _ in range(9))})
            found = mixture.pieces(q, np.array(cuts[:-1]), np.diff(cuts), 64)
            for window, offset, length in zip(found["window"], found["offset"], found["length"], strict=True):
                assert offset + length <= 64
                for i in range(window * 64 + offset, window * 64 + offset + length):
                    assert seen[i] is None
                    seen[i] = q
        assert None not in seen
        if weights is None and n > 1:
            for a in range(0, len(seen) - 63, 64):
                assert all(abs(seen[a : a + 64].count(q) - 64 * totals[q] / sum(totals)) < 4 for q in range(n))


def test_packing(spark, docs, rows, nothing):
    from tokenizers import Tokenizer

    from lazaret.llm.tokens import path

    tokenizer = Tokenizer.from_file(path("word_bpe_49k.json"))
    pieces = packing.pack(docs, "word_bpe_49k.json", window=256).collect()
    expected = Counter((r[0], tuple(tokenizer.encode(r[1] or "", add_special_tokens=False).ids) + (2,)) for r in rows)
    by_sequence = {}
    for p in pieces:
        assert len(p["ids"]) == 4 * p["length"]
        by_sequence.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    for s, parts in by_sequence.items():
        ends = [0]
        for offset, length in sorted(parts):
            assert offset == ends[-1] and length > 0
            ends.append(offset + length)
        assert ends[-1] == 256 or s == max(by_sequence)
    # Repeated rows share an id: their pieces are told apart only as a whole, so count tokens per id.
    tokens = Counter()
    for p in pieces:
        tokens[p["doc_id"]] += p["length"]
    assert tokens == Counter({k: sum(len(i) * n for (d, i), n in expected.items() if d == k) for k in {d for d, _ in expected}})
    single = {d: i for (d, i), n in expected.items() if n == 1 and d != 6}
    for d, ids in single.items():
        own = sorted((p["start"], bytes(p["ids"])) for p in pieces if p["doc_id"] == d)
        assert b"".join(b for _, b in own) == b"".join(x.to_bytes(4, "little") for x in ids)
    assert packing.pack(nothing, "word_bpe_49k.json").count() == 0


def test_url_parts_and_curated_rules(spark):
    urls = [None, "", "x", "HTTP://A.Example.NET/en/x?y#z", "http://a.net", "http://a.net/", "http://notexample.com/de/", "http://example.com/de/x", "http://b.org/fr/#q", "a://b://c/d", "http://h?q=/x"]
    frame = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    rules = url_rules.mine(spark.createDataFrame([], "url string, bad boolean"))
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_rules.judge(frame, rules).collect()}
    assert [got[i] for i in range(len(urls))] == [
        ("", "", None, "allow"),
        ("", "", None, "allow"),
        ("", "", None, "allow"),
        ("a.example.net", "/en/x", "example.net/en/", "allow"),
        ("a.net", "", None, "allow"),
        ("a.net", "/", "net/", "block"),
        ("notexample.com", "/de/", None, "allow"),
        ("example.com", "/de/x", "example.com/de/", "block"),
        ("b.org", "/fr/", "org/fr/", "allow"),
        ("b:", "//c/d", None, "allow"),
        ("h", "", None, "allow"),
    ]


def test_url_rules_are_mined(spark):
    rows = [(f"http://s{i % 7}.com/{'casino' if i % 3 == 0 else 'news'}/{i}", i % 3 == 0) for i in range(90)]
    rows += [(f"http://bad.com/news/{i}", True) for i in range(20)] + [(None, True), ("http://z.com/casino/1", None)]
    rules = url_rules.mine(spark.createDataFrame(rows, "url string, bad boolean"))
    found = {tuple(r["items"]) for r in rules.collect()}
    assert ("dir0=casino",) in found and ("host=bad.com", "name=bad") in found  # a host and its name stand in the same rows
    assert all(not ({"dir0=casino"} < set(f)) for f in found)
    test = spark.createDataFrame([(1, "http://new.com/casino/5"), (2, "http://new.com/news/5"), (3, "http://www.bad.com/x")], "page_id long, url string")
    assert {r["page_id"]: r["verdict"] for r in url_rules.judge(test, rules).collect()} == {1: "block", 2: "allow", 3: "block"}


def test_licences(docs, nothing, spark):
    text = "Foo.\nreleased UNDER the mit license\nReleased under the MIT License.\nThe MIT License of it\n\nLicensed under CC BY-NC 4.0."
    frame = spark.createDataFrame([(1, text), (2, None), (3, "")], "doc_id long, text string")
    found = {r["license"]: (r["n_matches"], r["best_dice"], r["first_word"]) for r in licenses.licences(frame).collect()}
    assert found == {"MIT": (2, 1.0, 1), "CC-BY-NC-4.0": (1, 1.0, 16)}
    assert licenses.licences(docs).count() == 0 and licenses.licences(nothing).count() == 0



def test_html(spark):
    model = html_crf.train(html_crf.training_set([]))
    held = [(html_crf.blocks_of(p), labels) for p, labels in html_crf.pattern_pages(80, 77)]
    right = [a == b for blocks, labels in held for a, b in zip(model.decode([html_crf.features(b) for b in blocks]), labels, strict=True)]
    assert sum(right) / len(right) > 0.97
    page = (
        "<html><head><title>T</title><style>p{}</style></head><body><nav><ul><li><a href='/'>Home</a></ul></nav><div class=ad>Buy this now.</div>"
        "<article><h1>A head &amp; more</h1><p>First <b>bold</b>ly,\n words<br>here.<script>var a='<p>';</script><p>Second one, of\xa0some length. &lt;x&gt;</article>"
        "<footer>&copy; someone</footer>"
    )
    frame = spark.createDataFrame([(1, "u", page, 1), (2, None, None, 1), (3, "u", "", 1), (None, "u", "<p", 1)], "page_id long, url string, html string, text int")
    got = {r["page_id"]: (r["text"], r["n_chars"]) for r in html_crf.extract(frame, model).collect()}
    expected = "A head & more First boldly, words here. Second one, of some length. <x>"
    assert got[1] == (expected, len(expected)) and got[2] == ("", 0) and got[3] == ("", 0)
    assert html_crf.extract(frame.limit(0), model).count() == 0


def brute_statistics(text):
    text = text or ""
    w, seen, dup = words(text), set(), 0
    for line in text.split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(w[i : i + 8]) for i in range(len(w) - 7)]
    n, cover = Counter(windows), set()
    for i, x in enumerate(windows):
        if n[x] > 1:
            cover.update(range(i, i + 8))
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(cover)


def test_quality(spark, docs, rows, nothing):
    labels = spark.createDataFrame([(i, i % 2) for i in range(50)] + [(None, 1), (3, None)], "doc_id long, quality int")
    model = quality.fit(docs, labels)
    found = quality.judge(docs, model).collect()
    got = Counter((r["doc_id"], *(r[s] for s in quality.STATISTICS), r["base_failed"]) for r in found)
    expected = Counter()
    for r in rows:
        s = brute_statistics(r[1])
        expected[(r[0], *s, s[0] < 20 or 100 * s[4] > 30 * s[0])] += 1
    assert got == expected
    kept = quality.keep(docs, model)
    assert kept.columns == docs.columns and kept.count() == sum(r["kept"] for r in found)
    assert quality.judge(nothing, quality.fit(nothing, labels)).count() == 0


def test_quality_forest_finds_what_labels_call_bad(spark):
    rng = random.Random(8)
    texts = [(i, prose(rng, 60)) if i % 8 else (i, " ".join(w + rng.choice(["###", "$$$", "%%%"]) for w in prose(rng, 60).split())) for i in range(600)]
    frame = spark.createDataFrame(texts, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 8 != 0)) for i in range(0, 600, 2)], "doc_id long, quality int")
    judged = {r["doc_id"]: r["kept"] for r in quality.judge(frame, quality.fit(frame, labels)).collect()}
    assert sum(judged[i] for i in range(600) if i % 8 == 0) <= 3
    assert sum(not judged[i] for i in range(600) if i % 8) <= 3


@pytest.mark.parametrize("shards", [1, 3, 8])
def test_shards(spark, shards):
    rng = random.Random(shards)
    rows = [(i, prose(rng, rng.randint(0, 80)), f"s{i % 4}") for i in range(700)]
    rows += [(1000 + i, "the same text", "s1") for i in range(200)] + [(None, None, None), (5, "", "s0")]
    found = sharding.shard(spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4), shards).collect()
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in found) == Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, _ in rows)
    sizes, slots, where = Counter(), {}, {}
    for r in found:
        sizes[r["shard"]] += r["size"]
        slots.setdefault(r["shard"], []).append(r["slot"])
        where.setdefault(r["text_crc32"], set()).add(r["shard"])
    assert set(sizes) == set(range(shards)) and all(len(w) == 1 for w in where.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(sizes.values()) - min(sizes.values()) <= 0.1 * sum(sizes.values()) / shards + 600
    assert sharding.shard(spark.createDataFrame([], "doc_id long, text string"), shards).count() == 0


def test_a_group_over_a_shard_has_one_for_itself(spark):
    rng = random.Random(2)
    rows = [(i, prose(rng, 30)) for i in range(200)] + [(500 + i, "copy " * 40) for i in range(200)]
    sizes = Counter()
    for r in sharding.shard(spark.createDataFrame(rows, "doc_id long, text string"), 4).collect():
        sizes[r["shard"]] += r["size"]
    assert sorted(sizes.values())[-1] == 200 * 201 and len(sizes) >= 2
