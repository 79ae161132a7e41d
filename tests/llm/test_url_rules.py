"""Mined URL rules against all combinations of tokens, and labelled rows that repeat."""

import itertools
import random

from lazaret.llm import url_rules


def brute(rows, min_rows, min_confidence, min_share=0.002):
    """Rules from (tokens, bad): all unions of tokens that stand in the same rows, without those that a part of them does as well as."""
    n = len(rows)
    support = max(min_rows, min_share * n) * min_confidence
    where = {}
    for i, (tokens, _) in enumerate(rows):
        for t in tokens:
            where.setdefault(t, set()).add(i)
    classes = {}
    for t, places in where.items():
        if len(places) >= support:
            classes.setdefault(frozenset(places), []).append(t)
    items = [(places, tuple(sorted(members))) for places, members in classes.items()]
    rules = {}
    for size in range(1, len(items) + 1):
        some = False
        for chosen in itertools.combinations(items, size):
            places = frozenset.intersection(*(p for p, _ in chosen))
            bad = sum(rows[i][1] for i in places)
            if bad >= support:
                some = True
                confidence = bad / len(places)
                if confidence >= min_confidence and len(places) >= max(min_rows, min_share * n):
                    rules[frozenset(t for _, m in chosen for t in m)] = (confidence, len(places))
        if not some:
            break
    return {k: v for k, v in rules.items() if not any(p < k and rules[p][0] >= v[0] for p in rules)}


def test_same_rules_as_from_all_combinations(spark):
    rng = random.Random(3)
    urls = [
        (f"http{rng.choice(['', 's'])}://{rng.choice(['m.', 'www.', ''])}{rng.choice(['win', 'news', 'shop'])}.{rng.choice(['com', 'net'])}/"
         f"{rng.choice(['en', 'de'])}/{rng.choice(['x', 'y'])}{rng.choice(['', '/', '?a=1'])}") for _ in range(150)
    ]
    rows = [(u, ("win" in u and "net" in u) or rng.random() < 0.1) for u in urls]
    df = spark.createDataFrame(rows, "url string, bad boolean")
    tokens = [sorted(r[0]) for r in df.select(url_rules.tokens(df["url"])).collect()]
    found = {frozenset(r["items"]): (r["confidence"], r["n_rows"]) for r in url_rules.mine(df, min_rows=5).collect()}
    expected = brute([(t, b) for t, (_, b) in zip(tokens, rows, strict=True)], 5, 0.8)
    assert found == expected and found


def test_rows_that_repeat_do_not_multiply(spark):
    long = "http://bad.example.com/" + "/".join(f"p{chr(97 + i)}" for i in range(26)) + "?" + "&".join(f"q{i}=1" for i in range(10))
    rows = [(long, True)] * 12 + [(f"http://good{i}.example.com/x", False) for i in range(30)]
    rules = url_rules.mine(spark.createDataFrame(rows, "url string, bad boolean")).collect()
    assert len(rules) == 1 and len(rules[0]["items"]) > 30 and rules[0]["n_rows"] == 12  # beyond three tokens, and one rule
    pages = spark.createDataFrame([(1, long), (2, long + "#x"), (3, "http://good1.example.com/x"), (3, long)], "page_id long, url string")
    got = url_rules.judge(pages, url_rules.mine(spark.createDataFrame(rows, "url string, bad boolean"))).collect()
    assert sorted((r["page_id"], r["verdict"]) for r in got) == [(1, "block"), (2, "block"), (3, "allow"), (3, "block")]
