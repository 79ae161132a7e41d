"""Licence scan against brute force over all windows, and notices wherever they stand."""

import random
import re

import pytest

from lazaret.llm import licenses
from tests.llm.test_operators import prose


def words(text):
    return re.findall(r"[0-9a-z\x80-\U0010ffff]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(text, templates, threshold=0.8):
    own, found = words(text), []
    pairs = list(zip(own, own[1:], strict=False))
    for name, template in templates.items():
        t = words(template)
        b = set(zip(t, t[1:], strict=False))
        length = min(len(t) - 1, len(pairs))
        for start in range(len(pairs) - length + 1) if length > 0 else []:
            a = set(pairs[start : start + length])
            dice = 2 * len(a & b) / (len(a) + len(b))
            if dice >= threshold:
                found.append((-dice, -len(b), name, start, length))
    taken, out = set(), []
    for less, _, name, start, length in sorted(found):
        place = set(range(start, start + length + 1))
        if not place & taken:
            taken |= place
            out.append((start, length + 1, name, -less))
    return sorted(out)


SHORT = {k: v for k, v in licenses.TEMPLATES.items() if len(v) < 400}


def varied(rng, text, n):
    own = text.split()
    for _ in range(n):
        k = rng.randrange(len(own))
        own[k : k + 1] = rng.choice([[], ["other"], [own[k], "more"], [own[k], own[k]]])
    return " ".join(own)


def test_same_as_all_windows(spark):
    rng = random.Random(1)
    texts = [None, "", "License", "MIT License", "Released under the MIT License. " * 4]
    for i in range(150):
        parts = [prose(rng, rng.randint(0, 15)) for _ in range(rng.randint(1, 3))]
        for name in rng.choices(sorted(SHORT), k=rng.randint(1, 3)):
            parts.insert(rng.randrange(len(parts) + 1), varied(rng, SHORT[name], rng.randint(0, 4)))
        texts.append(rng.choice([" ", "\n", ", "]).join(parts))
    rows = [(i, t, "x", 0.5) for i, t in enumerate(texts)] + [(5, texts[5], "y", 0.1), (None, texts[6], "z", 0.2)]
    found = licenses.scan(spark.createDataFrame(rows, "doc_id long, text string, license string, dice double").repartition(3), SHORT).collect()
    got = sorted(((r["doc_id"] is None, r["doc_id"] or 0, r["word"], r["n_words"], r["template"], r["dice"]) for r in found), key=repr)
    assert got == sorted(((i is None, i or 0, *m) for i, t, *_ in rows for m in brute(t, SHORT)), key=repr)
    assert len(got) > 150


@pytest.mark.parametrize("name", sorted(licenses.TEMPLATES))
def test_every_template_is_found_as_itself(name):
    text = licenses.TEMPLATES[name]
    (match,) = licenses.Templates(licenses.TEMPLATES).matches(licenses.texts_of(licenses.pa.array([text])), 0.8)
    assert licenses.Templates(licenses.TEMPLATES).names[match[3]] == name and match[4] == 1


def kinds(spark, *texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = {i: set() for i in range(len(texts))}
    for r in licenses.licences(df).collect():
        out[r["doc_id"]].add(r["license"])
    return [out[i] for i in range(len(texts))]


def test_wrapped_embedded_and_full_texts(spark):
    rng = random.Random(2)
    full = licenses.TEMPLATES["MIT 2"]
    commented = "\n".join(f" * {line.strip()}" for line in re.findall(r".{1,60}(?:\s|$)", re.sub(r"\s+", " ", full)))
    header = licenses.TEMPLATES["Apache-2.0 2"]
    assert kinds(
        spark,
        "Copyright (c) 2020 X\n\n" + full,
        f"/*\n{commented}\n */\n{prose(rng, 300)}",
        f"{prose(rng, 2000)} Copyright 2020 X. Licensed under CC BY 4.0. All rights {prose(rng, 2000)}",
        "Released under\nthe MIT\nLicense.",
        "\n".join("# " + line for line in re.findall(r".{1,50}(?:\s|$)", re.sub(r"\s+", " ", header))),
        "This program is free software; you can redistribute it and/or modify\nit under the terms of the GNU General Public License as published by\n"
        "the Free Software Foundation; either version 2 of the License, or\n(at your option) any later version. This program is distributed in the hope that it\n"
        "will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or\nFITNESS FOR A PARTICULAR PURPOSE. See the\n"
        "GNU General Public License for more details.",
        prose(rng, 500) + " the license of the software is free of charge",
        "x " * 200_000 + "Released under the MIT License.",
    ) == [{"MIT"}, {"MIT"}, {"CC-BY-4.0"}, {"MIT"}, {"Apache-2.0"}, {"GPL-2.0"}, set(), {"MIT"}]


def test_no_rows_and_no_templates(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert licenses.licences(none).collect() == []
    one = spark.createDataFrame([(1, "Released under the MIT License.")], "doc_id long, text string")
    assert licenses.scan(one, {}).collect() == []
