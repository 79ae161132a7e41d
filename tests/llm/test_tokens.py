"""Ids by parts of words against the tokenizer itself."""

import random

import pyarrow as pa
import pytest

from lazaret.llm import tokens
from tests.llm.test_operators import prose

ODD = [
    "don't we'll 'twas rock'n'roll ''s 's x's'S", "¿Qué? «¡olé!» 1º 2ª ½ x² ©2020", "ÀÉÎÕÜ ßẞ İstanbul ıI ŉ ǅ ǆ Ș ȴ ȿ Ⱥ", "a×b a÷b µm Åström",
    "<|startoftext|> <|STARTOFTEXT|> a|b ||", "12345 3.14 v2.0-beta x1y2z3", "%%%abc### th$$$ a_b__c", "é ́x a b a b \x1cx\x1f \x85  ",
    "漢字かな 한국어 العربية ไทย", "\U0001f600\U0001f468‍\U0001f469 x️", "\x00\x01 \x7f", "", " \t\n\x0b\x0c\r", "A" * 5000, "ﬁ ẞ K Å",
]


@pytest.fixture(scope="module")
def encoder():
    return tokens.Encoder(tokens.path("word_bpe_49k.json"))


def by_parts(encoder, texts):
    out = []
    for _, ids, counts in encoder(pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], names=["text"]), "text", 2):
        at = 0
        for n in counts.tolist():
            out.append(ids[at : at + n].tolist())
            at += n
    return out


def test_same_ids_as_the_tokenizer(encoder, monkeypatch):
    rng = random.Random(1)
    letters = "abcXYZ éÉßñÑÿĀā'’.,!?-|1290\n\t ¿»×"
    texts = [*ODD, *(prose(rng, 30) for _ in range(20)), *("".join(rng.choices(letters, k=rng.randint(1, 60))) for _ in range(3000))]
    expected = [[*encoder.tokenizer.encode(t, add_special_tokens=False).ids, 2] for t in texts]
    assert encoder.by_word
    assert by_parts(encoder, texts) == expected
    monkeypatch.setattr(tokens, "KNOWN_WORDS", 50)  # forgets all the time
    assert by_parts(encoder, texts[:200]) == expected[:200]


def test_nulls_and_slices(encoder, monkeypatch):
    monkeypatch.setattr("lazaret.llm.text.SLICE_BYTES", 16)
    texts = [None, "one two", "", "three four five", None, "x" * 100]
    assert by_parts(encoder, texts) == [[*encoder.tokenizer.encode(t or "", add_special_tokens=False).ids, 2] for t in texts]
    assert by_parts(encoder, []) == []
