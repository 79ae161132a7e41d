"""Windows of a token budget, counted by the public tokenizer itself."""

import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from lazaret.llm import chat, tokens
from tests.llm.test_operators import prose


@pytest.fixture(scope="module")
def size():
    public = Tokenizer.from_file(tokens.path(chat.TOKENIZER))
    return lambda text: len(public.encode(text, add_special_tokens=False).ids)


def test_no_window_is_over_by_the_tokenizer(spark, size):
    rng = random.Random(1)
    signs = "漢字仮名交文日本語中国話한국어العربيةไทย"
    rows = []
    for t in range(40):
        rows.append((1, t, ["user", "assistant"][t % 2], "".join(rng.choices(signs, k=rng.randint(1, 150)))))
        rows.append((2, t, ["user", "assistant"][t % 2], "\n" * 5000 + prose(rng, 20) + " \t" * 500))
        rows.append((3, t, "system" if not t else ["user", "assistant"][t % 2], prose(rng, rng.randint(1, 80)) + " 1234567890 !?!? 😀"))
    rows.append((3, 40, "assistant", prose(rng, 3000)))
    windows = chat.format_chats(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3), budget=400).collect()
    sizes = [(size(w["window_text"]), w["over"]) for w in windows]
    assert all(over == (n > 400) for n, over in sizes) and sum(over for _, over in sizes) == 1
    # but for the first, windows begin with turns from before
    for conv in (2, 3):
        own = sorted((w["window"], w["n_repeated"], w["over"]) for w in windows if w["conv_id"] == conv)
        assert len(own) > 3 and all(n > 0 for w, n, over in own if w and not over)


def test_given_table_by_the_tokenizer(spark, size):
    windows = chat.format_chats(spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")).collect()
    assert windows and all(w["over"] == (size(w["window_text"]) > 1024) for w in windows)


def test_windows_hold_history_and_every_turn_once():
    rng = random.Random(2)
    for _ in range(500):
        sizes = np.array([rng.randint(1, 60) for _ in range(rng.randint(1, 40))])
        context, history, budget, system = min(rng.randint(0, 4), len(sizes)), rng.randint(0, 5), 100, rng.randint(0, 60)
        spans = chat.windows_of(sizes, system, context, budget, history)
        assert [i for _, first, end in spans for i in range(first, end)] == list(range(context, len(sizes)))
        for begin, first, end in spans:
            total = system + sizes[begin:end].sum()
            assert first - history <= begin <= first and (total <= budget or (begin == first and end == first + 1))
            assert end == len(sizes) or total + sizes[end] > budget  # nothing more fits
            if begin and first - begin < history:  # one more turn from before would take over half of the room, or push the new one out
                more = sizes[begin - 1 : first].sum()
                assert more > (budget - system) // 2 or more + sizes[first] > budget - system
