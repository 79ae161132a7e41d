"""Chat formatting in windows of a token budget.

A conversation's rows, in the order of turn, role and text, become windows of whole turns. Prefix sums of the
turns' tokens tell how many new turns fit into a window beside the system turn, which every window repeats, and up to
``history`` turns from before, which have up to half of the room before new turns are added. Only what an assistant says for the first
time is a target: repeated turns are masked. A turn that is over the budget by itself has a window of its own, marked ``over``, and is not cut.

Tokens are those of a public tokenizer file (``tokenizer``) for the formatted turns. A turn ends in a line feed, which no token of such a
tokenizer spans, so a window has the sum of its turns' tokens.

A formatted turn is ``<|im_start|>role\\ntext<|im_end|>\\n``. Control strings inside texts are escaped: a backslash is doubled, and one is put
behind the first character of each control string; ``unescaped`` takes both back. Roles are percent-encoded.

Conversations of any length: rows are put in order by ranges of (conversation, turn), numbered, and cut into segments of
``SEGMENT`` turns that are formatted apart; the turns before a segment go with it as history. A null text or role is empty,
a null conversation id is one conversation, null turns come first, repeated rows are turns of their own.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from urllib.parse import quote, unquote

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lazaret.llm.tables import numbered
from lazaret.llm.tokens import encoder

START, END = "<|im_start|>", "<|im_end|>"
# Strings that chat templates in use treat as control.
CONTROL = (START, END, "<|endoftext|>", "<|startoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
SEGMENT = 256

_CONTROL = re.compile("|".join(map(re.escape, sorted(CONTROL, key=len, reverse=True))))
_MARKS = re.compile(r"[\\<\[]")
_ESCAPE = re.compile(r"\\(.)", re.DOTALL)
_TURN = re.compile(re.escape(START) + r"([^\n]*)\n(.*?)" + re.escape(END) + "\n", re.DOTALL)


def escaped(text: str) -> str:
    if not _MARKS.search(text):
        return text
    return _CONTROL.sub(lambda m: m[0][0] + "\\" + m[0][1:], text.replace("\\", "\\\\"))


def unescaped(text: str) -> str:
    return _ESCAPE.sub(r"\1", text) if "\\" in text else text


def formatted(role: str, text: str) -> str:
    return f"{START}{quote(role, safe='')}\n{escaped(text)}{END}\n"


def turns_of(window: str) -> Iterator[tuple[str, str, int, int]]:
    """Role, text, and where the escaped text begins and ends, of each turn of a formatted window."""
    for m in _TURN.finditer(window):
        yield unquote(m[1]), unescaped(m[2]), m.start(2), m.end(2)


TOKENIZER = "word_bpe_49k.json"


def count_tokens(texts: list[str], tokenizer: str = TOKENIZER) -> np.ndarray:
    """Tokens of formatted turns."""
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], names=["text"])
    counts = [n - 1 for _, _, n in encoder(tokenizer)(batch, "text", 0)]
    return np.concatenate(counts) if counts else np.zeros(0, np.int64)


def windows_of(sizes: np.ndarray, system: int, context: int, budget: int, history: int) -> list[tuple[int, int, int]]:
    """(first turn of the history, first new turn, end) of each window of a list of turns.

    ``system`` is the size of the system turn that each window repeats; the first ``context`` turns are only history.
    """
    sums = np.concatenate([[0], np.cumsum(sizes)])
    out, first, room = [], context, budget - system
    while first < len(sizes):
        # Whole turns of the history in half of the room, fewer if the first new turn needs more.
        begin = max(first - history, int(np.searchsorted(sums[: first + 1], sums[first] - max(room, 0) // 2, side="left")), 0)
        while begin < first and sums[first + 1] - sums[begin] > room:
            begin += 1
        end = max(int(np.searchsorted(sums, sums[begin] + room, side="right")) - 1, first + 1)
        out.append((begin, first, end))
        first = end
    return out


_SCHEMA = """conv_id long, segment long, window int, window_text string, n_repeated int, over boolean,
loss array<struct<begin: int, end: int>>"""


def format_chats(
    conversations: DataFrame,
    budget: int = 1024,
    history: int = 4,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    tokenizer: str = TOKENIZER,
) -> DataFrame:
    """A row per window: conv_id, segment, window, window_text, n_repeated turns at its start, over, loss spans in characters."""
    rows = conversations.select(
        F.col(conv_col).cast("long").alias("conv_id"),
        F.col(turn_col).alias("turn"),
        F.coalesce(role_col, F.lit("")).alias("role"),
        F.coalesce(text_col, F.lit("")).alias("text"),
    )
    order = ["conv_id", "turn", "role", "text"]
    placed = numbered(rows.repartitionByRange(*order).sortWithinPartitions(*order), "conv_id", None, "turns")
    placed = placed.select("conv_id", F.col("before").alias("position"), "role", "text")
    segment = F.floor(F.col("position") / SEGMENT)
    # The last turns of a segment are history of the next one; one that does not come to be has no turns of its own.
    late = (F.col("position") % SEGMENT) >= SEGMENT - history
    dealt = placed.withColumn("segment", F.explode(F.when(late, F.array(segment, segment + 1)).otherwise(F.array(segment))))
    dealt = dealt.withColumn("is_system", F.lit(False))
    first = placed.filter("position = 0 and role = 'system'").select("conv_id", "role", "text")
    ahead = placed.filter((F.col("position") % SEGMENT == 0) & (F.col("position") > 0)).select("conv_id", F.floor(F.col("position") / SEGMENT).alias("segment"))
    repeated = (
        ahead.alias("a")
        .join(first.alias("f"), F.col("a.conv_id").eqNullSafe(F.col("f.conv_id")))
        .select("a.conv_id", F.lit(0).cast("long").alias("position"), "f.role", "f.text", "a.segment", F.lit(True).alias("is_system"))
    )
    order = ["conv_id", "segment", F.col("is_system").desc(), "position"]
    rows = dealt.unionByName(repeated).repartition("conv_id", "segment").sortWithinPartitions(*order)

    def run(batches):
        key, held = None, []
        for batch in batches:
            out: list[tuple] = []
            columns = [batch.column(c).to_pylist() for c in ("conv_id", "segment", "position", "role", "text")]
            turns = [formatted(r, t) for r, t in zip(columns[3], columns[4], strict=True)]
            sizes = count_tokens(turns, tokenizer).tolist()
            for conv, segment, position, role, turn, size in zip(*columns[:4], turns, sizes, strict=True):
                if (conv, segment) != key:
                    out += _windows(key, held, budget, history)
                    key, held = (conv, segment), []
                held.append((position, role, turn, size))
            yield _batch(out)
        yield _batch(_windows(key, held, budget, history))

    return rows.select("conv_id", "segment", "position", "role", "text").mapInArrow(run, _SCHEMA)


_LOSS = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))
_KINDS = (pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.int32(), pa.bool_(), _LOSS)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(_KINDS)
    names = ["conv_id", "segment", "window", "window_text", "n_repeated", "over", "loss"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, _KINDS, strict=True)], names=names)


def _windows(key: tuple | None, rows: list[tuple[int, str, str, int]], budget: int, history: int) -> list[tuple]:
    """The windows of a segment from its rows (position, role, formatted turn, tokens), the repeated system turn first."""
    if not rows:
        return []
    conv, segment = key
    positions, roles, turns, sizes = (list(x) for x in zip(*rows, strict=True))
    # The system turn stands at the head of every window; in the first segment it is also a turn of its own there.
    body = 1 if roles[0] == "system" and positions[0] == 0 else 0
    head, system = "".join(turns[:body]), sum(sizes[:body])
    context = sum(p < segment * SEGMENT for p in positions[body:])
    if context == len(turns) - body and not (segment == 0 and body):
        return []
    out = []
    for w, (begin, first, end) in enumerate(windows_of(np.array(sizes[body:], np.int64), system, context, budget, history) or [(0, 0, 0)]):
        parts, loss, at = [head], [], len(head)
        for i in range(begin, end):
            turn = turns[body + i]
            if i >= first and roles[body + i] == "assistant":
                loss.append({"begin": at + turn.index("\n") + 1, "end": at + len(turn) - len(END) - 1})
            parts.append(turn)
            at += len(turn)
        system_again = body if w or segment else 0
        over = system + sum(sizes[body + begin : body + end]) > budget
        out.append((conv, segment, w, "".join(parts), system_again + first - begin, over, loss))
    return out


def read_windows(windows: DataFrame) -> DataFrame:
    """Per conversation what its windows hold, read back from their text: turns in order and what is under the loss mask.

    conv_id, n_turns, turns_sha256 (of role, line feed, text, line feed of each turn), loss_chars, loss_sha256 and
    formatted_chars. Windows stream in order through a task; it holds one window and two digests, however long a conversation is.
    """
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def read(batches):
        key, state = None, None

        def row():
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([key], pa.int64()),
                    pa.array([state[0]], pa.int64()),
                    pa.array([state[1].hexdigest()]),
                    pa.array([state[2]], pa.int64()),
                    pa.array([state[3].hexdigest()]),
                    pa.array([state[4]], pa.int64()),
                ],
                names=names,
            )

        for batch in batches:
            for r in batch.to_pylist():
                if state is None or r["conv_id"] != key:
                    if state is not None:
                        yield row()
                    key, state = r["conv_id"], [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                text = r["window_text"]
                state[4] += len(text)
                for i, (role, said, _, _) in enumerate(turns_of(text)):
                    if i >= r["n_repeated"]:
                        state[0] += 1
                        state[1].update(f"{role}\n{said}\n".encode())
                for span in r["loss"]:
                    target = unescaped(text[span["begin"] : span["end"]])
                    state[2] += len(target)
                    state[3].update(target.encode())
        if state is not None:
            yield row()

    ordered = windows.repartition("conv_id").sortWithinPartitions("conv_id", "segment", "window")
    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return ordered.select("conv_id", "window_text", "n_repeated", "loss").mapInArrow(read, schema)
