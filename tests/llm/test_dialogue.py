"""Conversation repair against an exhaustive search over all edits."""

import hashlib
import random
import re
import zlib

import pytest

from lazaret.llm import dialogue

SPACES = " \t\n\x0b\f\r"


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def faults(rows):
    seen, out = set(), []
    for _, _, role, text in rows:
        said = text.strip(SPACES)
        fault = "blank" if not said else "duplicate" if (role, text) in seen else "truncated" if said[-1] not in ".!?" else ""
        seen.add((role, text))
        out.append(fault)
    return out


def cheapest(rows, marks):
    """Least (cost, audit, turns) by states: the letters so far are empty, s, end in u, end in a."""
    states = {"": (0, "", ())}

    def inserted(states):
        for _ in range(3):
            for last, (cost, audit, turns) in list(states.items()):
                role = "assistant" if last == "u" else "user"
                found = (cost + 3, audit + "I", (*turns, (role, "")))
                if role[0] not in states or found[:2] < states[role[0]][:2]:
                    states[role[0]] = found
        return states

    for (_, _, role, text), mark in zip(rows, marks, strict=True):
        then = {}

        def offer(last, found, then=then):
            if last not in then or found[:2] < then[last][:2]:
                then[last] = found

        for last, (cost, audit, turns) in inserted(states).items():
            offer(last, (cost + 4, audit + "D", turns))
            if mark in ("blank", "duplicate"):
                continue
            more = 3 if mark == "truncated" else 0
            due = "a" if last == "u" else "u"
            if role[:1] == due or (role[:1] == "s" and not last):
                offer(role[:1], (cost + more, audit + "K", (*turns, (role, text))))
            offer(due, (cost + more + 3, audit + "R", (*turns, ("assistant" if due == "a" else "user", text))))
        states = then
    return min((s for last, s in inserted(states).items() if last in ("", "a")), key=lambda s: s[:2])


def repaired(rows):
    out = set()
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in damaged(rows) if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
        marks = faults(own)
        cost, audit, turns = cheapest(own, marks)
        known = [r[1] for r in own if r[1] is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        letters = [r[2][:1] for r in own]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(letters, letters[1:], strict=False))
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in turns).encode()).hexdigest()
        out.add((conv, gaps, *(marks.count(m) for m in ("blank", "duplicate", "truncated")), illegal, cost, audit, digest))
    return out


def conversations(n, longest, seed):
    rng = random.Random(seed)
    rows = []
    for conv in range(n):
        for turn in range(rng.randint(1, longest)):
            role = rng.choice(["user", "assistant"]) if rng.random() < 0.3 else "system" if not turn and rng.random() < 0.5 else ["user", "assistant"][turn % 2]
            if rng.random() < 0.1:
                role = rng.choice([None, "", "tool", "system", "usr"])
            text = rng.choice([f"Some words {turn}.", f"some {turn}", "Yes!", "", None, " \n\t", f"Why {turn}?\n", "no\x0b"])
            rows.append((conv, turn if rng.random() < 0.95 else rng.choice([None, 7, 2**40]), role, text))
    return rows


SCHEMA = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("segment", [3, 512])
def test_least_cost_and_audit(spark, segment):
    rows = conversations(120, 12, segment)
    rows += [(None, t, "user", "Hello.") for t in range(4)] + [(500, None, None, None)] * 3 + [(501, 3, "system", "x." * 50_000)]
    df = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], SCHEMA + ", audit int").repartition(3)
    got = [tuple(r) for r in dialogue.repair(dialogue.damaged(df), df, segment_rows=segment).collect()]
    assert set(got) == repaired(rows) and len(got) == len({r[0] for r in rows})


def plain(roles, marks):
    names = {"s": "system", "u": "user", "a": "assistant", "-": ""}
    return cheapest([(0, 0, names[r], "t") for r in roles], marks)[:2]


def symbols(roles, marks):
    order = ["", "truncated", "blank", "duplicate"]
    return bytes("sua-".index(r) + 4 * order.index(m) for r, m in zip(roles, marks, strict=True))


def test_any_segments_give_the_same():
    rng = random.Random(2)
    for _ in range(1500):
        n = rng.randint(1, 14)
        roles = [rng.choice("uuuaaas-") for _ in range(n)]
        marks = [rng.choice(["", "", "", "truncated", "blank", "duplicate"]) for _ in range(n)]
        expected, code = plain(roles, marks), symbols(roles, marks)
        cost, audit = dialogue.joined([dialogue.alignments(code, True)])
        assert (cost, "".join(audit)) == expected, (roles, marks)
        size = rng.randint(1, n)
        cost, audit = dialogue.joined([dialogue.alignments(code[i : i + size], False) for i in range(0, n, size)])
        assert (cost, "".join(audit)) == expected, (roles, marks, size)


def test_a_long_conversation():
    rng = random.Random(3)
    roles = [rng.choice("ua") if rng.random() < 0.4 else "ua"[i % 2] for i in range(6000)]
    marks = [rng.choice(["truncated", "blank", "duplicate"]) if rng.random() < 0.2 else "" for _ in roles]
    code = symbols(roles, marks)
    cost, audit = dialogue.joined([dialogue.alignments(code[i : i + 512], False) for i in range(0, 6000, 512)])
    expected, text = plain(roles, marks)
    assert cost == expected and "".join(audit) == text


def test_no_rows(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert dialogue.repair(dialogue.damaged(none)).collect() == []
    lost = next(t for t in range(1000) if zlib.crc32(f"1:{t}".encode()) % 20 == 0)
    only = spark.createDataFrame([(1, lost, "user", "Gone.")], SCHEMA)
    assert dialogue.repair(dialogue.damaged(only)).collect() == []
    assert [tuple(r) for r in dialogue.repair(dialogue.damaged(only), only).collect()] == [(1, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
