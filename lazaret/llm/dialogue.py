"""Repair of conversations: the cheapest edits that make the turns alternate, by alignment with the strings of the grammar.

A repaired conversation is empty or reads ``s?(ua)+`` in the first letters of its roles: system, user, assistant. Rows are in the order
of turn (nulls first), role and text. A row's first fault counts: blank (nothing but ASCII white space), duplicate (role and text stood
in an earlier row), truncated (the last character is not one of ``.!?``). Keep costs 0, Rerole (to user or assistant) 3, Delete 4, Insert (an empty
user or assistant turn) 3; blank and duplicate rows must go, and each truncated row that stays costs 3 more.

Wagner-Fischer: a table of costs aligns the rows from each one on with the last j letters of the alternating string, so one table
covers all feasible lengths. Ukkonen's band: only cells whose lower bound stays within an incumbent, the cost of a plain reading from left to
right, are filled. From each length of least cost the edits are traced, at each step the ASCII-least one that is optimal, and the
traces (their initials are the audit) are compared.

Conversations of any length: rows are put in order by ranges, numbered, and cut into segments of ``segment_rows``. A segment is aligned for each way
in and out (nothing yet, after system, after user, after assistant), and the segments of a conversation are then put together
by the same costs and ties, of which each segment gives a few audits and not its texts. Turns seen earlier are found by a minimum per digest. The
digest of a repaired conversation, as SHA-256 is sequential, streams through one task, which holds one segment's edits.

Nulls: roles and texts are one space, null conversation ids are one conversation, null turns come first and are left out of gaps (which stay at the
largest long if they pass it). A role without s, u or a in front has to be reroled or deleted. Repeated rows are duplicates. Extra columns are not read.
"""

from __future__ import annotations

import functools
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lazaret.llm.tables import cut, numbered

SEGMENT = 512
SPACE = " \t\n\x0b\f\r"
DELETE, INSERT, REROLE, BROKEN = 4, 3, 3, 3
_FAR = np.int64(1) << 40
#: Faults of a row, in the order they are looked for.
FINE, TRUNCATED, BLANK, DUPLICATE = range(4)
LETTERS = "sua-"


def damaged(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, turn, role, text) with faults by crc32 of ``conv_id:turn`` modulo 20: 0 drops a row, 1 empties its text, 2 takes
    ``.!?`` out of it, 3 repeats the row, 4 makes it a user's."""

    def written(name):
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    kind = F.pmod(F.crc32(F.concat(written(conv_col), F.lit(":"), written(turn_col)).cast("binary")), F.lit(20))
    text = written(text_col)
    rows = conversations.select(
        F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"), written(role_col).alias("role"), text.alias("text"), kind.alias("_kind")
    ).filter("_kind != 0")
    return rows.select(
        "conv_id",
        "turn",
        F.when(F.col("_kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("_kind") == 1, "").when(F.col("_kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(F.col("_kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("_copy"),
    ).drop("_copy")


class Alignment:
    """Rows aligned with alternating strings that end in ``last``; ``costs[i][j - low[i]]`` for rows from i on and the last j letters."""

    def __init__(self, roles: np.ndarray, faults: np.ndarray, last: int, incumbent: int):
        n = len(roles)
        self.roles, self.last = roles, last
        self.must = faults >= BLANK
        self.broken = np.where(faults == TRUNCATED, BROKEN, 0)
        left = np.concatenate([np.cumsum((~self.must)[::-1])[::-1], [0]])
        cheap = np.concatenate([np.cumsum((faults == TRUNCATED)[::-1])[::-1], [0]])
        spare = max(incumbent - DELETE * int(self.must.sum()) - int(self.broken.sum()), 0)
        # A deleted row costs 4 instead of 0, or of 3 if it is truncated.
        fewer = np.where(cheap >= spare, spare, cheap + (spare - cheap) // DELETE)
        self.low = np.maximum(left - fewer, 0)
        self.high = left + spare // INSERT + 1
        letters = np.where(np.arange(int(self.high.max()) + 2) % 2 == 1, last, 3 - last)
        self.costs: list[np.ndarray] = [np.zeros(0, np.int64)] * (n + 1)
        self.costs[n] = INSERT * np.arange(self.low[n], self.high[n] + 1, dtype=np.int64)
        for i in range(n - 1, -1, -1):
            j = np.arange(self.low[i], self.high[i] + 1)
            best = self._at(i + 1, j) + DELETE
            if not self.must[i]:
                step = np.where(letters[j] == roles[i], 0, REROLE) + self.broken[i]
                best = np.minimum(best, np.where(j > 0, self._at(i + 1, j - 1) + step, _FAR))
            self.costs[i] = np.minimum.accumulate(best - INSERT * j) + INSERT * j

    def _at(self, i: int, j: np.ndarray) -> np.ndarray:
        place = j - self.low[i]
        inside = (place >= 0) & (place < len(self.costs[i]))
        return np.where(inside, self.costs[i][np.where(inside, place, 0)], _FAR)

    def cost(self, i: int, j: int) -> int:
        place = j - int(self.low[i])
        return int(self.costs[i][place]) if 0 <= place < len(self.costs[i]) else int(_FAR)

    def best(self, i: int, parity: int, least: int) -> tuple[int, list[int]]:
        """Least cost of rows from i on over lengths of this parity, ``least`` or more, and the lengths that have it."""
        j = np.arange(self.low[i], self.high[i] + 1)
        own = np.where((j % 2 == parity) & (j >= least), self.costs[i], _FAR)
        low = int(own.min())
        return low, j[own == low].tolist() if low < _FAR else []

    def trace(self, i: int, j: int) -> str:
        """The ASCII-least audit of least cost from row i and j letters on."""
        out, n = [], len(self.roles)
        while i < n or j:
            now = self.cost(i, j)
            if i < n and now == DELETE + self.cost(i + 1, j):
                out.append("D")
                i += 1
            elif j and now == INSERT + self.cost(i, j - 1):
                out.append("I")
                j -= 1
            else:
                out.append("K" if self.roles[i] == (self.last if j % 2 else 3 - self.last) else "R")
                i, j = i + 1, j - 1
        return "".join(out)

    def least(self, i: int, parity: int, shortest: int) -> tuple[int, str] | None:
        cost, lengths = self.best(i, parity, shortest)
        return (cost, min(self.trace(i, j) for j in lengths)) if lengths else None


def incumbent(roles: np.ndarray, faults: np.ndarray) -> int:
    """The cost of a reading from left to right, with one more turn at each end: so much suffices for either first and last letter."""
    cost, last = 2 * INSERT, 0
    for role, fault in zip(roles.tolist(), faults.tolist(), strict=True):
        if fault >= BLANK:
            cost += DELETE
            continue
        cost += BROKEN if fault == TRUNCATED else 0
        if role not in (1, 2):
            cost, role = cost + REROLE, 3 - last if last else 1
        elif role == last:
            cost += INSERT
        last = role
    return cost if last else cost + INSERT


@functools.lru_cache(maxsize=50_000)
def alignments(symbols: bytes, whole: bool) -> dict[str, tuple[int, str]]:
    """The least (cost, audit) for each way in and out: ``0`` nothing yet, ``s``, ``u``, ``a`` the last turn's letter.

    A symbol is the place of a role's letter in LETTERS plus 4 times the fault. ``whole``: only what a whole conversation needs.
    """
    codes = np.frombuffer(symbols, np.uint8).astype(np.int64)
    roles, faults = codes % 4, codes // 4
    n, most = len(roles), incumbent(roles, faults)
    gone = (DELETE * n, "D" * n)
    out: dict[str, tuple[int, str]] = {"00": gone}

    def offer(way: str, found: tuple[int, str] | None) -> None:
        if found is not None and (way not in out or found < out[way]):
            out[way] = found

    tables = {2: Alignment(roles, faults, 2, most)}
    if not whole:
        tables[1] = Alignment(roles, faults, 1, most)
        for state in "sua":
            offer(state * 2, gone)
    for last, table in tables.items():
        end = LETTERS[last]
        # From the end: an odd number of letters begins with the last one, an even number with the other.
        from_user = table.least(0, 1 if last == 1 else 0, 1)
        offer("0" + end, from_user)
        if not whole:
            offer("s" + end, from_user)
            offer("a" + end, from_user)
            offer("u" + end, table.least(0, 0 if last == 1 else 1, 1))
        for i in np.flatnonzero((roles == 0) & ~table.must).tolist():
            # A system turn that stays, all before it deleted.
            ahead = DELETE * i + int(table.broken[i])
            if ahead + table.best(i + 1, 1 if last == 1 else 0, 1)[0] <= out.get("0" + end, (int(_FAR),))[0]:
                rest = table.least(i + 1, 1 if last == 1 else 0, 1)
                if rest:
                    offer("0" + end, (ahead + rest[0], "D" * i + "K" + rest[1]))
    if not whole:
        for i in np.flatnonzero((roles == 0) & (faults < BLANK)).tolist():
            cost = DELETE * (n - 1) + (BROKEN if faults[i] == TRUNCATED else 0)
            offer("0s", (cost, "D" * i + "K" + "D" * (n - 1 - i)))
    return out


def joined(segments: list[dict[str, tuple[int, str]]]) -> tuple[int, list[str]]:
    """The least cost and the audit, by segment, of a conversation whose segments have these alignments."""
    at: dict[str, tuple[int, list[str]]] = {"0": (0, [])}
    for ways in segments:
        then: dict[str, tuple[int, list[str]]] = {}
        for way, (cost, audit) in ways.items():
            if way[0] not in at:
                continue
            before, parts = at[way[0]]
            found = (before + cost, [*parts, audit])
            held = then.get(way[1])
            if held is None or found[0] < held[0] or (found[0] == held[0] and "".join(found[1]) < "".join(held[1])):
                then[way[1]] = found
        at = then
    ends = [at[s] for s in "0a" if s in at]
    return min(ends, key=lambda e: (e[0], "".join(e[1])))


_LEGAL = {(0, 1), (1, 2), (2, 1)}

_SEGMENT_COLUMNS = "segment long, blank long, duplicate long, truncated long, illegal long, first int, last int, ways array<struct<way: string, cost: long, audit: string>>"


def _aligned(batches, segment_rows):
    for batch in batches:
        rows = []
        for segment, symbols in zip(batch.column("segment").to_pylist(), batch.column("symbols").to_pylist(), strict=True):
            roles, faults = [s % 4 for s in symbols], [s // 4 for s in symbols]
            ways = alignments(bytes(symbols), segment == 0 and len(symbols) < segment_rows)
            rows.append(
                {
                    "segment": segment,
                    "blank": faults.count(BLANK),
                    "duplicate": faults.count(DUPLICATE),
                    "truncated": faults.count(TRUNCATED),
                    "illegal": sum(p not in _LEGAL for p in zip(roles, roles[1:], strict=False)),
                    "first": roles[0],
                    "last": roles[-1],
                    "ways": [{"way": w, "cost": c, "audit": a} for w, (c, a) in ways.items()],
                }
            )
        kind = pa.struct([("way", pa.string()), ("cost", pa.int64()), ("audit", pa.string())])
        names = ["segment", "blank", "duplicate", "truncated", "illegal", "first", "last", "ways"]
        kinds = [pa.int64()] * 5 + [pa.int32()] * 2 + [pa.list_(kind)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("conv_id"), *(pa.array([r[n] for r in rows], k) for n, k in zip(names, kinds, strict=True))], names=["conv_id", *names]
        )


def _put_together(batches):
    names = ["blank", "duplicate", "truncated", "illegal"]
    for batch in batches:
        rows, pieces = [], []
        for parts in batch.column("parts").to_pylist():
            cost, audits = joined([{w["way"]: (w["cost"], w["audit"]) for w in p["ways"]} for p in parts])
            between = sum((a["last"], b["first"]) not in _LEGAL for a, b in zip(parts, parts[1:], strict=False))
            totals = [sum(p[n] for p in parts) for n in names]
            totals[3] += between
            rows.append((*totals, cost, "".join(audits)))
            pieces.append(audits)
        columns = list(zip(*rows, strict=True)) if rows else [()] * 6
        arrays = [*(pa.array(c, pa.int64()) for c in columns[:5]), pa.array(columns[5], pa.string()), pa.array(pieces, pa.list_(pa.string()))]
        yield pa.RecordBatch.from_arrays([batch.column("conv_id"), *arrays], names=["conv_id", *names, "cost", "audit", "pieces"])


def _digests(batches):
    """One digest per conversation from its rows in order, each segment's edits (kind 0) before its turns."""
    key = state = None

    def out():
        state.insertions()
        return pa.RecordBatch.from_arrays([keys, pa.array([state.digest.hexdigest()])], names=["conv_id", "repaired_sha256"])

    for batch in batches:
        ids, kinds, roles, texts = (batch.column(c) for c in ("conv_id", "kind", "role", "text"))
        for i, (conv, kind, role, text) in enumerate(zip(ids.to_pylist(), kinds.to_pylist(), roles.to_pylist(), texts.to_pylist(), strict=True)):
            if state is None or conv != key:
                if state is not None:
                    yield out()
                key, state, keys = conv, Repaired(), ids.slice(i, 1)
            if kind == 0:
                state.segment(text)
            else:
                state.turn(role, text)
    if state is not None:
        yield out()


class Repaired:
    """A conversation's repaired turns, one after the other, as the edits of its segments make them."""

    def __init__(self):
        self.digest, self.last, self.first = hashlib.sha256(), "", True
        self.edits, self.at = "", 0

    def _said(self, role: str, text: str) -> None:
        self.digest.update(f"{'' if self.first else chr(10)}{role}:{text}".encode("utf-8", "surrogatepass"))
        self.first, self.last = False, role[:1]

    def _due(self) -> str:
        return "assistant" if self.last == "u" else "user"

    def insertions(self) -> None:
        while self.at < len(self.edits) and self.edits[self.at] == "I":
            self._said(self._due(), "")
            self.at += 1

    def segment(self, edits: str) -> None:
        self.insertions()
        self.edits, self.at = edits, 0

    def turn(self, role: str, text: str) -> None:
        self.insertions()
        edit = self.edits[self.at]
        self.at += 1
        if edit != "D":
            self._said(role if edit == "K" else self._due(), text)


def repair(
    conversations: DataFrame,
    of: DataFrame | None = None,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    segment_rows: int = SEGMENT,
) -> DataFrame:
    """A row per conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit and repaired_sha256.

    Conversations of the rows of ``of`` (by default the same) that have no rows here are empty ones.
    """

    def written(name):
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    order = ["conv_id", "turn", "role", "text", "row"]
    rows = conversations.select(
        F.col(conv_col).alias("conv_id"), F.col(turn_col).cast("long").alias("turn"), written(role_col).alias("role"), written(text_col).alias("text")
    ).withColumn("row", F.monotonically_increasing_id())  # parts rows that are equal in all else
    placed = numbered(rows.repartitionByRange(*order).sortWithinPartitions(*order), "conv_id", None, "turns")
    end = F.right(F.rtrim(F.col("text"), F.lit(SPACE)), F.lit(1))
    letter = F.substring("role", 1, 1)
    placed = cut(
        placed.select(
            "conv_id",
            "turn",
            "role",
            "text",
            F.col("before").alias("position"),
            F.when(end == "", BLANK).when(end.isin(".", "!", "?"), FINE).otherwise(TRUNCATED).alias("fault"),
            F.when(letter == "s", 0).when(letter == "u", 1).when(letter == "a", 2).otherwise(3).alias("letter"),
        ),
        "placed-turns",
    )
    # The first row of each role and text; by place, a text that comes again and again is not gathered.
    first = placed.filter(F.col("fault") != BLANK).groupBy("conv_id", "role", F.md5("text").alias("digest"), F.length("text").alias("size"))
    first = first.agg(F.min("position").alias("position")).select(F.col("conv_id").alias("_conv"), F.col("position").alias("_position"))
    slim = placed.select("conv_id", "position", "fault", "letter")
    told = slim.join(first, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("position") == F.col("_position")), "left")
    fault = F.when((F.col("fault") != BLANK) & F.col("_position").isNull(), DUPLICATE).otherwise(F.col("fault"))
    symbol = F.struct("position", (F.col("letter") + 4 * fault).alias("symbol"))
    segments = told.groupBy("conv_id", F.floor(F.col("position") / segment_rows).alias("segment")).agg(F.sort_array(F.collect_list(symbol)).alias("symbols"))
    segments = segments.select("conv_id", "segment", F.col("symbols.symbol").alias("symbols"))
    conv = conversations.schema[conv_col].dataType.simpleString()
    aligned = segments.mapInArrow(lambda batches: _aligned(batches, segment_rows), f"conv_id {conv}, {_SEGMENT_COLUMNS}")
    parts = F.sort_array(F.collect_list(F.struct("segment", "blank", "duplicate", "truncated", "illegal", "first", "last", "ways")))
    whole = aligned.groupBy("conv_id").agg(parts.alias("parts")).mapInArrow(
        _put_together, f"conv_id {conv}, blank long, duplicate long, truncated long, illegal long, cost long, audit string, pieces array<string>"
    )
    whole = cut(whole, "repairs")
    edits = whole.select("conv_id", F.posexplode("pieces").alias("segment", "text"))
    stream = placed.select("conv_id", F.floor(F.col("position") / segment_rows).alias("segment"), F.lit(1).alias("kind"), "position", "role", "text").unionByName(
        edits.select("conv_id", F.col("segment").cast("long").alias("segment"), F.lit(0).alias("kind"), F.lit(0).cast("long").alias("position"), F.lit("").alias("role"), "text")
    )
    ordered = stream.repartition("conv_id").sortWithinPartitions("conv_id", "segment", "kind", "position")
    digests = ordered.select("conv_id", "kind", "role", "text").mapInArrow(_digests, f"conv_id {conv}, repaired_sha256 string")
    # Turns are counted per conversation and turn first, so a long conversation is spread.
    turns = placed.filter(F.col("turn").isNotNull()).groupBy("conv_id", "turn").agg(F.lit(1).alias("one"))
    wide = "decimal(38,0)"
    span = F.max("turn").cast(wide) - F.min("turn").cast(wide) + 1 - F.count("one")
    gaps = turns.groupBy("conv_id").agg(F.least(span, F.lit(2**63 - 1).cast(wide)).cast("long").alias("gaps"))
    out = (conversations if of is None else of).select(F.col(conv_col).alias("_id")).distinct()
    for table in (whole.drop("pieces"), digests, gaps):
        table = table.withColumnRenamed("conv_id", "_other")
        out = out.join(table, F.col("_id").eqNullSafe(F.col("_other")), "left").drop("_other")
    zero = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return out.select(
        F.col("_id").alias(conv_col),
        *(F.coalesce(F.col(c), F.lit(0).cast("long")).alias(c) for c in zero),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"),
    )
