"""Packing texts into sequences of a fixed number of tokens, each with the same mixture of sources.

Every source is a queue of tokens in the order of the rows. A deficit round robin serves them: a tree over the
queues has a counter at each node, and the side whose share is owed hands over the next token; the rest
of the division is the deficit, carried from token to token, so across windows and partitions. A queue is
never off its share by more than one token per level of the tree, in any window.

The counters have a closed form (floor(share * position)), so each task knows for its own rows which windows they
fall in: the schedule is not walked through, and no queue or window is gathered anywhere. Ids are written once,
two bytes each for a small vocabulary, and are not shuffled unless the table of queue starts is large.

Targets: by default the sources' own shares, so all queues end together. Given other weights, queues run dry at
different times; from then on the others share the windows by their weights. Every token is packed in any case.

A null text is empty and still ends with the end id; each source is a queue of its own at any number of them, and so is null.
Names of queues stay in written tables; the driver and the tasks hold a few numbers per queue, and per different end that ``targets``
give. Repeated rows and ids are packed each on their own. Extra columns are not read.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Mapping

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lazaret.llm.tables import cut, numbered
from lazaret.llm.tokens import encoder


def mul_div(a: np.ndarray, b: int | np.ndarray, c: int | np.ndarray) -> np.ndarray:
    """floor(a * b / c) for numbers from 0 whose result is below 2^50; c > 0. The product may pass 64 bits."""
    a, b, c = (np.asarray(x, np.int64) for x in (a, b, c))
    q = np.floor(a.astype(np.float64) * b / c).astype(np.int64)
    with np.errstate(over="ignore"):
        rest = a * b - q * c  # exact modulo 2^64, and small
    return q + rest // c


class Schedule:
    """Which queue gives the token at each place of the stream, for queues with these numbers of tokens.

    All queues end together at the stream's end.
    """

    def __init__(self, totals: list[int]):
        #: Tokens of the queues before each; a node of the tree is a range of queues.
        self.sums = np.concatenate([[0], np.cumsum(np.asarray(totals, np.int64))]).astype(np.int64)
        self.total = int(self.sums[-1])

    def way(self, queue: int) -> list[tuple[int, int, bool]]:
        """The way down to a queue: (tokens left, tokens of the node, whether it is on the left)."""
        out, a, b = [], 0, len(self.sums) - 1
        while b - a > 1:
            m = (a + b) // 2
            out.append((int(self.sums[m] - self.sums[a]), int(self.sums[b] - self.sums[a]), queue < m))
            a, b = (a, m) if queue < m else (m, b)
        return out

    def served(self, queue: int, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Tokens served before each place of the stream: of this queue, and of the queues before it."""
        x, before = np.asarray(places, np.int64), np.zeros(len(places), np.int64)
        for left, both, is_left in self.way(queue):
            given = mul_div(x, left, both) if both else np.zeros_like(x)
            if is_left:
                x = given
            else:
                before = before + given
                x = x - given
        return x, before

    def place(self, queue: int, index: np.ndarray) -> np.ndarray:
        """The place in the stream of the queue's tokens with these numbers."""
        i = np.asarray(index, np.int64)
        for left, both, is_left in reversed(self.way(queue)):
            if is_left:
                i = -mul_div_negative(i + 1, both, left) - 1
            else:
                i = mul_div(i, both, both - left)
        return i


def mul_div_negative(a: np.ndarray, b: int, c: int) -> np.ndarray:
    """-ceil(a * b / c)."""
    low = mul_div(a, b, c)
    with np.errstate(over="ignore"):
        exact = (np.asarray(a, np.int64) * np.int64(b) - low * np.int64(c)) == 0
    return -(low + ~exact)


class Mixture:
    """Schedules one after the other: a new one starts where a queue runs dry."""

    def __init__(self, totals: list[int], weights: list[float] | None = None):
        self.totals = totals
        n = len(totals)
        if weights is None:
            parts = [list(totals)]
        else:
            if any(w < 0 for w in weights):
                raise ValueError("weights are 0 or more")
            # Queues without weight come last, by their own shares.
            ends = sorted({t / w for t, w in zip(totals, weights, strict=True) if t and w})
            given, parts = [0] * n, []
            for end in ends:
                upto = [t if w and t / w <= end else min(int(w * end), t) for t, w in zip(totals, weights, strict=True)]
                parts.append([u - g for u, g in zip(upto, given, strict=True)])
                given = upto
            parts.append([t - g for t, g in zip(totals, given, strict=True)])
        parts = [p for p in parts if sum(p)]
        self.schedules = [Schedule(p) for p in parts]
        self.starts = np.concatenate([[0], np.cumsum([s.total for s in self.schedules])]).astype(np.int64)
        #: For each queue the number of its first token in each schedule.
        self.firsts = np.zeros((n, len(parts) + 1), np.int64)
        np.cumsum(np.array(parts, np.int64).reshape(len(parts), n).T, axis=1, out=self.firsts[:, 1:])

    def pieces(self, queue: int, first: np.ndarray, length: np.ndarray, window: int) -> dict[str, np.ndarray]:
        """The pieces of rows that take ``length`` tokens of a queue from number ``first`` on.

        Gives for each piece its row, start (in the row), length, window and offset there.
        """
        out: dict[str, list[np.ndarray]] = defaultdict(list)
        rows = np.flatnonzero(length > 0)
        at, end = first[rows].astype(np.int64), (first + length)[rows].astype(np.int64)
        while len(rows):
            phase = np.searchsorted(self.firsts[queue], at, side="right") - 1
            stop, offset, number = np.empty_like(at), np.empty_like(at), np.empty_like(at)
            for p in np.unique(phase):
                own = np.flatnonzero(phase == p)
                schedule, base, start = self.schedules[p], int(self.firsts[queue][p]), int(self.starts[p])
                place = schedule.place(queue, at[own] - base)
                number[own] = (place + start) // window
                low = np.maximum(number[own] * window - start, 0)
                high = np.minimum((number[own] + 1) * window - start, schedule.total)
                got_low, before_low = schedule.served(queue, low)
                got_high, before_high = schedule.served(queue, high)
                stop[own] = np.minimum(got_high + base, end[own])
                offset[own] = low + start - number[own] * window + before_high - before_low + at[own] - base - got_low
            for name, x in (("row", rows), ("start", at - first[rows]), ("length", stop - at), ("window", number), ("offset", offset)):
                out[name].append(x)
            more = stop < end
            rows, at, end = rows[more], stop[more], end[more]
        return {k: np.concatenate(out[k]) if out else np.zeros(0, np.int64) for k in ("row", "start", "length", "window", "offset")}


def encoded(docs: DataFrame, tokenizer: str, end_id: int, id_col: str, text_col: str, queue_col: str) -> DataFrame:
    """A written table of the rows' token ids, with the tokens of the same queue before them in the same partition."""
    schema = T.StructType(
        [
            T.StructField("id", docs.schema[id_col].dataType),
            T.StructField("queue", T.StringType()),
            T.StructField("part", T.IntegerType()),
            T.StructField("before", T.LongType()),
            T.StructField("n", T.LongType()),
            T.StructField("ids", T.BinaryType()),
        ]
    )
    queue = F.col(queue_col).cast("string")

    def run(batches):
        part, totals, encode = TaskContext.get().partitionId(), defaultdict(int), encoder(tokenizer)
        for batch in batches:
            for rows, ids, counts in encode(batch, "text", end_id):
                own = rows.column("queue").to_pylist()
                before = np.empty(len(own), np.int64)
                for i, (q, n) in enumerate(zip(own, counts.tolist(), strict=True)):
                    before[i] = totals[q]
                    totals[q] += n
                edges = np.concatenate([[0], np.cumsum(counts)]) * ids.itemsize
                binary = pa.LargeBinaryArray.from_buffers(
                    pa.large_binary(), len(own), [None, pa.py_buffer(edges.astype(np.int64).tobytes()), pa.py_buffer(ids.tobytes())]
                )
                yield pa.RecordBatch.from_arrays(
                    [rows.column("id"), rows.column("queue"), pa.array(np.full(len(own), part, np.int32)), pa.array(before), pa.array(counts), binary.cast(pa.binary())],
                    names=schema.names,
                )

    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), queue.alias("queue"))
    return cut(slim.mapInArrow(run, schema), "ids")


def pack(
    docs: DataFrame,
    tokenizer: str,
    end_id: int = 2,
    window: int = 4096,
    targets: Mapping[str | None, float] | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    queue_col: str = "source",
) -> DataFrame:
    """A row per piece: id, queue, start, length, doc_tokens, sequence_id, offset and ids (unsigned 32 bit, little endian).

    Pieces of a sequence, put at their offsets, are its tokens; all sequences but the last are full.
    """
    table = encoded(docs, tokenizer, end_id, id_col, text_col, queue_col)
    sums = cut(table.groupBy("part", "queue").agg(F.sum("n").alias("n")), "queue-sums")
    earlier = Window.partitionBy("queue").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # Queues are numbered by name, null first; the driver sees their tokens in that order.
    named = sums.groupBy("queue").agg(F.sum("n").alias("n")).withColumn("key", F.lit(0))
    queues = numbered(named.repartitionByRange("queue").sortWithinPartitions("queue"), "key", None, "queues")
    queues = cut(queues.select(F.col("queue").alias("_name"), F.col("n").alias("_n"), F.col("before").alias("number")), "queues")
    totals = [int(n) for n in queues.orderBy("number").select("_n").toPandas()["_n"]]
    weights = None
    if targets is not None:
        weights = [0.0] * len(totals)
        if targets:
            given = docs.sparkSession.createDataFrame([(q, float(w)) for q, w in targets.items()], "queue string, weight double")
            for r in given.join(queues, F.col("queue").eqNullSafe(F.col("_name"))).select("number", "weight").collect():
                weights[r["number"]] = r["weight"]
    mixture = Mixture(totals, weights)
    base = sums.join(queues, F.col("queue").eqNullSafe(F.col("_name"))).select(
        F.col("part").alias("_part"), F.col("queue").alias("_queue"), "number", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base")
    )
    base = cut(base, "queue-starts")
    schema = T.StructType(
        [
            T.StructField(id_col, docs.schema[id_col].dataType),
            T.StructField("queue", T.StringType()),
            *(T.StructField(n, T.LongType()) for n in ("start", "length", "doc_tokens", "sequence_id", "offset")),
            T.StructField("ids", T.BinaryType()),
        ]
    )

    def run(batches):
        width = encoder(tokenizer).width
        for batch in batches:
            queues = batch.column("number").to_numpy()
            first = (batch.column("before").to_numpy() + batch.column("base").to_numpy()).astype(np.int64)
            length = batch.column("n").to_numpy().astype(np.int64)
            for q in np.unique(queues):
                own = np.flatnonzero(queues == q)
                rows = batch.take(pa.array(own))
                found = mixture.pieces(int(q), first[own], length[own], window)
                order = np.lexsort((found["start"], found["row"]))
                found = {k: v[order] for k, v in found.items()}
                _, offsets, data = rows.column("ids").cast(pa.large_binary()).buffers()
                starts = np.frombuffer(offsets, np.int64)[: len(own)] // width
                ids = np.frombuffer(data, f"<u{width}") if data is not None else np.zeros(0, f"<u{width}")
                for a in range(0, len(order), 4096):
                    own_pieces = {k: v[a : a + 4096] for k, v in found.items()}
                    lengths = own_pieces["length"]
                    edges = np.concatenate([[0], np.cumsum(lengths)])
                    # Pieces of a row follow each other, and rows too, so their ids do as well.
                    low = starts[own_pieces["row"][0]] + own_pieces["start"][0]
                    values = ids[low : low + edges[-1]].astype("<u4")
                    binary = pa.LargeBinaryArray.from_buffers(
                        pa.large_binary(), len(lengths), [None, pa.py_buffer((edges * 4).astype(np.int64).tobytes()), pa.py_buffer(values.tobytes())]
                    )
                    of = pa.array(own_pieces["row"])
                    yield pa.RecordBatch.from_arrays(
                        [
                            rows.column("id").take(of),
                            rows.column("queue").take(of),
                            pa.array(own_pieces["start"]),
                            pa.array(lengths),
                            pa.array(length[own][own_pieces["row"]]),
                            pa.array(own_pieces["window"]),
                            pa.array(own_pieces["offset"]),
                            binary.cast(pa.binary()),
                        ],
                        names=schema.names,
                    )

    joined = table.join(base, (F.col("part") == F.col("_part")) & F.col("queue").eqNullSafe(F.col("_queue")))
    return joined.select("id", "queue", "number", "before", "base", "n", "ids").mapInArrow(run, schema)


def sequences(pieces: DataFrame) -> DataFrame:
    """(sequence_id, length, ids): the pieces of each sequence put together; a sequence is bounded by the window."""
    grouped = pieces.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("p"))
    ids = F.aggregate("p", F.lit(b""), lambda acc, x: F.concat(acc, x["ids"]))
    return grouped.select("sequence_id", ids.alias("ids")).withColumn("length", (F.octet_length("ids") / 4).cast("long"))
