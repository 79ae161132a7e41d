"""Exact ranked search: the best documents of a whole table for each item of a query set, by blocked posting lists.

Terms are maximal runs of ASCII letters, digits and all characters beyond ASCII, with A-Z in lower case. With N documents that hold a
term, L terms in all and n in one document, a document's m is 100-25+((25*n*N) div L), and a term that it holds tf times has the
coordinate (1000000000*tf) div (1000*tf+12*m) there. An item is a vector of weights, for each of its terms floor(1000*ln((2N+2)/(2df+1)))
times its repeats; a score is the product of both vectors. All of it is 64-bit integers.

Documents are turned into vectors over the terms of the query set and written; a task then takes them in chunks. In a chunk each term has a
posting list, and a list is cut into blocks of like documents: some of its members are centres, and each document goes to the centre
whose vector is nearest in a random projection. A block's summary is the coordinatewise maximum of its vectors, in eight bits, rounded
up. The product of an item with a summary is thus a bound for all documents of the block, and a block is skipped only if that is below the
item's worst kept score. Lists whose maxima together stay below it are not walked through: who is found in no other list cannot rank.

Each task starts with bounds from a pilot: the documents with one hash in 64 are searched first (for large tables after one in 4,096), and
the score of the last kept there is a lower bound for the whole. So a task hands on few rows, however many tasks there are. All rows
are searched; nothing is shuffled but counts of terms and candidates, so neither long lists nor copies of a document gather anywhere.

The query set is taken in blocks of a bounded number of terms; a block is sent to the tasks and costs a pass over the texts. Terms are known by
64-bit hashes (two given ones share one with a chance of 2^-60). Null and empty texts have no terms and are in no result; an item
without terms has no rows. Equal scores go by id, nulls last, rows of one id as they come; repeated rows of documents rank
each on their own, and a repeated row of the query set has ranks of its own. Extra columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from lazaret.llm.tables import cut, numbered
from lazaret.llm.text import NOT_ALNUM, slices, texts_of, words_of

#: Terms with repeats that a block of the query set holds; a longer item is a block of its own.
BLOCK_TERMS = 32_768
#: So many of them are on the driver at once.
HELD_TERMS = 1_000_000
#: Cells of a chunk's vectors, and documents of a posting block on average.
CHUNK_CELLS, POSTING_BLOCK = 1 << 23, 32
#: A summary's unit: the largest coordinate, 10^6, is 245 of them.
UNIT = 4096
#: One document in PILOT is searched before the others, if that leaves PILOT_ROWS or more.
PILOT, PILOT_ROWS = 64, 1000


@dataclass
class Items:
    """A block of the query set: ids, the hashes of its terms in order, and each item's terms (as places there) with their repeats."""

    ids: list
    terms: np.ndarray
    lists: list[tuple[np.ndarray, np.ndarray]]

    @classmethod
    def of(cls, ids: list, texts: list[str | None]) -> Items:
        words = words_of(texts_of(pa.array(texts, pa.large_string())), NOT_ALNUM)
        terms = np.unique(words.hash)
        lists = []
        for i in range(len(ids)):
            own, repeats = np.unique(words.hash[words.first[i] : words.first[i + 1]], return_counts=True)
            lists.append((np.searchsorted(terms, own), repeats.astype(np.int64)))
        return cls(ids, terms, lists)


@dataclass
class Ranking:
    """What scores need of the table: documents with a term, terms in all, and each item's terms with their weights above 0."""

    documents: int
    length: int
    lists: list[tuple[np.ndarray, np.ndarray]]

    @classmethod
    def of(cls, items: Items, documents: int, length: int, df: np.ndarray) -> Ranking:
        weight = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * int(n) + 1))) if n else 0 for n in df], np.int64)
        lists = []
        for terms, repeats in items.lists:
            w = weight[terms] * repeats
            lists.append((terms[w > 0], w[w > 0]))
        return cls(documents, length, lists)

    def coordinates(self, n: np.ndarray, tf: np.ndarray) -> np.ndarray:
        m = 100 - 25 + (25 * n * self.documents) // self.length
        return (1_000_000_000 * tf) // (1000 * tf + 12 * m)


class Chunk:
    """Vectors of some documents, with posting lists in blocks of like documents; ``row`` ascends."""

    def __init__(self, row: np.ndarray, term: np.ndarray, value: np.ndarray, n_rows: int, n_terms: int):
        self.vectors = np.zeros((n_rows, n_terms), np.int32)
        self.vectors[row, term] = value
        self.coarse = (-(-self.vectors // UNIT)).astype(np.uint8)
        self.highest = self.vectors.max(axis=0, initial=0).astype(np.int64)
        order = np.lexsort((row, term))
        self.rows = row[order]
        self.first = np.searchsorted(term[order], np.arange(n_terms + 1))
        signs = np.random.default_rng(11).integers(0, 2, (n_terms, 32)).astype(np.float32) * 2 - 1
        self.sketch = np.zeros((n_rows, 32), np.float32)
        if len(row):
            starts = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
            sums = np.add.reduceat(signs[term] * self.coarse[row, term, None], starts, axis=0)
            self.sketch[row[starts]] = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-9)

    def blocks(self, term: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The posting list of a term, cut into blocks: rows, each block's number of rows, and the blocks' summaries."""
        rows = self.rows[self.first[term] : self.first[term + 1]]
        n = -(-len(rows) // POSTING_BLOCK)
        if n > 1:
            centres = self.sketch[rows[np.arange(n) * len(rows) // n]]
            nearest = np.argmax(self.sketch[rows] @ centres.T, axis=1)
            order = np.argsort(nearest, kind="stable")
            rows, nearest = rows[order], nearest[order]
            starts = np.flatnonzero(np.concatenate([[True], nearest[1:] != nearest[:-1]]))
        else:
            starts = np.zeros(min(n, 1), np.int64)
        ends = np.append(starts[1:], len(rows))
        summaries = [self.coarse[rows[a:b]].max(axis=0) for a, b in zip(starts, ends, strict=True)]
        return rows, ends - starts, np.array(summaries, np.uint8).reshape(len(starts), -1)


class Search:
    """The best documents seen so far for each item of a block, chunk by chunk."""

    def __init__(self, lists: list[tuple[np.ndarray, np.ndarray]], k: int, least: np.ndarray):
        self.lists, self.k = lists, k
        #: A document below an item's threshold cannot rank; one at it can, by its id.
        self.threshold = np.maximum(least, 1).astype(np.int64)
        self.best: list[list[tuple[int, bool, object]]] = [[] for _ in lists]
        self.seen_blocks = self.skipped_blocks = self.scored = 0

    def _asked(self, chunk: Chunk) -> dict[int, list[int]]:
        """The lists to walk through, each with its items: an item's lists of least maxima are left out while their sum stays below."""
        asked: dict[int, list[int]] = {}
        for q, (terms, w) in enumerate(self.lists):
            most = w * chunk.highest[terms]
            order = np.argsort(most, kind="stable")
            needed = order[np.cumsum(most[order]) >= self.threshold[q]]
            for t in terms[needed].tolist():
                asked.setdefault(t, []).append(q)
        return asked

    def add(self, chunk: Chunk, ids: list) -> None:
        marked = np.zeros((len(self.lists), len(ids)), bool)
        for term, items in self._asked(chunk).items():
            rows, sizes, summaries = chunk.blocks(term)
            if not len(rows):
                continue
            bounds = np.column_stack([summaries[:, self.lists[q][0]] @ self.lists[q][1] for q in items]) * UNIT
            within = bounds >= self.threshold[items]
            self.seen_blocks += within.size
            self.skipped_blocks += within.size - int(within.sum())
            own = np.repeat(within, sizes, axis=0)
            for place in np.flatnonzero(within.any(axis=0)):
                marked[items[place], rows[own[:, place]]] = True
        for q in np.flatnonzero(marked.any(axis=1)):
            rows = np.flatnonzero(marked[q])
            terms, w = self.lists[q]
            scores = chunk.vectors[rows[:, None], terms] @ w
            self.scored += len(rows)
            if len(rows) > self.k:
                self.threshold[q] = max(self.threshold[q], np.partition(scores, len(rows) - self.k)[len(rows) - self.k])
            good = np.flatnonzero(scores >= self.threshold[q])
            found = [(-int(scores[i]), ids[rows[i]] is None, ids[rows[i]]) for i in good]
            if found:
                merged = sorted(self.best[q] + found, key=lambda x: x if x[2] is not None else x[:2])
                self.best[q] = merged[: self.k]
                if len(merged) >= self.k:
                    self.threshold[q] = max(self.threshold[q], -self.best[q][-1][0])


def item_blocks(items: DataFrame, item_col: str, text_col: str) -> Iterator[Items]:
    """The query set in blocks of about BLOCK_TERMS terms."""
    sized = items.select(F.col(item_col).alias("item"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    # Half the bytes bound the terms.
    sized = cut(sized.withColumn("size", (F.octet_length("text") / 2).cast("long") + 1), "items")
    if (sized.agg(F.sum("size")).first()[0] or 0) <= HELD_TERMS:
        parts = [sized]
    else:
        ordered = sized.withColumn("key", F.lit(0)).repartitionByRange("item", "text").sortWithinPartitions("item", "text")
        placed = numbered(ordered, "key", "size", "items")
        placed = cut(placed.withColumn("block", (F.col("before") / HELD_TERMS).cast("long")), "items")
        numbers = sorted(r["block"] for r in placed.select("block").distinct().collect())
        parts = [placed.filter(F.col("block") == b) for b in numbers]
    for part in parts:
        rows = part.orderBy("item", "text").select("item", "text").collect()
        ids, texts, held = [], [], 0
        for r in rows:
            size = len(r["text"]) // 2 + 1
            if ids and held + size > BLOCK_TERMS:
                yield Items.of(ids, texts)
                ids, texts, held = [], [], 0
            ids.append(r["item"])
            texts.append(r["text"])
            held += size
        if ids:
            yield Items.of(ids, texts)


def vectors(docs: DataFrame, terms: np.ndarray, id_col: str, text_col: str) -> DataFrame:
    """A written row per document with a term: id, pilot (2, 1 or 0), n, and the places in ``terms`` of its own with their counts."""
    schema = T.StructType(
        [
            T.StructField("id", docs.schema[id_col].dataType),
            T.StructField("pilot", T.IntegerType()),
            T.StructField("n", T.LongType()),
            T.StructField("terms", T.ArrayType(T.IntegerType())),
            T.StructField("tf", T.ArrayType(T.IntegerType())),
        ]
    )
    sent = docs.sparkSession.sparkContext.broadcast(terms)

    def run(batches):
        known = sent.value
        for batch in batches:
            for piece, texts in slices(batch, "text"):
                words = words_of(texts, NOT_ALNUM)
                n = np.diff(words.first)
                at = np.searchsorted(known, words.hash) if len(known) else np.zeros(len(words.hash), np.int64)
                at[at == len(known)] = 0
                hit = np.flatnonzero(known[at] == words.hash) if len(known) else np.zeros(0, np.int64)
                key, tf = np.unique(words.row[hit] * max(len(known), 1) + at[hit], return_counts=True)
                row, term = np.divmod(key, max(len(known), 1))
                keep = np.flatnonzero(n > 0)
                # Only rows with words have terms, so offsets over the kept rows are offsets over all.
                edges = pa.array(np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(n))[keep])]).astype(np.int32))
                rows = piece.take(pa.array(keep))
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column("id"),
                        rows.column("pilot"),
                        pa.array(n[keep].astype(np.int64)),
                        pa.ListArray.from_arrays(edges, pa.array(term.astype(np.int32))),
                        pa.ListArray.from_arrays(edges, pa.array(tf.astype(np.int32))),
                    ],
                    names=schema.names,
                )

    key = F.xxhash64(id_col)
    pilot = F.when(F.pmod(key, F.lit(PILOT * PILOT)) == 0, 2).when(F.pmod(key, F.lit(PILOT)) == 0, 1).otherwise(0)
    slim = docs.select(F.col(id_col).alias("id"), pilot.alias("pilot"), F.col(text_col).alias("text"))
    return cut(slim.mapInArrow(run, schema), "vectors")


def _best(table: DataFrame, ranking: Ranking, n_terms: int, k: int, least: np.ndarray) -> DataFrame:
    """(item, id, score): the k best of the table for each item by number, without those below ``least``."""
    schema = T.StructType([T.StructField("item", T.IntegerType()), table.schema["id"], T.StructField("score", T.LongType())])
    id_type = to_arrow_type(table.schema["id"].dataType)
    sent = table.sparkSession.sparkContext.broadcast((ranking, least))
    rows_per_chunk = max(CHUNK_CELLS // max(n_terms, 1), 64)

    def run(batches):
        ranking, least = sent.value
        search = Search(ranking.lists, k, least)
        for batch in batches:
            for first in range(0, len(batch), rows_per_chunk):
                part = batch.slice(first, rows_per_chunk)
                per_row = np.diff(part.column("terms").offsets.to_numpy())
                term, tf = (part.column(c).flatten().to_numpy().astype(np.int64) for c in ("terms", "tf"))
                row = np.repeat(np.arange(len(part)), per_row)
                n = part.column("n").to_numpy().astype(np.int64)
                chunk = Chunk(row, term, ranking.coordinates(n[row], tf), len(part), n_terms)
                search.add(chunk, part.column("id").to_pylist())
        found = [(q, i, -s) for q, best in enumerate(search.best) for s, _, i in best]
        item, ids, score = zip(*found, strict=True) if found else ((), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(item, pa.int32()), pa.array(ids, id_type), pa.array(score, pa.int64())], names=schema.names)

    local = table.select("id", "n", "terms", "tf").mapInArrow(run, schema)
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last())
    return local.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def search(
    docs: DataFrame,
    items: DataFrame,
    k: int = 20,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """(item_id, rank, doc_id, score): the k documents of highest score above 0 for each item, ranks from 1."""
    out = None
    spark = docs.sparkSession
    schema = T.StructType(
        [
            T.StructField(item_col, items.schema[item_col].dataType),
            T.StructField("rank", T.IntegerType()),
            T.StructField(id_col, docs.schema[id_col].dataType),
            T.StructField("score", T.LongType()),
        ]
    )
    for block in item_blocks(items, item_col, item_text_col):
        table = vectors(docs, block.terms, id_col, text_col)
        totals = table.agg(F.count("*").alias("n"), F.sum("n").alias("length"), *(F.sum((F.col("pilot") >= p).cast("long")).alias(f"p{p}") for p in (1, 2))).first()
        if not totals["n"]:
            continue
        df = np.zeros(len(block.terms), np.int64)
        for r in table.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
            df[r["term"]] = r["count"]
        ranking = Ranking.of(block, int(totals["n"]), int(totals["length"]), df)
        least = np.zeros(len(block.ids), np.int64)
        for level in (2, 1):
            if totals[f"p{level}"] >= PILOT_ROWS:
                pilot = _best(table.filter(F.col("pilot") >= level), ranking, len(block.terms), k, least)
                for r in pilot.filter(F.col("rank") == k).select("item", "score").collect():
                    least[r["item"]] = r["score"]
        found = _best(table, ranking, len(block.terms), k, least)
        names = spark.createDataFrame(list(enumerate(block.ids)), T.StructType([T.StructField("_item", T.IntegerType()), T.StructField("_name", items.schema[item_col].dataType)]))
        named = found.join(F.broadcast(names), F.col("item") == F.col("_item")).select(
            F.col("_name").alias(item_col), "rank", F.col("id").alias(id_col), "score"
        )
        out = named if out is None else out.unionByName(named)
    return out if out is not None else spark.createDataFrame([], schema)
