"""Benchmark decontamination by spaced seeds.

Words are runs of letters and digits (ASCII marks part them, A-Z folded, other bytes stay). A mask is a fixed pattern of
positions that count; those between are ignored, so that a seed still fits where words were replaced. Items of fewer than
``SHORT`` words have two light masks besides, which fit wherever up to a quarter of such an item is replaced. Every position
of every benchmark item and of every text is hashed under each mask; equal hashes are hits. Around a hit the words
are compared along the item, not shifted: the overlap is the stretch with the best score (a match counts 1, another word
-``PENALTY``), and it holds when it has ``MIN_MATCHES`` matches and at least ``MIN_SHARE`` of its words match. Otherwise the whole item
holds when ``MIN_SHARE`` of all its words match, or else the stretch with most matches that meets both bounds. An item of fewer than ``MIN_WORDS`` words
holds where all its words stand in a row; one without words holds nowhere. Null texts are empty. Repeated items and texts are compared each on their own.

The benchmark is joined in blocks of a bounded number of words, each sent to the tasks; the texts are
read once per block and never shuffled. The work for a text grows with its length and its hits only.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lazaret.llm.tables import cut, numbered
from lazaret.llm.text import NOT_ALNUM, Words, mix, slices, texts_of, words_of

#: Fixed masks: 1 is compared, 0 ignored.
MASKS = ("11101100101101", "1101011100100111", "111001010011000111", "11110111")
#: For items of fewer than SHORT words: with a quarter of the words replaced, three in a row or two and two stay.
LIGHT = ("111", "11011")
MIN_WORDS, MIN_MATCHES, PENALTY, MIN_SHARE, SHORT = 6, 12, 2, 0.75, 25
#: Words of the benchmark that one block holds, about 60 bytes each with its seeds.
BLOCK_WORDS = 500_000
#: Hits of masks that are held at once.
HITS = 2_000_000
_FILTER_BITS = 22
_STEP = np.uint64(0x94D049BB133111EB)


def _masked(words: Words, mask: str) -> tuple[np.ndarray, np.ndarray]:
    """First word and hash of each place where the mask fits inside a row."""
    n = len(words.hash) - len(mask) + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    h = np.full(n, np.uint64(len(mask)))
    for k, c in enumerate(mask):
        if c == "1":
            h = h * _STEP + words.hash[k : n + k]
    at = np.flatnonzero(words.row[:n] == words.row[len(mask) - 1 :])
    return at, mix(h[at])


def _longest(same: np.ndarray) -> tuple[int, int, int]:
    """Start, end and matches of the stretch with most matches of which MIN_SHARE match (ties: the shortest, then the first)."""
    sums = np.concatenate([[0.0], np.cumsum(np.where(same, 1 - MIN_SHARE, -MIN_SHARE))])
    # For each end the earliest start that leaves the share.
    start = np.searchsorted(-np.minimum.accumulate(sums), -sums, side="left")
    count = np.concatenate([[0], np.cumsum(same)])
    matches = count - count[start]
    end = int(np.lexsort((np.arange(len(sums)) - start, -matches))[0])
    return int(start[end]), end, int(matches[end])


@dataclass
class Block:
    """Items of a benchmark: their words and seeds, sorted by hash."""

    ids: list
    words: np.ndarray
    first: np.ndarray
    masks: tuple[str, ...]
    seeds: np.ndarray
    places: np.ndarray
    filter: np.ndarray

    @staticmethod
    def of(ids: list, texts: list[str | None]) -> Block:
        words = words_of(texts_of(pa.array(texts, pa.string())), NOT_ALNUM)
        counts = np.diff(words.first)
        short = (counts >= MIN_WORDS) & (counts < SHORT)
        # The items that each mask is for; those of a few words are hashed as a whole.
        fits = {mask: counts >= MIN_WORDS for mask in MASKS}
        fits |= {mask: short for mask in LIGHT if short.any()}
        for n in range(1, MIN_WORDS):
            if (counts == n).any():
                fits["1" * n] = fits.get("1" * n, False) | (counts == n)
        masks = tuple(fits)
        seeds, places = [], []
        for mask in masks:
            at, h = _masked(words, mask)
            own = fits[mask][words.row[at]]
            at, h = at[own], h[own]
            seeds.append(h)
            places.append(at)
        seeds, places = np.concatenate(seeds), np.concatenate(places)
        order = np.argsort(seeds, kind="stable")
        seeds, places = seeds[order], places[order]
        bits = np.zeros(1 << _FILTER_BITS, bool)
        bits[seeds >> np.uint64(64 - _FILTER_BITS)] = True
        return Block(ids, words.hash, words.first, masks, seeds, places, bits)

    def lines(self, words: Words) -> np.ndarray:
        """Row, item and distance of each pair of a text and an item that a mask fits; its hits verify together.

        Words that repeat give many hits on few lines, so hits are made and folded a bounded number at a time.
        """
        found = [np.zeros((0, 3), np.int64)]
        for mask in self.masks:
            at, h = _masked(words, mask)
            near = np.flatnonzero(self.filter[h >> np.uint64(64 - _FILTER_BITS)])
            at, h = at[near], h[near]
            low, high = np.searchsorted(self.seeds, h, "left"), np.searchsorted(self.seeds, h, "right")
            sums = np.concatenate([[0], np.cumsum(high - low)])
            first = 0
            while first < len(at):
                last = max(int(np.searchsorted(sums, sums[first] + HITS, side="right")) - 1, first + 1)
                n = high[first:last] - low[first:last]
                spread = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                theirs = self.places[np.repeat(low[first:last], n) + spread]
                mine = np.repeat(at[first:last], n)
                item = np.searchsorted(self.first, theirs, side="right") - 1
                found.append(np.unique(np.column_stack([words.row[mine], item, mine - theirs]), axis=0))
                first = last
        return np.unique(np.concatenate(found), axis=0)

    def _hopeful(self, words: Words, lines: np.ndarray) -> np.ndarray:
        """Lines of long items, and those of short ones with enough matches in all; chance hits of light masks go here."""
        a, b = self.first[lines[:, 1]], self.first[lines[:, 1] + 1]
        keep = b - a >= SHORT
        for part in np.array_split(np.flatnonzero(~keep), max(1, len(lines) // 50_000)):
            row, shift = lines[part, 0], lines[part, 2]
            at = a[part, None] + np.arange(SHORT)
            there = at + shift[:, None]
            inside = (at < b[part, None]) & (there >= words.first[row][:, None]) & (there < words.first[row + 1][:, None])
            same = self.words[np.where(inside, at, 0)] == words.hash[np.where(inside, there, 0)]
            keep[part] = (same & inside).sum(1) >= np.minimum(MIN_MATCHES, MIN_SHARE * (b - a)[part])
        return keep

    def overlaps(self, words: Words) -> Iterator[tuple[int, int, int, int, int, int]]:
        """(row, item, first word in the text, first word in the item, words, matches) of each verified overlap."""
        lines = self.lines(words)
        if not len(lines):
            return
        lines = lines[self._hopeful(words, lines)]
        for row, i, shift in lines.tolist():
            a, b = int(self.first[i]), int(self.first[i + 1])
            low = max(a, int(words.first[row]) - shift)
            high = min(b, int(words.first[row + 1]) - shift)
            same = self.words[low:high] == words.hash[low + shift : high + shift]
            score = np.concatenate([[0], np.cumsum(np.where(same, 1, -PENALTY))])
            floor = np.minimum.accumulate(score)
            end = int(np.argmax(score - floor))
            start = int(np.flatnonzero(score[: end + 1] == floor[end])[-1])
            matches, n = int(same[start:end].sum()), end - start
            if matches < MIN_MATCHES or matches < MIN_SHARE * n:
                every = int(same.sum())
                if every >= MIN_SHARE * (b - a):
                    inside = np.flatnonzero(same)
                    start, end, matches = int(inside[0]), int(inside[-1]) + 1, every
                else:
                    start, end, matches = _longest(same)
                n = end - start
            if matches >= MIN_SHARE * (b - a) or (matches >= MIN_MATCHES and matches >= MIN_SHARE * n):
                yield row, i, low + shift + start - int(words.first[row]), low + start - a, n, matches


def blocks_of(benchmark: DataFrame, item_col: str, text_col: str) -> Iterator[Block]:
    """Blocks of the benchmark of about BLOCK_WORDS words, one after the other; a longer item is a block of its own."""
    sized = benchmark.select(F.col(item_col).alias("item"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    # Half the bytes bound the words.
    sized = cut(sized.withColumn("size", (F.octet_length("text") / 2).cast("long") + 1), "benchmark")
    total = sized.agg(F.sum("size")).first()[0] or 0
    if total <= BLOCK_WORDS:
        numbers, rows = [0], {0: sized.orderBy("item", "text")}
    else:
        # Running totals by task, as the benchmark may be too large for one.
        ordered = sized.withColumn("key", F.lit(0)).repartitionByRange("item", "text").sortWithinPartitions("item", "text")
        placed = numbered(ordered, "key", "size", "benchmark")
        placed = cut(placed.withColumn("block", (F.col("before") / BLOCK_WORDS).cast("long")), "benchmark")
        numbers = sorted(r["block"] for r in placed.select("block").distinct().collect())
        rows = {b: placed.filter(F.col("block") == b).orderBy("item", "text") for b in numbers}
    for b in numbers:
        own = rows[b].select("item", "text").collect()
        yield Block.of([r["item"] for r in own], [r["text"] for r in own])


def overlaps(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text"
) -> DataFrame:
    """A row per verified overlap: id, item, start and item_start (words before it), n_words and n_matches."""
    schema = T.StructType(
        [
            T.StructField(id_col, docs.schema[id_col].dataType),
            T.StructField(item_col, benchmark.schema[item_col].dataType),
            *(T.StructField(n, T.LongType()) for n in ("start", "item_start", "n_words", "n_matches")),
        ]
    )
    slim = docs.select(id_col, text_col)

    def scan(block: Block) -> DataFrame:
        sent = slim.sparkSession.sparkContext.broadcast(block)

        def run(batches):
            block = sent.value
            items = pa.array(block.ids)
            for batch in batches:
                for piece, texts in slices(batch, text_col):
                    found = list(block.overlaps(words_of(texts, NOT_ALNUM)))
                    if found:
                        row, item, *numbers = (pa.array(x, pa.int64()) for x in zip(*found, strict=True))
                        yield pa.RecordBatch.from_arrays([piece.column(id_col).take(row), items.take(item), *numbers], names=schema.names)

        return slim.mapInArrow(run, schema)

    out = None
    for block in blocks_of(benchmark, item_col, item_text_col):
        out = scan(block) if out is None else out.union(scan(block))
    return out


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", item_col: str = "item_id", **columns: str) -> DataFrame:
    """(id, item, n_overlaps, start, n_words, n_matches): a row per id and item; place and size are of the overlap with most matches."""
    best = F.max(F.struct("n_matches", (-F.col("n_words")).alias("less"), (-F.col("start")).alias("early")))
    return (
        overlaps(docs, benchmark, id_col, item_col=item_col, **columns)
        .groupBy(id_col, item_col)
        .agg(F.count("*").alias("n_overlaps"), best.alias("b"))
        .select(id_col, item_col, "n_overlaps", (-F.col("b.early")).alias("start"), (-F.col("b.less")).alias("n_words"), F.col("b.n_matches").alias("n_matches"))
    )


def clean(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The rows without a verified overlap, with all their columns."""
    for block in blocks_of(benchmark, item_col, item_text_col):
        docs = _without(docs, block, text_col)
    return docs


def _without(docs: DataFrame, block: Block, text_col: str) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast(block)

    def run(batches):
        for batch in batches:
            for piece, texts in slices(batch, text_col):
                keep = np.ones(len(texts), bool)
                for row, *_ in sent.value.overlaps(words_of(texts, NOT_ALNUM)):
                    keep[row] = False
                yield piece.filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)
