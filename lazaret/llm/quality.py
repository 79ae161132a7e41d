"""Quality rules with an isolation forest over the statistics of the rules.

Statistics of a text: words are runs without ASCII white space, lines end at line feeds; a null text is empty.
Two fixed rules reject a text: under 20 words, or over 30 % of its words in repeated windows of 8 words.
The others are judged by forests of random splits, one over each feature and one over all: rows that few splits
set apart have short paths and are odd. Each tree is grown on a few hundred of the labelled rows, good and bad alike, which is
what an isolation forest is. What is odd need not be bad, so the labels, all of them, set a threshold on each forest's path
length: the one that parts good and bad rows best, of those that reject at most ``max_good_loss`` of the good ones; a forest
that finds no such threshold rejects nothing.

Extra columns pass through ``keep`` unchanged. Empty tables give empty results; without labels, or with no bad
ones, only the fixed rules reject. Labels that are null are left out; rows that share an id share its label.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lazaret.llm.tables import cut
from lazaret.llm.text import SPACE, Texts, mix, slices, span_hashes, window_hashes, words_of

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_SHOUT = np.zeros(256, bool)
_SHOUT[list(b"!?{}[]()=_/\\@~^")] = True

STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_MORE = ("n_upper", "n_digits", "n_marks", "n_lines", "n_echoes")
MIN_WORDS, REPEAT_PERCENT, WINDOW = 20, 30, 8


def _totals(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return sums[offsets[1:]] - sums[offsets[:-1]]


def _repeats(rows: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """1 or 2 where a hash stands at other places of the same row too; 2 marks all of them but one."""
    keys = mix(hashes + rows.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    order = np.argsort(keys)
    keys = keys[order]
    out = np.zeros(len(keys), np.int8)
    if len(keys):
        same = keys[1:] == keys[:-1]
        out[order[:-1][same]] = 1
        out[order[1:][same]] = 2
    return out


def statistics(texts: Texts) -> dict[str, np.ndarray]:
    """The statistics of each text, whole."""
    n, data, offsets = len(texts), texts.data, texts.offsets
    words = words_of(texts, lower=False)
    space, tail = SPACE[data], (data & 0xC0) == 0x80
    out = {"n_words": np.diff(words.first)}
    out["word_chars"] = _totals(~space & ~tail, offsets)
    for name, flags in (("n_symbols", _SYMBOL), ("n_upper", _UPPER), ("n_digits", _DIGIT), ("n_marks", _SHOUT)):
        out[name] = _totals(flags[data], offsets)

    # Lines: from a text's start or behind a line feed, to a line feed or the text's end.
    feeds = np.flatnonzero(data == 10)
    begins = np.sort(np.concatenate([offsets[:-1], feeds + 1]), kind="stable")
    ends = np.sort(np.concatenate([feeds, offsets[1:]]), kind="stable")
    row = np.searchsorted(offsets, begins, side="right") - 1
    # A line feed that ends a text starts an empty line at the next text's place; empty lines have no word.
    inner = np.concatenate([[0], np.cumsum(~space)])
    full = np.flatnonzero((ends > begins) & (inner[ends] > inner[np.minimum(begins, len(data))]))
    line_hash = span_hashes(data, begins[full], ends[full])
    out["n_lines"] = np.bincount(row[full], minlength=n)
    out["n_dup_lines"] = np.bincount(row[full][_repeats(row[full], line_hash) == 2], minlength=n)

    at, hashes = window_hashes(words, WINDOW)
    again = at[_repeats(words.row[at], hashes) > 0]
    cover = np.zeros(len(words.hash) + 1, np.int64)
    np.add.at(cover, again, 1)
    np.add.at(cover, again + WINDOW, -1)
    covered = np.cumsum(cover)[:-1] > 0
    out["n_repeat_words"] = np.bincount(words.row[covered], minlength=n)

    echo = (words.hash[1:] == words.hash[:-1]) & (words.row[1:] == words.row[:-1])
    out["n_echoes"] = np.bincount(words.row[1:][echo], minlength=n)
    return {k: out[k].astype(np.int64) for k in (*STATISTICS, *_MORE)}


def base_failed(s: dict[str, np.ndarray]) -> np.ndarray:
    return (s["n_words"] < MIN_WORDS) | (100 * s["n_repeat_words"] > REPEAT_PERCENT * s["n_words"])


FEATURES = ("symbols", "repeated lines", "repeated words", "word length", "marks", "capitals", "echoes")


def features(s: dict[str, np.ndarray]) -> np.ndarray:
    """What the forests split on, a row per text and a column per entry of FEATURES."""
    words, chars = np.maximum(s["n_words"], 1), np.maximum(s["word_chars"], 1)
    return np.column_stack(
        [
            s["n_symbols"] / words,
            s["n_dup_lines"] / np.maximum(s["n_lines"], 1),
            s["n_repeat_words"] / words,
            s["word_chars"] / words,
            s["n_marks"] / words,
            s["n_upper"] / chars,
            s["n_echoes"] / words,
        ]
    )


@dataclass(frozen=True)
class Forest:
    """Trees as arrays: node k of a tree has children 2k+1 and 2k+2; a split of -1 is a leaf."""

    split: np.ndarray
    value: np.ndarray
    depth: np.ndarray
    threshold: float = -np.inf

    def path_lengths(self, x: np.ndarray) -> np.ndarray:
        """The mean path length of each row."""
        total = np.zeros(len(x))
        rows = np.arange(len(x))
        for split, value, depth in zip(self.split, self.value, self.depth, strict=True):
            node = np.zeros(len(x), np.int64)
            while True:
                at = split[node]
                inner = at >= 0
                if not inner.any():
                    break
                right = x[rows, np.maximum(at, 0)] >= value[node]
                node = np.where(inner, 2 * node + 1 + right, node)
            total += depth[node]
        return total / max(len(self.split), 1)


@dataclass(frozen=True)
class Gates:
    """Forests with thresholds; a row is odd if its path in one of them is shorter than the threshold."""

    forests: tuple[Forest, ...]

    def margins(self, x: np.ndarray) -> np.ndarray:
        """By how much the path is above the threshold, in the forest where that is least; below 0 is odd."""
        out = np.full(len(x), np.inf)
        for f in self.forests:
            out = np.minimum(out, f.path_lengths(x) - f.threshold)
        return out


def _rest(n: int) -> float:
    """The mean path of an unsuccessful search among n rows, what a leaf of n rows still hides."""
    return 0.0 if n <= 1 else 2 * (np.log(n - 1) + np.euler_gamma) - 2 * (n - 1) / n if n > 2 else 1.0


def grow(x: np.ndarray, columns: tuple[int, ...], trees: int = 50, rows: int = 256, seed: int = 11) -> Forest:
    """Random trees over some columns, each on up to ``rows`` rows, to the usual depth of log2(rows)."""
    rng = np.random.default_rng(seed)
    columns = np.array(columns)
    height = int(np.ceil(np.log2(max(min(rows, len(x)), 2))))
    size = 2 ** (height + 1) - 1
    split, value, depth = np.full((trees, size), -1), np.zeros((trees, size)), np.zeros((trees, size))
    for t in range(trees):
        stack = [(0, 0, rng.choice(len(x), min(rows, len(x)), replace=False))]
        while stack:
            node, level, own = stack.pop()
            low, high = x[own].min(0), x[own].max(0)
            wide = columns[(high > low)[columns]]
            if level == height or len(own) <= 1 or not len(wide):
                depth[t, node] = level + _rest(len(own))
                continue
            d = rng.choice(wide)
            v = rng.uniform(low[d], high[d])
            v = high[d] if v <= low[d] else v
            split[t, node], value[t, node] = d, v
            right = x[own, d] >= v
            stack += [(2 * node + 1, level + 1, own[~right]), (2 * node + 2, level + 1, own[right])]
    return Forest(split, value, depth)


def _columns() -> list[tuple[int, ...]]:
    """The features of each forest: one each, then all."""
    return [*((i,) for i in range(len(FEATURES))), tuple(range(len(FEATURES)))]


_STAT_FIELDS = [T.StructField(n, T.LongType()) for n in (*STATISTICS, *_MORE)]


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The id and the statistics of every row."""
    schema = T.StructType([docs.schema[id_col], *_STAT_FIELDS])

    def run(batches):
        for batch in batches:
            for piece, texts in slices(batch, text_col):
                s = statistics(texts)
                yield pa.RecordBatch.from_arrays([piece.column(id_col), *(pa.array(v) for v in s.values())], names=[id_col, *s])

    return docs.select(id_col, text_col).mapInArrow(run, schema)


def _threshold(paths: DataFrame, path: str, left: Column, max_good_loss: float) -> float | None:
    """The threshold on a column of path lengths that rejects most bad rows less good ones, within the loss allowed; None if none fits.

    All rows count: the good ones, and the bad ones that are ``left``. A threshold must reject 5 bad rows at least, and bad rows at
    20 times the rate of good ones. Rows are counted by path length, in ranges of it, and the counts of the ranges before are added.
    """
    own = paths.filter(F.col("_good") | left).groupBy(F.col(path).alias("at"))
    counts = own.agg(F.count_if("_good").alias("g"), F.count_if(~F.col("_good")).alias("b"))
    counts = cut(counts.repartitionByRange("at").withColumn("part", F.spark_partition_id()), "paths-counted")
    ranges = counts.groupBy("part").agg(F.sum("g").alias("gs"), F.sum("b").alias("bs"), F.max("at").alias("top"))
    # A row per range: one task may hold them all.
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.select(
        "part",
        *(F.coalesce(F.sum(c).over(ahead), F.lit(0)).alias(f"{c}_ahead") for c in ("gs", "bs")),
        F.max("top").over(ahead).alias("top_ahead"),
    )
    totals = counts.agg(F.sum("g").alias("good"), F.sum("b").alias("bad")).first()
    if not totals["good"] or not totals["bad"]:
        return None
    below = Window.partitionBy("part").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    lost = (F.col("gs_ahead") + F.coalesce(F.sum("g").over(below), F.lit(0))).alias("lost")
    found = (F.col("bs_ahead") + F.coalesce(F.sum("b").over(below), F.lit(0))).alias("found")
    before = F.coalesce(F.max("at").over(below), "top_ahead").alias("before")
    tries = counts.join(F.broadcast(ranges), "part").select("at", lost, found, before)
    lost, found = F.col("lost") / F.lit(totals["good"]), F.col("found") / F.lit(totals["bad"])
    fits = (F.col("found") >= 5) & (F.col("lost") <= max_good_loss * totals["good"]) & (found >= 20 * lost)
    best = tries.filter(fits).orderBy((found - lost).desc(), "at").first()
    # Halfway to the longest path rejected, so that no labelled row lies on the threshold.
    return None if best is None else (best["at"] + best["before"]) / 2


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    quality_col: str = "quality",
    max_good_loss: float = 0.002,
    trees: int = 50,
    rows: int = 256,
) -> Gates:
    """Forests with thresholds from all labelled rows.

    A tree is grown on ``rows`` rows, as an isolation forest is; those of all trees come to the driver, as statistics, and no others.
    Each forest is calibrated on all good rows, and on all bad ones that the forests before it let pass.
    """
    labels = labels.filter(F.col(quality_col).isNotNull() & F.col(id_col).isNotNull())
    labels = labels.groupBy(F.col(id_col)).agg((F.min(quality_col) > 0).alias("_good"))
    # Statistics meet the labels, so that texts stay where they are.
    labelled = cut(measure(docs, id_col, text_col).join(labels, id_col), "labelled")
    passed = labelled.filter(
        (F.col("n_words") >= MIN_WORDS) & (100 * F.col("n_repeat_words") <= REPEAT_PERCENT * F.col("n_words"))
    )
    if passed.filter("_good").isEmpty():
        return Gates(())
    names = (*STATISTICS, *_MORE)
    # Rows for the trees go by the hash of their id; a cut of the hashes at about twice as many comes first, so that tasks send few.
    key, total = F.xxhash64(id_col), passed.count()
    near = passed if total <= 4 * trees * rows else passed.filter(key < int(-(2**63) + 2**64 * 2 * trees * rows / total))
    drawn = near.orderBy(key, id_col, *names).limit(trees * rows).select(*names).toPandas()
    x = features({k: drawn[k].to_numpy(np.int64) for k in names})
    forests = [grow(x, columns, trees, rows) for columns in _columns()]

    def run(batches):
        for batch in batches:
            own = features({k: batch.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in names})
            paths = [pa.array(f.path_lengths(own)) for f in forests]
            yield pa.RecordBatch.from_arrays([batch.column("_good"), *paths], names=schema.names)

    schema = T.StructType([T.StructField("_good", T.BooleanType()), *(T.StructField(f"p{k}", T.DoubleType()) for k in range(len(forests)))])
    paths = cut(passed.select("_good", *names).mapInArrow(run, schema), "paths")
    chosen: list[Forest] = []
    left = ~F.col("_good")
    for k, forest in enumerate(forests):
        threshold = _threshold(paths, f"p{k}", left, max_good_loss)
        if threshold is not None:
            chosen.append(replace(forest, threshold=float(threshold)))
            left = left & (F.col(f"p{k}") >= threshold)
    return Gates(tuple(chosen))


def judge(docs: DataFrame, model: Gates, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Id, statistics, ``base_failed``, ``margin`` (of the path over the threshold; infinite without one) and ``kept`` for every row."""
    own = [T.StructField("base_failed", T.BooleanType()), T.StructField("margin", T.DoubleType()), T.StructField("kept", T.BooleanType())]
    schema = T.StructType([docs.schema[id_col], *_STAT_FIELDS, *own])

    def run(batches):
        for batch in batches:
            for piece, texts in slices(batch, text_col):
                s = statistics(texts)
                failed, margins = base_failed(s), model.margins(features(s))
                columns = [piece.column(id_col), *(pa.array(v) for v in s.values())]
                columns += [pa.array(failed), pa.array(margins), pa.array(~failed & (margins >= 0))]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return docs.select(id_col, text_col).mapInArrow(run, schema)


def keep(docs: DataFrame, model: Gates, text_col: str = "text") -> DataFrame:
    """The rows that pass, with all their columns."""

    def run(batches):
        for batch in batches:
            for piece, texts in slices(batch, text_col):
                s = statistics(texts)
                yield piece.filter(pa.array(~base_failed(s) & (model.margins(features(s)) >= 0)))

    return docs.mapInArrow(run, docs.schema)
