"""Toxicity scores from a weighted lexicon that is learned from labelled rows.

Folding: letters are lower-cased, accents, zero-width characters and combining marks go, letters of other scripts that look like Latin ones
become these, digits and symbols that stand for letters become them (1, ! and | may be i or l, so l is folded to i as well; $, @, ! and | count as
letters only in front of a letter or digit). All else parts words, which one space then separates. Texts and lexicon are folded alike.

The lexicon holds words and beginnings of words (with ``*``), each with a weight: the log ratio of its share of toxic rows to
its share of the others. Candidates are all words and their beginnings of 4 to 8 letters; one is taken if it is LEAST_RATIO times
as frequent in toxic rows and chance would hardly give that to any of the candidates (a Chernoff bound times their number).
Of a beginning and its continuations the longest that covers 95 % of the rows is kept. SEEDS are entries from the start, until rows
speak against them. Exception phrases are given, or learned: an entry with a neighbour that stands mostly in rows that are not toxic.

An Aho-Corasick automaton over all entries and phrases runs over the whole folded text. A word counts once, with its best entry;
words inside an exception phrase do not count. The sum of weights, over the number of words plus PADDING, is the density; a logistic curve
of its logarithm, fitted to the same rows, gives the score, with the share of toxic rows among all labelled ones as the prior.

Only rows whose crc32 of the id modulo 3 is not 1 are learned from, at most ``sample_rows`` toxic and as many others, those with the
smallest hash of their id. Scores are of whole texts and use nothing but the text. Null and empty texts have density 0. Without
labels of both kinds the seeds alone score, on a fixed curve. Null labels and labels without an id are left out; of repeated labels the highest
counts, of repeated rows one is learned from. A null id is not held out. Repeated rows are scored each on their own; extra columns are not read.
"""

from __future__ import annotations

import functools
import math
import unicodedata
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lazaret.llm.tables import cut, sampled_ids
from lazaret.llm.text import Texts, slices

# Letters of other scripts, Latin letters without a decomposition, and digits, by the Latin letter they stand for.
LOOKALIKES = {
    "a": "аα4", "b": "вβ8ƀ", "c": "сϲ¢", "d": "ԁđð", "e": "еεє3€", "f": "ƒ", "g": "ɡ9", "h": "һн", "i": "іιɪ1ı", "j": "јϳ", "k": "кκ",
    "l": "ӏłⅼ", "m": "мµ", "n": "пηñ", "o": "оοσø0", "p": "рρþ", "q": "ԛ", "r": "гɾ", "s": "ѕ5ʂ", "t": "тτ7", "u": "υʋ", "v": "ѵν", "w": "ѡωԝ",
    "x": "хχ×", "y": "уγү¥", "z": "ʐ2",
}
# Symbols that stand for a letter in front of another one.
SYMBOLS = {"$": "s", "@": "a", "!": "i", "|": "i"}
# Plain insults in four languages, and phrases in which such words are none.
SEEDS = (
    "idiot", "idiots", "moron", "morons", "imbecile", "stupid", "dumb", "loser", "losers", "scum", "trash", "worthless", "pathetic",
    "bastard", "trottel", "depp", "dummkopf", "abschaum", "schwachkopf", "crétin", "abruti", "connard", "imbécile", "idiota", "estúpido",
    "imbécil", "escoria",
)
EXCEPTIONS = ("trash can", "trash cans", "trash bag", "idiot proof", "idiot savant", "sore loser", "dumb bell", "dumb waiter", "pond scum")

SEED_WEIGHT, LEAST_RATIO, CHANCE = 3.0, 8.0, 0.1
SHORTEST, LONGEST, LETTERS = 4, 8, 40
PADDING, FLOOR = 10, 1e-3

_BREAK, _OTHER, _DROP = 0, 0x7E, 255


@functools.cache
def _table() -> np.ndarray:
    """The folded byte of each code point: a small letter, a capital for a symbol that may be one, ``~`` for other letters."""
    table = np.full(0x110000, _BREAK, np.uint8)
    for c in range(0x30, 0x30000):
        if 0xD800 <= c < 0xE000:
            continue
        char = chr(c)
        kind = unicodedata.category(char)
        if kind[0] == "M" or kind == "Cf":
            table[c] = _DROP
        elif kind[0] in "LN":
            parts = unicodedata.normalize("NFKD", char).lower()
            base = [x for x in parts if unicodedata.category(x)[0] != "M"]
            table[c] = ord(base[0]) if len(base) == 1 and base[0].isascii() and base[0].isalpha() else _OTHER
    table[0xAD] = _DROP
    for letter, others in LOOKALIKES.items():
        for char in others:
            table[ord(char)] = table[ord(char.upper()[0])] = ord(letter)
    table[ord("1")] = ord("i")
    for symbol, letter in SYMBOLS.items():
        table[ord(symbol)] = ord(letter) - 32
    table[(table == ord("l"))] = ord("i")
    return table


def folded(texts: Texts) -> Texts:
    """The texts as words of small letters (and ``~``), with one space before each word and one behind the last."""
    table = _table()
    points = np.frombuffer(texts.data.tobytes().decode("utf-8", "replace").encode("utf-32-le", "replace"), np.uint32)
    first = np.concatenate([[0], np.cumsum((texts.data & 0xC0) != 0x80)])[texts.offsets]
    letters = np.insert(table[points], first, _BREAK)  # a break before each row, and one at the end
    first = first + np.arange(len(first))
    kept = letters != _DROP
    first = np.concatenate([[0], np.cumsum(kept)])[first]
    letters = letters[kept]
    soft = (letters >= 65) & (letters <= 90)
    follows = np.append((letters[1:] >= 97), False)
    letters = np.where(soft, np.where(follows, letters + 32, _BREAK), letters).astype(np.uint8)
    breaks = letters == _BREAK
    starts = np.zeros(len(letters), bool)
    starts[first] = True
    # Of a run of breaks one stays; each row has one at its start.
    stays = ~breaks | starts | np.append(False, ~breaks[:-1])
    first = np.concatenate([[0], np.cumsum(stays)])[first]
    letters = letters[stays]
    letters[letters == _BREAK] = 32
    return Texts(letters, first)


def folded_text(text: str) -> str:
    data = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    return folded(Texts(data, np.array([0, len(data)], np.int64))).data.tobytes().decode("ascii").strip()


@dataclass(frozen=True)
class Model:
    """Folded entries with weights (a trailing ``*`` for beginnings), folded exception phrases, and the curve's slope and height."""

    entries: tuple[tuple[str, float], ...]
    exceptions: tuple[str, ...]
    slope: float = 2.0
    height: float = 7.0

    def scores(self, density: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * np.log(density + FLOOR) + self.height, -500, 500)))


@functools.lru_cache(maxsize=8)
def _automaton(entries: tuple[tuple[str, float], ...], exceptions: tuple[str, ...]):
    import ahocorasick

    made = ahocorasick.Automaton()
    for entry, weight in entries:
        text = " " + entry.rstrip("*") if entry.endswith("*") else f" {entry} "
        made.add_word(text, (len(text), weight))
    for phrase in exceptions:
        made.add_word(f" {phrase} ", (len(phrase) + 2, None))
    if len(made):
        made.make_automaton()
    return made


def matches(words: Texts, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Places and weights of the words that count, in the folded texts taken as one; a place is that of the space before the word."""
    automaton = _automaton(model.entries, model.exceptions)
    if not len(automaton):
        return np.zeros(0, np.int64), np.zeros(0)
    best: dict[int, float] = {}
    spans = []
    for end, (length, weight) in automaton.iter(words.data.tobytes().decode("ascii")):
        at = end - length + 1
        if weight is None:
            spans.append((at, end))
        elif weight > best.get(at, 0):
            best[at] = weight
    places = np.array(sorted(best), np.int64)
    weights = np.array([best[p] for p in places.tolist()], float)
    if spans and len(places):
        inside = np.zeros(len(places), bool)
        for a, b in spans:
            inside[np.searchsorted(places, a) : np.searchsorted(places, b)] = True
        places, weights = places[~inside], weights[~inside]
    return places, weights


def measured(texts: Texts, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words, words that count, and the density of each text."""
    words = folded(texts)
    places, weights = matches(words, model)
    rows = np.searchsorted(words.offsets, places, side="right") - 1
    spaces = np.concatenate([[0], np.cumsum(words.data == 32)])[words.offsets]
    # A row has a space before each word and may have one behind the last.
    ends = words.offsets[1:] - 1
    n = np.diff(spaces) - (words.data[ends] == 32)
    hits = np.bincount(rows, minlength=len(n))
    return n.astype(np.int64), hits.astype(np.int64), np.bincount(rows, weights, minlength=len(n)) / (n + PADDING)


def _counted(sample: DataFrame, parts) -> DataFrame:
    """(part, toxic, other): rows of either kind that hold each part, which ``parts`` gives for a row's folded words."""

    def run(batches):
        counts: Counter = Counter()
        for batch in batches:
            for piece, texts in slices(batch, "text"):
                words = folded(texts)
                line = words.data.tobytes().decode("ascii")
                for a, b, label in zip(words.offsets[:-1].tolist(), words.offsets[1:].tolist(), piece.column("toxic").to_pylist(), strict=True):
                    counts.update((part, label) for part in parts(line[a:b].split()))
            if len(counts) > 1_000_000:
                yield _emitted(counts)
                counts.clear()
        yield _emitted(counts)

    def _emitted(counts):
        keys = list(counts)
        own = [counts[k] for k in keys]
        toxic = [n if label else 0 for (_, label), n in zip(keys, own, strict=True)]
        other = [0 if label else n for (_, label), n in zip(keys, own, strict=True)]
        return pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.string()), pa.array(toxic, pa.int64()), pa.array(other, pa.int64())], names=["part", "toxic", "other"])

    counted = sample.select("text", "toxic").mapInArrow(run, "part string, toxic long, other long")
    return counted.groupBy("part").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))


def _candidates(words: list[str]) -> set[str]:
    out = {w for w in words if 3 <= len(w) <= LETTERS}
    return out | {f"{w[:n]}*" for w in out for n in range(SHORTEST, min(LONGEST, len(w) - 1) + 1)}


def _trimmed(found: dict[str, tuple[float, int]]) -> dict[str, float]:
    """Of a beginning and what continues it, the longest that covers nearly as many rows; ``found`` has weight and toxic rows."""
    starts = {e[:-1]: n for e, (_, n) in found.items() if e.endswith("*")}
    covered = set()
    for entry, (_, n) in found.items():
        stem = entry.rstrip("*")
        for size in range(SHORTEST, min(LONGEST, len(stem)) + 1):
            if (stem[:size] != stem or not entry.endswith("*")) and n >= 0.95 * starts.get(stem[:size], math.inf):
                covered.add(f"{stem[:size]}*")
    kept = {e: w for e, (w, _) in found.items() if e not in covered}
    # A word whose beginning says as much need not be kept.
    spare = set()
    for entry in kept:
        stem = entry.rstrip("*")
        for size in range(SHORTEST, len(stem) + (0 if entry.endswith("*") else 1)):
            if kept.get(f"{stem[:size]}*", -math.inf) >= kept[entry] - 0.5:
                spare.add(entry)
    return {e: w for e, w in kept.items() if e not in spare}


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    toxic_col: str = "toxic",
    sample_rows: int = 10_000,
    seeds: tuple[str, ...] = SEEDS,
    exceptions: tuple[str, ...] = EXCEPTIONS,
) -> Model:
    """The lexicon and curve from at most ``sample_rows`` rows of either label. Counts and densities come to the driver, texts do not."""
    phrases = {folded_text(p) for p in exceptions}
    entries = {folded_text(s): SEED_WEIGHT for s in seeds}
    start = Model(tuple(sorted(entries.items())), tuple(sorted(phrases)))
    own = labels.filter(F.col(toxic_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(id_col))
    own = cut(own.groupBy(F.col(id_col).alias("id")).agg((F.max(toxic_col) > 0).alias("toxic")), "labels")
    totals = {r["toxic"]: r["count"] for r in own.groupBy("toxic").count().collect()}
    if len(totals) < 2:
        return start
    picked = sampled_ids(own.filter("toxic").select("id"), "id", sample_rows).withColumn("toxic", F.lit(True))
    picked = cut(picked.unionByName(sampled_ids(own.filter("not toxic").select("id"), "id", sample_rows).withColumn("toxic", F.lit(False))), "picked")
    # sample_rows bounds what is sent to the tasks, so that texts stay where they are.
    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(picked), "id")
    sample = cut(slim.dropDuplicates(["id"]), "sample")
    n = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    if len(n) < 2:
        return start
    share = n[True] / (n[True] + n[False])

    counted = cut(_counted(sample, _candidates).filter("toxic + other >= 3"), "candidates")
    tries = counted.count()
    both = F.col("toxic") + F.col("other")
    ratio = F.log(((F.col("toxic") + 0.5) / (n[True] + 1)) / ((F.col("other") + 0.5) / (n[False] + 1)))
    q = F.col("toxic") / both
    # Chance that so many of the rows are toxic: at most exp(-rows * divergence of the shares).
    far = both * (q * F.log(q / share) + F.when(q < 1, (1 - q) * F.log((1 - q) / (1 - share))).otherwise(0.0))
    counted = counted.withColumn("weight", ratio)
    sure = (F.col("weight") >= math.log(LEAST_RATIO)) & (q > share) & (far >= math.log(max(tries, 1) / CHANCE))
    found = {r["part"]: (r["weight"], r["toxic"]) for r in counted.filter(F.col("toxic") > 0).filter(sure).collect()}
    refuted = counted.filter(F.col("part").isin(sorted(entries)) & (both >= 5) & (F.col("weight") < math.log(2))).collect()
    for r in refuted:
        entries.pop(r["part"])
    entries |= _trimmed(found)

    model = Model(tuple(sorted(entries.items())), tuple(sorted(phrases)))
    # Only a part with an entry may be a phrase, so the count stays small.
    stems = tuple(e[:-1] for e in entries if e.endswith("*"))

    def pairs(words):
        return {f"{a} {b}" for a, b in zip(words, words[1:], strict=False) for w in (a, b) if w in entries or w.startswith(stems)}

    benign = _counted(sample, pairs).filter(F.col("other") >= 5).filter(ratio < -math.log(4)).select("part").collect()
    model = Model(model.entries, tuple(sorted(phrases | {r["part"] for r in benign})))

    rows = _measured_rows(sample, model, ["toxic"]).select("toxic", "density").toPandas()
    slope, height = _curve(np.log(rows["density"].to_numpy(float) + FLOOR), rows["toxic"].to_numpy(bool), totals[True] / (totals[True] + totals[False]))
    return Model(model.entries, model.exceptions, slope, height)


def _curve(x: np.ndarray, toxic: np.ndarray, prior: float) -> tuple[float, float]:
    """Slope (0 or more) and height of a logistic curve by Newton's method, with a small ridge, both kinds weighted to the prior."""
    weight = np.where(toxic, prior / toxic.sum(), (1 - prior) / (~toxic).sum()) * len(x)
    middle = x.mean()
    features = np.column_stack([x - middle, np.ones(len(x))])
    beta = np.zeros(2)
    ridge = np.diag([0.1, 1e-6])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(features @ beta, -30, 30)))
        slope = features.T @ (weight * (toxic - p)) - ridge @ beta
        curve = (features * (weight * np.maximum(p * (1 - p), 1e-9))[:, None]).T @ features + ridge
        step = np.linalg.solve(curve, slope)
        beta = beta + step * min(1, 5 / max(np.abs(step).max(), 1e-9))
        if np.abs(step).max() < 1e-8:
            break
    if beta[0] <= 0:
        return 0.0, math.log(prior / (1 - prior))
    return float(beta[0]), float(beta[1] - beta[0] * middle)


def held_out(id_col: str):
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


def _measured_rows(rows: DataFrame, model: Model, columns: list[str]) -> DataFrame:
    added = [T.StructField("n_words", T.LongType()), T.StructField("n_hits", T.LongType()), T.StructField("density", T.DoubleType())]
    schema = T.StructType([*(rows.schema[c] for c in columns), *added])

    def run(batches):
        for batch in batches:
            for piece, texts in slices(batch, "text"):
                found = measured(texts, model)
                yield pa.RecordBatch.from_arrays([*(piece.column(c) for c in columns), *(pa.array(x) for x in found)], names=schema.names)

    return rows.select(*columns, "text").mapInArrow(run, schema)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.7) -> DataFrame:
    """(id, held_out, score, predicted, n_words, n_hits) of every row."""
    rows = docs.select(F.col(id_col).alias("id"), held_out(id_col).alias("held_out"), F.col(text_col).alias("text"))
    found = _measured_rows(rows, model, ["id", "held_out"])
    x = F.lit(model.slope) * F.log(F.col("density") + FLOOR) + F.lit(model.height)
    value = 1 / (1 + F.exp(-x))
    return found.select(
        F.col("id").alias(id_col), "held_out", value.alias("score"), F.when(value >= threshold, 1).otherwise(0).alias("predicted"), "n_words", "n_hits"
    )
