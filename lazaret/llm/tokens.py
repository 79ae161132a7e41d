"""Token ids of many texts with a public tokenizer file, whose path is a parameter.

A tokenizer whose pieces never span white space gives a text the ids of its words, one after the other, and a plain word those
of its letters, digits and marks. Most of these parts come again and again, so a worker keeps the ids of those it has met; when
there are too many it starts anew.
"""

from __future__ import annotations

import functools
import json
import os
import re

import numpy as np
import pyarrow as pa
import regex

from lazaret.llm.text import LOWER, SPACE, Texts, slices

#: Words kept with their ids, per worker.
KNOWN_WORDS = 500_000

#: Words of letters, digits and marks of Latin scripts, which have one normal form and letter by letter a lower case.
_PLAIN = re.compile("[\x21-\x7b\x7d\x7e\xa1-\u012f\u0131-\u0233]+")


def path(name: str) -> str:
    """The place of a public tokenizer file on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


@functools.lru_cache(maxsize=4)
def encoder(tokenizer: str) -> Encoder:
    """The encoder of a tokenizer file, one per worker. A bare name is a public tokenizer."""
    return Encoder(tokenizer if os.path.sep in tokenizer else path(tokenizer))


def _byte_letters() -> dict[int, str]:
    """How byte-level tokenizers write the bytes of a character: a printable one as itself, others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = (b for b in range(256) if b not in plain)
    letters = {b: chr(b) for b in plain} | {b: chr(0x100 + i) for i, b in enumerate(others)}
    return {c: "".join(letters[b] for b in chr(c).encode()) for c in range(0x21, 0x250)}


def _classes() -> np.ndarray:
    """Of each byte: 0 white space, 1 part of a letter, 2 digit, 3 other mark, 4 none of these in every word."""
    out = np.full(256, 4, np.uint8)
    out[0x21:0x7F] = 3
    out[[ord("'"), ord("|")]] = 4
    out[0x30:0x3A] = 2
    out[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0xC0), *range(0xC3, 0xC9)]] = 1
    out[SPACE] = 0
    return out


_CLASS = _classes()
# Two-byte characters from U+00C0 to U+023F that are no letters, have no lower case of one letter, or came late.
_NO_LETTER = np.array([0xC397, 0xC3B7, 0xC4B0, *range(0xC8B4, 0xC8C0)], np.uint16)


def parts_of(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and lengths of the parts of all words: runs of letters, single digits, runs of marks; and their bytes, A-Z folded.

    A word with other characters, an apostrophe or a bar is one part and stays as it is, as how it is cut depends on more than single characters.
    """
    kind = _CLASS[texts.data]
    n = len(kind)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), texts.data
    inner = kind > 0
    first = np.ones(n, bool)
    first[1:] = ~inner[:-1]
    edge = texts.offsets[:-1]
    first[edge[edge < n]] = True
    first &= inner
    odd = kind == 4
    lead = np.flatnonzero((texts.data[:-1] == 0xC3) | (texts.data[:-1] == 0xC4) | (texts.data[:-1] == 0xC8))
    pairs = texts.data[lead].astype(np.uint16) << np.uint16(8) | texts.data[lead + 1]
    odd[lead[np.isin(pairs, _NO_LETTER)]] = True
    word = np.cumsum(first)  # of each byte, from 1
    whole = np.zeros(int(word[-1]) + 1, bool)
    whole[word[odd]] = True
    cut = np.zeros(n, bool)
    cut[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == 2)
    cut &= inner & ~whole[word]
    start = np.flatnonzero(first | cut)
    # Bytes that are no white space belong to the part that began last.
    spaces = np.concatenate([[0], np.cumsum(~inner)])
    ends = np.append(start[1:], n)
    packed = np.where(whole[word], texts.data, LOWER[texts.data])[inner]
    return start, ends - start - (spaces[ends] - spaces[start]), packed


class Encoder:
    def __init__(self, file: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(file)
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.width = 2 if size <= 65_536 else 4
        self.kind = np.dtype(f"<u{self.width}")
        with open(file, encoding="utf-8") as f:
            about = json.load(f)
        steps = [s["type"] for s in (about["normalizer"] or {}).get("normalizers", [])]
        cuts = (about["pre_tokenizer"] or {}).get("pretokenizers", [{"type": ""}])
        #: Whether words can be encoded one by one, and plain words by the model alone.
        self.by_word = (
            steps == ["NFC", "Replace", "Lowercase"]
            and [s["type"] for s in cuts] == ["Split", "ByteLevel"]
            and (cuts[0]["behavior"], cuts[0]["invert"]) == ("Removed", True)
            and not (cuts[1]["add_prefix_space"] or cuts[1]["use_regex"])
            and about["post_processor"] is None
            and all("|" in x["content"] for x in about["added_tokens"])  # so no plain word holds one
        )
        if self.by_word:
            self._pattern = regex.compile(cuts[0]["pattern"]["Regex"])
            self._letters = _byte_letters()
        self._forget()

    def _forget(self) -> None:
        self._known: dict[str, int] = {}
        self._ids = [np.zeros(0, self.kind)]
        self._edges = [np.zeros(1, np.int64)]

    def _encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        got = [x.ids for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)] if texts else []
        counts = np.fromiter(map(len, got), np.int64, len(got))
        return np.fromiter((i for x in got for i in x), self.kind, int(counts.sum())), counts

    def _encode_parts(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        tokenize, letters, find, plain = self.tokenizer.model.tokenize, self._letters, self._pattern.findall, _PLAIN.fullmatch
        out: list[int] = []
        ends = [0]
        for part in parts:
            if plain(part):
                part = part.lower()
                for run in (part,) if part.isalpha() else find(part):
                    out.extend([x.id for x in tokenize(run if run.isascii() else run.translate(letters))])
            else:
                out.extend(self.tokenizer.encode(part, add_special_tokens=False).ids)
            ends.append(len(out))
        return np.array(out, self.kind), np.diff(np.array(ends, np.int64))

    def _numbers(self, words: list[str]) -> np.ndarray:
        """The numbers of words in the store; new ones are encoded."""
        if len(self._known) + len(words) > KNOWN_WORDS:
            self._forget()
        known = self._known
        new = [w for w in words if w not in known]
        if new:
            ids, counts = self._encode_parts(new)
            first = len(known)
            known.update(zip(new, range(first, first + len(new)), strict=True))
            self._ids.append(ids)
            self._edges.append(self._edges[-1][-1] + np.cumsum(counts))
            if len(self._ids) > 16:
                self._ids, self._edges = [np.concatenate(self._ids)], [np.concatenate(self._edges)]
        return np.fromiter((known[w] for w in words), np.int64, len(words))

    def __call__(self, batch: pa.RecordBatch, text: str, end_id: int):
        """Parts of the batch, their ids (each text's with the end id behind) and each text's number of ids."""
        for piece, texts in slices(batch, text):
            ids, counts = self._by_parts(texts) if self.by_word else self._encode(piece.column(text).fill_null("").to_pylist())
            edges = np.concatenate([[0], np.cumsum(counts)])
            out = np.full(len(ids) + len(counts), end_id, self.kind)
            inner = np.ones(len(out), bool)
            inner[edges[1:] + np.arange(len(counts))] = False
            out[inner] = ids
            yield piece, out, counts + 1

    def _by_parts(self, texts: Texts) -> tuple[np.ndarray, np.ndarray]:
        """Ids of each text by those of its parts, each different part looked up once."""
        start, length, packed = parts_of(texts)
        if not len(start):
            return np.zeros(0, self.kind), np.zeros(len(texts), np.int64)
        offsets = np.concatenate([[0], np.cumsum(length)])
        found = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(length), [None, pa.py_buffer(offsets), pa.py_buffer(packed)]).dictionary_encode()
        numbers = self._numbers(found.dictionary.cast(pa.large_string()).to_pylist())
        edges = np.concatenate(self._edges) if len(self._edges) > 1 else self._edges[0]
        store = np.concatenate(self._ids) if len(self._ids) > 1 else self._ids[0]
        # The ids of this slice's different parts, then of its parts in order.
        first, counts = edges[numbers], edges[numbers + 1] - edges[numbers]
        which = found.indices.to_numpy()
        sums = np.concatenate([[0], np.cumsum(counts[which])])
        ids = store[np.repeat(first[which] - sums[:-1], counts[which]) + np.arange(sums[-1])]
        rows = np.searchsorted(start, texts.offsets)
        return ids, sums[rows[1:]] - sums[rows[:-1]]
