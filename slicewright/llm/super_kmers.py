"""Substring removal over words by super-k-mer partitioning.

A window is 50 words in a row; its minimiser is the smallest hash of the
eight-word grams it holds. Consecutive windows with one minimiser, a
super-k-mer, travel as one packed string to the minimiser's bucket, where the
windows are cut out again and sorted: equal ones lie side by side and are
compared word for word, so counts are exact. See ``window_exchange`` for the
way there and back.

Every word covered by a window whose words also start in a document with a
smaller id is removed, judged on the input. Defined results: a NULL text has no
words; a text under 50 words stays whole; white space between words does not
count; equal ids do not remove from each other; a NULL id comes after all
others; every input row gives one row.
"""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import DataFrame

from slicewright.llm.window_exchange import Units, kept_ranges, mixed, remove_repeats, sliding_min

WIDTH, GRAM = 50, 8
STEP = np.uint64(0x9E3779B97F4A7C15)
#: Word hashes that a worker remembers before it starts afresh.
MEMORY = 200_000


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


HASHES = WordHashes()


class Words:
    """The words of a UTF-8 text; bytes.split cuts at the same six characters as a word does."""

    def __init__(self, text: bytes):
        self.words = text.split()
        self.hashes = None

    def __len__(self) -> int:
        return len(self.words)

    def hashed(self) -> np.ndarray:
        if self.hashes is None:
            if len(HASHES) > MEMORY:
                HASHES.clear()
            self.hashes = np.fromiter(map(HASHES.__getitem__, self.words), np.uint64, len(self.words))
        return self.hashes


def minimisers(text: Words, low: int, high: int) -> np.ndarray:
    h = text.hashed()[low : high + WIDTH - 1]
    gram = h[: len(h) - GRAM + 1]
    for j in range(1, GRAM):
        gram = gram * STEP + h[j : len(h) - GRAM + 1 + j]
    return sliding_min(mixed(gram), WIDTH - GRAM + 1)


def windows_of(string: bytes) -> list[bytes]:
    words = string.split(b" ")
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = [0, *(ends + 1).tolist()]
    return [string[a:b] for a, b in zip(starts, ends[WIDTH - 1 :].tolist())]


def classes(strings: list[bytes], keys: np.ndarray) -> np.ndarray:
    """Number of the 50 words at each window of the strings, equal for equal ones."""
    windows = np.array([s.count(b" ") + 2 - WIDTH for s in strings], np.int64)
    start = (np.cumsum(windows) - windows).tolist()
    out = np.arange(windows.sum(), dtype=np.int64)
    order = np.argsort(keys, kind="stable")
    edges = np.flatnonzero(np.concatenate([[True], keys[order][1:] != keys[order][:-1]]))
    for group in np.split(order, edges[1:]):
        if len(group) == 1:
            continue  # repeats inside one run are of one document
        found = sorted((w, start[g] + i) for g in group.tolist() for i, w in enumerate(windows_of(strings[g])))
        last, number = None, 0
        for window, place in found:
            if window != last:
                last, number = window, place
            out[place] = number
    return out


WORDS = Units(WIDTH, Words, minimisers, lambda text, a, b: b" ".join(text.words[a:b]), classes, lambda s: s.count(b" ") + 1)


def _finish(doc, text: bytes, gone: list) -> tuple:
    words = text.split()
    kept = [w for a, b in kept_ranges(len(words), gone) for w in words[a:b]]
    return doc, len(words), len(words) - len(kept), b" ".join(kept).decode("utf-8", "replace")


def remove_repeated_words(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **sizes) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_removed`` and the ``kept`` text of each row."""
    result = "doc_id long, n_words long, n_removed long, kept string"
    return remove_repeats(docs, WORDS, _finish, result, id_col=id_col, text_col=text_col, **sizes)
