"""Substring removal by bucket-pointer refinement of suffixes.

The suffixes of the candidate texts start in buckets by their first eight
bytes. A bucket is then refined by sorting its suffixes on the bucket
identifiers found at a later offset: identifiers for 8 bytes at offsets 0 and 8
give those for 16, these give 32, and two of these, 18 bytes apart, give the 50
that a match needs; each step reuses the identifiers of the step before. A
suffix alone in its bucket is done and takes no part in later steps.

The candidates come from ``window_exchange``: 50-byte strings that meet in a
bucket by the smallest hash of their 16-byte grams.

Every byte covered by a 50-byte string that also starts in a document with a
smaller id is removed, judged on the input. Defined results: a NULL text is
empty; a text under 50 bytes stays whole; equal ids do not remove from each
other; a NULL id comes after all others; every input row gives one row.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from slicewright.llm.window_exchange import NO_SIDE, SIDE_BITS, Units, kept_ranges, mixed, remove_repeats, sliding_min

WIDTH, GRAM = 50, 16
#: Bytes on one side of a gram: every window has as many on its left or on its right.
HALF = (WIDTH - GRAM + 1) // 2
PLACES = np.arange(1 << 16, dtype=np.uint64)
ODD = [np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0xBF58476D1CE4E5B9)]


def eight_grams(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on, as one number; a view."""
    return np.ndarray((max(0, len(data) - 7),), "<u8", data, strides=(1,))


def minimisers(text: bytes, low: int, high: int) -> np.ndarray:
    eight = eight_grams(np.frombuffer(text, np.uint8, high - low + WIDTH - 1, low)).astype(np.uint64)
    gram = (eight[:-8] * ODD[0]) ^ (eight[8:] * ODD[1])
    gram ^= gram >> np.uint64(29)
    gram *= ODD[2]
    gram &= ~PLACES[-1]
    gram |= PLACES[: len(gram)]
    return sliding_min(gram, WIDTH - GRAM + 1)


def sides(texts: list[bytes], row: np.ndarray, at: np.ndarray) -> np.ndarray:
    """A byte (1 to 254) for the 17 bytes before each gram and one for those after it."""
    size = np.array([len(t) for t in texts], np.int64)
    data = np.frombuffer(b"".join(texts), np.uint8)
    eight = eight_grams(data)
    place = at + (np.cumsum(size) - size)[row]

    def side(start: np.ndarray, there: np.ndarray) -> np.ndarray:
        start = np.where(there, start, 0)
        x = mixed(eight[start]) + eight[start + 8]
        x = mixed(mixed(x) + eight[start + HALF - 8])
        return np.where(there, (x >> np.uint64(32)) % np.uint64(254) + np.uint64(1), np.uint64(NO_SIDE))

    left = side(place - HALF, at >= HALF)
    return left << SIDE_BITS | side(place + GRAM, at + GRAM + HALF <= size[row])


def refined(first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of each pair of identifiers, and which are alone in theirs.

    Sorts on a scramble of the pair, and on the pair itself should two different
    pairs ever share one.
    """
    scramble = mixed(mixed(first) + second)
    order = np.argsort(scramble)
    a, b, s = first[order], second[order], scramble[order]
    differs = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    if (differs & (s[1:] == s[:-1])).any():
        order = np.lexsort((second, first))
        a, b = first[order], second[order]
        differs = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    number = np.concatenate([[0], np.cumsum(differs)]).astype(np.uint64)
    bucket = np.empty(len(first), np.uint64)
    bucket[order] = number
    edge = np.concatenate([[True], differs, [True]])
    alone = np.empty(len(first), bool)
    alone[order] = edge[1:] & edge[:-1]
    return bucket, alone


def classes(strings: list[bytes], keys: np.ndarray) -> np.ndarray:
    """Number of the 50-byte string at each window of the strings, equal for equal ones."""
    data = np.frombuffer(b"".join(strings), np.uint8)
    size = np.array([len(s) for s in strings], np.int64)
    windows = size - (WIDTH - 1)
    start = np.repeat(np.cumsum(size) - size - (np.cumsum(windows) - windows), windows) + np.arange(windows.sum())
    eight = eight_grams(data).astype(np.uint64)
    sixteen, alone = refined(eight[:-8], eight[8:])
    done = alone[start]
    for offset in (16, 32, 34):  # a window is settled as soon as a part of it is unique
        done |= alone[start + offset]
    open_ = start[~done]
    out = np.arange(len(start), dtype=np.int64) + len(start)
    if len(open_):
        need = np.unique(np.concatenate([open_, open_ + 18]))
        wider, _ = refined(sixteen[need], sixteen[need + 16])
        full, _ = refined(wider[np.searchsorted(need, open_)], wider[np.searchsorted(need, open_ + 18)])
        out[~done] = full.astype(np.int64)
    return out


BYTES = Units(WIDTH, lambda text: text, minimisers, lambda text, a, b: text[a:b], classes, len, sides, b"".join)


def _finish(doc, text: bytes, gone: list) -> tuple:
    kept = b"".join([text[a:b] for a, b in kept_ranges(len(text), gone)])
    return doc, len(text), len(text) - len(kept), len(gone), kept


def remove_repeated_bytes(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **sizes) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans`` and the ``kept`` bytes of each row."""
    result = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"
    return remove_repeats(docs, BYTES, _finish, result, id_col=id_col, text_col=text_col, **sizes)
