"""Benchmark decontamination by SimHash over item-sized windows.

Texts and items are lower-cased and read as words (letters, digits,
underscore). Every window of a document that is as long as an item and shares
one shingle (five words in a row) with an item of that length gets a 64-bit
SimHash of its words; a document shorter than the item is one window as a whole; windows that share none have similarity 0, so leaving
them out loses nothing. The fingerprints of the items are indexed by
four blocks of 16 bits: two fingerprints at most ``radius`` bits apart
are at most a quarter of it apart in one block at least, so looking for every block with
so many bits changed finds them all. Each
candidate is then verified by its weighted shingle similarity: the sum of the
smaller over the sum of the larger shingle counts.

The benchmark is the stated query set. It is handed to the tasks in blocks of
at most ``BLOCK_WORDS`` words, each block against all documents, so what is
sent has a fixed bound however many items there are.

Defined results: NULL and empty texts or items match nothing; an item shorter
than a shingle is one shingle; repeated items and documents are reported each;
of several windows of a document that match an item, the most similar counts,
then the first. Only the named columns are read.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from slicewright.llm.common import pieces_of, small_slices

WORD = re.compile(r"\w+")
SHINGLE = 5
SIMILARITY = 0.8
#: Bits two fingerprints may differ in. Windows at similarity 0.8 differ in about 8 of 64, short ones in up to 21.
RADIUS = 23
#: Bits of a block of the index.
BLOCK_BITS = 16
#: Looking a block up costs about as much as so many comparisons.
LOOKUP_COST = 4
#: Pairs of blocks held at once.
PAIRS = 1 << 22
BLOCK_WORDS = 1_000_000
#: Windows whose bit sums are held at once.
STRETCH = 2_048
BITS = np.arange(64, dtype=np.uint64)


def shingles(words: list) -> list[tuple]:
    n = min(SHINGLE, len(words))
    return [tuple(words[i : i + n]) for i in range(len(words) - n + 1)] if n else []


def similarity(a: Counter, b: Counter) -> float:
    """Weighted Jaccard similarity of two shingle counts."""
    both = sum(min(n, b[s]) for s, n in a.items() if s in b)
    return both / (sum(a.values()) + sum(b.values()) - both) if both else 0.0


def signs(word: str) -> np.ndarray:
    """+1 or -1 for each bit of the word's hash."""
    return np.where(np.uint64(xxhash.xxh3_64_intdigest(word)) >> BITS & np.uint64(1), 1, -1).astype(np.int32)


def fingerprints(bits: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """SimHash of the windows that start at ``starts``; ``bits`` has a row of signs for each word."""
    sums = np.concatenate([np.zeros((1, 64), np.int32), np.cumsum(bits, 0, dtype=np.int32)])
    ones = (sums[starts + length] - sums[starts]) > 0
    return (ones.astype(np.uint64) << BITS).sum(1, dtype=np.uint64)


@lru_cache
def _changes(bits: int) -> np.ndarray:
    """All ways to change at most ``bits`` bits of a block."""
    every = np.arange(1 << BLOCK_BITS).astype(np.uint16)
    return every[np.bitwise_count(every) <= bits]


class Blocks:
    """Fingerprints of the items of one length, indexed by four blocks of 16 bits.

    Of two fingerprints at most ``radius`` bits apart, one block is at most ``radius // 4`` bits apart.
    """

    def __init__(self, prints: np.ndarray, radius: int):
        self.prints, self.radius, self.bits = prints, radius, radius // (64 // BLOCK_BITS)
        self.parts = []
        for low in range(0, 64, BLOCK_BITS):
            values = self._block(prints, low)
            order = np.argsort(values, kind="stable")
            self.parts.append((low, order, *np.unique(values[order], return_index=True, return_counts=True)))

    @staticmethod
    def _block(prints: np.ndarray, low: int) -> np.ndarray:
        return (prints >> np.uint64(low)).astype(np.uint16)

    def _alike(self, own: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in ``own`` and in the sorted ``values`` of blocks a few bits apart.

        Few values are compared one by one; among many, all changes of the own block are looked up.
        """
        changes = _changes(self.bits)
        if len(values) <= LOOKUP_COST * len(changes):
            return np.nonzero(np.bitwise_count(own[:, None] ^ values) <= self.bits)
        probes = own[:, None] ^ changes
        place = np.minimum(np.searchsorted(values, probes), len(values) - 1)
        at, change = np.nonzero(values[place] == probes)
        return at, place[at, change]

    def near(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All pairs (place in ``prints``, item) within the radius."""
        step = max(1, PAIRS // max(len(self.prints), len(_changes(self.bits))))
        pairs = []
        for begin in range(0, len(prints), step):
            some = prints[begin : begin + step]
            for low, order, values, first, count in self.parts:
                at, value = self._alike(self._block(some, low), values)
                n = count[value]
                at = np.repeat(at, n)
                item = order[np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first[value], n)]
                close = np.bitwise_count(some[at] ^ self.prints[item]) <= self.radius
                pairs.append((at[close] + begin) * len(self.prints) + item[close])
        found = np.unique(np.concatenate(pairs))
        return found // len(self.prints), found % len(self.prints)


class Vocabulary(dict):
    def __missing__(self, word: str) -> int:
        return -1


class Benchmark:
    """What a task needs to know of a block of items."""

    def __init__(self, items: list[tuple[int, str]], radius: int):
        read = [(k, WORD.findall(t.lower())) for k, t in items]
        read = sorted((k, w) for k, w in read if w)
        self.vocabulary = Vocabulary((w, i) for i, w in enumerate(dict.fromkeys(w for _, ws in read for w in ws)))
        self.items: dict[int, list[tuple[int, list[str], Counter]]] = defaultdict(list)
        self.lengths: dict[tuple, set[int]] = defaultdict(set)
        for k, words in read:
            own = shingles(words)
            self.items[len(words)].append((k, words, Counter(own)))
            for s in own:
                self.lengths[tuple(self.vocabulary[w] for w in s)].add(len(words))
        self.short = sorted({n for n in self.items if n < SHINGLE})
        self.index = {}
        for n, own in self.items.items():
            prints = [fingerprints(np.array([signs(w) for w in ws]), np.zeros(1, int), n)[0] for _, ws, _ in own]
            self.index[n] = Blocks(np.array(prints, np.uint64), radius)
        self.codes = np.array(sorted({self._code(s) for s in self.lengths}), np.uint64)

    @staticmethod
    def _code(ids: tuple) -> int:
        code = len(ids)
        for i in ids:
            code = (code * 0x9E3779B97F4A7C15 + i + 1) % 2**64
        return code

    def _meeting(self, ids: np.ndarray) -> dict[int, set[int]]:
        """By item length, the places of shingles that an item of that length has."""
        met: dict[int, set[int]] = defaultdict(set)
        for n in [*self.short, SHINGLE]:
            if len(ids) < n or not len(self.codes):
                continue
            known = ids[: len(ids) - n + 1] >= 0
            for j in range(1, n):
                known = known & (ids[j : len(ids) - n + 1 + j] >= 0)
            places = np.flatnonzero(known)
            code = np.full(len(places), n, np.uint64)
            for j in range(n):
                code = code * np.uint64(0x9E3779B97F4A7C15) + ids[places + j].astype(np.uint64) + np.uint64(1)
            at = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
            for p in places[self.codes[at] == code]:
                for length in self.lengths.get(tuple(ids[p : p + n].tolist()), ()):
                    met[length].add(int(p))
        return met

    def search(self, text: str, least: float) -> list[tuple[int, float, int, int]]:
        """(item, similarity, first word, words) of the best window for each item that has one."""
        words = WORD.findall(text.lower())
        ids = np.fromiter(map(self.vocabulary.__getitem__, words), np.int64, len(words))
        best: dict[int, tuple[float, int, int]] = {}
        for length, places in sorted(self._meeting(ids).items()):
            size = min(length, len(words))
            if size < length and (size - SHINGLE + 1) / (length - SHINGLE + 1) < least:
                continue  # too few shingles to be similar
            reach = size - min(SHINGLE, size)
            starts = sorted({s for p in places for s in range(max(0, p - reach), min(p, len(words) - size) + 1)})
            while starts:
                last = next((i for i, s in enumerate(starts) if s > starts[0] + STRETCH), len(starts))
                self._verify(words, np.array(starts[:last]), size, length, least, best)
                starts = starts[last:]
        return [(k, *v) for k, v in sorted(best.items())]

    def _verify(self, words: list[str], starts: np.ndarray, size: int, length: int, least: float, best: dict) -> None:
        """Compare the windows of ``size`` words with the items of ``length``."""
        low, high = int(starts[0]), int(starts[-1]) + size
        prints = fingerprints(np.array([signs(w) for w in words[low:high]]), starts - low, size)
        counts: dict[int, Counter] = {}
        for at, item in zip(*self.index[length].near(prints)):
            start, (key, _, own) = int(starts[at]), self.items[length][item]
            if start not in counts:
                counts[start] = Counter(shingles(words[start : start + size]))
            s = similarity(counts[start], own)
            if s >= least and (-s, start, size) < (-best.get(key, (-1.0,))[0], *best.get(key, (0, 0, 0))[1:]):
                best[key] = (s, start, size)


def _blocks(benchmark: DataFrame, item_col: str, item_text_col: str) -> Iterator[list[tuple[int, str]]]:
    """The items, in blocks of a bounded size."""
    items = benchmark.select(F.col(item_col).cast("long").alias("k"), F.col(item_text_col).alias("t")).where("t <> ''")
    total = items.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    blocks = pieces_of(total, BLOCK_WORDS * 6)
    dealt = items.withColumn("b", F.pmod(F.xxhash64("k", "t"), F.lit(blocks)))
    return ([(r.k, r.t) for r in dealt.where(F.col("b") == b).collect()] for b in range(blocks))


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    least: float = SIMILARITY,
    radius: int = RADIUS,
) -> DataFrame:
    """``id_col``, ``item_col``, ``similarity``, ``first_word`` and ``n_words`` of each document and item that match.

    ``first_word`` counts the normalised words of the document from 0.
    """
    schema = T.StructType(
        [
            T.StructField(id_col, docs.schema[id_col].dataType),
            T.StructField(item_col, T.LongType()),
            T.StructField("similarity", T.DoubleType()),
            T.StructField("first_word", T.LongType()),
            T.StructField("n_words", T.LongType()),
        ]
    )
    arrow = to_arrow_schema(schema)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where("text <> ''")

    def against(part: list[tuple[int, str]]) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known = Benchmark(part, radius)
            for batch in small_slices(batches, "text"):
                hits = [
                    (i, *hit)
                    for i, text in zip(batch["id"].to_pylist(), batch["text"].to_pylist())
                    for hit in known.search(text, least)
                ]
                if hits:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, f.type) for c, f in zip(zip(*hits), arrow)], names=schema.fieldNames()
                    )

        return texts.mapInArrow(run, schema)

    parts = _blocks(benchmark, item_col, item_text_col)
    return reduce(DataFrame.unionAll, [against(p) for p in parts])


def uncontaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    least: float = SIMILARITY,
    radius: int = RADIUS,
) -> DataFrame:
    """The rows of ``docs``, with all their columns, that match no item.  Narrow: row by row, a filter for each block of items."""

    def without(rows: DataFrame, part: list[tuple[int, str]]) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known = Benchmark(part, radius)
            for batch in small_slices(batches, text_col):
                clean = [not (t and known.search(t, least)) for t in batch[text_col].to_pylist()]
                yield batch.filter(pa.array(clean, pa.bool_()))

        return rows.mapInArrow(run, docs.schema)

    return reduce(without, _blocks(benchmark, item_col, item_text_col), docs)
