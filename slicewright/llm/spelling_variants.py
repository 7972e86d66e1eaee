"""Spelling variants: words that differ by one inserted, deleted or replaced code point.

Two words with at most ``M`` code points differ by one edit just when their common prefix and
their common suffix together reach M - 1 (dense prefix-suffix tiling).  So they share their first
M // 2 code points or their last M - M // 2, and have M and M or M - 1 code points: words meet
in these groups, none of the pairs is missed, and a pair found by its prefix is not counted again by
its suffix.  Within a task the words of its groups lie in padded code-point matrices, aligned left and right, and
are compared tile by tile.

A group of more than ``block`` words is split into blocks and its pairs of blocks are dealt to
tasks of their own, so no task holds more than two blocks of a group.  A tile adds up, for each
of its words, the number of near words and the best of them: no list of pairs is ever formed, and
a word with many near words is summed up before and after the shuffle.

Roots come by pointer jumping over the forms; a form occurs at least twice as often as its
word, so the paths are no longer than the logarithm of the largest count.

Defined results: a NULL text has no words; the prefix of the hash of a NULL id is the empty text.
Repeated rows count as often as they occur.  A word of any length is compared whole; a
task takes fewer long words at once.  Ties between forms go to the smaller word in code-point order.
An empty table gives no rows.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slicewright.llm.common import saved

RUN = r"[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Words of a group that one task compares with each other; larger groups are split.
BLOCK = 8_192
#: Words on a side of a tile.
TILE = 192
#: Words compared in one go, and code points of them.
BATCH_WORDS, BATCH_CELLS = 16_384, 4_000_000

_PARTIAL = "word string, n long, near long, best_n long, best string"


def counted_words(docs: DataFrame, *, id_col: str = "doc_id", text: str = "text", every: int = 97, least: int = 3, shortest: int = 5) -> DataFrame:
    """``word`` and ``n``: letter runs in lower case (A-Z only) that occur ``least`` times.

    Where ``every`` divides the crc32 of ``<id>:<run>``, the run loses the code point at that
    number modulo its length.
    """
    id_text = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    lowered = F.translate(F.col(text), UPPER, LOWER).alias("_t")
    runs = docs.select(id_text.alias("_i"), lowered).select("_i", F.explode(F.expr(f"regexp_extract_all(_t, r'{RUN}', 0)")).alias("_r"))
    long_runs = runs.where(F.length("_r") >= shortest)  # a run only gets shorter
    mark = F.crc32(F.concat("_i", F.lit(":"), "_r").cast("binary"))
    marked = long_runs.select("_r", mark.alias("_h"))
    at = (F.col("_h") % F.length("_r")).cast("int")
    cut = F.concat(F.substring("_r", F.lit(1), at), F.substring("_r", at + 2, F.length("_r")))
    words = marked.select(F.when(F.col("_h") % every == 0, cut).otherwise(F.col("_r")).alias("word"))
    return words.where(F.length("word") >= shortest).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least)


def _grouped(words: DataFrame, block: int) -> DataFrame:
    """Every word in its four groups, and there in every pair of blocks that has its block."""
    size = F.length("word")
    sides = words.select("word", "n", F.explode(F.array(size, size + 1)).alias("m")).select(
        "*", F.explode(F.array(F.lit(True), F.lit(False))).alias("by_prefix")
    )
    half = F.floor(F.col("m") / 2).cast("int")
    prefix, suffix = F.substring("word", F.lit(1), half), F.substring("word", size - (F.col("m") - half) + 1, F.col("m") - half)
    keyed = saved(sides.withColumn("key", F.when(F.col("by_prefix"), prefix).otherwise(suffix)), "tiles")
    group = ["m", "by_prefix", "key"]
    most = F.greatest(F.lit(1), F.least(F.lit(block), F.lit(4 * BATCH_CELLS) / F.col("m")))  # fewer long words
    counts = keyed.groupBy(*group).agg(F.count("*").alias("_size")).where(F.col("_size") > most)
    # four rows for every `block` words (or 16 million code points) at most
    blocks = keyed.join(F.broadcast(saved(counts, "large_groups")), group, "left")
    n_blocks = F.ceil(F.coalesce("_size", F.lit(1)) / most).cast("int")
    own = F.pmod(F.xxhash64("word"), n_blocks).cast("int")
    pairs = blocks.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), n_blocks - 1)))
    return pairs.select(
        "word", "n", *group,
        F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), (F.col("own") > F.col("other")).alias("second"),
    )


def _matrices(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of the words, aligned left and right, and their lengths; padding is 0."""
    lengths = np.array([len(w) for w in words])
    width = int(lengths.max())
    left = np.array(words, dtype=f"<U{width}").view(np.uint32).reshape(len(words), width)
    if left.max() < 256:
        left = left.astype(np.uint8)
    shift = (np.arange(width)[None, :] - (width - lengths)[:, None]) % width
    right = np.where(np.arange(width)[None, :] < (width - lengths)[:, None], 0, np.take_along_axis(left, shift, 1))
    return left, right[:, ::-1], lengths


def _common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common start of every row of ``a`` and every row of ``b``."""
    alive = np.ones((len(a), len(b)), bool)
    length = np.zeros(alive.shape, np.int32)
    for k in range(a.shape[1]):
        alive &= (a[:, k, None] == b[None, :, k]) & (a[:, k, None] != 0)
        if not alive.any():
            break
        length += alive
    return length


def _compare(words: list[str], n: np.ndarray, group: np.ndarray, m: np.ndarray, by_prefix: np.ndarray, second: np.ndarray, mixed: np.ndarray):
    """Near words, their number and the best, of words sorted by group; only groups in common are compared."""
    left, right, lengths = _matrices(words)
    rank = np.empty(len(words), np.int64)
    rank[sorted(range(len(words)), key=words.__getitem__)] = np.arange(len(words))
    weight = n * len(words) + (len(words) - 1 - rank)  # larger n first, then the smaller word
    near, best = np.zeros(len(words), np.int64), np.full(len(words), -1, np.int64)
    tile = max(1, min(TILE, BATCH_CELLS // left.shape[1]))
    for a in range(0, len(words), tile):
        a_end = min(a + tile, len(words))
        for b in range(a, len(words), tile):
            if group[b] > group[a_end - 1]:
                break
            rows, cols = np.s_[a:a_end], np.s_[b : min(b + tile, len(words))]
            prefix = _common(left[rows], left[cols])
            size = m[rows, None]
            hit = (group[rows, None] == group[None, cols]) & (np.maximum(lengths[rows, None], lengths[None, cols]) == size)
            # a pair that shares its prefix group is counted there; blocks are compared with the other block of their pair
            hit &= by_prefix[rows, None] | (prefix < size // 2)
            hit &= ~mixed[rows, None] | (second[rows, None] != second[None, cols])
            if not hit.any():
                continue
            hit &= prefix + _common(right[rows], right[cols]) >= size - 1
            x, y = np.nonzero(hit)
            x, y = x + a, y + b
            once = x < y
            x, y = x[once], y[once]
            for one, other in ((x, y), (y, x)):
                np.add.at(near, one, 1)
                np.maximum.at(best, one, weight[other])
    named = {int(w): words[i] for i, w in enumerate(weight)}
    return near, best, named


def _tiles(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial results of the words of a task, which come sorted by group."""
    held: list[dict] = []

    def compared(rows: list[dict]) -> pa.RecordBatch:
        keys = [(r["m"], r["by_prefix"], r["key"], r["i"], r["j"]) for r in rows]
        group = np.cumsum([False] + [a != b for a, b in zip(keys, keys[1:])])
        words = [r["word"] for r in rows]
        n = np.array([r["n"] for r in rows], np.int64)
        flags = {c: np.array([r[c] for r in rows], bool) for c in ("by_prefix", "second")}
        mixed = np.array([r["i"] != r["j"] for r in rows], bool)
        near, best, named = _compare(words, n, group, np.array([r["m"] for r in rows]), flags["by_prefix"], flags["second"], mixed)
        some = np.nonzero(near)[0]
        total = len(words)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([words[i] for i in some], pa.string()),
                pa.array(n[some], pa.int64()),
                pa.array(near[some], pa.int64()),
                pa.array(best[some] // total, pa.int64()),
                pa.array([named[int(best[i])] for i in some], pa.string()),
            ],
            ["word", "n", "near", "best_n", "best"],
        )

    last = None
    for batch in batches:
        for row in batch.to_pylist():
            key = (row["m"], row["by_prefix"], row["key"], row["i"], row["j"])
            # m never falls, so the matrix is as wide as the last word
            if held and key != last and (len(held) >= BATCH_WORDS or len(held) * row["m"] >= BATCH_CELLS):
                yield compared(held)
                held = []
            held.append(row)
            last = key
    if held:
        yield compared(held)


def near_words(words: DataFrame, block: int = BLOCK) -> DataFrame:
    """``words`` (word, n) with ``n_near``, and the near word of largest n as ``best`` and ``best_n``."""
    group = ["m", "by_prefix", "key", "i", "j"]
    dealt = _grouped(words, block).repartition(*(F.col(c) for c in group)).sortWithinPartitions(*group)
    partial = dealt.mapInArrow(_tiles, _PARTIAL)
    rank = F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("w"))
    found = partial.groupBy("word").agg(F.sum("near").alias("n_near"), F.min(rank).alias("top"))
    out = words.join(found, "word", "left")
    near = F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near")
    return out.select("word", "n", near, F.col("top.w").alias("best"), (-F.col("top.n")).alias("best_n"))


def grouped_variants(words: DataFrame, *, ratio: int = 2, block: int = BLOCK) -> DataFrame:
    """``word``, ``form``, ``root``, ``n``, ``n_near`` and ``form_n`` of every word (word, n).

    A word's form is its best near word, if that occurs ``ratio`` (more than 1) times as often or more.
    """
    near = near_words(words, block)
    better = F.col("best_n") >= ratio * F.col("n")
    formed = saved(
        near.select("word", "n", "n_near", F.when(better, F.col("best")).alias("form"), F.when(better, F.col("best_n")).alias("form_n")), "forms"
    )
    # words without a form are their own root already; the others move up, twice as far each time
    paths = formed.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    while True:
        onward = paths.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        moved = saved(paths.join(onward, "root", "left").select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_moved")), "roots")
        done = moved.where("_moved").isEmpty()
        paths = moved.drop("_moved")
        if done:
            break
    rooted = formed.join(paths, "word", "left")
    return rooted.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
