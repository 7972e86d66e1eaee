"""Toxicity by gradient-boosted trees over dense features, with isotonic calibration.

Features of a text: share and number of lexicon words, share of their log odds,
lexicon words close to a word of address, lexicon words found only after undoing
obfuscation, and rates of capitals, punctuation and obfuscated words. The
lexicon is learned: words and word beginnings that the toxic learning rows use
far more often than the others. Language, source, ids and labels are no inputs
of a score.

The lexicon counts all labelled learning rows and holds the ``LEXICON`` stems of the largest
odds (a size of the model). Trees and calibration, Spark ML's, use at most ``SAMPLE``
rows (those with the smallest hash of the id), and one fifth of these is kept from the trees for
the calibration; scoring covers every row.

Labelled texts are found by one join, whatever the size: a bitmap of the hashes of labelled ids, of
``BITMAP`` bits at most, first keeps back most other texts (it only saves shuffling).

Defined results: NULL and empty texts have all features 0 and get a score like
any other; a row labelled twice counts twice in learning, unlabelled or NULL
labels teach nothing; where the learning rows for the trees have one class only, the score is that
class's share, and 0.5 without any label. Scores lie between 0 and 1. Only the
named columns are read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slicewright.llm.common import saved, small_slices

SAMPLE = 20_000
#: Partitions of the sample.
PARTS = 8
LEXICON = 100_000
#: Bits of the bitmap of labelled ids: 16 MB.
BITMAP = 2**27
#: Stem counts that a task holds before it hands them on.
HELD = 150_000
#: Least toxic rows with a stem, and least odds against the other rows.
ROWS, ODDS = 4, 8.0
#: Letters in the beginnings of words that count as stems.
STEMS = (4, 5, 6, 7, 8)
NEAR = 5

# Words of address, and signs that stand for letters.
ADDRESS = frozenset(
    "you your yours you're youre u ur du dich dir dein deine ihr euch tu te toi ton ta vous votre tú ti usted ustedes vosotros".split()
)
SIGNS = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "*": "", ".": "", "-": "", "_": ""})

EDGE = re.compile(r"^\W+|\W+$")
ODD = re.compile(r"\w[0-9@$!*._-]+\w|(.)\1\1")
CAPITALS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
FEATURES = ["density", "hits", "odds", "near", "hidden", "capitals", "shouted", "marks", "exclaimed", "odd", "length"]


def plain_words(text: str) -> list[str]:
    return [w for w in (EDGE.sub("", t) for t in text.lower().split()) if w]


def stems(word: str) -> set[str]:
    return {word, *(word[:n] + "~" for n in STEMS if len(word) > n)}


def odds_of(word: str, lexicon: dict[str, float]) -> float:
    """Largest log odds among the word and its beginnings; 0 for none."""
    best = lexicon.get(word, 0.0)
    for n in STEMS:
        if len(word) <= n:
            break
        best = max(best, lexicon.get(word[:n] + "~", 0.0))
    return best


#: Words that a task remembers before it starts afresh.
MEMORY = 150_000


class Features(dict):
    """Word as it stands in a text -> what it shows, None where that is nothing."""

    def __init__(self, lexicon: dict[str, float]):
        super().__init__()
        self.lexicon = lexicon

    def word(self, raw: str) -> tuple[float, int, int]:
        """Log odds, whether only undoing obfuscation found it, whether it looks obfuscated."""
        low = raw.lower()
        word = EDGE.sub("", low)
        odds, hidden, odd = odds_of(word, self.lexicon) if word else 0.0, 0, 0
        if ODD.search(low):
            odd = 1
            if not odds:
                undone = re.sub(r"(.)\1+", r"\1", EDGE.sub("", low.translate(SIGNS)))
                odds = odds_of(EDGE.sub("", low.translate(SIGNS)), self.lexicon) or odds_of(undone, self.lexicon)
                hidden = int(odds > 0)
        return odds, hidden, odd

    def __missing__(self, raw: str) -> tuple[float, int, int, int, int] | None:
        shown = (*self.word(raw), int(raw.isupper() and len(raw) > 2), int(EDGE.sub("", raw.lower()) in ADDRESS))
        self[raw] = shown if any(shown) else None
        return self[raw]

    def __call__(self, text: str) -> list[float]:
        raw = text.split()
        n = len(raw)
        if not n:
            return [0.0] * len(FEATURES)
        if len(self) > MEMORY:
            self.clear()
        seen = list(map(self.__getitem__, raw))
        places = [i for i, shown in enumerate(seen) if shown]
        rows = np.array([seen[i] for i in places], np.float64).reshape(-1, 5)
        odds, hidden, odd, loud, address = rows.T
        at = np.array(places, np.int64)
        hits, calls = at[odds > 0], at[address > 0]
        near = 0
        if len(hits) and len(calls):
            near = int((np.searchsorted(calls, hits + NEAR, "right") > np.searchsorted(calls, hits - NEAR)).sum())
        size = len(text)
        plain = text.encode("utf-8", "replace")
        capitals = (len(plain) - len(plain.translate(None, CAPITALS))) / size
        marks = sum(text.count(c) for c in "!?#*$%&@") / size
        return [
            len(hits) / n, math.log1p(len(hits)), float(odds.sum()) / n, near / n, float(hidden.sum()) / n,
            capitals, float(loud.sum()) / n, marks, text.count("!") / size, float(odd.sum()) / n, math.log1p(n),
        ]


class Numbers(dict):
    """Stem -> its number, in the order in which they come up."""

    def __missing__(self, stem: str) -> int:
        self[stem] = n = len(self)
        return n


class Stems(dict):
    """Word as it stands in a text -> the numbers of its stems; each stem is held once, however many words have it."""

    def __init__(self):
        super().__init__()
        self.numbers = Numbers()

    def __missing__(self, raw: str) -> tuple[int, ...]:
        word = EDGE.sub("", raw)
        self[raw] = own = tuple(map(self.numbers.__getitem__, stems(word))) if word else ()
        return own


def _counted(rows: DataFrame) -> DataFrame:
    """``stem``, ``n1``, ``n0``: toxic and other rows that hold each stem."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, held = Stems(), (Counter(), Counter())

        def handed() -> pa.RecordBatch:
            counts = [np.fromiter((h[n] for n in range(len(known.numbers))), np.int64, len(known.numbers)) for h in held]
            out = pa.RecordBatch.from_arrays(
                [pa.array(list(known.numbers), pa.string()), pa.array(counts[1]), pa.array(counts[0])], names=["stem", "n1", "n0"]
            )
            for d in (*held, known.numbers, known):
                d.clear()
            return out

        for batch in small_slices(batches, "text", 1 << 19):
            for text, label in zip(batch["text"].to_pylist(), batch["label"].to_pylist()):
                held[label].update(set().union(*map(known.__getitem__, set((text or "").lower().split()))))
            if len(known.numbers) > HELD:
                yield handed()
            elif len(known) > MEMORY:
                known.clear()
        yield handed()

    found = rows.select("text", "label").mapInArrow(run, "stem string, n1 long, n0 long")
    return found.groupBy("stem").agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0"))


def learn_lexicon(rows: DataFrame) -> dict[str, float]:
    """Stem -> log odds, from ``text`` and ``label`` of all rows."""
    n = {r.label: r["count"] for r in rows.groupBy("label").count().collect()}
    if not n.get(1) or not n.get(0):
        return {}
    odds = (F.col("n1") / n[1]) / ((F.col("n0") + 0.5) / n[0])
    best = _counted(rows).where(F.col("n1") >= ROWS).withColumn("odds", odds).where(F.col("odds") >= ODDS)
    best = best.orderBy(F.col("odds").desc(), F.col("n1").desc(), "stem").limit(LEXICON)
    return {r.stem: math.log(r.odds) for r in best.select("stem", "odds").collect()}


def _bit(id_: Column) -> Column:
    return F.pmod(F.xxhash64(id_), F.lit(BITMAP))


def labelled(texts: DataFrame, marked: DataFrame) -> DataFrame:
    """``texts`` (id, text) with the ``label`` of every row of ``marked``."""
    bits = marked.select(_bit(F.col("id")).alias("bit"))
    maps = bits.groupBy(F.bitmap_bucket_number("bit").alias("_bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("_map"))
    place = F.bitmap_bit_position(_bit(F.col("id")))
    byte = F.conv(F.hex(F.substring("_map", F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    maybe = texts.where("id IS NOT NULL").join(F.broadcast(maps), F.bitmap_bucket_number(_bit(F.col("id"))) == F.col("_bucket"))
    maybe = maybe.where(byte.bitwiseAND(F.call_function("shiftleft", F.lit(1), (place % 8).cast("int"))) != 0)
    return maybe.select(*texts.columns).join(marked.hint("merge"), "id")


def with_features(rows: DataFrame, lexicon: dict[str, float], keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` columns and the features of the column ``text``."""
    schema = T.StructType(
        [rows.schema[c] for c in keep] + [T.StructField(f, T.DoubleType()) for f in FEATURES]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features(lexicon)
        for batch in small_slices(batches, text):
            out = np.array([features(t or "") for t in batch[text].to_pylist()], np.float64).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays(
                [batch[c] for c in keep] + [pa.array(c) for c in np.ascontiguousarray(out.T)], names=[*keep, *FEATURES]
            )

    return rows.select(*dict.fromkeys([*keep, text])).mapInArrow(run, schema)


def score(
    docs: DataFrame,
    labels: DataFrame,
    learning: Column,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    sample: int = SAMPLE,
    keep: tuple[str, ...] = (),
    id_col_of_labels: str | None = None,
) -> DataFrame:
    """``id_col``, the columns ``keep`` and ``score`` of each row of ``docs``; ``learning`` picks rows of ``labels`` by the id.

    A kept column has no name that a feature has.
    """
    part = F.pmod(F.xxhash64(F.lit("part"), "id"), F.lit(5))
    marked = labels.where(learning).select(F.col(id_col_of_labels or id_col).alias("id"), F.col(label_col).cast("int").alias("label"))
    marked = marked.where("id IS NOT NULL AND label IN (0, 1)")
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    known = saved(labelled(texts, marked).withColumn("part", part), "toxicity-labelled")
    # at most ``sample`` rows of two numbers are sent to the tasks
    chosen = F.broadcast(marked.orderBy(F.xxhash64("id"), "id", "label").limit(sample).distinct())
    lexicon = learn_lexicon(known.select("text", "label"))
    vector = VectorAssembler(inputCols=FEATURES, outputCol="features")
    fit = saved(with_features(known.join(chosen, ["id", "label"]), lexicon, ["id", "label", "part"]), "toxicity-features")
    # in a fixed order, which the trees' candidate splits depend on, so that reruns agree
    fit = vector.transform(fit.repartition(PARTS, "id").sortWithinPartitions("id", "label", *FEATURES))
    out = list(dict.fromkeys([id_col, *keep]))
    ready = vector.transform(with_features(docs, lexicon, out, text_col))
    shares = {r.label: r["count"] for r in fit.where("part > 0").groupBy("label").count().collect()}
    if len(shares) < 2:
        share = float(shares.get(1, 0)) / sum(shares.values()) if shares else 0.5
        return ready.select(*out, F.lit(share).alias("score"))
    trees = GBTClassifier(featuresCol="features", labelCol="label", maxIter=15, maxDepth=4, stepSize=0.3, seed=7)
    model = trees.fit(fit.where("part > 0"))
    raw = lambda df: model.transform(df).withColumn("raw", vector_to_array("probability")[1])
    held = raw(fit.where("part = 0")).select("raw", F.col("label").cast("double").alias("label"))
    if held.select("label").distinct().count() < 2:
        return raw(ready).select(*out, F.col("raw").alias("score"))
    steps = IsotonicRegression(featuresCol="raw", labelCol="label", predictionCol="score").fit(held)
    scored = steps.transform(raw(ready))
    return scored.select(*out, F.greatest(F.lit(0.0), F.least(F.lit(1.0), "score")).alias("score"))
