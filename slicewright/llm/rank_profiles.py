"""Language identification by rank-order profiles.

A profile lists the most frequent n-grams (one to three letters, words framed
by a space) of a language, or of a document, by falling frequency; ties go to
the smaller n-gram code. The out-of-place distance of a document adds up, over
its own n-grams, how far each one's rank lies from its rank in the language's
profile; an n-gram that is missing there counts the profile's length. The
nearest language wins, ties going to the first name.

Profiles are learned from all rows given; per task only counts leave Python.
The learned table holds ``size`` rows for each language and is held to
``MOST_LANGUAGES`` before it is sent to the tasks.

Defined results: a NULL text, or one without a letter, is ``und`` with score 0,
and so is every text when nothing was learned; rows without a language teach
nothing; only the named columns are read, so other columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slicewright.llm.common import small_slices

UNKNOWN = "und"
#: More names than there are languages; beyond it the language column is no such thing.
MOST_LANGUAGES = 10_000
SPACE = 32
#: Characters up to here are looked up; those above are letters without case.
TABLE = 0x20000


class Letters:
    """Maps text to lower-case letters and single spaces, as code points."""

    def __init__(self):
        chars = [chr(i) for i in range(TABLE)]
        lower = ((c.lower() if len(c.lower()) == 1 else c) for c in chars)
        self.to = np.fromiter((ord(x) if x.isalpha() else SPACE for x in lower), np.uint32, TABLE)

    def __call__(self, text: str) -> np.ndarray:
        raw = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        seen = self.to[np.minimum(raw, TABLE - 1)]
        seen = np.where(raw >= TABLE, raw, seen) if len(raw) and raw.max() >= TABLE else seen
        framed = np.concatenate([[SPACE], seen, [SPACE]]).astype(np.uint64)
        gap = framed == SPACE
        return framed[~(gap & np.concatenate([[False], gap[:-1]]))]


def grams(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of framed words, as numbers in rising order, and their counts."""
    if len(codes) < 3:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    inner = codes != SPACE
    two = codes[:-1] << np.uint64(21) | codes[1:]
    three = two[:-1] << np.uint64(21) | codes[2:]
    return np.unique(np.concatenate([codes[inner], two, three[inner[1:-1]]]), return_counts=True)


def learn(docs: DataFrame, *, lang_col: str = "lang", text_col: str = "text", size: int = 300) -> DataFrame:
    """``lang``, ``gram``, ``place`` (from 0): the profile of each language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters = Letters()
        for batch in small_slices(batches, "text"):
            own: dict[str, list] = {}
            for lang, text in zip(batch["lang"].to_pylist(), batch["text"].to_pylist()):
                own.setdefault(lang, []).append(grams(letters(text)))
            for lang, parts in own.items():
                found, at = np.unique(np.concatenate([g for g, _ in parts]), return_inverse=True)
                n = np.bincount(at, np.concatenate([c for _, c in parts]), len(found)).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(found), pa.string()), pa.array(found.view(np.int64)), pa.array(n)],
                    names=["lang", "gram", "n"],
                )

    rows = docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
    counts = (
        rows.where("lang IS NOT NULL AND text IS NOT NULL")
        .mapInArrow(run, "lang string, gram long, n long")
        .groupBy("lang", "gram")
        .agg(F.sum("n").alias("n"))
    )
    first = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    return (
        counts.withColumn("place", F.row_number().over(first) - 1)
        .where(F.col("place") < size)
        .select("lang", "gram", "place")
    )


def predict(
    docs: DataFrame, profiles: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", size: int = 300
) -> DataFrame:
    """``id_col``, ``lang_pred`` and ``score``: 1 less the share of the largest possible distance."""
    learned = profiles.limit(MOST_LANGUAGES * size + 1).toPandas()
    langs = sorted(learned.lang.unique())
    if len(langs) > MOST_LANGUAGES or len(learned) > MOST_LANGUAGES * size:
        raise ValueError("too many values for a language column")
    known = np.unique(learned.gram.to_numpy(np.int64).view(np.uint64))
    place = np.full((len(known), len(langs)), -1, np.int32)
    place[
        np.searchsorted(known, learned.gram.to_numpy(np.int64).view(np.uint64)),
        np.searchsorted(langs, learned.lang) if langs else np.zeros(0, int),
    ] = learned.place

    def verdict(codes: np.ndarray) -> tuple[str, float]:
        found, n = grams(codes)
        if not len(found) or not langs:
            return UNKNOWN, 0.0
        top = found[np.argsort(-n, kind="stable")[:size]]
        at = np.minimum(np.searchsorted(known, top), len(known) - 1)
        there = place[at]
        missing = (known[at] != top)[:, None] | (there < 0)
        apart = np.where(missing, size, np.abs(there - np.arange(len(top))[:, None])).sum(0)
        best = int(apart.argmin())
        return langs[best], 1.0 - float(apart[best]) / (size * len(top))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters = Letters()
        for batch in small_slices(batches, "text"):
            out = [verdict(letters(t)) if t else (UNKNOWN, 0.0) for t in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch["id"], pa.array([x for x, _ in out], pa.string()), pa.array([x for _, x in out], pa.float64())],
                names=[id_col, "lang_pred", "score"],
            )

    schema = T.StructType(
        [
            T.StructField(id_col, docs.schema[id_col].dataType),
            T.StructField("lang_pred", T.StringType()),
            T.StructField("score", T.DoubleType()),
        ]
    )
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, schema)
