"""From raw documents to coded training text, stage by stage.

Each stage takes (spark, docs, sf_dir) and returns the documents it keeps, with
the columns of ``documents``; the last one returns ids and decoded text.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slicewright.llm import decontamination, merge_coding, pii, prob_minhash, toxicity
from slicewright.llm.common import fold, saved, send_package, table


#: Text that goes to a Python worker at once.
BATCH_BYTES = "4m"


def stage(run: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """A stage as it runs: workers get the package, and texts in batches of a few megabytes, however long they are."""

    @wraps(run)
    def sent(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        send_package(spark)
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
        return run(spark, docs, sf_dir)

    return sent


@stage
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose calibrated toxicity is under one half, learned from the labels outside fold 0.

    Row by row, so rows that repeat an id, or have none, are each judged by their own text.
    A NULL text is scored as an empty one.
    """
    plain = {c: f"_{i}" for i, c in enumerate(docs.columns)}  # no name the scoring uses
    scored = toxicity.score(
        docs.withColumnsRenamed(plain), table(spark, sf_dir, "labels"), fold(F.col("doc_id")) != 0,
        id_col=plain["doc_id"], text_col=plain["text"], keep=tuple(plain.values()), id_col_of_labels="doc_id",
    )
    return scored.where("score < 0.5").select(*(F.col(p).alias(c) for c, p in plain.items()))


@stage
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each near-duplicate class, by id; rows without an id or without a word stay.

    Different texts under one id are judged by themselves; of rows alike in id and words one stays.
    """
    return prob_minhash.first_of_each_class(docs)


@stage
def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows without a passage like a benchmark item; row by row, so ids may repeat or be NULL.  A NULL text stays."""
    return decontamination.uncontaminated(docs, table(spark, sf_dir, "benchmark"))


@stage
def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, with every span of personal data replaced by its kind and ``n_chars`` counted anew; a NULL text stays NULL."""
    rows = docs.select(F.struct(*docs.columns).alias("doc"), "text")
    clean = pii.find_spans(rows).withColumn("clean", pii.redacted("text", "spans"))
    new = {"text": F.col("clean"), "n_chars": F.length("clean").cast("long")}
    return clean.select(*(new.get(c, F.col("doc")[c]).alias(c) for c in docs.columns))


@stage
def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, packed ``ids`` and ``decoded`` text of all rows; a NULL text is coded as an empty one."""
    return merge_coding.encode_decode(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("toxicity", drop_toxic),
    ("minhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", drop_contaminated),
    ("pii", redact),
    ("sentencepiece", encode),
]

#: The stages learn models and code tokens, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written before the next reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = saved(step(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
