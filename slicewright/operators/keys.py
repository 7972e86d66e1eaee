"""One row per key, and the check that a key holds.

All of these aggregate before the shuffle, so one hot key costs no more than
any other: each task sends at most one row per key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _pick(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], choose) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    rank = F.struct(*order)
    chosen = df.groupBy(*keys).agg(choose(F.struct(*rest), rank).alias("_row"))
    return chosen.select(*keys, "_row.*").select(*df.columns)


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """The row with the greatest ``order`` values of each key."""
    return _pick(df, keys, order, F.max_by)


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """The row with the least ``order`` values of each key."""
    return _pick(df, keys, order, F.min_by)


def only_row_per_key(
    df: DataFrame, keys: Sequence[str], what: str, *, apart: bool = False
) -> DataFrame:
    """``df``, failing the job when two of its rows share a key.

    The count leaves the rows partitioned and sorted by key, as a join on the
    same keys needs them, so the check adds nothing to that join.  ``apart``
    partitions them by more than the key: the join then shuffles this side once
    more, and adaptive execution can split hot keys of the other side.
    """
    complaint = F.concat(F.lit(f"{what}: several rows for key "), F.to_json(F.struct(*keys)))
    own = [*keys, F.xxhash64(*keys)] if apart else keys
    count = F.count("*").over(Window.partitionBy(*own))
    single = F.when(F.col("_n") == 1, True).otherwise(F.raise_error(complaint).cast("boolean"))
    return df.withColumn("_n", count).where(single).drop("_n")


def key_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that are not unique or not complete, with the number of rows that carry them."""
    incomplete = F.lit(False)
    for key in keys:
        incomplete = incomplete | F.col(key).isNull()
    return (
        df.groupBy(*keys)
        .agg(F.count("*").alias("n_rows"))
        .withColumn(
            "violation",
            F.when(incomplete, "NULL_KEY").when(F.col("n_rows") > 1, "DUPLICATE_KEY"),
        )
        .where(F.col("violation").isNotNull())
    )


def required_violations(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns that the schema requires but that hold NULLs, counted in one pass."""
    required = [f.name for f in schema.fields if not f.nullable]
    counts = df.agg(*[F.count_if(F.col(name).isNull()).alias(name) for name in required])
    return counts.unpivot([], required, "column_name", "n_rows").where(F.col("n_rows") > 0)
