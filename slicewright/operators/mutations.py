"""Table changes for storage without row-level DML.

Slices are replaced in place; other changes return the new table version, to
be saved to a new folder.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slicewright.functions import dates
from slicewright.operators.keys import only_row_per_key
from slicewright.schemas import conform


def overwrite(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def insert_select(df: DataFrame, path: str, schema: T.StructType) -> None:
    """Append a query result; columns it lacks become NULL where the schema allows."""
    append(conform(df, schema), path)


def insert_values(spark, rows: Sequence[Sequence], columns: Sequence[str], path, schema) -> None:
    """Append literal rows given in the order of ``columns``."""
    types = T.StructType([T.StructField(c, schema[c].dataType, True) for c in columns])
    insert_select(spark.createDataFrame(rows, types), path, schema)


def replace_slice(target: DataFrame, new: DataFrame, column: str, data_dt) -> DataFrame:
    """``target`` with the rows of one date replaced by ``new``.  Narrow: nothing is shuffled.

    Target rows without a date belong to no slice and stay.  New rows must lie
    in the slice; one that does not fails the job.
    """
    wanted = F.coalesce(F.col(column).cast("date") == dates.day(data_dt), F.lit(False))
    stray = F.raise_error(F.lit(f"new row outside the slice {column} = {data_dt}"))
    guarded = new.where(F.when(wanted, True).otherwise(stray.cast("boolean")))
    return target.where(~wanted).unionByName(guarded)


def replace_slices(target: DataFrame, new: DataFrame, column: str) -> DataFrame:
    """``target`` with every date that occurs in ``new`` replaced by the rows of ``new``."""
    replaced = new.select(F.col(column).cast("date").alias("_slice")).distinct()
    # Bounded: a calendar has fewer than 3.7 million dates, whatever the table holds.
    dates_only = F.broadcast(replaced.where(F.col("_slice").isNotNull()))
    kept = target.join(dates_only, F.col(column).cast("date") == F.col("_slice"), "left_anti")
    return kept.unionByName(new)


def write_slices(
    df: DataFrame,
    path: str,
    column: str = "DATA_DT",
    *,
    slices: Column | None = None,
    gather: bool = False,
):
    """Replace, in a table partitioned by ``column``, exactly the slices found in ``df``.

    ``slices`` is a condition on ``column`` for the slices that may be replaced; a
    row outside fails the job before any slice is touched.  ``gather`` first
    brings each slice's rows together, for input in which every task holds rows
    of many slices; adaptive execution splits a slice too large for one task.
    Input that arrives slice by slice is written as it comes.
    """
    if slices is not None:
        stray = F.raise_error(
            F.concat(F.lit(f"row outside the slices to replace: {column} = "), F.coalesce(F.col(column).cast("string"), F.lit("NULL")))
        )
        df = df.where(F.when(slices, True).otherwise(stray.cast("boolean")))
    if gather:
        df = df.hint("rebalance", column)
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(column)
        .parquet(path)
    )


def update_matched(
    target: DataFrame,
    changes: DataFrame,
    keys: Sequence[str],
    assignments: Mapping[str, Column],
    when: Column | None = None,
) -> DataFrame:
    """``target`` with columns set on the rows that match a change and satisfy ``when``.

    ``changes`` holds at most one row per key.  Its other columns are available
    to ``assignments`` and ``when`` as ``new_<name>``.  Few changes are broadcast
    by adaptive execution and the target is then not shuffled at all; of many,
    both sides are shuffled and a hot key of the target is split.
    """
    values = [c for c in changes.columns if c not in keys]
    complete = changes.dropna(subset=list(keys))  # a NULL key matches nothing
    source = only_row_per_key(complete, keys, "update", apart=True).select(
        *keys, *[F.col(c).alias(f"new_{c}") for c in values], F.lit(True).alias("_matched")
    )
    hit = F.col("_matched").isNotNull()
    if when is not None:
        hit = hit & F.coalesce(when, F.lit(False))
    joined = target.join(source, list(keys), "left")
    return joined.select(
        *[
            F.when(hit, assignments[c]).otherwise(F.col(c)).cast(target.schema[c].dataType).alias(c)
            if c in assignments
            else F.col(c)
            for c in target.columns
        ]
    )


def merge_upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    *,
    update: Mapping[str, Column],
    insert: Mapping[str, Column],
) -> DataFrame:
    """Upsert: set ``update`` columns on matched rows, add ``insert`` rows for the rest.

    Source columns are available as ``new_<name>``.  A matched row takes the
    source's value even when that is NULL; columns not named keep their value
    when matched and are NULL when inserted.  Both tables hold one row per key
    (checked for the source), so a full outer join moves each row once and no
    key can be hot.
    """
    values = [c for c in source.columns if c not in keys]
    new = only_row_per_key(source, keys, "merge").select(
        *[F.col(k).alias(f"_key_{k}") for k in keys],
        *[F.col(c).alias(f"new_{c}") for c in values],
        F.lit(True).alias("_in_source"),
    )
    old = target.withColumn("_in_target", F.lit(True))
    same = F.lit(True)
    for k in keys:
        same = same & (F.col(k) == F.col(f"_key_{k}"))
    joined = old.join(new, same, "full_outer")
    inserted = F.col("_in_target").isNull()
    matched = F.col("_in_target").isNotNull() & F.col("_in_source").isNotNull()

    def column(field: T.StructField) -> Column:
        name = field.name
        if name in keys:
            return F.coalesce(F.col(name), F.col(f"_key_{name}")).alias(name)
        chain = F.when(inserted, insert.get(name, F.lit(None).cast(field.dataType)))
        if name in update:
            chain = chain.when(matched, update[name])
        return chain.otherwise(F.col(name)).cast(field.dataType).alias(name)

    return joined.select(*[column(f) for f in target.schema.fields])
