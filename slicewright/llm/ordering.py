"""Places of rows in a total order, without one task that sees them all."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slicewright.llm.common import saved


def numbered(df: DataFrame, group: Sequence[str], order: Sequence[Column], size: str | None = None) -> DataFrame:
    """``df`` with ``place``, from 0 in the order of its group; with ``size`` also ``before``,
    the sum of that column over the rows of the group that come earlier.

    The rows are dealt by ranges of (group, order), so a large group lies in many
    partitions; what each partition holds of a group is summed up, and the sums of
    the partitions before it are added.  Rows that tie in everything stand in any order.
    """
    keys = [F.col(c).asc_nulls_first() for c in group]
    dealt = saved(df.repartitionByRange(*keys, *order).withColumn("_part", F.spark_partition_id()), "dealt")
    amount = F.col(size) if size else F.lit(0)
    held = saved(dealt.groupBy("_part", *group).agg(F.count("*").alias("_n"), F.sum(amount).alias("_s")), "held")
    earlier = Window.partitionBy(*(group or [F.lit(0)])).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    start = held.select(
        F.col("_part").alias("_at"),
        *(F.col(c).alias(f"_g{i}") for i, c in enumerate(group)),
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_n"),
        F.coalesce(F.sum("_s").over(earlier), F.lit(0)).alias("_s"),
    )
    within = Window.partitionBy("_part", *group).orderBy(*order)
    so_far = within.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = dealt.withColumn("_i", F.row_number().over(within) - 1).withColumn("_sum", F.sum(amount).over(so_far) - amount)
    same = F.col("_part") == F.col("_at")
    for i, c in enumerate(group):
        same = same & F.col(c).eqNullSafe(F.col(f"_g{i}"))
    out = local.join(start, same).withColumn("place", F.col("_n") + F.col("_i"))
    if size:
        out = out.withColumn("before", F.col("_s") + F.col("_sum"))
    return out.select(*df.columns, "place", *(["before"] if size else []))
