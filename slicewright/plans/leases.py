"""Leases that let a process run once at a time, also when a run dies.

A lease table holds one row per process: who runs it, since when, until when, and whether the
run has given it back.  It is a versioned table, so a batch of starts is decided on
one state and comes into force in one step: of two drivers that start the same
process at once, the second to commit finds the first's lease and is refused.  A run that
crashed gives nothing back; its lease ends at its expiry and the next start takes it over.
A long run renews its lease before that.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from slicewright.operators.keys import first_per_key
from slicewright.operators.mutations import merge_upsert
from slicewright.schemas import LEASE
from slicewright.storage import new_folder, save
from slicewright.versions import VersionedTable

#: Verdicts on a start.
GRANTED, TAKEN_OVER, HELD, OUTRUN = "GRANTED", "TAKEN_OVER", "HELD", "OUTRUN"


def lease_table(spark: SparkSession, path: str) -> VersionedTable:
    return VersionedTable(spark, path, ["proc_name"])


def _until(as_of: Column, ttl: timedelta) -> Column:
    return as_of + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(ttl.total_seconds()).cast("decimal(18,6)"))


def judge(leases: DataFrame, starts: DataFrame, as_of: Column, order: list[str]) -> DataFrame:
    """``starts`` (proc_name, proc_run_id, and the columns of ``order``) with a ``verdict``.

    A process is free when it has no lease, gave it back, or its lease has expired (then it is taken
    over).  The first start of a free process, by ``order``, is granted; the others are outrun.  The
    holder itself may start again.  A start without a process is refused as HELD.
    """
    rank = F.struct(*order, "proc_run_id")
    firsts = starts.groupBy("proc_name").agg(F.min(rank).alias("_first"))
    held = leases.select(
        "proc_name", F.col("proc_run_id").alias("_holder"),
        (~F.col("released") & (F.col("expires_dtm") > as_of)).alias("_live"), F.col("released").alias("_released"),
    )
    context = starts.join(firsts, "proc_name", "left").join(held, "proc_name", "left")
    own = F.col("_holder").eqNullSafe(F.col("proc_run_id"))
    verdict = (
        F.when(F.col("proc_name").isNull() | (F.coalesce("_live", F.lit(False)) & ~own), HELD)
        .when(F.coalesce("_live", F.lit(False)) & own, GRANTED)
        .when(F.col("_first") != rank, OUTRUN)
        .when(F.coalesce(~F.col("_released"), F.lit(False)), TAKEN_OVER)
        .otherwise(GRANTED)
    )
    return context.select(*starts.columns, verdict.alias("verdict"))


def acquire(table: VersionedTable, starts: DataFrame, as_of: Column, ttl: timedelta, order: list[str] | None = None) -> DataFrame:
    """Decide all starts and enter the leases of those that may run; returns ``starts`` with their ``verdict``."""
    spark = table.spark
    found: list[DataFrame] = []

    def work(listed):
        leases = spark.createDataFrame([], LEASE) if listed is None else table.rows_of(listed)
        judged = save(judge(leases, starts, as_of, order or []), new_folder(spark, "leases"))
        found[:] = [judged]
        won = judged.where(F.col("verdict").isin(GRANTED, TAKEN_OVER))
        won = first_per_key(won.select("proc_name", "proc_run_id"), ["proc_name"], ["proc_run_id"])
        if won.isEmpty():
            return None, None
        run = F.col("new_proc_run_id")
        taken = {"proc_run_id": run, "taken_dtm": as_of, "expires_dtm": _until(as_of, ttl), "released": F.lit(False)}
        return None, merge_upsert(leases, won, ["proc_name"], update=taken, insert=taken)

    table.change(work)
    return found[0]


def _held_by(as_of: Column) -> Column:
    return (F.col("proc_run_id") == F.col("new_proc_run_id")) & ~F.col("released") & (F.col("expires_dtm") > as_of)


def renew(table: VersionedTable, runs: DataFrame, as_of: Column, ttl: timedelta) -> int:
    """Move the expiry of the leases that ``runs`` (proc_name, proc_run_id) still hold; an expired one is not renewed."""
    return table.update_matched(
        runs.select("proc_name", "proc_run_id"), ["proc_name"], {"expires_dtm": _until(as_of, ttl)}, when=_held_by(as_of)
    )


def release(table: VersionedTable, runs: DataFrame, as_of: Column) -> int:
    """Give back the leases of ``runs`` (proc_name, proc_run_id); one that another run has taken over stays."""
    return table.update_matched(runs.select("proc_name", "proc_run_id"), ["proc_name"], {"released": F.lit(True)}, when=_held_by(as_of))
