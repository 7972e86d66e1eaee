"""What happens to the status and log tables while processes run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slicewright.functions import envelope, text
from slicewright.operators.mutations import merge_upsert, update_matched
from slicewright.schemas import FAILED, RUN_LOG, RUN_LOG_KEY, RUNNING, STATUS_KEY, SUCCESS, conform


def start_status(status: DataFrame, windows: DataFrame) -> DataFrame:
    """Status table with every window entered as Running.

    A window without dates cannot run and is not entered.  A known process keeps
    its first-seen time and its last end time.
    """
    both = ["proc_run_id", "proc_status", "run_mode", "running_dt", "start_dt", "end_dt",
            "start_proc_dtm"]
    usable = windows.where(F.col("window_error").isNull())
    source = usable.select("proc_name", *both, "ins_proc_dtm")
    entered = {name: F.col(f"new_{name}") for name in both}
    return merge_upsert(
        status,
        source,
        STATUS_KEY,
        update={**entered, "upd_proc_dtm": F.col("new_ins_proc_dtm")},
        insert={**entered, "ins_proc_dtm": F.col("new_ins_proc_dtm")},
    )


def log_rows(calendar: DataFrame, as_of: Column) -> DataFrame:
    """Running log rows for the dates of a calendar."""
    return conform(
        calendar.withColumns({"proc_status": F.lit(RUNNING), "start_proc_dtm": as_of}), RUN_LOG
    )


def read_outcomes(reports: DataFrame) -> DataFrame:
    """Outcomes from the envelopes that jobs return; a job without a readable one has failed."""
    body = F.col("_body")
    unreadable = body["status"].isNull()
    return reports.withColumn("_body", envelope.parse(F.col("envelope"))).select(
        *RUN_LOG_KEY,
        F.coalesce(body["status"], F.lit(FAILED)).alias("proc_status"),
        F.when(unreadable, "no readable result").otherwise(body["message"]).alias("error_message"),
    )


def stop_after_failure(outcomes: DataFrame, process: str, order: list[str], failed: Column):
    """Outcomes up to and including each process's first failure.

    The first failure is an aggregate, not a running window, so the rows of a
    busy process are never gathered in one task; grouping by more than the
    process lets adaptive execution split a busy process in the join.
    """
    position = F.struct(*order)
    apart = F.xxhash64(process).alias("_apart")
    first = outcomes.where(failed).groupBy(process, apart).agg(F.min(position).alias("_stop"))
    return (
        outcomes.join(first.drop("_apart"), process, "left")
        .where(F.col("_stop").isNull() | (position <= F.col("_stop")))
        .drop("_stop")
    )


def close_log(log: DataFrame, outcomes: DataFrame, as_of: Column) -> DataFrame:
    """Log with an outcome written to the rows that are still Running.

    ``outcomes`` holds (proc_name, proc_run_id, running_dt, proc_status, error_message).
    """
    return update_matched(
        log,
        outcomes.select(*RUN_LOG_KEY, "proc_status", "error_message"),
        RUN_LOG_KEY,
        {
            "proc_status": F.col("new_proc_status"),
            "end_proc_dtm": as_of,
            "error_message": text.clean_message(F.col("new_error_message")),
        },
        when=F.col("proc_status") == RUNNING,
    )


def move_marker(status: DataFrame, attempted: DataFrame, as_of: Column) -> DataFrame:
    """Status with ``running_dt`` moved to the last date attempted, from the second date on."""
    marks = (
        attempted.groupBy("proc_name")
        .agg(F.count("*").alias("n"), F.max("running_dt").alias("running_dt"))
        .where(F.col("n") > 1)
        .select("proc_name", "running_dt")
    )
    return update_matched(
        status,
        marks,
        STATUS_KEY,
        {
            "proc_status": F.lit(RUNNING),
            "running_dt": F.col("new_running_dt"),
            "upd_proc_dtm": as_of,
        },
    )


def finish_status(status: DataFrame, results: DataFrame, as_of: Column) -> DataFrame:
    """Status closed with each process's result (proc_name, proc_status).

    Success clears the marker and sets the end time; failure keeps the marker
    as the point to resume from and clears the end time.
    """
    failed = F.col("new_proc_status") == FAILED
    return update_matched(
        status,
        results.select("proc_name", "proc_status"),
        STATUS_KEY,
        {
            "proc_status": F.col("new_proc_status"),
            "running_dt": F.when(failed, F.col("running_dt")),
            "end_proc_dtm": F.when(~failed, as_of),
            "upd_proc_dtm": as_of,
        },
    )


def results_of(outcomes: DataFrame, windows: DataFrame | None = None) -> DataFrame:
    """Failed when any date of the process failed, else Success.

    With ``windows``, every window that could run has a result: one that had no
    date left to run for has nothing to do and is a Success.
    """
    any_failed = F.max(F.col("proc_status") == FAILED)
    found = outcomes.groupBy("proc_name").agg(
        F.when(any_failed, FAILED).otherwise(SUCCESS).alias("proc_status")
    )
    if windows is None:
        return found
    entered = windows.where(F.col("window_error").isNull()).select("proc_name")
    return entered.join(found, "proc_name", "left").select(
        "proc_name", F.coalesce("proc_status", F.lit(SUCCESS)).alias("proc_status")
    )
