"""Business dates that each process has to run for."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slicewright.functions import dates
from slicewright.operators import predicates
from slicewright.operators.projection import with_parameters
from slicewright.schemas import DAILY, FAILED, MONTHLY, NORMAL, RUNNING


CONFIG_FIELDS = [
    "proc_name", "is_active", "data_freq", "run_period", "data_back_day", "notebook_path"
]


def join_config(requests: DataFrame, config: DataFrame, how: str = "inner") -> DataFrame:
    """Requests with the active config of their process."""
    return requests.join(config.where(predicates.active()).select(*CONFIG_FIELDS), "proc_name", how)


def join_status(configured: DataFrame, status: DataFrame) -> DataFrame:
    """Add the last known status, absent on a first run."""
    fields = ["proc_status", "run_mode", "running_dt", "start_dt", "end_dt"]
    last = status.select("proc_name", *[F.col(c).alias(f"last_{c}") for c in fields])
    return configured.join(last, "proc_name", "left")


def _by_frequency(daily: Column, monthly: Column) -> Column:
    freq = F.col("data_freq")
    return F.when(freq == DAILY, daily).when(freq == MONTHLY, monthly)


def resolve_windows(context: DataFrame, as_of: Column) -> DataFrame:
    """Run window per guarded request (see ``guard_runs``), one request per process.

    A failed process resumes where it stopped, whatever the request says.
    Otherwise the requested dates count, and missing ones follow from the
    config: the window ends ``data_back_day`` periods ago and is ``run_period``
    periods long, a period being a day or a month.  A frequency other than
    D or M leaves the dates NULL and sets ``window_error``.
    """
    today = dates.business_date(as_of)
    back, span = F.col("data_back_day"), F.col("run_period") - 1
    ask_start, ask_end = F.col("start_day"), F.col("end_day")
    resumed = F.col("last_proc_status").eqNullSafe(FAILED)

    fresh_end = _by_frequency(
        F.coalesce(ask_end, F.date_sub(today, back)),
        F.coalesce(F.last_day(ask_end), dates.month_end(today, -back)),
    )
    rows = context.withColumns(
        {
            "_resumed": resumed,
            "_end": F.when(resumed, F.col("last_end_dt")).otherwise(fresh_end),
        }
    )
    fresh_start = _by_frequency(
        F.coalesce(ask_start, F.date_sub(F.col("_end"), span)),
        F.coalesce(F.last_day(ask_start), dates.month_end(F.col("_end"), -span)),
    )
    start = F.coalesce(F.when(F.col("_resumed"), F.col("last_start_dt")), fresh_start)
    running = F.coalesce(F.when(F.col("_resumed"), F.col("last_running_dt")), start)
    mode = F.when(F.col("_resumed"), F.col("last_run_mode")).otherwise(
        F.coalesce(F.col("run_mode"), F.lit(NORMAL))
    )
    return rows.select(
        "proc_name",
        "proc_run_id",
        F.lit(RUNNING).alias("proc_status"),
        mode.alias("run_mode"),
        running.alias("running_dt"),
        start.alias("start_dt"),
        F.col("_end").alias("end_dt"),
        as_of.alias("start_proc_dtm"),
        as_of.alias("ins_proc_dtm"),
        "data_freq",
        "notebook_path",
        F.when(running.isNull() | F.col("_end").isNull(), "run window has no dates").alias(
            "window_error"
        ),
    )


def expand_calendar(windows: DataFrame) -> DataFrame:
    """One row per process and run date, from ``running_dt`` to ``end_dt``.

    Monthly processes run on month ends.  A window that has passed yields no
    row.  Rows are made where the window is; nothing is shuffled.
    """
    first, last = F.col("running_dt"), F.col("end_dt")
    one_day = F.expr("INTERVAL 1 DAY")
    one_month = F.expr("INTERVAL 1 MONTH")
    daily = F.when(first <= last, F.sequence(first, last, one_day))
    month_starts = F.sequence(F.trunc(first, "MM"), F.trunc(last, "MM"), one_month)
    monthly = F.when(first <= last, F.transform(month_starts, F.last_day))
    run_dates = F.filter(_by_frequency(daily, monthly), lambda d: d <= last)
    return windows.select(
        "proc_name",
        "proc_run_id",
        "run_mode",
        "start_dt",
        "end_dt",
        "notebook_path",
        F.posexplode(run_dates).alias("loop_no", "running_dt"),
    )


def next_run_date(status: DataFrame, config: DataFrame, loop_no: int) -> DataFrame:
    """Running processes with the date that lies ``loop_no`` periods after their marker."""
    fields = config.select("proc_name", "data_freq", "notebook_path")
    marker, step = F.col("running_dt"), F.col("loop_no")
    following = _by_frequency(F.date_add(marker, step), dates.month_end(marker, step))
    running = status.where(F.col("proc_status") == RUNNING).join(fields, "proc_name")
    return with_parameters(running, {"loop_no": loop_no}).select(
        "proc_name", "proc_run_id", "run_mode", "running_dt", "start_dt", "end_dt",
        "notebook_path", "loop_no", following.alias("next_dt"),
    )
