"""Which run requests and configs are acceptable, decided for all of them at once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slicewright.functions import dates, text
from slicewright.operators import predicates
from slicewright.plans.windows import CONFIG_FIELDS, join_status
from slicewright.schemas import DAILY, MONTHLY, NORMAL, RERUN, RUNNING


def _first_failing(rules: list[tuple[Column, str]]) -> Column:
    """Message of the first rule that holds; NULL when none does."""
    chain = F.when(rules[0][0], rules[0][1])
    for broken, message in rules[1:]:
        chain = chain.when(broken, message)
    return chain


def validate_requests(requests: DataFrame) -> DataFrame:
    """Requests with blanks made NULL, typed dates, and an ``error`` (NULL when accepted)."""
    params = ["proc_name", "proc_run_id", "run_mode", "start_dt", "end_dt"]
    clean = requests.withColumns({p: text.blank_to_null(F.col(p)) for p in params})
    mode, start, end = F.col("run_mode"), F.col("start_dt"), F.col("end_dt")
    typed = _worked_out(clean.withColumns({"start_day": dates.parse_iso(start), "end_day": dates.parse_iso(end)}))
    start_day, end_day = F.col("start_day"), F.col("end_day")
    rerun = mode.eqNullSafe(RERUN)
    rules = [
        (rerun & (start.isNull() | end.isNull()), "a re-run needs both a start and an end date"),
        (start.isNotNull() & (~rerun | end.isNull()), "a start date needs mode R and an end date"),
        (end.isNotNull() & (~rerun | start.isNull()), "an end date needs mode R and a start date"),
        (start.isNotNull() & start_day.isNull(), "start date is not a yyyy-MM-dd date"),
        (end.isNotNull() & end_day.isNull(), "end date is not a yyyy-MM-dd date"),
        (rerun & (end_day < start_day), "end date lies before start date"),
        (mode.isNotNull() & ~mode.isin(RERUN, NORMAL), "mode must be R, N or empty"),
    ]
    return _worked_out(typed.withColumn("error", _first_failing(rules)))


def _worked_out(df: DataFrame) -> DataFrame:
    """The same rows, each column worked out once.

    Projections collapse into what uses them, so a rule with many parts would be copied to each
    use; a row made into an array of one and taken out again stops that, narrowly.
    """
    return df.select(F.inline(F.array(F.struct(*df.columns))))


def validate_config(config: DataFrame) -> DataFrame:
    """Active config rows with the first fault found in what their kind of process needs."""
    kind = F.col("proc_type")
    inbound_fields = {
        "src_system": "source system",
        "src_file_name": "file name",
        "trgt_tbl_name": "target table",
        "src_delimeter": "delimiter",
        "src_volume_name": "volume",
    }
    again = F.col("_n_configured") > 1
    rules = [(again, "process is configured twice")]
    rules += [
        ((kind == "inbound") & text.is_blank(F.col(name)), f"{label} is not configured")
        for name, label in inbound_fields.items()
    ]
    rules.append(
        ((kind == "transform") & F.col("script_path").isNull(), "script is not configured")
    )
    if "script_text" in config.columns:
        rules.append(((kind == "transform") & text.is_blank(F.col("script_text")), "script is empty"))
    rules.append((~F.col("data_freq").isin(DAILY, MONTHLY), "frequency must be D or M"))
    active = config.where(predicates.active())
    counted = active.withColumn("_n_configured", F.count("*").over(Window.partitionBy("proc_name")))
    return counted.withColumn("error", _first_failing(rules)).drop("_n_configured")


def config_by_process(config: DataFrame) -> DataFrame:
    """One row for each active process; ``n_configured`` tells how many it has in the config."""
    rest = [c for c in CONFIG_FIELDS if c != "proc_name"]
    active = config.where(predicates.active())
    one = active.groupBy("proc_name").agg(F.count("*").alias("n_configured"), F.min(F.struct(*rest)).alias("_c"))
    return one.select("proc_name", "_c.*", "n_configured")


def guard_runs(requests: DataFrame, config: DataFrame, status: DataFrame) -> DataFrame:
    """Requests with their config, last status and a ``guard_error``.

    The error is NULL when the process may start: it has one active config and
    is not running already.  A doubled config stops that process alone.  Config and status are joined once, here; the run
    window is then worked out row by row.
    """
    context = join_status(requests.join(config_by_process(config), "proc_name", "left"), status)
    error = F.when(F.col("is_active").isNull(), "process is unknown or not active")
    error = error.when(F.col("n_configured") > 1, "process is configured twice")
    error = error.when(F.col("last_proc_status") == RUNNING, "process is running already")
    return context.withColumn("guard_error", error).drop("n_configured")
