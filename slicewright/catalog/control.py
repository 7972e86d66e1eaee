"""Control framework: validation, run windows, calendars and progress."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slicewright import schemas
from slicewright.catalog import fixtures as fx
from slicewright.catalog.joins import current_status
from slicewright.catalog.registry import query
from slicewright.functions import envelope
from slicewright.operators.keys import latest_per_key
from slicewright.plans import progress, requests, steps, windows
from slicewright.storage import new_folder, save

# --- oracle pieces -------------------------------------------------------------

_CHECKED_CTE = """clean AS (
SELECT proc_name, proc_run_id, requested_at, request_no,
       CASE WHEN trim(run_mode) <> '' THEN run_mode END AS run_mode,
       CASE WHEN trim(start_dt) <> '' THEN start_dt END AS start_dt,
       CASE WHEN trim(end_dt) <> '' THEN end_dt END AS end_dt FROM requests),
typed AS (
SELECT *, CASE WHEN regexp_full_match(start_dt, '\\d{4}-\\d{1,2}-\\d{1,2}')
               THEN TRY_CAST(start_dt AS DATE) END AS start_day,
       CASE WHEN regexp_full_match(end_dt, '\\d{4}-\\d{1,2}-\\d{1,2}')
               THEN TRY_CAST(end_dt AS DATE) END AS end_day,
       coalesce(run_mode = 'R', false) AS rerun FROM clean),
checked AS (
SELECT *, CASE
  WHEN rerun AND (start_dt IS NULL OR end_dt IS NULL)
    THEN 'a re-run needs both a start and an end date'
  WHEN start_dt IS NOT NULL AND (NOT rerun OR end_dt IS NULL)
    THEN 'a start date needs mode R and an end date'
  WHEN end_dt IS NOT NULL AND (NOT rerun OR start_dt IS NULL)
    THEN 'an end date needs mode R and a start date'
  WHEN start_dt IS NOT NULL AND start_day IS NULL THEN 'start date is not a yyyy-MM-dd date'
  WHEN end_dt IS NOT NULL AND end_day IS NULL THEN 'end date is not a yyyy-MM-dd date'
  WHEN rerun AND end_day < start_day THEN 'end date lies before start date'
  WHEN run_mode NOT IN ('R', 'N') THEN 'mode must be R, N or empty' END AS error
FROM typed)"""

_LATEST_CTE = """latest AS (
SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (
  PARTITION BY proc_name ORDER BY requested_at DESC, request_no DESC) AS rn
  FROM checked WHERE error IS NULL) WHERE rn = 1)"""

_GUARD_CTE = """guarded AS (
SELECT r.*, CASE WHEN c.proc_name IS NULL THEN 'process is unknown or not active'
                 WHEN c.n > 1 THEN 'process is configured twice'
                 WHEN s.proc_status = 'Running' THEN 'process is running already' END AS guard_error
FROM latest r LEFT JOIN (SELECT proc_name, count(*) AS n FROM config WHERE is_active = 1 GROUP BY 1) c ON c.proc_name = r.proc_name
LEFT JOIN status s ON s.proc_name = r.proc_name)"""

# 2024-03-31 20:00 UTC is 2024-04-01 in the business zone.
_WINDOW_CTE = f"""joined AS (
SELECT g.proc_name, g.proc_run_id, g.run_mode, g.start_day, g.end_day,
       c.data_freq, c.run_period, c.data_back_day, c.notebook_path,
       coalesce(s.proc_status, '') = 'Failed' AS failed,
       s.run_mode AS s_mode, s.running_dt AS s_running, s.start_dt AS s_start, s.end_dt AS s_end
FROM guarded g JOIN config c ON c.proc_name = g.proc_name AND c.is_active = 1
LEFT JOIN status s ON s.proc_name = g.proc_name WHERE g.guard_error IS NULL),
ended AS (
SELECT *, CASE WHEN failed THEN s_end
  WHEN data_freq = 'D' THEN coalesce(end_day, DATE '2024-04-01' - data_back_day)
  WHEN data_freq = 'M' THEN coalesce(last_day(end_day),
       last_day(DATE '2024-04-01' - to_months(data_back_day))) END AS w_end FROM joined),
started AS (
SELECT *, CASE WHEN failed AND s_start IS NOT NULL THEN s_start
  WHEN data_freq = 'D' THEN coalesce(start_day, w_end - (run_period - 1))
  WHEN data_freq = 'M' THEN coalesce(last_day(start_day),
       last_day(w_end - to_months(run_period - 1))) END AS w_start FROM ended),
windows AS (
SELECT proc_name, proc_run_id, 'Running' AS proc_status,
       CASE WHEN failed THEN s_mode ELSE coalesce(run_mode, 'N') END AS run_mode,
       CASE WHEN failed AND s_running IS NOT NULL THEN s_running ELSE w_start END AS running_dt,
       w_start AS start_dt, w_end AS end_dt,
       TIMESTAMP '{fx.AS_OF_TEXT}' AS start_proc_dtm, TIMESTAMP '{fx.AS_OF_TEXT}' AS ins_proc_dtm,
       data_freq, notebook_path
FROM started)"""

_TO_WINDOWS = ", ".join(
    [
        fx.ctes("requests", "config", "status_events"),
        fx.STATUS_CTE,
        _CHECKED_CTE,
        _LATEST_CTE,
        _GUARD_CTE,
        _WINDOW_CTE,
    ]
)

# --- Spark pieces --------------------------------------------------------------


def newest_accepted(spark, sf_dir) -> DataFrame:
    """The newest accepted request of each process."""
    every = fx.derive(spark, sf_dir, "requests")
    accepted = requests.validate_requests(every).where(F.col("error").isNull())
    needed = accepted.select(
        "proc_name", "proc_run_id", "run_mode", "start_day", "end_day", "requested_at", "request_no"
    )
    return latest_per_key(needed, ["proc_name"], ["requested_at", "request_no"])


def guarded_requests(spark, sf_dir, status: DataFrame) -> DataFrame:
    return requests.guard_runs(
        newest_accepted(spark, sf_dir), fx.config(spark, sf_dir), status
    )


def run_windows(spark, sf_dir, status: DataFrame | None = None) -> DataFrame:
    if status is None:
        status = current_status(spark, sf_dir)
    free = guarded_requests(spark, sf_dir, status).where(F.col("guard_error").isNull())
    return windows.resolve_windows(free, fx.as_of())


# --- queries -------------------------------------------------------------------


@query(
    "ctl_request_validate",
    f"""{fx.ctes("requests")}, {_CHECKED_CTE}
SELECT proc_name, proc_run_id, run_mode, start_dt, end_dt, start_day, end_day, error FROM checked""",
)
def ctl_request_validate(spark, sf_dir) -> DataFrame:
    checked = requests.validate_requests(fx.derive(spark, sf_dir, "requests"))
    return checked.drop("requested_at", "request_no")


@query(
    "ctl_config_validate",
    f"""{fx.ctes("config")}
SELECT proc_name, proc_type, CASE
  WHEN count(*) OVER (PARTITION BY proc_name) > 1 THEN 'process is configured twice'
  WHEN proc_type = 'inbound' AND coalesce(trim(src_system), '') = ''
    THEN 'source system is not configured'
  WHEN proc_type = 'inbound' AND coalesce(trim(src_file_name), '') = '' THEN 'file name is not configured'
  WHEN proc_type = 'inbound' AND coalesce(trim(trgt_tbl_name), '') = ''
    THEN 'target table is not configured'
  WHEN proc_type = 'inbound' AND coalesce(trim(src_delimeter), '') = '' THEN 'delimiter is not configured'
  WHEN proc_type = 'inbound' AND coalesce(trim(src_volume_name), '') = '' THEN 'volume is not configured'
  WHEN proc_type = 'transform' AND script_path IS NULL THEN 'script is not configured'
  WHEN proc_type = 'transform' AND coalesce(trim(script_text), '') = '' THEN 'script is empty'
  WHEN data_freq NOT IN ('D', 'M') THEN 'frequency must be D or M' END AS error
FROM (SELECT *, CASE WHEN proc_name LIKE '%8' THEN ' ' ELSE 'SELECT 1' END AS script_text FROM config)
WHERE is_active = 1""",
)
def ctl_config_validate(spark, sf_dir) -> DataFrame:
    scripted = fx.config(spark, sf_dir).withColumn(
        "script_text", F.when(F.col("proc_name").endswith("8"), " ").otherwise("SELECT 1")
    )
    return requests.validate_config(scripted).select("proc_name", "proc_type", "error")


@query(
    "ctl_run_guard",
    ", ".join(
        [
            fx.ctes("requests", "config", "status_events"),
            fx.STATUS_CTE,
            _CHECKED_CTE,
            _LATEST_CTE,
            _GUARD_CTE,
        ]
    )
    + " SELECT proc_name, proc_run_id, guard_error FROM guarded",
)
def ctl_run_guard(spark, sf_dir) -> DataFrame:
    guarded = guarded_requests(spark, sf_dir, current_status(spark, sf_dir))
    return guarded.select("proc_name", "proc_run_id", "guard_error")


@query(
    "ctl_run_window",
    f"""{_TO_WINDOWS}
SELECT *, CASE WHEN running_dt IS NULL OR end_dt IS NULL THEN 'run window has no dates' END
       AS window_error FROM windows""",
)
def ctl_run_window(spark, sf_dir) -> DataFrame:
    return run_windows(spark, sf_dir)


_CALENDAR_CTE = """daily AS (
SELECT w.*, CAST(unnest(generate_series(running_dt, end_dt, INTERVAL 1 DAY)) AS DATE) AS run_day
FROM windows w WHERE data_freq = 'D' AND running_dt <= end_dt),
monthly AS (
SELECT w.*, last_day(unnest(generate_series(date_trunc('month', running_dt),
       date_trunc('month', end_dt), INTERVAL 1 MONTH))) AS run_day
FROM windows w WHERE data_freq = 'M' AND running_dt <= end_dt),
calendar AS (
SELECT proc_name, proc_run_id, run_mode, start_dt, end_dt, notebook_path,
       CAST(row_number() OVER (PARTITION BY proc_name ORDER BY run_day) - 1 AS INTEGER) AS loop_no,
       run_day AS running_dt
FROM (SELECT * FROM daily UNION ALL SELECT * FROM monthly) WHERE run_day <= end_dt)"""


@query("ctl_run_calendar", f"{_TO_WINDOWS}, {_CALENDAR_CTE} SELECT * FROM calendar")
def ctl_run_calendar(spark, sf_dir) -> DataFrame:
    return windows.expand_calendar(run_windows(spark, sf_dir))


@query(
    "ctl_status_start",
    f"""{_TO_WINDOWS}
SELECT coalesce(s.proc_name, w.proc_name) AS proc_name,
       CASE WHEN w.proc_name IS NULL THEN s.proc_run_id ELSE w.proc_run_id END AS proc_run_id,
       CASE WHEN w.proc_name IS NULL THEN s.proc_status ELSE w.proc_status END AS proc_status,
       CASE WHEN w.proc_name IS NULL THEN s.run_mode ELSE w.run_mode END AS run_mode,
       CASE WHEN s.proc_name IS NULL THEN w.ins_proc_dtm ELSE s.ins_proc_dtm END AS ins_proc_dtm,
       CASE WHEN w.proc_name IS NULL THEN s.running_dt ELSE w.running_dt END AS running_dt,
       CASE WHEN w.proc_name IS NULL THEN s.start_dt ELSE w.start_dt END AS start_dt,
       CASE WHEN w.proc_name IS NULL THEN s.end_dt ELSE w.end_dt END AS end_dt,
       CASE WHEN w.proc_name IS NULL THEN s.start_proc_dtm ELSE w.start_proc_dtm END AS start_proc_dtm,
       s.end_proc_dtm,
       CASE WHEN w.proc_name IS NOT NULL AND s.proc_name IS NOT NULL THEN w.ins_proc_dtm END
           AS upd_proc_dtm
FROM status s FULL JOIN (SELECT * FROM windows WHERE running_dt IS NOT NULL AND end_dt IS NOT NULL) w
  ON s.proc_name = w.proc_name""",
)
def ctl_status_start(spark, sf_dir) -> DataFrame:
    status = save(current_status(spark, sf_dir), new_folder(spark, "status"))
    started = progress.start_status(status, run_windows(spark, sf_dir, status))
    return save(started, new_folder(spark, "status"))


_OUTCOME_ORDER = ["finished_at", "event_id"]

_STOPPED_CTE = """stopped AS (
SELECT * EXCLUDE (failures) FROM (
  SELECT *, coalesce(sum(CASE WHEN proc_status = 'Failed' THEN 1 ELSE 0 END) OVER (
    PARTITION BY proc_name ORDER BY finished_at, event_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS failures FROM outcomes)
WHERE failures = 0)"""


def attempted(spark, sf_dir) -> DataFrame:
    return progress.stop_after_failure(
        fx.derive(spark, sf_dir, "outcomes"),
        "proc_name",
        _OUTCOME_ORDER,
        F.col("proc_status") == schemas.FAILED,
    )


@query("ctl_stop_after_failure", f"{fx.ctes('outcomes')}, {_STOPPED_CTE} SELECT * FROM stopped")
def ctl_stop_after_failure(spark, sf_dir) -> DataFrame:
    return attempted(spark, sf_dir)


_STATUS_COLUMNS = ("proc_name, proc_run_id, proc_status, run_mode, ins_proc_dtm, running_dt, "
                   "start_dt, end_dt, start_proc_dtm, end_proc_dtm, upd_proc_dtm")

_STATUS_WHOLE = "st AS (SELECT *, CAST(NULL AS TIMESTAMP) AS upd_proc_dtm FROM status)"


@query(
    "ctl_progress",
    f"""{fx.ctes("outcomes", "status_events")}, {fx.STATUS_CTE}, {_STATUS_WHOLE}, {_STOPPED_CTE},
marks AS (SELECT proc_name, max(running_dt) AS mark FROM stopped GROUP BY proc_name HAVING count(*) > 1)
SELECT {_STATUS_COLUMNS} FROM (
SELECT st.* REPLACE (CASE WHEN mark IS NULL THEN proc_status ELSE 'Running' END AS proc_status,
       coalesce(mark, running_dt) AS running_dt,
       CASE WHEN mark IS NOT NULL THEN TIMESTAMP '{fx.AS_OF_TEXT}' END AS upd_proc_dtm)
FROM st LEFT JOIN marks USING (proc_name))""",
)
def ctl_progress(spark, sf_dir) -> DataFrame:
    return progress.move_marker(
        current_status(spark, sf_dir), attempted(spark, sf_dir), fx.as_of()
    )


@query(
    "ctl_status_finish",
    f"""{fx.ctes("outcomes", "status_events")}, {fx.STATUS_CTE}, {_STATUS_WHOLE}, {_STOPPED_CTE},
results AS (SELECT proc_name, bool_or(proc_status = 'Failed') AS failed FROM stopped GROUP BY proc_name)
SELECT {_STATUS_COLUMNS} FROM (
SELECT st.* REPLACE (CASE WHEN failed IS NULL THEN proc_status WHEN failed THEN 'Failed'
                          ELSE 'Success' END AS proc_status,
       CASE WHEN failed IS NULL OR failed THEN running_dt END AS running_dt,
       CASE WHEN failed IS NULL THEN end_proc_dtm WHEN failed THEN NULL
            ELSE TIMESTAMP '{fx.AS_OF_TEXT}' END AS end_proc_dtm,
       CASE WHEN failed IS NOT NULL THEN TIMESTAMP '{fx.AS_OF_TEXT}' END AS upd_proc_dtm)
FROM st LEFT JOIN results USING (proc_name))""",
)
def ctl_status_finish(spark, sf_dir) -> DataFrame:
    results = progress.results_of(attempted(spark, sf_dir))
    return progress.finish_status(current_status(spark, sf_dir), results, fx.as_of())


@query(
    "ctl_run_cycle",
    f"""{_TO_WINDOWS}, {_CALENDAR_CTE},
begun AS (SELECT * FROM windows WHERE running_dt IS NOT NULL AND end_dt IS NOT NULL),
broken AS (SELECT proc_name, min(running_dt) AS stop FROM calendar WHERE day(running_dt) = 13 GROUP BY 1),
tried AS (
SELECT c.proc_name, count(*) AS n, max(c.running_dt) AS mark, bool_or(day(c.running_dt) = 13) AS failed
FROM calendar c LEFT JOIN broken b USING (proc_name)
WHERE stop IS NULL OR c.running_dt <= stop GROUP BY 1)
SELECT coalesce(s.proc_name, w.proc_name) AS proc_name,
       CASE WHEN w.proc_name IS NULL THEN s.proc_run_id ELSE w.proc_run_id END AS proc_run_id,
       CASE WHEN w.proc_name IS NULL THEN s.proc_status
            WHEN coalesce(t.failed, false) THEN 'Failed' ELSE 'Success' END AS proc_status,
       CASE WHEN w.proc_name IS NULL THEN s.run_mode ELSE w.run_mode END AS run_mode,
       CASE WHEN w.proc_name IS NULL THEN s.running_dt
            WHEN coalesce(t.failed, false) THEN CASE WHEN t.n > 1 THEN t.mark ELSE w.running_dt END
            END AS running_dt,
       CASE WHEN w.proc_name IS NULL THEN s.start_dt ELSE w.start_dt END AS start_dt,
       CASE WHEN w.proc_name IS NULL THEN s.end_dt ELSE w.end_dt END AS end_dt,
       CASE WHEN w.proc_name IS NULL THEN s.start_proc_dtm ELSE w.start_proc_dtm END AS start_proc_dtm,
       CASE WHEN w.proc_name IS NULL THEN s.end_proc_dtm
            WHEN NOT coalesce(t.failed, false) THEN TIMESTAMP '{fx.AS_OF_TEXT}' END AS end_proc_dtm,
       CASE WHEN s.proc_name IS NULL THEN w.ins_proc_dtm ELSE s.ins_proc_dtm END AS ins_proc_dtm,
       CASE WHEN w.proc_name IS NOT NULL THEN TIMESTAMP '{fx.AS_OF_TEXT}' END AS upd_proc_dtm
FROM status s FULL JOIN begun w ON s.proc_name = w.proc_name
LEFT JOIN tried t ON t.proc_name = w.proc_name""",
)
def ctl_run_cycle(spark, sf_dir) -> DataFrame:
    """Requests through guard, window, start and outcomes to the final status.

    Every process fails on the 13th of a month; what follows is not attempted.
    """
    status = current_status(spark, sf_dir)
    found = save(run_windows(spark, sf_dir, status), new_folder(spark, "windows"))
    started = progress.start_status(status, found)
    failed = F.dayofmonth("running_dt") == 13
    outcomes = windows.expand_calendar(found).withColumn(
        "proc_status", F.when(failed, schemas.FAILED).otherwise(schemas.SUCCESS)
    )
    tried = progress.stop_after_failure(outcomes, "proc_name", ["running_dt"], failed)
    marked = progress.move_marker(started, tried, fx.as_of())
    return progress.finish_status(marked, progress.results_of(tried, found), fx.as_of())


@query(
    "ctl_log_close",
    f"""{fx.ctes("run_log", "outcomes")}
SELECT l.proc_name, l.proc_run_id,
       CASE WHEN l.proc_status = 'Running' THEN o.proc_status ELSE l.proc_status END AS proc_status,
       l.run_mode, l.start_proc_dtm, l.running_dt, l.start_dt, l.end_dt,
       CASE WHEN l.proc_status = 'Running' THEN TIMESTAMP '{fx.AS_OF_TEXT}' END AS end_proc_dtm,
       CASE WHEN l.proc_status = 'Running'
            THEN regexp_replace(o.error_message, '[^\\p{{L}}\\p{{N}}_\\s/:#]', '', 'g') END AS error_message
FROM run_log l JOIN outcomes o ON o.proc_run_id = l.proc_run_id""",
)
def ctl_log_close(spark, sf_dir) -> DataFrame:
    report = envelope.build(F.col("proc_status"), F.col("error_message"))
    reports = fx.derive(spark, sf_dir, "outcomes").select(
        *schemas.RUN_LOG_KEY, report.alias("envelope")
    )
    return progress.close_log(
        fx.run_log(spark, sf_dir), progress.read_outcomes(reports), fx.as_of()
    )


@query(
    "ctl_log_open",
    f"""{_TO_WINDOWS}, {_CALENDAR_CTE}
SELECT proc_name, proc_run_id, 'Running' AS proc_status, run_mode,
       TIMESTAMP '{fx.AS_OF_TEXT}' AS start_proc_dtm, running_dt, start_dt, end_dt,
       CAST(NULL AS TIMESTAMP) AS end_proc_dtm, CAST(NULL AS STRING) AS error_message
FROM calendar""",
)
def ctl_log_open(spark, sf_dir) -> DataFrame:
    calendar = windows.expand_calendar(run_windows(spark, sf_dir))
    return progress.log_rows(calendar, fx.as_of())


STEPS = [
    (
        "daily",
        """SELECT CAST(l_shipdate AS DATE) AS ship_dt, l_returnflag,
                  CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS qty, count(*) AS n_lines
           FROM {lineitem} WHERE l_shipdate < CAST(:data_dt AS DATE) GROUP BY ALL""",
    ),
    ("blank", "  "),
    (
        "stamped",
        """SELECT *, DATE '${data_dt}' AS DATA_DT, :proc_run_id AS PROC_RUN_ID
           FROM {daily} WHERE qty > 10""",
    ),
]


@query(
    "ctl_sql_steps",
    f"""
SELECT CAST(l_shipdate AS DATE) AS ship_dt, l_returnflag,
       CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS qty, count(*) AS n_lines,
       DATE '2000-06-30' AS DATA_DT, '{fx.RUN_ID}' AS PROC_RUN_ID
FROM lineitem WHERE l_shipdate < DATE '2000-06-30'
GROUP BY CAST(l_shipdate AS DATE), l_returnflag HAVING sum(l_quantity) > 10""",
)
def ctl_sql_steps(spark, sf_dir) -> DataFrame:
    return steps.run_steps(
        spark,
        STEPS,
        data_dt="2000-06-30",
        proc_run_id=fx.RUN_ID,
        sources={"lineitem": fx.table(spark, sf_dir, "lineitem")},
    )


SCRIPT = """
DECLARE cut DATE DEFAULT CAST(:data_dt AS DATE);
DECLARE n_late BIGINT DEFAULT 0;
DECLARE note STRING DEFAULT 'counted; complete';
BEGIN
  DECLARE EXIT HANDLER FOR TABLE_OR_VIEW_NOT_FOUND
    SET note = 'counted; no table of late lines';
  SET n_late = (SELECT count(*) FROM late_lines);
END;
SELECT l_returnflag, count(*) AS n_lines, n_late, note, '${proc_run_id}' AS PROC_RUN_ID
FROM {lineitem} WHERE l_shipdate < cut GROUP BY l_returnflag;
"""


@query(
    "ctl_sql_script",
    f"""
SELECT l_returnflag, count(*) AS n_lines, CAST(0 AS BIGINT) AS n_late, 'counted; no table of late lines' AS note, '{fx.RUN_ID}' AS PROC_RUN_ID
FROM lineitem WHERE l_shipdate < DATE '2000-06-30' GROUP BY l_returnflag""",
)
def ctl_sql_script(spark, sf_dir) -> DataFrame:
    lineitem = fx.table(spark, sf_dir, "lineitem")
    return steps.run_script(spark, SCRIPT, data_dt="2000-06-30", proc_run_id=fx.RUN_ID, sources={"lineitem": lineitem})
