"""Joins of requests, config and status."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slicewright import schemas
from slicewright.catalog import fixtures as fx
from slicewright.catalog.registry import query
from slicewright.operators.keys import first_per_key, latest_per_key
from slicewright.operators.ledger import unprocessed
from slicewright.plans import windows
from slicewright.schemas import conform


def current_status(spark, sf_dir) -> DataFrame:
    """Status table: the latest event of each process."""
    latest = latest_per_key(
        fx.status_events(spark, sf_dir), schemas.STATUS_KEY, ["start_proc_dtm", "event_id"]
    )
    return conform(latest, schemas.STATUS)


@query(
    "jn_request_config",
    f"""{fx.ctes("config", "requests")}
SELECT r.proc_name, r.proc_run_id, c.is_active, c.data_freq, c.run_period, c.data_back_day, c.notebook_path
FROM requests r JOIN config c ON r.proc_name = c.proc_name WHERE c.is_active = 1""",
)
def jn_request_config(spark, sf_dir) -> DataFrame:
    requests = fx.derive(spark, sf_dir, "requests").select("proc_name", "proc_run_id")
    return windows.join_config(requests, fx.config(spark, sf_dir))


@query(
    "jn_config_status_left",
    f"""{fx.ctes("config", "status_events")}, {fx.STATUS_CTE}
SELECT c.proc_name, c.data_freq, s.proc_status AS last_proc_status, s.run_mode AS last_run_mode,
       s.running_dt AS last_running_dt, s.start_dt AS last_start_dt, s.end_dt AS last_end_dt
FROM config c LEFT JOIN status s USING (proc_name)""",
)
def jn_config_status_left(spark, sf_dir) -> DataFrame:
    config = fx.config(spark, sf_dir).select("proc_name", "data_freq")
    return windows.join_status(config, current_status(spark, sf_dir))


@query(
    "jn_status_config",
    f"""{fx.ctes("config", "status_events")}, {fx.STATUS_CTE}
SELECT s.proc_name, s.proc_run_id, s.proc_status, s.end_dt, c.data_freq, c.notebook_path
FROM status s JOIN config c USING (proc_name)""",
)
def jn_status_config(spark, sf_dir) -> DataFrame:
    status = current_status(spark, sf_dir).select("proc_name", "proc_run_id", "proc_status", "end_dt")
    config = fx.config(spark, sf_dir).select("proc_name", "data_freq", "notebook_path")
    return status.join(config, "proc_name")


@query(
    "jn_cross_param",
    f"""{fx.ctes("config", "status_events")}, {fx.STATUS_CTE}
SELECT s.proc_name, s.proc_run_id, s.run_mode, s.running_dt, s.start_dt, s.end_dt,
       c.notebook_path, p.loop_no,
       CASE c.data_freq WHEN 'D' THEN s.running_dt + p.loop_no
                        WHEN 'M' THEN last_day(s.running_dt + to_months(p.loop_no)) END AS next_dt
FROM status s JOIN config c USING (proc_name), (SELECT 1 AS loop_no) p
WHERE s.proc_status = 'Running'""",
)
def jn_cross_param(spark, sf_dir) -> DataFrame:
    return windows.next_run_date(current_status(spark, sf_dir), fx.config(spark, sf_dir), loop_no=1)


@query(
    "jn_unprocessed_anti",
    """
WITH landed AS (SELECT event_id, concat('run-', epoch_us(ts) // 1000, '-part-', event_id) AS file_name
                FROM events),
ledger AS (SELECT concat('run-', epoch_us(ts) // 1000, '-part-', event_id) AS file_name
           FROM events WHERE event_type IN ('view', 'purchase'))
SELECT * FROM landed WHERE file_name NOT IN (SELECT file_name FROM ledger)""",
)
def jn_unprocessed_anti(spark, sf_dir) -> DataFrame:
    day = F.unix_date(F.col("ts").cast("date")).cast("bigint") * 86_400_000
    second = F.hour("ts") * 3_600_000 + F.minute("ts") * 60_000
    millis = F.floor(F.expr("extract(SECOND FROM ts)") * 1000)
    name = F.concat(
        F.lit("run-"), (day + second + millis).cast("string"), F.lit("-part-"),
        F.col("event_id").cast("string"),
    )
    landed = fx.table(spark, sf_dir, "events").select("event_id", name.alias("file_name"), "event_type")
    ledger = landed.where(F.col("event_type").isin("view", "purchase"))
    return unprocessed(landed.select("event_id", "file_name"), ledger)


@query(
    "win_latest_status",
    f"""{fx.ctes("status_events")}, {fx.STATUS_CTE} SELECT * FROM status""",
)
def win_latest_status(spark, sf_dir) -> DataFrame:
    return latest_per_key(
        fx.status_events(spark, sf_dir), schemas.STATUS_KEY, ["start_proc_dtm", "event_id"]
    )


_LINE_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
               "l_shipdate", "l_discount", "l_tax", "l_returnflag", "l_linestatus"]


@query(
    "lim_first_per_key",
    f"""SELECT * EXCLUDE (rn) FROM (
SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY {", ".join(_LINE_ORDER)}) AS rn
FROM lineitem) WHERE rn = 1""",
)
def lim_first_per_key(spark, sf_dir) -> DataFrame:
    return first_per_key(fx.table(spark, sf_dir, "lineitem"), ["l_orderkey"], _LINE_ORDER)
