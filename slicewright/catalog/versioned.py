"""Versioned tables, leases, and rejected rows."""

from __future__ import annotations

from dataclasses import replace
from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slicewright import schemas
from slicewright.catalog import fixtures as fx
from slicewright.catalog.control import current_status
from slicewright.catalog.loads import _DAYS_CTE, daily_controls, daily_events, daily_files, land_daily_events, new_load, right_controls
from slicewright.catalog.registry import query
from slicewright.plans import leases
from slicewright.plans.inbound import load_files
from slicewright.schemas import FILE_LOG, FILE_LOG_KEY, conform
from slicewright.sources import delimited
from slicewright.storage import new_folder
from slicewright.versions import VersionedTable

ORDERS_BY_KEY = "o_orderkey, o_custkey, o_orderstatus"


def order_table(spark, sf_dir) -> VersionedTable:
    """Orders in a versioned table, dealt over its files by key."""
    table = VersionedTable(spark, new_folder(spark, "versioned"), ["o_orderkey"])
    rows = fx.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    table.overwrite(rows.repartitionByRange(16, "o_orderkey"))
    return table


@query(
    "snk_merge_touched",
    """
SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 1000 = 1 THEN 'M' ELSE o_orderstatus END AS o_orderstatus FROM orders
UNION ALL SELECT -o_orderkey, o_custkey, 'I' FROM orders WHERE o_orderkey % 1000 = 1""",
)
def snk_merge_touched(spark, sf_dir) -> DataFrame:
    """Some keys are updated and as many new ones added; files that hold none of them stay."""
    table = order_table(spark, sf_dir)
    some = fx.table(spark, sf_dir, "orders").where("o_orderkey % 1000 = 1").select("o_orderkey", "o_custkey")
    source = some.withColumn("o_orderstatus", F.lit("M")).unionAll(
        some.select(-F.col("o_orderkey"), "o_custkey", F.lit("I").alias("o_orderstatus"))
    )
    values = {"o_custkey": F.col("new_o_custkey"), "o_orderstatus": F.col("new_o_orderstatus")}
    table.merge_upsert(source, ["o_orderkey"], update=values, insert=values)
    return table.read()


@query(
    "snk_update_touched",
    "SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 500 = 3 AND o_orderstatus = 'O' THEN 'U' ELSE o_orderstatus END AS o_orderstatus FROM orders",
)
def snk_update_touched(spark, sf_dir) -> DataFrame:
    table = order_table(spark, sf_dir)
    changes = fx.table(spark, sf_dir, "orders").where("o_orderkey % 500 = 3").select("o_orderkey")
    table.update_matched(changes, ["o_orderkey"], {"o_orderstatus": F.lit("U")}, when=F.col("o_orderstatus") == "O")
    return table.read()


@query(
    "snk_slices_touched",
    """
SELECT event_id, CAST(ts AS DATE) AS day, CAST(value AS DECIMAL(12,2)) + CASE WHEN day(ts) IN (3, 4) THEN 100 ELSE 0 END AS value
FROM events WHERE day(ts) <> 5""",
)
def snk_slices_touched(spark, sf_dir) -> DataFrame:
    """The 3rd and 4th are replaced and the 5th is emptied, in one step."""
    value = F.col("value").cast("decimal(12,2)").cast("decimal(13,2)")
    rows = fx.table(spark, sf_dir, "events").select("event_id", F.col("ts").cast("date").alias("day"), value.alias("value"))
    table = VersionedTable(spark, new_folder(spark, "versioned"), ["day"])
    table.overwrite(rows.repartitionByRange(12, "day"))
    new = rows.where(F.dayofmonth("day").isin(3, 4)).withColumn("value", (F.col("value") + 100).cast("decimal(13,2)"))
    table.replace_slices(new, rows.where(F.dayofmonth("day").isin(3, 4, 5)).select("day").distinct())
    return table.read()


@query(
    "snk_log_compacted",
    f"""{fx.ctes("file_log")}
SELECT * FROM file_log
QUALIFY row_number() OVER (PARTITION BY proc_name, proc_run_id, file_name ORDER BY start_proc_dtm DESC) = 1""",
)
def snk_log_compacted(spark, sf_dir) -> DataFrame:
    """A file log appended in many batches, then put together into few files with the latest row of each key."""
    log = conform(fx.derive(spark, sf_dir, "file_log"), FILE_LOG)
    table = VersionedTable(spark, new_folder(spark, "log"))
    table.overwrite(log.where(F.dayofmonth("start_proc_dtm") <= 24))
    for day in range(25, 32):
        table.append(log.where(F.dayofmonth("start_proc_dtm") == day))
    table.compact(FILE_LOG_KEY, ["start_proc_dtm"])
    return table.read()


@query(
    "inbound_load_versioned",
    f"""WITH {_DAYS_CTE}
SELECT CAST(e.event_id AS STRING) AS event_id, strftime(e.ts, '%Y-%m-%d %H:%M:%S.%f') AS ts,
       e.event_type, {fx.amount("e.value")} AS value, '{fx.RUN_ID}' AS PROC_RUN_ID,
       TIMESTAMP '{fx.AS_OF_TEXT}' AS INS_PROC_DTM, v.data_dt AS DATA_DT
FROM events e JOIN verdicts v ON v.data_dt = CAST(e.ts AS DATE) AND v.check_status = 'OK'""",
)
def inbound_load_versioned(spark, sf_dir) -> DataFrame:
    """As inbound_load, into a table whose slices appear all at once; the good days are then loaded again."""
    load = replace(new_load(spark, land_daily_events(spark, sf_dir)), versioned=True)
    files = daily_files(spark, sf_dir)
    for _ in range(2):  # the second time with an empty ledger, as after a crash
        load_files(spark, load, files.select("file_name", "data_dt"), daily_controls(files))
        load = replace(load, ledger=load.ledger + "x")
    return VersionedTable(spark, load.target, ["DATA_DT"]).read()


@query(
    "inbound_load_bad_first_file",
    """
SELECT concat('FEED_', strftime(CAST(ts AS DATE), '%Y%m%d'), '.csv') AS file_name,
       CASE WHEN CAST(ts AS DATE) = min(CAST(ts AS DATE)) OVER () THEN 'HEADER_MISMATCH' ELSE 'OK' END AS check_status,
       CASE WHEN CAST(ts AS DATE) > min(CAST(ts AS DATE)) OVER () THEN count(*) END AS n_rows
FROM events GROUP BY CAST(ts AS DATE)""",
)
def inbound_load_bad_first_file(spark, sf_dir) -> DataFrame:
    """The first file of a new feed has another header than all others; it alone is refused."""
    rows, files = daily_events(spark, sf_dir), daily_files(spark, sf_dir)
    first = F.col("landed") == F.lit(files.agg(F.min("file_name")).first()[0])
    folder = fx.land(rows.where(~first), F.col("landed"), sep="|")
    fx.land(rows.where(first).select("value", F.col("ts").alias("wrong"), "landed"), F.col("landed"), sep="|", folder=folder)
    load = new_load(spark, folder)
    verdicts = load_files(spark, load, files.select("file_name", "data_dt"), right_controls(files))
    held = spark.read.parquet(load.target).groupBy(F.col("DATA_DT").alias("data_dt")).agg(F.count("*").alias("n_rows"))
    return verdicts.join(held, "data_dt", "left").select("file_name", "check_status", "n_rows")


LEASE_DAYS = 75


@query(
    "ctl_run_lease",
    f"""{fx.ctes("status_events", "requests")}, {fx.STATUS_CTE},
held AS (
SELECT proc_name, proc_run_id, start_proc_dtm AS taken_dtm, start_proc_dtm + INTERVAL '{LEASE_DAYS}' DAY AS expires_dtm,
       proc_status <> 'Running' AS released FROM status),
won AS (
SELECT proc_name, proc_run_id FROM requests r
WHERE NOT EXISTS (SELECT 1 FROM held h WHERE h.proc_name = r.proc_name AND NOT released AND expires_dtm > TIMESTAMP '{fx.AS_OF_TEXT}')
QUALIFY row_number() OVER (PARTITION BY proc_name ORDER BY requested_at, request_no) = 1)
SELECT coalesce(w.proc_name, h.proc_name) AS proc_name, coalesce(w.proc_run_id, h.proc_run_id) AS proc_run_id,
       CASE WHEN w.proc_name IS NULL THEN taken_dtm ELSE TIMESTAMP '{fx.AS_OF_TEXT}' END AS taken_dtm,
       CASE WHEN w.proc_name IS NULL THEN expires_dtm ELSE TIMESTAMP '{fx.AS_OF_TEXT}' + INTERVAL '{LEASE_DAYS}' DAY END AS expires_dtm,
       CASE WHEN w.proc_name IS NULL THEN released ELSE false END AS released
FROM held h FULL JOIN won w ON w.proc_name = h.proc_name""",
)
def ctl_run_lease(spark, sf_dir) -> DataFrame:
    """Leases after a batch of starts: runs that never ended keep theirs until it expires, then the first start takes over."""
    ttl = timedelta(days=LEASE_DAYS)
    status = current_status(spark, sf_dir)
    expires = F.col("start_proc_dtm") + F.make_dt_interval(F.lit(LEASE_DAYS))
    before = status.select(
        "proc_name", "proc_run_id", F.col("start_proc_dtm").alias("taken_dtm"), expires.alias("expires_dtm"),
        (F.col("proc_status") != "Running").alias("released"),
    )
    table = leases.lease_table(spark, new_folder(spark, "leases"))
    table.overwrite(conform(before, schemas.LEASE))
    starts = fx.derive(spark, sf_dir, "requests").select("proc_name", "proc_run_id", "requested_at", "request_no")
    leases.acquire(table, starts, fx.as_of(), ttl, ["requested_at", "request_no"])
    return table.read()


# Orders as text; some prices are no numbers, some lines lack a field or have one too many, some lack a required date.
_LINE = """concat_ws('|', CAST(o_orderkey AS STRING),
  CASE WHEN o_orderkey % 97 = 0 THEN 'n/a' ELSE CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS STRING) END,
  CASE WHEN o_orderkey % 89 = 0 THEN NULL WHEN o_orderkey % 83 = 0 THEN '' ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) END,
  CASE WHEN o_orderkey % 79 = 0 THEN 'x' END)"""
fx.DERIVATIONS["checked_lines"] = f"""
SELECT concat('ORD_', CAST(o_orderkey % 8 AS STRING), '.csv') AS file_name, o_orderkey, {_LINE} AS line FROM {{orders}}
"""
CHECKED_LAYOUT = T.StructType(
    [
        T.StructField("o_orderkey", T.LongType(), False),
        T.StructField("o_totalprice", T.DecimalType(12, 2)),
        T.StructField("o_orderdate", T.DateType(), False),
    ]
)
_REASON = """CASE WHEN (o_orderkey % 89 = 0) <> (o_orderkey % 79 = 0) THEN 'number of fields'
     WHEN o_orderkey % 97 = 0 AND o_orderkey % 79 = 0 AND o_orderkey % 89 = 0 THEN 'not of its type: o_totalprice, o_orderdate'
     WHEN o_orderkey % 97 = 0 THEN 'not of its type: o_totalprice'
     WHEN o_orderkey % 79 = 0 AND o_orderkey % 89 = 0 THEN 'not of its type: o_orderdate'
     WHEN o_orderkey % 83 = 0 THEN 'required: o_orderdate' END"""


def checked_orders(spark, sf_dir) -> DataFrame:
    lines = fx.derive(spark, sf_dir, "checked_lines")
    folder = new_folder(spark, "landing")
    lines.select(F.col("line").alias("value"), F.col("file_name").alias("landed")).write.partitionBy("landed").text(folder)
    return delimited.read_checked(spark, folder, CHECKED_LAYOUT, "|", header=False)


@query("src_csv_rejected", f"{fx.ctes('checked_lines')} SELECT file_name, line, {_REASON} AS reason FROM checked_lines WHERE {_REASON} IS NOT NULL")
def src_csv_rejected(spark, sf_dir) -> DataFrame:
    return delimited.rejected(checked_orders(spark, sf_dir))


@query(
    "src_csv_accepted",
    f"""{fx.ctes('checked_lines')}
SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(12,2)) AS o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate, file_name
FROM orders JOIN checked_lines USING (o_orderkey) WHERE {_REASON} IS NULL""",
)
def src_csv_accepted(spark, sf_dir) -> DataFrame:
    return delimited.accepted(checked_orders(spark, sf_dir))


@query(
    "src_csv_reject_verdicts",
    f"""{fx.ctes('checked_lines')}
SELECT file_name, count(*) AS n_rows, count({_REASON}) AS n_rejected,
       CASE WHEN count({_REASON}) > 0.045 * count(*) THEN 'ROWS_REJECTED' ELSE 'OK' END AS row_status
FROM checked_lines GROUP BY file_name""",
)
def src_csv_reject_verdicts(spark, sf_dir) -> DataFrame:
    return delimited.reject_verdicts(checked_orders(spark, sf_dir), most=0.045)
