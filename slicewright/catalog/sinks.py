"""Table changes and exports: each is carried out and the result read back."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slicewright import schemas
from slicewright.catalog import fixtures as fx
from slicewright.catalog.registry import query
from slicewright.catalog.scalars import SLICE_DAY
from slicewright.functions import filenames
from slicewright.operators import exports, ledger, mutations
from slicewright.operators.projection import with_lineage
from slicewright.storage import new_folder, save

# A fixed key, for these checks only; real feeds take theirs from a secret store.
CHECK_KEY = "0123456789abcdef"


@query("snk_overwrite", "SELECT * FROM part")
def snk_overwrite(spark, sf_dir) -> DataFrame:
    path = new_folder(spark, "overwrite")
    mutations.overwrite(fx.table(spark, sf_dir, "supplier"), path)
    mutations.overwrite(fx.table(spark, sf_dir, "part"), path)
    return spark.read.parquet(path)


# Lines as a table with a business date; a few have none.
fx.DERIVATIONS["dated_lines"] = """
SELECT l_orderkey, l_linenumber, l_quantity,
       CASE WHEN l_partkey % 50 = 0 THEN NULL ELSE CAST(l_shipdate AS DATE) END AS BUSINESSDAYDATE
FROM {lineitem}
"""


@query(
    "snk_slice_replace",
    f"""{fx.ctes("dated_lines")}
SELECT * FROM dated_lines
WHERE BUSINESSDAYDATE IS NULL OR BUSINESSDAYDATE <> DATE '{SLICE_DAY.isoformat()}'
UNION ALL
SELECT l_orderkey, l_linenumber, l_quantity + 1000, DATE '{SLICE_DAY.isoformat()}'
FROM dated_lines WHERE day(BUSINESSDAYDATE) = 17""",
)
def snk_slice_replace(spark, sf_dir) -> DataFrame:
    target = fx.derive(spark, sf_dir, "dated_lines")
    new = target.where(F.dayofmonth("BUSINESSDAYDATE") == 17).withColumns(
        {"l_quantity": F.col("l_quantity") + 1000, "BUSINESSDAYDATE": F.lit(SLICE_DAY)}
    )
    replaced = mutations.replace_slice(target, new, "BUSINESSDAYDATE", SLICE_DAY)
    return save(replaced, new_folder(spark, "slice"))


@query(
    "snk_slices_replace",
    f"""{fx.ctes("dated_lines")}
SELECT BUSINESSDAYDATE, l_orderkey, l_linenumber, l_quantity FROM dated_lines
WHERE BUSINESSDAYDATE IS NULL OR day(BUSINESSDAYDATE) <> 17
UNION ALL
SELECT BUSINESSDAYDATE, l_orderkey, l_linenumber, l_quantity + 1000
FROM dated_lines WHERE day(BUSINESSDAYDATE) = 17""",
)
def snk_slices_replace(spark, sf_dir) -> DataFrame:
    target = fx.derive(spark, sf_dir, "dated_lines")
    new = target.where(F.dayofmonth("BUSINESSDAYDATE") == 17).withColumn(
        "l_quantity", F.col("l_quantity") + 1000
    )
    return save(
        mutations.replace_slices(target, new, "BUSINESSDAYDATE"), new_folder(spark, "slices")
    )


@query(
    "snk_partition_replace",
    f"""
SELECT event_id, user_id, event_type, value + CASE WHEN day(ts) % 2 = 0 THEN 1000 ELSE 0 END AS value,
       CAST(ts AS DATE) AS DATA_DT,
       CASE WHEN day(ts) % 2 = 0 THEN 'run-0002' ELSE '{fx.RUN_ID}' END AS PROC_RUN_ID,
       TIMESTAMP '{fx.AS_OF_TEXT}' AS INS_PROC_DTM
FROM events""",
)
def snk_partition_replace(spark, sf_dir) -> DataFrame:
    path = new_folder(spark, "partitioned")
    events = fx.table(spark, sf_dir, "events")
    day = F.col("ts").cast("date")
    fields = ["event_id", "user_id", "event_type", "value"]
    first = with_lineage(events, day, fx.RUN_ID, fx.as_of())
    columns = [*fields, "DATA_DT", "PROC_RUN_ID", "INS_PROC_DTM"]
    mutations.write_slices(first.select(*columns), path, gather=True)
    again = with_lineage(
        events.where(F.dayofmonth("ts") % 2 == 0).withColumn("value", F.col("value") + 1000),
        day, "run-0002", fx.as_of(),
    )
    even = F.dayofmonth("DATA_DT") % 2 == 0
    mutations.write_slices(again.select(*columns), path, slices=even, gather=True)
    return spark.read.parquet(path)


@query("snk_csv_export", "SELECT * FROM events")
def snk_csv_export(spark, sf_dir) -> DataFrame:
    path = new_folder(spark, "export")
    events = fx.table(spark, sf_dir, "events")
    exports.write_delimited(events, path)
    return exports.read_delimited(spark, path, events.schema)


@query("snk_csv_feed", "SELECT * FROM lineitem")
def snk_csv_feed(spark, sf_dir) -> DataFrame:
    """One feed file, written by all tasks, proved and read back."""
    path = new_folder(spark, "export") + "/LINES_20240331.csv"
    lines = fx.table(spark, sf_dir, "lineitem")
    exports.write_feed(lines, path, verify=True)
    return exports.read_delimited(spark, path, lines.schema, line_breaks=False)


@query(
    "snk_log_append",
    f"""{fx.ctes("file_log")}
SELECT proc_name, proc_run_id, proc_status, file_name, total_record, start_proc_dtm, end_proc_dtm,
       error_message FROM file_log
UNION ALL
SELECT proc_name, concat(proc_run_id, '-next'), 'Processing', file_name, 0,
       TIMESTAMP '{fx.AS_OF_TEXT}', NULL, NULL FROM file_log WHERE proc_status = 'Failed'""",
)
def snk_log_append(spark, sf_dir) -> DataFrame:
    path = new_folder(spark, "log")
    log = schemas.conform(fx.derive(spark, sf_dir, "file_log"), schemas.FILE_LOG)
    mutations.overwrite(log, path)
    retries = log.where(F.col("proc_status") == schemas.FAILED).select(
        "proc_name",
        F.concat("proc_run_id", F.lit("-next")).alias("proc_run_id"),
        F.lit(schemas.PROCESSING).alias("proc_status"),
        "file_name",
        F.lit(0).alias("total_record"),
        fx.as_of().alias("start_proc_dtm"),
    )
    mutations.append(schemas.conform(retries, schemas.FILE_LOG), path)
    return spark.read.schema(schemas.FILE_LOG).parquet(path)


@query(
    "snk_update_matched",
    f"""{fx.ctes("file_log")}
SELECT l.proc_name, l.proc_run_id,
       CASE WHEN hit THEN new_status ELSE proc_status END AS proc_status, l.file_name,
       CASE WHEN hit THEN new_total ELSE total_record END AS total_record, start_proc_dtm,
       CASE WHEN hit THEN TIMESTAMP '{fx.AS_OF_TEXT}' ELSE end_proc_dtm END AS end_proc_dtm,
       CASE WHEN hit THEN NULL ELSE error_message END AS error_message
FROM (SELECT f.*, CASE WHEN e.event_id % 3 = 0 THEN 'Failed' ELSE 'Success' END AS new_status,
             e.event_id * 10 AS new_total,
             coalesce(f.proc_status = 'Processing' AND e.event_id % 2 = 0, false) AS hit
      FROM file_log f LEFT JOIN events e ON f.proc_run_id = concat('run-', e.event_id)) l""",
)
def snk_update_matched(spark, sf_dir) -> DataFrame:
    log = schemas.conform(fx.derive(spark, sf_dir, "file_log"), schemas.FILE_LOG)
    event = F.replace(F.col("proc_run_id"), F.lit("run-")).cast("bigint")
    changes = log.where(event % 2 == 0).select(
        *schemas.FILE_LOG_KEY,
        F.when(event % 3 == 0, schemas.FAILED).otherwise(schemas.SUCCESS).alias("proc_status"),
        (event * 10).alias("total_record"),
    )
    updated = mutations.update_matched(
        log,
        changes,
        schemas.FILE_LOG_KEY,
        {
            "proc_status": F.col("new_proc_status"),
            "total_record": F.col("new_total_record"),
            "end_proc_dtm": fx.as_of(),
            "error_message": F.lit(None),
        },
        when=F.col("proc_status") == schemas.PROCESSING,
    )
    return save(updated, new_folder(spark, "log"))


_UPSERT_ORACLE = """
WITH target AS (SELECT concat('order-', o_orderkey) AS proc_name, concat('old-', o_custkey) AS proc_run_id,
       o_orderstatus AS proc_status, CAST(o_orderdate AS DATE) AS running_dt,
       o_orderdate AS ins_proc_dtm FROM orders),
source AS (SELECT concat('order-', l_orderkey * 2) AS proc_name,
       concat('new-', CAST(count(*) AS STRING)) AS proc_run_id,
       CASE WHEN count(*) % 2 = 0 THEN 'Running' ELSE 'Success' END AS proc_status,
       CASE WHEN count(*) > 3 THEN NULL ELSE CAST(max(l_shipdate) AS DATE) END AS running_dt,
       max(l_shipdate) AS ins_proc_dtm FROM lineitem GROUP BY l_orderkey)
SELECT coalesce(t.proc_name, s.proc_name) AS proc_name,
       CASE WHEN s.proc_name IS NULL THEN t.proc_run_id ELSE s.proc_run_id END AS proc_run_id,
       CASE WHEN s.proc_name IS NULL THEN t.proc_status ELSE s.proc_status END AS proc_status,
       CASE WHEN s.proc_name IS NULL THEN t.running_dt ELSE s.running_dt END AS running_dt,
       CASE WHEN t.proc_name IS NULL THEN s.ins_proc_dtm ELSE t.ins_proc_dtm END AS ins_proc_dtm,
       CASE WHEN t.proc_name IS NOT NULL AND s.proc_name IS NOT NULL THEN s.ins_proc_dtm END
           AS upd_proc_dtm
FROM target t FULL JOIN source s ON t.proc_name = s.proc_name"""


@query("snk_merge_upsert", _UPSERT_ORACLE)
def snk_merge_upsert(spark, sf_dir) -> DataFrame:
    target = fx.table(spark, sf_dir, "orders").select(
        F.concat(F.lit("order-"), F.col("o_orderkey").cast("string")).alias("proc_name"),
        F.concat(F.lit("old-"), F.col("o_custkey").cast("string")).alias("proc_run_id"),
        F.col("o_orderstatus").alias("proc_status"),
        F.col("o_orderdate").cast("date").alias("running_dt"),
        F.col("o_orderdate").alias("ins_proc_dtm"),
        F.lit(None).cast("timestamp_ntz").alias("upd_proc_dtm"),
    )
    n = F.col("n")
    source = (
        fx.table(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey")
        .agg(F.count("*").alias("n"), F.max("l_shipdate").alias("shipped"))
        .select(
            F.concat(F.lit("order-"), (F.col("l_orderkey") * 2).cast("string")).alias("proc_name"),
            F.concat(F.lit("new-"), n.cast("string")).alias("proc_run_id"),
            F.when(n % 2 == 0, schemas.RUNNING).otherwise(schemas.SUCCESS).alias("proc_status"),
            F.when(n <= 3, F.col("shipped").cast("date")).alias("running_dt"),
            F.col("shipped").alias("ins_proc_dtm"),
        )
    )
    entered = {c: F.col(f"new_{c}") for c in ("proc_run_id", "proc_status", "running_dt")}
    first_seen = F.col("new_ins_proc_dtm")
    merged = mutations.merge_upsert(
        target,
        source,
        schemas.STATUS_KEY,
        update={**entered, "upd_proc_dtm": first_seen},
        insert={**entered, "ins_proc_dtm": first_seen},
    )
    return save(merged, new_folder(spark, "status"))


_CONFIG_COLUMNS = ", ".join(schemas.CONFIG.names)


@query(
    "snk_insert_select",
    f"""{fx.ctes("config")}, whole AS (SELECT *, TIMESTAMP '2024-01-01 00:00:00' AS created_dtm,
  CAST(NULL AS STRING) AS updated_by, CAST(NULL AS TIMESTAMP) AS updated_dtm FROM config)
SELECT {_CONFIG_COLUMNS} FROM whole
UNION ALL BY NAME
SELECT concat('INB_', s_name) AS proc_name, 'inbound' AS proc_type, 1 AS is_active, 1 AS run_period,
       1 AS data_back_day, 'D' AS data_freq, '/jobs/common_inbound' AS notebook_path,
       'setup' AS created_by, TIMESTAMP '{fx.AS_OF_TEXT}' AS created_dtm, s_name AS src_file_name
FROM supplier""",
)
def snk_insert_select(spark, sf_dir) -> DataFrame:
    path = new_folder(spark, "config")
    mutations.overwrite(fx.config(spark, sf_dir), path)
    added = fx.table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("INB_"), "s_name").alias("proc_name"),
        F.lit("inbound").alias("proc_type"),
        F.lit(1).alias("is_active"),
        F.lit(1).alias("run_period"),
        F.lit(1).alias("data_back_day"),
        F.lit(schemas.DAILY).alias("data_freq"),
        F.lit("/jobs/common_inbound").alias("notebook_path"),
        F.lit("setup").alias("created_by"),
        fx.as_of().alias("created_dtm"),
        F.col("s_name").alias("src_file_name"),
    )
    mutations.insert_select(added, path, schemas.CONFIG)
    return spark.read.schema(schemas.CONFIG).parquet(path)


@query(
    "snk_insert_values",
    f"""{fx.ctes("status_events")}
SELECT proc_name, proc_run_id, proc_status, run_mode, ins_proc_dtm, running_dt, start_dt, end_dt,
       start_proc_dtm, end_proc_dtm, CAST(NULL AS TIMESTAMP) AS upd_proc_dtm FROM status_events
UNION ALL
SELECT * FROM (VALUES
  ('EXTRACT_A', 'seed-1', 'Success', 'N', TIMESTAMP '2024-01-01 00:00:00', NULL::DATE, DATE '2023-12-31',
   DATE '2023-12-31', NULL::TIMESTAMP, NULL::TIMESTAMP, NULL::TIMESTAMP),
  ('EXTRACT_B', 'seed-2', 'Failed', 'R', TIMESTAMP '2024-01-01 00:00:00', DATE '2023-12-30',
   DATE '2023-12-29', DATE '2023-12-31', NULL, NULL, NULL))""",
)
def snk_insert_values(spark, sf_dir) -> DataFrame:
    path = new_folder(spark, "status")
    mutations.overwrite(
        schemas.conform(fx.status_events(spark, sf_dir), schemas.STATUS), path
    )
    columns = ["proc_name", "proc_run_id", "proc_status", "run_mode", "ins_proc_dtm", "running_dt",
               "start_dt", "end_dt"]
    new_year = datetime(2024, 1, 1)
    rows = [
        ("EXTRACT_A", "seed-1", "Success", "N", new_year, None, date(2023, 12, 31),
         date(2023, 12, 31)),
        ("EXTRACT_B", "seed-2", "Failed", "R", new_year, date(2023, 12, 30), date(2023, 12, 29),
         date(2023, 12, 31)),
    ]
    mutations.insert_values(spark, rows, columns, path, schemas.STATUS)
    return spark.read.schema(schemas.STATUS).parquet(path)


@query("snk_protected_feed", "SELECT * FROM events")
def snk_protected_feed(spark, sf_dir) -> DataFrame:
    path = new_folder(spark, "protected")
    events = fx.table(spark, sf_dir, "events")
    key = F.lit(CHECK_KEY).cast("binary")
    exports.protect(events, key).write.text(path)
    return exports.unprotect(spark.read.text(path), key, events.schema)


@query(
    "snk_file_ledger",
    f"""
WITH files AS (SELECT CAST(l_shipdate AS DATE) AS data_dt, count(*) AS n_bytes FROM lineitem GROUP BY 1),
named AS (SELECT concat('LINES_', strftime(data_dt, '%Y%m%d'), '.csv') AS file_name, * FROM files)
SELECT file_name, 'INB_LINES' AS proc_name,
       CASE WHEN day(data_dt) <= 15 THEN '{fx.RUN_ID}' ELSE 'run-0002' END AS proc_run_id,
       concat('zone/in/archived/20240401030000/LINES_', strftime(data_dt, '%Y%m%d'), '_',
              strftime(data_dt, '%Y%m%d'), '_20240401030000.csv') AS archive_path,
       TIMESTAMP '{fx.AS_OF_TEXT}' AS processed_dtm, data_dt, n_bytes,
       TIMESTAMP '{fx.AS_OF_TEXT}' AS modified_dtm
FROM named""",
)
def snk_file_ledger(spark, sf_dir) -> DataFrame:
    """Two pick-ups of one landing zone; the second takes only what the first left."""
    path = new_folder(spark, "ledger")
    days = fx.table(spark, sf_dir, "lineitem").groupBy(F.col("l_shipdate").cast("date").alias("data_dt"))
    landed = days.agg(F.count("*").alias("n_bytes")).withColumns(
        {"file_name": filenames.dated_name(F.lit("LINES"), F.col("data_dt")), "modified_dtm": fx.as_of()}
    )

    def pick_up(files: DataFrame, run_id: str) -> None:
        rows = ledger.entries(
            files, folder="zone/in", proc_name=F.lit("INB_LINES"), run_id=F.lit(run_id),
            as_of=fx.as_of(),
        )
        mutations.append(rows, path)

    pick_up(landed.where(F.dayofmonth("data_dt") <= 15), fx.RUN_ID)
    so_far = spark.read.schema(schemas.LEDGER).parquet(path)
    pick_up(ledger.unprocessed(landed, so_far), "run-0002")
    return spark.read.schema(schemas.LEDGER).parquet(path)
