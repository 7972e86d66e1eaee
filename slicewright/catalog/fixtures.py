"""Control tables and landed files derived from the test tables.

The derivations are SQL that Spark and DuckDB both accept, with source tables
written as ``{table}``, so both sides of a check start from the same rows.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from slicewright import schemas
from slicewright.functions import dates, filenames
from slicewright.schemas import conform
from slicewright.storage import new_folder

# The run clock of every query: 20:00 UTC is already the next day in the business zone.
AS_OF_TEXT = "2024-03-31 20:00:00"
RUN_ID = "run-0001"


def as_of() -> Column:
    return dates.clock(F.lit(AS_OF_TEXT))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Text pieces that recur below.
_PROC = "concat('Customer#', lpad(CAST({id} AS STRING), 9, '0'))"
_PROC_OF_USER = _PROC.replace("{id}", "user_id")
_PROC_OF_CUSTOMER = _PROC.replace("{id}", "o_custkey")

DERIVATIONS: dict[str, str] = {}

DERIVATIONS["config"] = """
SELECT c_name AS proc_name,
       CASE c_custkey % 4 WHEN 0 THEN 'extract' WHEN 1 THEN 'inbound'
                          WHEN 2 THEN 'transform' ELSE 'outbound' END AS proc_type,
       CAST(CASE WHEN c_acctbal > 0 THEN 1 ELSE 0 END AS INTEGER) AS is_active,
       CAST(1 + c_custkey % 5 AS INTEGER) AS run_period,
       CAST(1 + c_custkey % 3 AS INTEGER) AS data_back_day,
       CASE WHEN c_custkey % 17 = 0 THEN 'W' WHEN c_custkey % 2 = 0 THEN 'D' ELSE 'M' END
           AS data_freq,
       concat('/jobs/', CASE WHEN c_custkey % 3 = 0 THEN 'common_' ELSE 'custom_' END,
              lower(c_mktsegment)) AS notebook_path,
       'setup' AS created_by,
       CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE concat('scripts/', c_name, '.sql') END
           AS script_path,
       CASE WHEN c_custkey % 13 = 0 THEN '  ' ELSE c_mktsegment END AS src_system,
       CASE WHEN c_custkey % 11 = 0 THEN NULL WHEN c_custkey % 11 = 1 THEN ' '
            ELSE concat('FEED', CAST(c_custkey AS STRING)) END AS src_file_name,
       CASE WHEN c_custkey % 19 = 0 THEN '' WHEN c_custkey % 5 = 0 THEN 'FIX' ELSE '|' END
           AS src_delimeter,
       CASE WHEN c_custkey % 23 = 0 THEN NULL ELSE 'raw' END AS src_volume_name,
       CASE WHEN c_custkey % 29 = 0 THEN NULL ELSE concat('bronze.t', CAST(c_custkey AS STRING))
           END AS trgt_tbl_name
FROM (SELECT * FROM {customer} UNION ALL SELECT * FROM {customer} WHERE c_custkey % 47 = 0)
"""

DERIVATIONS["status_events"] = f"""
SELECT {_PROC_OF_USER} AS proc_name,
       concat('run-', CAST(event_id AS STRING)) AS proc_run_id,
       CASE event_type WHEN 'error' THEN 'Failed' WHEN 'signup' THEN 'Running'
                       ELSE 'Success' END AS proc_status,
       CASE WHEN event_id % 2 = 0 THEN 'N' ELSE 'R' END AS run_mode,
       CASE WHEN event_type NOT IN ('error', 'signup') OR event_id % 3 = 0 THEN NULL
            ELSE CAST(ts AS DATE) END AS running_dt,
       CASE WHEN event_id % 5 = 0 THEN NULL ELSE CAST(ts AS DATE) - 2 END AS start_dt,
       CASE WHEN event_id % 11 = 0 THEN CAST(ts AS DATE) - 1 ELSE CAST(ts AS DATE) + 1 END AS end_dt,
       ts AS start_proc_dtm,
       CASE WHEN event_type IN ('error', 'signup') THEN NULL
            ELSE ts + INTERVAL '1' HOUR END AS end_proc_dtm,
       ts AS ins_proc_dtm,
       event_id
FROM {{events}}
"""

DERIVATIONS["requests"] = f"""
SELECT {_PROC_OF_CUSTOMER} AS proc_name,
       concat('req-', CAST(o_orderkey AS STRING)) AS proc_run_id,
       CASE o_orderkey % 5 WHEN 0 THEN 'R' WHEN 1 THEN 'R' WHEN 2 THEN 'N'
                           WHEN 3 THEN NULL ELSE CASE WHEN o_orderkey % 2 = 0 THEN 'X' ELSE ' ' END
           END AS run_mode,
       CASE WHEN o_orderkey % 5 IN (2, 3, 4) AND o_orderkey % 7 <> 0 THEN NULL
            WHEN o_orderkey % 31 = 0 THEN '   '
            WHEN o_orderkey % 37 = 0 THEN '2024-13-01'
            WHEN o_orderkey % 41 = 0 THEN '1994-9-01'
            ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) END AS start_dt,
       CASE WHEN o_orderkey % 5 IN (2, 3, 4) AND o_orderkey % 7 <> 1 THEN NULL
            WHEN o_orderkey % 29 = 0 THEN ''
            WHEN o_orderkey % 43 = 0 THEN '2023-02-29'
            WHEN o_orderkey % 23 = 0 THEN CAST(CAST(o_orderdate AS DATE) - 3 AS STRING)
            ELSE CAST(CAST(o_orderdate AS DATE) + CAST(o_orderkey % 40 AS INTEGER) AS STRING)
            END AS end_dt,
       o_orderdate AS requested_at,
       o_orderkey AS request_no
FROM {{orders}}
"""

DERIVATIONS["file_log"] = f"""
SELECT {_PROC_OF_USER} AS proc_name,
       concat('run-', CAST(event_id AS STRING)) AS proc_run_id,
       CASE event_type WHEN 'error' THEN 'Failed' WHEN 'signup' THEN 'Processing'
                       ELSE 'Success' END AS proc_status,
       concat('FEED_', replace(CAST(CAST(ts AS DATE) AS STRING), '-', ''), '.csv') AS file_name,
       CAST(round(value * 100) AS BIGINT) AS total_record,
       ts AS start_proc_dtm,
       CASE WHEN event_type = 'signup' THEN NULL ELSE ts + INTERVAL '5' MINUTE END AS end_proc_dtm,
       CASE WHEN event_type = 'error' THEN props END AS error_message
FROM {{events}}
"""

DERIVATIONS["run_log"] = f"""
SELECT {_PROC_OF_USER} AS proc_name,
       concat('run-', CAST(event_id AS STRING)) AS proc_run_id,
       CASE event_type WHEN 'error' THEN 'Failed' WHEN 'purchase' THEN 'Success'
                       ELSE 'Running' END AS proc_status,
       CASE WHEN event_id % 2 = 0 THEN 'N' ELSE 'R' END AS run_mode,
       ts AS start_proc_dtm,
       CAST(ts AS DATE) AS running_dt,
       CAST(ts AS DATE) - 2 AS start_dt,
       CAST(ts AS DATE) + 1 AS end_dt
FROM {{events}}
"""

# One run outcome per event; a process is run for several dates in event order.
DERIVATIONS["outcomes"] = f"""
SELECT {_PROC_OF_USER} AS proc_name,
       concat('run-', CAST(event_id AS STRING)) AS proc_run_id,
       CAST(ts AS DATE) AS running_dt,
       ts AS finished_at,
       event_id,
       CASE WHEN event_type = 'error' THEN 'Failed' ELSE 'Success' END AS proc_status,
       CASE WHEN event_type = 'error' THEN concat('Fehler "', event_type, '": ', props) END
           AS error_message
FROM {{events}}
"""

_TABLE = re.compile(r"\{(\w+)\}")


def sql(name: str) -> str:
    """A derivation as DuckDB reads it."""
    return _TABLE.sub(r"\1", DERIVATIONS[name]).strip()


def ctes(*names: str) -> str:
    """WITH clause that defines the derivations under their names."""
    return "WITH " + ",\n".join(f"{name} AS (\n{sql(name)}\n)" for name in names)


def derive(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A derivation as a Spark plan."""
    statement = DERIVATIONS[name]
    used = {t: table(spark, sf_dir, t) for t in set(_TABLE.findall(statement))}
    return spark.sql(statement, **used)


def config(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Process config, one row per customer, and some of them twice."""
    rows = derive(spark, sf_dir, "config").withColumn(
        "created_dtm", dates.clock(F.lit("2024-01-01 00:00:00"))
    )
    return conform(rows, schemas.CONFIG)


def status_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive(spark, sf_dir, "status_events")


def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform(derive(spark, sf_dir, "run_log"), schemas.RUN_LOG)


# Latest event per user, as a plain window in the oracle.
STATUS_CTE = """status AS (
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY proc_name ORDER BY start_proc_dtm DESC, event_id DESC)
         AS rn FROM status_events) WHERE rn = 1
)"""


def land(df: DataFrame, name: Column, *, sep: str | None = None, folder: str | None = None) -> str:
    """Write ``df`` as landed files: Parquet, or headed text when ``sep`` is given.

    Into an existing ``folder``, files of the same name replace the landed ones.

    Rows of one landed file are brought together first, as a sender would
    deliver them; adaptive execution splits a file too large for one task.
    """
    folder = folder or new_folder(df.sparkSession, "landing")
    writer = (
        df.withColumn(filenames.LANDED_COLUMN, name)
        .hint("rebalance", filenames.LANDED_COLUMN)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(filenames.LANDED_COLUMN)
    )
    if sep is None:
        writer.parquet(folder)
    else:
        keep_blanks = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
        writer.options(**keep_blanks).csv(folder, sep=sep, header=True)
    return folder


# Fixed-point text of a two-decimal amount, the same in both engines.
def amount(column: str) -> str:
    return f"CAST(CAST({column} AS DECIMAL(12,2)) AS STRING)"
