"""Counts, reconciliation and key checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slicewright import schemas
from slicewright.catalog import fixtures as fx
from slicewright.catalog.registry import query
from slicewright.functions import dates, filenames
from slicewright.operators import reconciliation
from slicewright.operators.keys import key_violations, required_violations
from slicewright.storage import new_folder, save

COUNTED = ["customer", "documents", "events", "lineitem", "orders", "part"]


@query(
    "agg_count",
    " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}" for t in COUNTED),
)
def agg_count(spark, sf_dir) -> DataFrame:
    counts = [
        fx.table(spark, sf_dir, t).agg(F.count("*").alias("n_rows")).select(
            F.lit(t).alias("table_name"), "n_rows"
        )
        for t in COUNTED
    ]
    return reduce(DataFrame.unionByName, counts)


def order_controls(counts: DataFrame) -> DataFrame:
    """Announced counts with known faults: one row too many on every 13th, and the
    control row of every 29th filed under a day without data."""
    day = F.dayofmonth("slice_dt")
    return counts.select(
        F.when(day == 29, F.date_add("slice_dt", 20000)).otherwise(F.col("slice_dt"))
        .alias("slice_dt"),
        (F.col("data_cnt") + F.when(day == 13, 1).otherwise(0)).alias("ctrl_cnt"),
    )


@query(
    "agg_slice_reconcile",
    """
WITH counts AS (SELECT CAST(o_orderdate AS DATE) AS slice_dt, count(*) AS data_cnt
                FROM orders GROUP BY 1),
controls AS (SELECT CASE WHEN day(slice_dt) = 29 THEN slice_dt + 20000 ELSE slice_dt END AS slice_dt,
                    data_cnt + CASE WHEN day(slice_dt) = 13 THEN 1 ELSE 0 END AS ctrl_cnt FROM counts),
both_ AS (SELECT slice_dt, data_cnt, ctrl_cnt,
       CASE WHEN ctrl_cnt IS NULL THEN 'NO_CONTROL' WHEN data_cnt IS NULL THEN 'NO_DATA'
            WHEN data_cnt <> ctrl_cnt THEN 'COUNT_MISMATCH' ELSE 'OK' END AS check_status
FROM counts FULL JOIN controls USING (slice_dt))
SELECT *, CASE WHEN check_status = 'COUNT_MISMATCH'
               THEN concat('rows loaded ', data_cnt, ', rows announced ', ctrl_cnt) END AS message
FROM both_""",
)
def agg_slice_reconcile(spark, sf_dir) -> DataFrame:
    orders = fx.table(spark, sf_dir, "orders")
    counts = reconciliation.count_slices(orders, F.col("o_orderdate").cast("date"), "slice_dt")
    return reconciliation.reconcile(counts, order_controls(counts), ["slice_dt"])


@query(
    "agg_content_reconcile",
    """
WITH faults AS (SELECT CAST(o_orderdate AS DATE) AS slice_dt, o_orderkey % 997 = 0 AS changed, o_orderkey % 991 = 0 AS emptied,
                       o_orderkey % 983 = 0 AS doubled FROM orders)
SELECT slice_dt, CAST(count(*) + count_if(doubled) AS BIGINT) AS data_cnt, count(*) AS ctrl_cnt,
       CASE WHEN count_if(doubled) > 0 THEN 'COUNT_MISMATCH'
            WHEN count_if(changed OR emptied) > 0 THEN 'CONTENT_MISMATCH' ELSE 'OK' END AS check_status
FROM faults GROUP BY slice_dt""",
)
def agg_content_reconcile(spark, sf_dir) -> DataFrame:
    """Orders read back from a table in which single cells were changed or emptied and single rows doubled."""
    orders = fx.table(spark, sf_dir, "orders").withColumn("slice_dt", F.col("o_orderdate").cast("date"))
    key = F.col("o_orderkey")
    price = F.when(key % 997 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    status = F.when(key % 991 != 0, F.col("o_orderstatus"))
    stored = orders.withColumns({"o_totalprice": price.cast(orders.schema["o_totalprice"].dataType), "o_orderstatus": status})
    held = save(stored.unionAll(stored.where(key % 983 == 0)), new_folder(spark, "contents"))
    read, written = (reconciliation.digest_slices(df, ["slice_dt"]) for df in (held, orders))
    return reconciliation.reconcile_contents(read, written, ["slice_dt"])


@query(
    "agg_date_check",
    """
WITH files AS (SELECT DISTINCT CAST(l_shipdate AS DATE) AS d FROM lineitem),
pairs AS (SELECT concat('LINES_', strftime(d, '%Y%m%d'), '.csv') AS file_name,
                 strftime(d, '%Y%m%d') AS run_dt,
                 CASE day(d) WHEN 7 THEN strftime(d + 1, '%Y%m%d') WHEN 8 THEN NULL
                             ELSE strftime(d, '%Y%m%d') END AS ctrl_dt FROM files)
SELECT *, CASE WHEN run_dt IS DISTINCT FROM ctrl_dt THEN 'DATE_MISMATCH' ELSE 'OK' END AS check_status,
       CASE WHEN run_dt IS DISTINCT FROM ctrl_dt
            THEN concat('run date ', run_dt, ', control date ', coalesce(ctrl_dt, 'missing')) END
           AS message
FROM pairs""",
)
def agg_date_check(spark, sf_dir) -> DataFrame:
    d = F.col("d")
    faulty = F.when(F.dayofmonth(d) == 7, dates.compact(F.date_add(d, 1))).when(
        F.dayofmonth(d) != 8, dates.compact(d)
    )
    pairs = (
        fx.table(spark, sf_dir, "lineitem")
        .select(F.col("l_shipdate").cast("date").alias("d"))
        .distinct()
        .select(
            filenames.dated_name(F.lit("LINES"), d).alias("file_name"),
            dates.compact(d).alias("run_dt"),
            faulty.alias("ctrl_dt"),
        )
    )
    return reconciliation.check_dates(pairs)


@query(
    "agg_key_violations",
    """
WITH keyed AS (SELECT CASE WHEN l_partkey % 97 = 0 THEN NULL ELSE l_orderkey END AS l_orderkey,
                      l_linenumber FROM lineitem)
SELECT l_orderkey, l_linenumber, count(*) AS n_rows,
       CASE WHEN l_orderkey IS NULL OR l_linenumber IS NULL THEN 'NULL_KEY'
            ELSE 'DUPLICATE_KEY' END AS violation
FROM keyed GROUP BY l_orderkey, l_linenumber
HAVING count(*) > 1 OR l_orderkey IS NULL OR l_linenumber IS NULL""",
)
def agg_key_violations(spark, sf_dir) -> DataFrame:
    keyed = fx.table(spark, sf_dir, "lineitem").select(
        F.when(F.col("l_partkey") % 97 != 0, F.col("l_orderkey")).alias("l_orderkey"),
        "l_linenumber",
    )
    return key_violations(keyed, ["l_orderkey", "l_linenumber"])


@query(
    "agg_load_metrics",
    f"""{fx.ctes("file_log")}
SELECT proc_name, proc_status, count(*) AS n_files,
       CAST(sum(total_record) AS BIGINT) AS total_record,
       min(start_proc_dtm) AS first_start, max(end_proc_dtm) AS last_end
FROM file_log GROUP BY proc_name, proc_status""",
)
def agg_load_metrics(spark, sf_dir) -> DataFrame:
    return reconciliation.load_metrics(fx.derive(spark, sf_dir, "file_log"))


@query(
    "agg_required_violations",
    """
SELECT 'file_name' AS column_name, count(*) AS n_rows FROM events WHERE event_type = 'error'
UNION ALL SELECT 'total_record', count(*) FROM events WHERE event_type = 'signup'""",
)
def agg_required_violations(spark, sf_dir) -> DataFrame:
    status = F.col("proc_status")
    log = fx.derive(spark, sf_dir, "file_log").withColumns(
        {
            "file_name": F.when(status != schemas.FAILED, F.col("file_name")),
            "total_record": F.when(status != schemas.PROCESSING, F.col("total_record")),
        }
    )
    return required_violations(log, schemas.FILE_LOG)
