"""Whole loads and exports, from landed files to checked tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slicewright import schemas
from slicewright.catalog import fixtures as fx
from slicewright.catalog.registry import query
from slicewright.catalog.sinks import CHECK_KEY
from slicewright.catalog.sources import (
    CUSTOMER_WIDTHS,
    FIXED_ORACLE,
    ORDER_LAYOUT,
    UNTOUCHED,
    land_epoch_events,
    land_fixed_width,
)
from slicewright.functions import dates, filenames
from slicewright.operators import exports
from slicewright.operators.mutations import write_slices
from slicewright.plans.inbound import (
    Load,
    file_state,
    load_configured,
    load_epoch_files,
    load_files,
    load_source,
)
from slicewright.plans.outbound import export_table
from slicewright.sources.dispatch import NOT_DELIMITED, SourceSpec
from slicewright.storage import new_folder

PROC = "INB_EVENTS"

# Events land as one file per day.  Announced counts are off on the 13th, the
# control date is off on the 17th, and there is no control row for the 29th.

_DAYS_CTE = """days AS (
SELECT CAST(ts AS DATE) AS data_dt, count(*) AS data_cnt FROM events GROUP BY 1),
verdicts AS (
SELECT *, concat('FEED_', strftime(data_dt, '%Y%m%d'), '.csv') AS file_name,
       CASE WHEN day(data_dt) = 29 THEN NULL WHEN day(data_dt) = 13 THEN data_cnt + 1
            ELSE data_cnt END AS ctrl_cnt,
       CASE day(data_dt) WHEN 13 THEN 'COUNT_MISMATCH' WHEN 17 THEN 'DATE_MISMATCH'
                         WHEN 29 THEN 'NO_CONTROL' ELSE 'OK' END AS check_status FROM days)"""


def new_load(spark, landing: str, sep: str = "|") -> Load:
    work = new_folder(spark, "inbound")
    return Load(
        proc_name=PROC,
        run_id=fx.RUN_ID,
        as_of=fx.as_of(),
        landing=landing,
        target=f"{work}/target",
        file_log=f"{work}/file_log",
        ledger=f"{work}/ledger",
        sep=sep,
    )


def daily_events(spark, sf_dir) -> DataFrame:
    """Events as text, with the name of their day's file."""
    day = F.col("ts").cast("date")
    events = fx.table(spark, sf_dir, "events").select(
        F.concat(F.lit("  "), F.col("event_id").cast("string")).alias("event_id"),
        "ts",
        "event_type",
        F.col("value").cast("decimal(12,2)").cast("string").alias("value"),
    )
    name = filenames.dated_name(F.lit("FEED"), day)
    exact = F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return events.withColumn("landed", name).withColumn("ts", exact)


def land_daily_events(spark, sf_dir) -> str:
    return fx.land(daily_events(spark, sf_dir), F.col("landed"), sep="|")


def daily_files(spark, sf_dir) -> DataFrame:
    """Expected files with the row counts that were landed."""
    return (
        fx.table(spark, sf_dir, "events")
        .groupBy(F.col("ts").cast("date").alias("data_dt"))
        .agg(F.count("*").alias("n"))
        .withColumn("file_name", filenames.dated_name(F.lit("FEED"), F.col("data_dt")))
    )


def daily_controls(files: DataFrame) -> DataFrame:
    day = F.dayofmonth("data_dt")
    return files.where(day != 29).select(
        "file_name",
        F.when(day == 17, dates.compact(F.date_add("data_dt", 1)))
        .otherwise(dates.compact(F.col("data_dt")))
        .alias("ctrl_dt"),
        (F.col("n") + F.when(day == 13, 1).otherwise(0)).alias("ctrl_cnt"),
    )


def run_daily_load(spark, sf_dir) -> Load:
    load = new_load(spark, land_daily_events(spark, sf_dir))
    files = daily_files(spark, sf_dir)
    load_files(spark, load, files.select("file_name", "data_dt"), daily_controls(files))
    return load


@query(
    "inbound_load",
    f"""WITH {_DAYS_CTE}
SELECT CAST(e.event_id AS STRING) AS event_id, strftime(e.ts, '%Y-%m-%d %H:%M:%S.%f') AS ts,
       e.event_type, {fx.amount("e.value")} AS value, '{fx.RUN_ID}' AS PROC_RUN_ID,
       TIMESTAMP '{fx.AS_OF_TEXT}' AS INS_PROC_DTM, v.data_dt AS DATA_DT
FROM events e JOIN verdicts v ON v.data_dt = CAST(e.ts AS DATE) AND v.check_status = 'OK'""",
)
def inbound_load(spark, sf_dir) -> DataFrame:
    return spark.read.parquet(run_daily_load(spark, sf_dir).target)


@query(
    "inbound_load_log",
    f"""WITH {_DAYS_CTE}
SELECT '{PROC}' AS proc_name, '{fx.RUN_ID}' AS proc_run_id,
       CASE WHEN check_status = 'OK' THEN 'Success' ELSE 'Failed' END AS proc_status, file_name,
       data_cnt AS total_record, TIMESTAMP '{fx.AS_OF_TEXT}' AS start_proc_dtm,
       TIMESTAMP '{fx.AS_OF_TEXT}' AS end_proc_dtm,
       CASE check_status
         WHEN 'COUNT_MISMATCH' THEN concat('rows loaded ', data_cnt, ', rows announced ', ctrl_cnt)
         WHEN 'DATE_MISMATCH' THEN concat('run date ', strftime(data_dt, '%Y%m%d'), ', control date ',
                                          strftime(data_dt + 1, '%Y%m%d'))
         WHEN 'NO_CONTROL' THEN 'control row not found' END AS error_message
FROM verdicts""",
)
def inbound_load_log(spark, sf_dir) -> DataFrame:
    return file_state(spark, run_daily_load(spark, sf_dir).file_log)


@query(
    "inbound_load_multi",
    f"""
SELECT event_id, ts, user_id, event_type, value, props, '{fx.RUN_ID}' AS PROC_RUN_ID,
       TIMESTAMP '{fx.AS_OF_TEXT}' AS INS_PROC_DTM, CAST(ts AS DATE) AS DATA_DT
FROM events""",
)
def inbound_load_multi(spark, sf_dir) -> DataFrame:
    load = new_load(spark, land_epoch_events(spark, sf_dir))
    days = fx.table(spark, sf_dir, "events").agg(
        F.min("ts").cast("date").alias("lo"), F.max("ts").cast("date").alias("hi")
    )
    run_dates = days.select(
        F.explode(F.sequence(F.date_sub("lo", 1), F.date_add("hi", 1))).alias("data_dt")
    )
    load_epoch_files(spark, load, run_dates)
    return spark.read.parquet(load.target)


# The rows of a text load, whole: every day, with what a re-delivery changed.
_TEXT_ROWS = f"""
SELECT CAST(event_id AS STRING) AS event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, event_type,
       {{value}} AS value, '{fx.RUN_ID}' AS PROC_RUN_ID,
       TIMESTAMP '{fx.AS_OF_TEXT}' AS INS_PROC_DTM, CAST(ts AS DATE) AS DATA_DT
FROM events"""


def right_controls(files: DataFrame) -> DataFrame:
    return files.select("file_name", dates.compact(F.col("data_dt")).alias("ctrl_dt"), F.col("n").alias("ctrl_cnt"))


@query(
    "inbound_load_mixed_headers",
    """
SELECT concat('FEED_', strftime(CAST(ts AS DATE), '%Y%m%d'), '.csv') AS file_name,
       CASE WHEN day(ts) IN (5, 6) THEN 'HEADER_MISMATCH' ELSE 'OK' END AS check_status,
       CASE WHEN day(ts) NOT IN (5, 6) THEN count(*) END AS n_rows,
       CASE WHEN day(ts) NOT IN (5, 6) THEN CAST(sum(CAST(CAST(value AS DECIMAL(12,2)) * 100 AS BIGINT)) AS BIGINT)
            END AS cents
FROM events GROUP BY CAST(ts AS DATE), day(ts)""",
)
def inbound_load_mixed_headers(spark, sf_dir) -> DataFrame:
    """Files of the 5th have their columns in another order, those of the 6th lack one."""
    rows = daily_events(spark, sf_dir)
    day = F.dayofmonth(F.col("ts").cast("timestamp_ntz"))
    name = F.col("landed")
    folder = fx.land(rows.where(~day.isin(5, 6)), name, sep="|")
    fx.land(rows.where(day == 5).select("value", "event_type", "ts", "event_id", "landed"), name, sep="|", folder=folder)
    fx.land(rows.where(day == 6).select("event_id", "event_type", "value", "landed"), name, sep="|", folder=folder)
    load, files = new_load(spark, folder), daily_files(spark, sf_dir)
    verdicts = load_files(spark, load, files.select("file_name", "data_dt"), right_controls(files))
    cents = F.sum((F.col("value").cast("decimal(12,2)") * 100).cast("bigint"))
    held = spark.read.parquet(load.target).groupBy(F.col("DATA_DT").alias("data_dt")).agg(
        F.count("*").alias("n_rows"), cents.alias("cents")
    )
    return verdicts.join(held, "data_dt", "left").select("file_name", "check_status", "n_rows", "cents")


@query("inbound_load_partial_slice", _TEXT_ROWS.replace("{value}", fx.amount("value")))
def inbound_load_partial_slice(spark, sf_dir) -> DataFrame:
    """Two files a day; one is announced wrongly on every third day and mended in a second run."""
    half = F.when(F.trim("event_id").cast("bigint") % 2 == 0, "A").otherwise("B")
    rows = daily_events(spark, sf_dir).withColumn("landed", F.concat(half, F.lit("_"), "landed"))
    load = new_load(spark, fx.land(rows, F.col("landed"), sep="|"))
    day = F.col("ts").cast("timestamp_ntz").cast("date")
    files = rows.groupBy(F.col("landed").alias("file_name"), day.alias("data_dt")).agg(F.count("*").alias("n"))
    wrong = F.col("file_name").startswith("A_") & (F.dayofmonth("data_dt") % 3 == 0)
    first = files.withColumn("n", F.col("n") + F.when(wrong, 1).otherwise(0))
    expected = files.select("file_name", "data_dt")
    load_files(spark, load, expected, right_controls(first))
    load_files(spark, load, expected, right_controls(files))
    return spark.read.parquet(load.target)


@query(
    "inbound_load_redelivered",
    _TEXT_ROWS.replace(
        "{value}",
        "CAST(CAST(value AS DECIMAL(12,2)) + CASE WHEN day(ts) <= 10 THEN 1000 ELSE 0 END AS DECIMAL(12,2))::STRING",
    ),
)
def inbound_load_redelivered(spark, sf_dir) -> DataFrame:
    """All files are loaded; those up to the 10th land again, changed, under the same names."""
    rows = daily_events(spark, sf_dir)
    folder = fx.land(rows, F.col("landed"), sep="|")
    load, files = new_load(spark, folder), daily_files(spark, sf_dir)
    expected = files.select("file_name", "data_dt")
    load_files(spark, load, expected, right_controls(files))
    again = rows.where(F.dayofmonth(F.col("ts").cast("timestamp_ntz")) <= 10)
    more = (F.col("value").cast("decimal(12,2)") + 1000).cast("decimal(12,2)").cast("string")
    fx.land(again.withColumn("value", more), F.col("landed"), sep="|", folder=folder)
    load_files(spark, load, expected, right_controls(files))
    return spark.read.parquet(load.target)


@query(
    "inbound_load_late_file",
    f"""
SELECT event_id, ts, user_id, event_type, value, props, '{fx.RUN_ID}' AS PROC_RUN_ID,
       TIMESTAMP '{fx.AS_OF_TEXT}' AS INS_PROC_DTM, CAST(ts AS DATE) AS DATA_DT
FROM events""",
)
def inbound_load_late_file(spark, sf_dir) -> DataFrame:
    """The second half of every day lands when the first is loaded already."""
    folder = land_epoch_events(spark, sf_dir, halves=(0,))
    load = new_load(spark, folder)
    run_dates = fx.table(spark, sf_dir, "events").select(F.col("ts").cast("date").alias("data_dt")).distinct()
    load_epoch_files(spark, load, run_dates)
    land_epoch_events(spark, sf_dir, halves=(1,), folder=folder)
    load_epoch_files(spark, load, run_dates)
    return spark.read.parquet(load.target)


CONFIGURED_DAY = date(2024, 3, 31)


@query(
    "inbound_load_configured",
    f"""{fx.ctes("padded")}
SELECT 'delimited' AS kind, trim(c_custkey) AS k, trim(c_name) AS v, DATE '{CONFIGURED_DAY}' AS DATA_DT
  FROM padded
UNION ALL SELECT 'typed', CAST(o_orderkey AS STRING), CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS STRING),
  DATE '{CONFIGURED_DAY}' FROM orders
UNION ALL SELECT 'fixed', "C_KEY", "C_BALANCE", DATE '{CONFIGURED_DAY}' FROM ({FIXED_ORACLE})
UNION ALL SELECT 'cast', CAST(p_partkey AS STRING), CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS STRING),
  DATE '{CONFIGURED_DAY}' FROM part
UNION ALL SELECT 'epoch', CAST(event_id AS STRING), event_type, CAST(ts AS DATE) FROM events""",
)
def inbound_load_configured(spark, sf_dir) -> DataFrame:
    """One config row for each kind of source, from the row to the loaded slice."""
    padded, typed, cast = (new_folder(spark, x) for x in ("padded", "typed", "cast"))
    fx.derive(spark, sf_dir, "padded").write.options(**UNTOUCHED).csv(padded, sep="|", header=True)
    priced = T.StructType([ORDER_LAYOUT["o_orderkey"], ORDER_LAYOUT["o_totalprice"]])
    price = F.col("o_totalprice").cast("decimal(12,2)").alias("o_totalprice")
    fx.table(spark, sf_dir, "orders").select("o_orderkey", price).write.csv(typed, sep="|", header=True)
    fx.table(spark, sf_dir, "part").select("p_partkey", F.col("p_retailprice").cast("string")).write.parquet(cast)
    fixed, epoch = land_fixed_width(spark, sf_dir), land_epoch_events(spark, sf_dir)
    sources = [
        ("delimited", padded, "|", None, "customer", "c_custkey", "c_name"),
        ("typed", typed, "|", priced, "orders", "o_orderkey", "o_totalprice"),
        ("fixed", fixed, NOT_DELIMITED, schemas.fixed_width_schema(CUSTOMER_WIDTHS), "customer", "C_KEY", "C_BALANCE"),
        ("cast", cast, NOT_DELIMITED, {"p_partkey": "string", "p_retailprice": "decimal(12,2)"}, "part", "p_partkey", "p_retailprice"),
        ("epoch", epoch, NOT_DELIMITED, None, "events", "event_id", "event_type"),
    ]
    result = None
    for kind, path, sep, layout, counted, key, value in sources:
        root, name = path.rsplit("/", 1)
        row = {"src_file_name": name, "src_volume_name": name if kind == "epoch" else "raw", "src_delimeter": sep}
        load = new_load(spark, path, sep)
        days = fx.table(spark, sf_dir, "events").select(F.col("ts").cast("date").alias("data_dt")).distinct()
        if kind != "epoch":
            days = spark.createDataFrame([(CONFIGURED_DAY,)], "data_dt date")
        controls = fx.table(spark, sf_dir, counted).agg(F.count("*").alias("ctrl_cnt")).select(
            F.lit(name).alias("file_name"), F.lit(f"{CONFIGURED_DAY:%Y%m%d}").alias("ctrl_dt"), "ctrl_cnt"
        )
        load_configured(
            spark, load, row, root=root, single_file_volume="raw", run_dates=days, controls=controls,
            layouts=lambda _, layout=layout: layout,
        )
        part = spark.read.parquet(load.target).select(
            F.lit(kind).alias("kind"), F.col(key).cast("string").alias("k"), F.col(value).cast("string").alias("v"), "DATA_DT"
        )
        result = part if result is None else result.unionByName(part)
    return result


@query(
    "outbound_export",
    """
SELECT c.copy, doc_id, text, lang, source, n_chars
FROM documents, (SELECT unnest(['delimited', 'protected']) AS copy) c
UNION ALL
SELECT 'ledger', NULL, unnest(['3_Documents_20240331.csv', '3_Documents_20240331.csv.protected']), NULL, NULL, NULL""",
)
def outbound_export(spark, sf_dir) -> DataFrame:
    work = new_folder(spark, "outbound")
    documents = fx.table(spark, sf_dir, "documents")
    key = F.lit(CHECK_KEY).cast("binary")
    paths = export_table(
        spark,
        documents,
        folder=f"{work}/out",
        prefix="3_Documents",
        data_dt=date(2024, 3, 31),
        ledger=f"{work}/ledger",
        proc_name="OUTB_DOCUMENTS",
        run_id=fx.RUN_ID,
        as_of=fx.as_of(),
        key=key,
    )
    names = documents.columns
    sent = exports.read_delimited(spark, paths["delimited"], documents.schema)
    coded = exports.unprotect(spark.read.text(paths["protected"]), key, documents.schema)
    ledger = spark.read.schema(schemas.LEDGER).parquet(f"{work}/ledger").select(F.col("file_name").alias("text"))
    parts = [(sent, "delimited"), (coded, "protected"), (ledger, "ledger")]
    shown = [p.withColumn("copy", F.lit(c)) for p, c in parts]
    return shown[0].unionByName(shown[1]).unionByName(shown[2], allowMissingColumns=True).select("copy", *names)


BUSINESS_DAY = date(1997, 12, 31)


@query(
    "inbound_load_business",
    f"""
SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(12,2)) AS o_totalprice, BUSINESSDAYDATE
FROM (SELECT *, CAST(make_date(year(o_orderdate), 12, 31) AS DATE) AS BUSINESSDAYDATE FROM orders)
WHERE BUSINESSDAYDATE <> DATE '{BUSINESS_DAY.isoformat()}'
UNION ALL
SELECT o_orderkey, CAST(CAST(o_totalprice AS DECIMAL(12,2)) + 1 AS DECIMAL(12,2)), DATE '{BUSINESS_DAY.isoformat()}'
FROM orders""",
)
def inbound_load_business(spark, sf_dir) -> DataFrame:
    """One typed source replaces one business date of a table of order years."""
    price = F.col("o_totalprice").cast("decimal(12,2)")
    orders = fx.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        price.alias("o_totalprice"),
        F.make_date(F.year("o_orderdate"), F.lit(12), F.lit(31)).alias("BUSINESSDAYDATE"),
    )
    path = new_folder(spark, "landing")
    load = new_load(spark, path)
    write_slices(orders, load.target, "BUSINESSDAYDATE", gather=True)
    landed = orders.withColumns(
        {
            "o_totalprice": (F.col("o_totalprice") + 1).cast("decimal(12,2)"),
            "BUSINESSDAYDATE": F.lit(BUSINESS_DAY),
        }
    )
    landed.write.csv(path, sep="|", header=True)
    name = f"FEED_{BUSINESS_DAY:%Y%m%d}.csv"
    controls = orders.agg(F.count("*").alias("ctrl_cnt")).select(
        F.lit(name).alias("file_name"), F.lit(f"{BUSINESS_DAY:%Y%m%d}").alias("ctrl_dt"), "ctrl_cnt"
    )
    load_source(
        spark, load, SourceSpec(path, "|", orders.schema), file_name=name, data_dt=BUSINESS_DAY,
        controls=controls, slice_column="BUSINESSDAYDATE",
    )
    return spark.read.schema(orders.schema).parquet(load.target)
