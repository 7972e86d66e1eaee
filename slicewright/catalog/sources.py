"""Readers: a test table is landed in some format and read back with the operator."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slicewright import schemas
from slicewright.catalog import fixtures as fx
from slicewright.catalog.registry import query
from slicewright.catalog.scalars import FLATTEN_ORACLE, weather_documents
from slicewright.functions import filenames
from slicewright.operators import predicates, projection
from slicewright.sources import columnar, delimited, fixed_width, json_documents, landing
from slicewright.sources.dispatch import NOT_DELIMITED, SourceSpec, read_source
from slicewright.storage import new_folder

UNTOUCHED = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}

fx.DERIVATIONS["padded"] = f"""
SELECT CAST(c_custkey AS STRING) AS c_custkey, concat('  ', c_name, ' ') AS c_name,
       concat(' ', {fx.amount("c_acctbal")}) AS c_acctbal,
       concat(c_mktsegment, '   ') AS c_mktsegment
FROM {{customer}}
"""


@query(
    "src_csv_trimmed",
    f"""{fx.ctes("padded")}
SELECT trim(c_custkey) AS c_custkey, trim(c_name) AS c_name, trim(c_acctbal) AS c_acctbal,
       trim(c_mktsegment) AS c_mktsegment FROM padded""",
)
def src_csv_trimmed(spark, sf_dir) -> DataFrame:
    path = new_folder(spark, "padded")
    fx.derive(spark, sf_dir, "padded").write.options(**UNTOUCHED).csv(path, sep="|", header=True)
    return delimited.read_trimmed(spark, path, "|")


# Lines with a declared layout: some are cut short, some hold a bad number.
fx.DERIVATIONS["order_lines"] = f"""
SELECT concat(CAST(o_orderkey AS STRING), '|',
              CASE WHEN o_orderkey % 11 = 0 THEN 'abc' ELSE CAST(o_custkey AS STRING) END, '| ',
              o_orderstatus, '',
              CASE WHEN o_orderkey % 7 = 0 THEN ''
                   ELSE concat('|', {fx.amount("o_totalprice")}, '|',
                               CAST(CAST(o_orderdate AS DATE) AS STRING)) END) AS value
FROM {{orders}}
"""

ORDER_LAYOUT = T.StructType(
    [
        T.StructField("o_orderkey", T.LongType()),
        T.StructField("o_custkey", T.LongType()),
        T.StructField("o_orderstatus", T.StringType()),
        T.StructField("o_totalprice", T.DecimalType(12, 2)),
        T.StructField("o_orderdate", T.DateType()),
    ]
)

TYPED_ORACLE = """
SELECT o_orderkey, CASE WHEN o_orderkey % 11 <> 0 THEN o_custkey END AS o_custkey,
       ' ' || o_orderstatus AS o_orderstatus,
       CASE WHEN o_orderkey % 7 <> 0 THEN CAST(o_totalprice AS DECIMAL(12,2)) END AS o_totalprice,
       CASE WHEN o_orderkey % 7 <> 0 THEN CAST(o_orderdate AS DATE) END AS o_orderdate
FROM orders"""


@query("src_csv_typed", TYPED_ORACLE)
def src_csv_typed(spark, sf_dir) -> DataFrame:
    path = new_folder(spark, "orders")
    fx.derive(spark, sf_dir, "order_lines").write.text(path)
    return delimited.read_typed(spark, path, ORDER_LAYOUT, "|", header=False)


DOTTED_TYPES = {
    "item.size": "decimal(10,1)",
    "item.price": "decimal(10,1)",
    "brand": "string",
    "key": "bigint",
}


def _land_dotted(spark, sf_dir) -> str:
    path = new_folder(spark, "dotted")
    fx.table(spark, sf_dir, "part").select(
        F.col("p_size").cast("string").alias("item.size"),
        F.when(F.col("p_partkey") % 9 == 0, "n/a")
        .otherwise(F.col("p_retailprice").cast("decimal(12,2)").cast("string"))
        .alias("item.price"),
        F.col("p_brand").alias("brand"),
        F.col("p_partkey").alias("key"),
        F.col("p_name").alias("not_selected"),
    ).write.parquet(path)
    return path


DOTTED_ORACLE = """
SELECT CAST(p_size AS DECIMAL(10,1)) AS "item.size",
       CASE WHEN p_partkey % 9 <> 0 THEN CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS DECIMAL(10,1))
            END AS "item.price",
       p_brand AS brand, p_partkey AS key
FROM part"""


@query("src_parquet_cast", DOTTED_ORACLE)
def src_parquet_cast(spark, sf_dir) -> DataFrame:
    return columnar.read_cast(spark, _land_dotted(spark, sf_dir), DOTTED_TYPES)


def land_epoch_events(spark, sf_dir, halves=(0, 1), folder: str | None = None) -> str:
    """Events landed as one epoch-named entry per day and half-day, stamped at its last moment."""
    day = F.col("ts").cast("date")
    half = F.floor(F.hour("ts") / 12)
    millis = F.unix_date(day).cast("bigint") * 86_400_000 + (half + 1) * 43_200_000 - 1
    name = F.concat(F.lit("run-"), millis.cast("string"), F.lit("-part-0"))
    return fx.land(fx.table(spark, sf_dir, "events").where(half.isin(*halves)), name, folder=folder)


@query(
    "src_epoch_files",
    """
SELECT *, concat('run-', epoch_ms(date_trunc('day', ts)) + (hour(ts) // 12 + 1) * 43200000 - 1,
                 '-part-0') AS file_name,
       CAST(ts AS DATE) AS file_dt
FROM events""",
)
def src_epoch_files(spark, sf_dir) -> DataFrame:
    return columnar.read_epoch_files(spark, land_epoch_events(spark, sf_dir))


CUSTOMER_WIDTHS = {"C_KEY": 10, "C_NAME": 20, "C_SEGMENT": 12, "C_BALANCE": 14}


def land_fixed_width(spark, sf_dir) -> str:
    path = new_folder(spark, "fixed")
    fields = {
        "C_KEY": F.col("c_custkey").cast("string"),
        "C_NAME": F.col("c_name"),
        "C_SEGMENT": F.col("c_mktsegment"),
        "C_BALANCE": F.col("c_acctbal").cast("decimal(12,2)").cast("string"),
    }
    line = F.concat(*[F.rpad(fields[name], n, " ") for name, n in CUSTOMER_WIDTHS.items()])
    fx.table(spark, sf_dir, "customer").select(line.alias("value")).write.text(path)
    return path


FIXED_ORACLE = f"""
SELECT CAST(c_custkey AS STRING) AS C_KEY, c_name AS C_NAME, c_mktsegment AS C_SEGMENT,
       {fx.amount("c_acctbal")} AS C_BALANCE FROM customer"""


@query("src_fixed_width", FIXED_ORACLE)
def src_fixed_width(spark, sf_dir) -> DataFrame:
    layout = schemas.fixed_width_schema(CUSTOMER_WIDTHS)
    return fixed_width.read_fixed_width(spark, land_fixed_width(spark, sf_dir), layout)


# Documents per landed JSON file; a file is parsed by one task, so it stays small.
DOCUMENTS_PER_FILE = 20_000

DOCUMENT_LAYOUT = T.StructType(
    [T.StructField("event_id", T.LongType()), *schemas.FORECAST_DOCUMENT.fields]
)


def _land_json(spark, sf_dir) -> str:
    """Weather documents landed as JSON arrays spread over many lines, one array per file."""
    path = new_folder(spark, "json")
    whole = F.struct("event_id", "latitude", "longitude", "hourly")
    batch = F.floor(F.monotonically_increasing_id() / DOCUMENTS_PER_FILE)
    arrays = (
        weather_documents(spark, sf_dir)
        .withColumn("batch", batch)
        .groupBy("batch")
        .agg(F.collect_list(whole).alias("documents"))
        .select(F.to_json("documents", {"pretty": "true"}).alias("value"))
    )
    arrays.write.option("maxRecordsPerFile", 1).text(path)
    return path


@query("src_json_multiline", FLATTEN_ORACLE)
def src_json_multiline(spark, sf_dir) -> DataFrame:
    documents = json_documents.read_documents(spark, _land_json(spark, sf_dir), DOCUMENT_LAYOUT)
    return projection.flatten_forecast(documents, keep=("event_id",))


@query("src_table_scan", "SELECT * FROM lineitem")
def src_table_scan(spark, sf_dir) -> DataFrame:
    return columnar.read_table(spark, f"{sf_dir}/lineitem.parquet")


# Announced counts: events are listed in one shared control file, orders have
# one control file per day, named after it.
@query(
    "src_control_file",
    """
SELECT concat('FEED_', d, '.csv') AS file_name, d AS ctrl_dt,
       CASE WHEN d LIKE '%13' THEN NULL ELSE count(*) END AS ctrl_cnt
FROM (SELECT strftime(ts, '%Y%m%d') AS d FROM events) GROUP BY d
UNION ALL
SELECT concat('orders', y, '.dat'), concat(y, '1231'), count(*)
FROM (SELECT year(o_orderdate) AS y FROM orders) GROUP BY y""",
)
def src_control_file(spark, sf_dir) -> DataFrame:
    day = F.col("ts").cast("date")
    shared = (
        fx.table(spark, sf_dir, "events")
        .groupBy(day.alias("d"))
        .agg(F.count("*").alias("n"))
        .select(
            filenames.dated_name(F.lit("FEED"), F.col("d")).alias("FILENAME"),
            F.when(F.dayofmonth("d") == 13, "many")
            .otherwise(F.concat(F.lit(" "), F.col("n").cast("string")))
            .alias("CNT_REC"),
            F.lit("FEED_RAW_COUNT_REC.csv").alias("control"),
        )
    )
    year = F.year("o_orderdate").cast("string")
    own = (
        fx.table(spark, sf_dir, "orders")
        .groupBy(year.alias("y"))
        .agg(F.count("*").alias("n"))
        .select(
            F.concat(F.lit("orders"), F.col("y"), F.lit(".dat")).alias("FILENAME"),
            F.col("n").cast("string").alias("CNT_REC"),
            F.concat(F.lit("orders"), F.col("y"), F.lit("_ctrl_"), F.col("y"), F.lit("1231.csv"))
            .alias("control"),
        )
    )
    controls = shared.unionByName(own)
    folder = fx.land(controls.select("FILENAME", "CNT_REC", "control"), F.col("control"), sep=",")
    return landing.read_controls(spark, folder, shared_prefix="FEED")


@query(
    "config_active",
    f"""{fx.ctes("config")}
SELECT proc_name, src_system, src_file_name, src_delimeter, src_volume_name, trgt_tbl_name
FROM config WHERE is_active = 1""",
)
def config_active(spark, sf_dir) -> DataFrame:
    return (
        fx.config(spark, sf_dir)
        .where(predicates.active())
        .select(
            "proc_name", "src_system", "src_file_name", "src_delimeter", "src_volume_name",
            "trgt_tbl_name",
        )
    )


@query(
    "src_dispatch",
    f"""{fx.ctes("padded")}
SELECT 'delimited' AS kind, trim(c_custkey) AS k, trim(c_name) AS v FROM padded
UNION ALL SELECT 'typed', CAST(o_orderkey AS STRING), CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS STRING)
  FROM orders
UNION ALL SELECT 'fixed width', "C_KEY", "C_BALANCE" FROM ({FIXED_ORACLE})
UNION ALL SELECT 'cast', CAST(key AS STRING), CAST("item.price" AS STRING) FROM ({DOTTED_ORACLE})
UNION ALL SELECT 'epoch named', CAST(event_id AS STRING), event_type FROM events
UNION ALL SELECT 'nested', CAST(event_id AS STRING), CAST(CAST(value AS DECIMAL(12,2)) AS STRING)
  FROM events""",
)
def src_dispatch(spark, sf_dir) -> DataFrame:
    padded, typed = new_folder(spark, "padded"), new_folder(spark, "typed")
    fx.derive(spark, sf_dir, "padded").write.options(**UNTOUCHED).csv(padded, sep="|", header=True)
    priced = T.StructType([ORDER_LAYOUT["o_orderkey"], ORDER_LAYOUT["o_totalprice"]])
    fx.table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_totalprice").cast("decimal(12,2)").alias("o_totalprice")
    ).write.csv(typed, sep="|", header=True)
    sources = [
        ("delimited", SourceSpec(padded, "|"), "c_custkey", "c_name"),
        ("typed", SourceSpec(typed, "|", priced), "o_orderkey", "o_totalprice"),
        (
            "fixed width",
            SourceSpec(
                land_fixed_width(spark, sf_dir),
                NOT_DELIMITED,
                schemas.fixed_width_schema(CUSTOMER_WIDTHS),
            ),
            "C_KEY",
            "C_BALANCE",
        ),
        (
            "cast",
            SourceSpec(_land_dotted(spark, sf_dir), NOT_DELIMITED, DOTTED_TYPES),
            "key",
            "`item.price`",
        ),
        (
            "epoch named",
            SourceSpec(land_epoch_events(spark, sf_dir), NOT_DELIMITED, epoch_named=True),
            "event_id",
            "event_type",
        ),
        (
            "nested",
            SourceSpec(_land_json(spark, sf_dir), layout=DOCUMENT_LAYOUT, json=True),
            "event_id",
            "CAST(longitude AS DECIMAL(12,2))",
        ),
    ]
    result = None
    for kind, spec, key, value in sources:
        part = read_source(spark, spec).select(
            F.lit(kind).alias("kind"),
            F.col(key).cast("string").alias("k"),
            F.expr(value).cast("string").alias("v"),
        )
        result = part if result is None else result.unionByName(part)
    return result


def _daily_requests(spark, sf_dir) -> DataFrame:
    """Run dates of every order's process: its order date and the two days after."""
    return fx.derive(spark, sf_dir, "requests").select(
        "proc_name",
        F.explode(
            F.sequence(
                F.col("requested_at").cast("date"),
                F.date_add(F.col("requested_at").cast("date"), 2),
            )
        ).alias("running_dt"),
    ).distinct()


@query(
    "src_missing_files",
    f"""{fx.ctes("config", "requests")},
calendar AS (
  SELECT DISTINCT proc_name, CAST(requested_at AS DATE) + i AS running_dt
  FROM requests, unnest([0, 1, 2]) AS t(i)),
expected AS (
  SELECT proc_name, running_dt,
         CASE WHEN trim(src_file_name) <> ''
              THEN concat(src_file_name, '_', strftime(running_dt, '%Y%m%d'), '.csv') END AS file_name,
         CASE WHEN trim(src_file_name) <> ''
              THEN concat(src_file_name, '_', strftime(running_dt, '%Y%m%d'), '_ctrl_',
                          strftime(running_dt, '%Y%m%d'), '.csv') END AS control_name
  FROM calendar JOIN config USING (proc_name)),
landed AS (
  SELECT DISTINCT concat('FEED', o_custkey, '_', strftime(o_orderdate, '%Y%m%d'), '.csv') AS f
  FROM orders)
SELECT proc_name, running_dt, file_name, control_name, f IS NULL AS missing
FROM expected LEFT JOIN landed ON f = file_name""",
)
def src_missing_files(spark, sf_dir) -> DataFrame:
    config = fx.config(spark, sf_dir)
    expected = landing.expected_files(_daily_requests(spark, sf_dir), config)
    landed = (
        fx.table(spark, sf_dir, "orders")
        .select(
            filenames.dated_name(
                F.concat(F.lit("FEED"), F.col("o_custkey").cast("string")),
                F.col("o_orderdate").cast("date"),
            ).alias("file_name")
        )
        .distinct()
    )
    return landing.resolve(expected, landed)
