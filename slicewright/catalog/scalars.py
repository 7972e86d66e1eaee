"""Column functions, projections and filters."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slicewright.catalog import fixtures as fx
from slicewright.catalog.registry import query
from slicewright.functions import dates, envelope, filenames, text
from slicewright.operators import predicates, projection
from slicewright.sources.columnar import cast_list
from slicewright.sources.json_documents import as_variant, drifting, parse_payload, variant_fields

fx.DERIVATIONS["texts"] = """
SELECT doc_id, text, n_chars,
       CASE doc_id % 6 WHEN 0 THEN NULL WHEN 1 THEN concat(' ', chr(9), ' ') WHEN 2 THEN 'NuLL'
            WHEN 3 THEN concat('  ', text, chr(9), ' ') WHEN 4 THEN ' null ' ELSE text END AS raw,
       CASE doc_id % 4 WHEN 0 THEN concat(' ', CAST(n_chars AS STRING), ' ') WHEN 1 THEN '12.0'
            WHEN 2 THEN concat('x', CAST(n_chars AS STRING)) ELSE CAST(n_chars AS STRING)
            END AS number_text,
       concat('landing/', source, '/run-', CAST(1704067200000 + doc_id * 3600000 AS STRING),
              CASE WHEN doc_id % 9 = 0 THEN '-bit-' ELSE '-part-' END, lang, '.v1.csv') AS path,
       concat('FEED_', replace(CAST(DATE '2024-01-01' + CAST(doc_id % 366 AS INTEGER) AS STRING),
              '-', ''), '.csv') AS feed,
       concat('feed_ctrl_2024', lpad(CAST(doc_id % 9999 AS STRING), 4, '0'), '.csv') AS control
FROM {documents}
"""

_DUCK_BLANKS = " || ".join(f"chr({ord(c)})" for c in text.BLANKS)


@query(
    "fn_string",
    f"""
{fx.ctes("texts")}, blanks AS (SELECT {_DUCK_BLANKS} AS b)
SELECT doc_id,
       md5(CASE WHEN trim(raw, b) <> '' THEN raw END) AS blank_as_null,
       md5(coalesce(trim(raw, b), '')) AS null_as_empty,
       md5(CASE WHEN lower(raw) = 'null' THEN '' ELSE coalesce(trim(raw, b), '') END)
           AS null_word_as_empty,
       md5(regexp_replace(text, '[^\\p{{L}}\\p{{N}}_\\s' || b || '/:#]', '', 'g')) AS message,
       CASE WHEN regexp_full_match(trim(number_text), '[0-9]+')
            THEN CAST(trim(number_text) AS BIGINT) END AS number,
       CASE WHEN regexp_matches(path, 'run-[0-9]+-part')
            THEN CAST(regexp_extract(path, 'run-([0-9]+)-part', 1) AS BIGINT) END AS epoch,
       md5(trim(raw, ' ')) AS trimmed,
       substring(text, 3, 10) AS piece,
       replace('2024-02-29', '-', '') AS undashed,
       split_part(split_part(feed, '_', 2), '.', 1) AS feed_date,
       split_part(list_last(string_split(control, '_')), '.', 1) AS control_date,
       list_last(string_split(path, '/')) AS last_element,
       split_part(list_last(string_split(path, '/')), '.', 1) AS stem,
       list_last(string_split(path, '.')) AS extension,
       starts_with(path, 'landing/') AS has_prefix,
       ends_with(path, 'gpg') AS has_suffix,
       concat(split_part(feed, '.', 1), '_ctrl_20240229.csv') AS control_name
FROM texts, blanks""",
)
def fn_string(spark, sf_dir) -> DataFrame:
    raw, path = F.col("raw"), F.col("path")
    leap_day = F.lit(date(2024, 2, 29))
    return fx.derive(spark, sf_dir, "texts").select(
        "doc_id",
        F.md5(text.blank_to_null(raw)).alias("blank_as_null"),
        F.md5(text.null_to_empty(raw)).alias("null_as_empty"),
        F.md5(text.null_word_to_empty(raw)).alias("null_word_as_empty"),
        F.md5(text.clean_message(F.col("text"))).alias("message"),
        text.whole_number(F.col("number_text")).alias("number"),
        filenames.epoch_millis(path).alias("epoch"),
        F.md5(F.trim(raw)).alias("trimmed"),
        F.substring("text", 3, 10).alias("piece"),
        F.replace(F.lit("2024-02-29"), F.lit("-"), F.lit("")).alias("undashed"),
        filenames.date_after_first_underscore(F.col("feed")).alias("feed_date"),
        filenames.date_after_last_underscore(F.col("control")).alias("control_date"),
        filenames.last_element(path).alias("last_element"),
        filenames.stem(filenames.last_element(path)).alias("stem"),
        filenames.extension(path).alias("extension"),
        path.startswith("landing/").alias("has_prefix"),
        path.endswith("gpg").alias("has_suffix"),
        filenames.control_name(F.col("feed"), leap_day).alias("control_name"),
    )


fx.DERIVATIONS["moments"] = """
SELECT event_id, ts, CAST(ts AS DATE) AS d,
       CAST(event_id % 61 AS INTEGER) - 30 AS n,
       CASE event_id % 5 WHEN 0 THEN '2024021' WHEN 1 THEN '20241301'
            ELSE replace(CAST(CAST(ts AS DATE) AS STRING), '-', '') END AS compact_text,
       CASE event_id % 6 WHEN 0 THEN '2024-1-5' WHEN 1 THEN '2024-02-30' WHEN 2 THEN '2024'
            WHEN 3 THEN '24-01-05' ELSE CAST(CAST(ts AS DATE) AS STRING) END AS iso_text,
       CASE event_id % 4 WHEN 0 THEN CAST(CAST(ts AS DATE) AS STRING)
            WHEN 1 THEN concat(CAST(CAST(ts AS DATE) AS STRING), 'T25:00')
            ELSE concat(CAST(CAST(ts AS DATE) AS STRING), 'T', lpad(CAST(hour(ts) AS STRING), 2, '0'),
                        ':', lpad(CAST(minute(ts) AS STRING), 2, '0')) END AS minute_text
FROM {events}
"""


@query(
    "fn_date",
    f"""
{fx.ctes("moments")}
SELECT event_id,
       CASE WHEN length(compact_text) = 8 THEN CAST(try_strptime(compact_text, '%Y%m%d') AS DATE)
            END AS compact_date,
       CASE WHEN regexp_full_match(iso_text, '[0-9]{{4}}-[0-9]{{1,2}}-[0-9]{{1,2}}')
            THEN TRY_CAST(iso_text AS DATE) END AS iso_date,
       CASE WHEN length(minute_text) = 16 THEN try_strptime(minute_text, '%Y-%m-%dT%H:%M')
            END AS minute_time,
       d + n AS day_shift,
       CAST(d + to_months(n) AS DATE) AS month_shift,
       last_day(d) AS month_last,
       last_day(d + to_months(n)) AS shifted_month_end,
       ts + INTERVAL 7 HOUR AS local_ts,
       CAST(ts + INTERVAL 7 HOUR AS DATE) AS business_day,
       TIMESTAMP '{fx.AS_OF_TEXT}' AS run_clock,
       DATE '2024-04-01' AS run_day,
       strftime(epoch_ms(epoch_ms(date_trunc('day', ts)) + 86399999), '%Y%m%d') AS epoch_day,
       strftime(ts + INTERVAL 7 HOUR, '%Y%m%d%H%M%S') AS archive_stamp,
       strftime(d, '%Y-%m-%d') AS iso_out
FROM moments""",
)
def fn_date(spark, sf_dir) -> DataFrame:
    d, n, ts = F.col("d"), F.col("n"), F.col("ts")
    last_millisecond = F.unix_date(d).cast("bigint") * 86_400_000 + 86_399_999
    return fx.derive(spark, sf_dir, "moments").select(
        "event_id",
        dates.parse_compact(F.col("compact_text")).alias("compact_date"),
        dates.parse_iso(F.col("iso_text")).alias("iso_date"),
        dates.parse_minute(F.col("minute_text")).alias("minute_time"),
        F.date_add(d, n).alias("day_shift"),
        F.add_months(d, n).alias("month_shift"),
        dates.month_end(d).alias("month_last"),
        dates.month_end(d, n).alias("shifted_month_end"),
        dates.local_time(ts).alias("local_ts"),
        dates.business_date(ts).alias("business_day"),
        fx.as_of().alias("run_clock"),
        dates.business_date(fx.as_of()).alias("run_day"),
        dates.compact(dates.epoch_date(last_millisecond)).alias("epoch_day"),
        dates.stamp(ts).alias("archive_stamp"),
        F.date_format(d, dates.ISO_DATE).alias("iso_out"),
    )


# One weather document per event: two parallel arrays of 0 to 3 readings, of
# unequal length, with some arrays missing and some times unreadable.
DOCUMENTS_CTE = """documents_ AS (
SELECT event_id,
       CAST(user_id AS DOUBLE) / 2 AS latitude,
       value AS longitude,
       CASE WHEN event_id % 13 = 0 THEN NULL
            ELSE list_transform(range(event_id % 4), lambda i: CASE WHEN event_id % 17 = 0 THEN 'soon'
                 ELSE strftime(ts + to_hours(i), '%Y-%m-%dT%H:%M') END) END AS times,
       list_transform(range(event_id % 3 + 1), lambda i: value + i) AS temps
FROM events
), readings AS (
SELECT event_id, latitude, longitude, i, times[i + 1] AS time_text, temps[i + 1] AS temperature
FROM (SELECT *, unnest(range(CASE WHEN times IS NULL THEN 0
                                  ELSE greatest(len(times), len(temps)) END)) AS i
      FROM documents_)
)"""

_FLAT = """
       CAST(latitude AS DECIMAL(12,2)) AS LATITUDE,
       CAST(longitude AS DECIMAL(12,2)) AS LONGITUDE,
       CASE WHEN time_text <> 'soon' THEN CAST(substring(time_text, 1, 10) AS DATE) END
           AS FORECAST_DATE,
       CASE WHEN time_text <> 'soon' THEN strptime(time_text, '%Y-%m-%dT%H:%M') END
           AS FORECAST_TIME,
       CAST(temperature AS DECIMAL(12,2)) AS FORECAST_TEMP,
       'Celsius' AS FORECAST_TEMP_UNIT"""

FLATTEN_ORACLE = f"WITH {DOCUMENTS_CTE} SELECT event_id, {_FLAT} FROM readings"


def weather_documents(spark, sf_dir) -> DataFrame:
    """The weather documents of ``DOCUMENTS_CTE`` as nested rows."""
    moment = F.col("ts")

    def steps(count):
        whole = F.sequence(F.lit(0), (count - 1).cast("int"))
        return F.when(count > 0, whole).otherwise(F.array().cast("array<int>"))

    def time_text(i):
        shown = F.date_format(
            moment + F.make_dt_interval(F.lit(0), i), "yyyy-MM-dd'T'HH:mm"
        )
        return F.when(F.col("event_id") % 17 == 0, F.lit("soon")).otherwise(shown)

    times = F.when(F.col("event_id") % 13 != 0, F.transform(steps(F.col("event_id") % 4), time_text))
    temps = F.transform(steps(F.col("event_id") % 3 + 1), lambda i: F.col("value") + i)
    return fx.table(spark, sf_dir, "events").select(
        "event_id",
        (F.col("user_id").cast("double") / 2).alias("latitude"),
        F.col("value").alias("longitude"),
        F.struct(times.alias("time"), temps.alias("temperature_2m")).alias("hourly"),
    )


@query("json_forecast_flatten", FLATTEN_ORACLE)
def json_forecast_flatten(spark, sf_dir) -> DataFrame:
    return projection.flatten_forecast(weather_documents(spark, sf_dir), keep=("event_id",))


@query("src_payload_rows", FLATTEN_ORACLE)
def src_payload_rows(spark, sf_dir) -> DataFrame:
    whole = F.struct("latitude", "longitude", "hourly")
    payloads = weather_documents(spark, sf_dir).select("event_id", F.to_json(whole).alias("payload"))
    parsed = payloads.select("event_id", parse_payload(F.col("payload")).alias("doc"))
    return projection.flatten_forecast(
        parsed.select("event_id", "doc.*"), keep=("event_id",)
    )


def drifting_payloads(spark, sf_dir) -> DataFrame:
    """``event_id`` and the props of events as a feed that changed its fields four times; every fifth text is cut off."""
    k = F.get_json_object("props", "$.k")
    shape = F.col("event_id") % 5
    payload = (
        F.when(shape == 1, F.concat(F.lit('{"k": "'), k, F.lit('"}')))
        .when(shape == 2, F.concat(F.lit('{"k": {"n": '), k, F.lit('}, "unit": "pt"}')))
        .when(shape == 3, F.concat(F.lit('{"k": null, "all": ['), k, F.lit("]}")))
        .when(shape == 4, F.substring("props", 1, 5))
        .otherwise(F.col("props"))
    )
    return fx.table(spark, sf_dir, "events").select("event_id", payload.alias("payload"))


@query(
    "src_variant_rows",
    """
SELECT event_id, CASE WHEN event_id % 5 <> 4 THEN CAST(props ->> '$.k' AS BIGINT) END AS k,
       CASE WHEN event_id % 5 = 2 AND props IS NOT NULL THEN 'pt' END AS unit,
       event_id % 5 = 4 AND props IS NOT NULL AS malformed
FROM events""",
)
def src_variant_rows(spark, sf_dir) -> DataFrame:
    rows = drifting_payloads(spark, sf_dir).withColumn("doc", as_variant(F.col("payload")))
    doc = F.col("doc")
    return rows.select(
        "event_id",
        drifting(doc, ["$.k", "$.k.n", "$.all[0]"], "bigint").alias("k"),
        drifting(doc, ["$.unit"], "string").alias("unit"),
        (F.col("payload").isNotNull() & doc.isNull()).alias("malformed"),
    )


@query(
    "src_variant_fields",
    """
WITH shapes(shape, field, kind) AS (VALUES (0, 'k', 'BIGINT'), (1, 'k', 'STRING'), (2, 'k', 'OBJECT<n: BIGINT>'),
  (2, 'unit', 'STRING'), (3, 'k', 'VOID'), (3, 'all', 'ARRAY<BIGINT>'))
SELECT field, kind, count(*) AS n_rows FROM events JOIN shapes ON event_id % 5 = shape
WHERE props IS NOT NULL GROUP BY field, kind""",
)
def src_variant_fields(spark, sf_dir) -> DataFrame:
    rows = drifting_payloads(spark, sf_dir).select(as_variant(F.col("payload")).alias("doc"))
    return variant_fields(rows, "doc")


@query(
    "fn_array",
    f"""WITH {DOCUMENTS_CTE}
SELECT d.event_id, r.time_text, CAST(r.temperature AS DECIMAL(12,2)) AS temperature
FROM documents_ d LEFT JOIN readings r ON r.event_id = d.event_id""",
)
def fn_array(spark, sf_dir) -> DataFrame:
    readings = projection.zip_readings(weather_documents(spark, sf_dir), keep_empty=True)
    return readings.select(
        "event_id",
        F.col("reading.time").alias("time_text"),
        F.col("reading.temperature_2m").try_cast("decimal(12,2)").alias("temperature"),
    )


@query(
    "prj_nested_rename",
    f"""WITH {DOCUMENTS_CTE}
SELECT event_id, latitude AS LATITUDE, times[1] AS FIRST_TIME, len(temps) AS N_READINGS,
       'Celsius' AS UNIT FROM documents_""",
)
def prj_nested_rename(spark, sf_dir) -> DataFrame:
    first_time = F.get(F.col("hourly.time"), F.lit(0))
    return weather_documents(spark, sf_dir).select(
        "event_id",
        F.col("latitude").alias("LATITUDE"),
        first_time.alias("FIRST_TIME"),
        F.size("hourly.temperature_2m").cast("bigint").alias("N_READINGS"),
        F.lit("Celsius").alias("UNIT"),
    )


@query(
    "fn_json_status",
    """
SELECT event_id, CAST(json_object('status', status, 'message', message) AS STRING) AS envelope,
       status, message
FROM (SELECT event_id, CASE WHEN event_type = 'error' THEN 'Failed' ELSE 'Success' END AS status,
             CASE WHEN event_type = 'error' THEN props END AS message FROM events)""",
)
def fn_json_status(spark, sf_dir) -> DataFrame:
    failed = F.col("event_type") == "error"
    status = F.when(failed, "Failed").otherwise("Success")
    text_of = envelope.build(status, F.when(failed, F.col("props")))
    reports = fx.table(spark, sf_dir, "events").select("event_id", text_of.alias("envelope"))
    parsed = reports.withColumn("body", envelope.parse(F.col("envelope")))
    return parsed.select("event_id", "envelope", "body.status", "body.message")


@query(
    "fn_archive_path",
    """
WITH named AS (SELECT event_id, ts, strftime(ts, '%Y%m%d') AS d,
       strftime(ts + INTERVAL 7 HOUR, '%Y%m%d%H%M%S') AS s,
       concat('zone/', event_type, '/FEED', event_id, '.v1.csv') AS path FROM events)
SELECT event_id,
       concat('zone/', split_part(path, '/', 2), '/archived/', s, '/',
              split_part(split_part(path, '/', 3), '.', 1), '_', d, '_', s, '.csv') AS archive_path
FROM named""",
)
def fn_archive_path(spark, sf_dir) -> DataFrame:
    path = F.concat(
        F.lit("zone/"), "event_type", F.lit("/FEED"), F.col("event_id").cast("string"),
        F.lit(".v1.csv"),
    )
    day = dates.compact(F.col("ts").cast("date"))
    target = filenames.archive_path(path, day, dates.stamp(F.col("ts")))
    return fx.table(spark, sf_dir, "events").select("event_id", target.alias("archive_path"))


fx.DERIVATIONS["raw_lines"] = f"""
SELECT l_orderkey, l_linenumber,
       CASE WHEN l_linenumber = 3 THEN 'n/a' ELSE {fx.amount("l_extendedprice")} END AS price,
       CASE WHEN l_linenumber = 5 THEN '' ELSE {fx.amount("l_tax")} END AS tax,
       l_quantity, l_returnflag
FROM {{lineitem}}
"""


@query(
    "prj_cast",
    f"""
{fx.ctes("raw_lines")}
SELECT l_orderkey, l_linenumber, TRY_CAST(price AS DECIMAL(12,2)) AS price,
       TRY_CAST(tax AS DECIMAL(10,1)) AS tax,
       TRY_CAST(l_quantity AS DECIMAL(12,2)) AS l_quantity,
       CAST(l_returnflag AS STRING) AS l_returnflag
FROM raw_lines""",
)
def prj_cast(spark, sf_dir) -> DataFrame:
    types = {
        "price": "decimal(12,2)",
        "tax": "decimal(10,1)",
        "l_quantity": "decimal(12,2)",
        "l_returnflag": "string",
    }
    return fx.derive(spark, sf_dir, "raw_lines").select(
        "l_orderkey", "l_linenumber", *cast_list(types)
    )


@query(
    "prj_lineage",
    f"""
SELECT o_orderkey, DATE '2024-02-29' AS DATA_DT, '{fx.RUN_ID}' AS PROC_RUN_ID,
       TIMESTAMP '{fx.AS_OF_TEXT}' AS INS_PROC_DTM
FROM orders""",
)
def prj_lineage(spark, sf_dir) -> DataFrame:
    orders = fx.table(spark, sf_dir, "orders").select("o_orderkey")
    return projection.with_lineage(
        orders, dates.parse_compact(F.lit("20240229")), fx.RUN_ID, fx.as_of()
    )


@query("flt_equals", "SELECT * FROM lineitem WHERE l_returnflag = 'R'")
def flt_equals(spark, sf_dir) -> DataFrame:
    return fx.table(spark, sf_dir, "lineitem").where(F.col("l_returnflag") == "R")


@query(
    "flt_not_like",
    f"""
{fx.ctes("config")}
SELECT proc_name, proc_type, data_freq, notebook_path, script_path
FROM config WHERE notebook_path NOT LIKE '%common%'""",
)
def flt_not_like(spark, sf_dir) -> DataFrame:
    return (
        fx.config(spark, sf_dir)
        .where(predicates.not_like("notebook_path", "%common%"))
        .select("proc_name", "proc_type", "data_freq", "notebook_path", "script_path")
    )


@query(
    "flt_blank",
    f"""
{fx.ctes("config")}
SELECT proc_name, src_system, src_file_name FROM config
WHERE src_file_name IS NULL OR trim(src_file_name) = '' OR trim(src_system) = ''""",
)
def flt_blank(spark, sf_dir) -> DataFrame:
    blank = text.is_blank(F.col("src_file_name")) | text.is_blank(F.col("src_system"))
    return fx.config(spark, sf_dir).where(blank).select("proc_name", "src_system", "src_file_name")


SLICE_DAY = date(1997, 6, 17)


@query(
    "flt_date_slice",
    f"SELECT * FROM lineitem WHERE CAST(l_shipdate AS DATE) = DATE '{SLICE_DAY.isoformat()}'",
)
def flt_date_slice(spark, sf_dir) -> DataFrame:
    lines = fx.table(spark, sf_dir, "lineitem")
    return lines.where(predicates.in_timestamp_slice("l_shipdate", SLICE_DAY))
