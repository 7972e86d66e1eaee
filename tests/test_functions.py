from datetime import date, datetime

from pyspark.sql import functions as F

from slicewright.functions import dates, envelope, filenames, text


def column(spark, values, expression, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r.y for r in rows.select("i", expression(F.col("x")).alias("y")).orderBy("i").collect()]


def test_blank_handling(spark):
    values = [None, "", " \t\n", " 　", " a ", "NULL", " null "]
    assert column(spark, values, text.blank_to_null) == [None] * 4 + [" a ", "NULL", " null "]
    assert column(spark, values, text.null_to_empty) == ["", "", "", "", "a", "NULL", "null"]
    assert column(spark, values, text.null_word_to_empty) == ["", "", "", "", "a", "", "null"]


def test_blanks_agree_with_python(spark):
    values = [chr(c) for c in range(1, 0x3100) if not 0xD800 <= c < 0xE000]
    assert column(spark, values, text.is_blank) == [v.strip() == "" for v in values]
    assert column(spark, values, text.strip) == [v.strip() for v in values]


def test_clean_message(spark):
    values = ['it\'s "bad"; drop', "Größe: 5/7 #1_a", "naïve\n日本 ½²", "''", None, "  "]
    expected = ["its bad drop", "Größe: 5/7 #1_a", "naïve\n日本 ½²", None, None, None]
    assert column(spark, values, text.clean_message) == expected


def test_strict_dates(spark):
    values = ["20240229", "20230229", "2024022", "2024-02-29", " 20240229", None]
    assert column(spark, values, dates.parse_compact) == [date(2024, 2, 29)] + [None] * 5
    values = ["2024-1-5", "2024-02-30", "2024", "2024-01-05 ", "2024-01-05\n", "24-01-05"]
    assert column(spark, values, dates.parse_iso) == [date(2024, 1, 5)] + [None] * 5
    values = ["2024-01-05T07:30", "2024-01-05 07:30", "2024-01-05T07:61", "2024-01-05"]
    assert column(spark, values, dates.parse_minute) == [datetime(2024, 1, 5, 7, 30)] + [None] * 3


def test_epoch_edges(spark):
    values = [1704067199999, 1704067200000, 0, 9223372036854775807]
    got = column(spark, values, dates.epoch_date, "bigint")
    assert got == [date(2023, 12, 31), date(2024, 1, 1), date(1970, 1, 1), None]


def test_business_clock(spark):
    values = [datetime(2023, 12, 31, 16, 59, 59), datetime(2023, 12, 31, 17, 0)]
    assert column(spark, values, dates.business_date, "timestamp_ntz") == [
        date(2023, 12, 31), date(2024, 1, 1)]
    assert column(spark, values, dates.stamp, "timestamp_ntz") == [
        "20231231235959", "20240101000000"]


def test_month_end(spark):
    values = [date(2024, 1, 31), date(2023, 1, 31), date(2024, 2, 29)]
    assert column(spark, values, lambda c: dates.month_end(c, 1), "date") == [
        date(2024, 2, 29), date(2023, 2, 28), date(2024, 3, 31)]
    assert column(spark, values, lambda c: dates.month_end(c, -1), "date") == [
        date(2023, 12, 31), date(2022, 12, 31), date(2024, 1, 31)]


def test_file_names(spark):
    values = ["run-1704067199999-part-0.parquet", "run--part", "run-x-part", "a-run-5-part"]
    assert column(spark, values, filenames.epoch_file_date) == [
        date(2023, 12, 31), None, None, date(1970, 1, 1)]
    values = ["/z/landed=A_20240101.csv/part-0.csv", "/z/B.csv"]
    assert column(spark, values, filenames.landed_name) == ["A_20240101.csv", "B.csv"]
    stamped = lambda c: filenames.archive_path(c, F.lit("20240102"), F.lit("S"))
    assert column(spark, ["s3://b/in/F.v1.csv", "F.csv", "in/F"], stamped) == [
        "s3://b/in/archived/S/F_20240102_S.csv",
        "/archived/S/F_20240102_S.csv",
        "in/archived/S/F_20240102_S.F",
    ]


def test_envelope_keeps_null_message(spark):
    built = lambda c: envelope.build(F.lit("Failed"), c)
    assert column(spark, [None, 'a "b"'], built) == [
        '{"status":"Failed","message":null}', '{"status":"Failed","message":"a \\"b\\""}']
    parsed = column(spark, ['{"status": "Success", "message": null}'], envelope.parse)
    assert (parsed[0].status, parsed[0].message) == ("Success", None)
