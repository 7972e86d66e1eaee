import json
from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slicewright import schemas
from slicewright.functions import filenames
from slicewright.operators import projection
from slicewright.sources import columnar, delimited, fixed_width, json_documents, landing
from slicewright.sources.dispatch import NOT_DELIMITED, SourceSpec, read_source


def write(folder: Path, name: str, content: str) -> str:
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(content, encoding="utf-8")
    return str(folder / name)


def test_trimmed_text(spark, tmp_path):
    path = write(tmp_path, "a.csv", "BUSINESSDAYDATE|n|t\n 20240101 | 7|  x y \n20240102||\n")
    rows = delimited.read_trimmed(spark, path, "|").collect()
    assert [tuple(r) for r in rows] == [("20240101", "7", "x y"), ("20240102", None, None)]


def test_typed_text_keeps_bad_and_short_rows(spark, tmp_path):
    path = write(tmp_path, "a.csv", "k,v,t\n1,2.5, x\nbad,1,y\n3\n")
    schema = T.StructType([T.StructField("k", T.LongType()), T.StructField("v", T.DoubleType()),
                           T.StructField("t", T.StringType())])
    rows = delimited.read_typed(spark, path, schema).collect()
    assert [tuple(r) for r in rows] == [(1, 2.5, " x"), (None, 1.0, "y"), (3, None, None)]


def test_fixed_width_layout(spark, tmp_path):
    layout = schemas.declared_layout("RATEREF")
    widths = list(schemas.RATE_REFERENCE_WIDTHS.values())
    assert sum(widths) == 74
    line = "".join(str(i).ljust(w) for i, w in enumerate(widths))
    path = write(tmp_path, "RATEREF", line + "\n" + line[:10] + "\n")
    rows = fixed_width.read_fixed_width(spark, path, layout).collect()
    assert [tuple(r) for r in rows] == [
        tuple(str(i) for i in range(8)), ("0", "1", "", "", "", "", "", "")]


def test_declared_cast_layout(spark, tmp_path):
    layout = schemas.declared_layout("iris.parquet")
    path = str(tmp_path / "iris.parquet")
    spark.createDataFrame([("5.15", "x", "1", "0.2", "setosa")], list(layout)).write.parquet(path)
    df = columnar.read_cast(spark, path, layout)
    assert [f"{n} {t}" for n, t in df.dtypes][0] == "sepal.length decimal(10,1)"
    assert [None if v is None else str(v) for v in df.first()] == ["5.2", None, "1.0", "0.2", "setosa"]
    assert schemas.declared_layout("other.csv") is None


def landed_epochs(spark, folder, flat):
    """Epoch-named entries around midnight, as flat files or as directories."""
    millis = [1704067199999, 1704067200000, 1704153599999, 1704153600000]
    for i, ms in enumerate(millis):
        target = folder / (f"tmp{i}" if flat else f"landed=run-{ms}-part-0")
        spark.createDataFrame([(i,)], "n int").coalesce(1).write.parquet(str(target))
        if flat:
            part = next(target.glob("part-*.parquet"))
            (folder / "zone").mkdir(exist_ok=True)
            (folder / "zone" / f"run-{ms}-part-0.parquet").write_bytes(part.read_bytes())
    return str(folder / "zone") if flat else str(folder)


@pytest.mark.parametrize("flat", [True, False])
def test_epoch_files_of_one_date(spark, tmp_path, flat):
    zone = landed_epochs(spark, tmp_path, flat)
    rows = columnar.read_epoch_files(spark, zone, "20240101")
    assert sorted(r.n for r in rows.collect()) == [1, 2]
    assert {r.file_dt for r in rows.collect()} == {date(2024, 1, 1)}
    assert columnar.read_epoch_files(spark, zone).count() == 4
    assert columnar.read_epoch_files(spark, zone, date(2030, 1, 1)).isEmpty()


@pytest.mark.parametrize("flat", [True, False])
def test_epoch_date_prunes_files(spark, tmp_path, flat):
    zone = landed_epochs(spark, tmp_path, flat)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = columnar.read_epoch_files(spark, zone, "20240101")._jdf.queryExecution()
        plan.toRdd().count()
        scan = plan.executedPlan().collectLeaves().apply(0)
        assert scan.metrics().get("numFiles").get().value() == 2
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_json_pads_uneven_arrays_and_keeps_own_coordinates(spark, tmp_path):
    docs = [
        {"latitude": 15.5, "longitude": 101, "hourly": {
            "time": ["2024-01-05T00:00", "2024-01-05T01:00"], "temperature_2m": [21.345]}},
        {"latitude": 1.0, "longitude": 2.0, "hourly": {"time": [], "temperature_2m": []}},
        {"latitude": 3.0, "longitude": 4.0, "hourly": {
            "time": ["2024-01-06T00:00"], "temperature_2m": [1.0]}},
        {"latitude": 5.0, "longitude": 6.0, "hourly": None},
    ]
    for i, doc in enumerate(docs):
        write(tmp_path / "in", f"{i}.json", json.dumps(doc, indent=2))
    declared = json_documents.read_documents(spark, str(tmp_path / "in"), schemas.FORECAST_DOCUMENT)
    rows = projection.flatten_forecast(declared).orderBy("FORECAST_TIME").collect()
    assert [(str(r.LATITUDE), r.FORECAST_DATE, r.FORECAST_TEMP and str(r.FORECAST_TEMP))
            for r in rows] == [
        ("15.50", date(2024, 1, 5), "21.35"), ("15.50", date(2024, 1, 5), None),
        ("3.00", date(2024, 1, 6), "1.00")]
    inferred = json_documents.read_documents(spark, str(tmp_path / "in"))
    assert projection.flatten_forecast(inferred).count() == 3
    assert projection.zip_readings(declared, keep_empty=True).count() == 5


def test_controls(spark, tmp_path):
    write(tmp_path, "FEED_RAW_COUNT_REC.csv",
          "FILENAME,CNT_REC\nFEED_20240101.csv,10\nFEED_20240102.csv,x\n")
    write(tmp_path, "sales_ctrl_20240103.csv", "FILENAME,CNT_REC\nsales.csv, 7\n")
    got = {r.file_name: (r.ctrl_dt, r.ctrl_cnt)
           for r in landing.read_controls(spark, str(tmp_path), "FEED").collect()}
    assert got == {"FEED_20240101.csv": ("20240101", 10), "FEED_20240102.csv": ("20240102", None),
                   "sales.csv": ("20240103", 7)}


def test_manifest_and_missing(spark, tmp_path):
    write(tmp_path, "A_20240101.csv", "x\n1\n")
    write(tmp_path / "landed=B_20240101.csv", "part-0.csv", "x\n1\n")
    write(tmp_path / "landed=B_20240101.csv", "part-1.csv", "x\n2\n")
    found = {r.file_name: r.n_parts for r in landing.manifest(spark, str(tmp_path)).collect()}
    assert found == {"A_20240101.csv": 1, "B_20240101.csv": 2}
    calendar = spark.createDataFrame(
        [("a", date(2024, 1, 1)), ("c", date(2024, 1, 1))], "proc_name string, running_dt date")
    config = spark.createDataFrame([("a", "A"), ("c", "C")], "proc_name string, src_file_name string")
    expected = landing.expected_files(calendar, config)
    got = {r.file_name: (r.control_name, r.missing) for r in
           landing.resolve(expected, landing.manifest(spark, str(tmp_path))).collect()}
    assert got == {"A_20240101.csv": ("A_20240101_ctrl_20240101.csv", False),
                   "C_20240101.csv": ("C_20240101_ctrl_20240101.csv", True)}


def test_undated_names(spark):
    calendar = spark.createDataFrame([("a", date(2024, 1, 1))], "proc_name string, running_dt date")
    config = spark.createDataFrame([("a", "sales.dat")], "proc_name string, src_file_name string")
    row = landing.expected_files(calendar, config, dated=F.col("proc_name") != "a").first()
    assert (row.file_name, row.control_name) == ("sales.dat", "sales_ctrl_20240101.csv")


def test_dispatch_from_config(spark, tmp_path):
    row = {"src_volume_name": "raw", "src_file_name": "iris.parquet", "src_delimeter": NOT_DELIMITED}
    spec = SourceSpec.from_config(row, "/zone", "raw")
    assert spec.path == "/zone/iris.parquet" and spec.layout == schemas.IRIS_TYPES
    folder = SourceSpec.from_config({**row, "src_volume_name": "mysql"}, "/zone/", "raw",
                                    data_dt="20240101")
    assert folder.epoch_named and folder.path == "/zone/mysql" and folder.layout is None
    path = str(tmp_path / "plain.parquet")
    spark.range(3).write.parquet(path)
    assert read_source(spark, SourceSpec(path, NOT_DELIMITED)).count() == 3
    zone = landed_epochs(spark, tmp_path / "zone", flat=False)
    one_day = SourceSpec(zone, NOT_DELIMITED, epoch_named=True, data_dt="20240101")
    assert read_source(spark, one_day).columns == ["n"]
    assert read_source(spark, one_day).count() == 2


def test_landed_name_of_metadata_path(spark):
    path = F.lit("file:/x/landed=run-5-part-0/part-00000.parquet")
    assert spark.range(1).select(filenames.landed_name(path)).first()[0] == "run-5-part-0"


def test_documents_with_drifting_fields(spark):
    texts = ['{"a": 1}', '{"a": "2"}', '{"a": {"n": 3}}', '{"a": [4]}', '{"a": null, "b": 1.5}', "[1]", '{"a": ', "", None, '{"a": "x"}']
    rows = spark.createDataFrame(list(enumerate(texts)), "id int, payload string")
    docs = rows.withColumn("doc", json_documents.as_variant(F.col("payload")))
    got = docs.select("id", json_documents.drifting(F.col("doc"), ["$.a", "$.a.n", "$.a[0]"], "bigint").alias("a"), F.isnull("doc").alias("bad"))
    assert {r.id: (r.a, r.bad) for r in got.collect()} == {
        0: (1, False), 1: (2, False), 2: (3, False), 3: (4, False), 4: (None, False), 5: (None, False),
        6: (None, True), 7: (None, True), 8: (None, True), 9: (None, False)}
    fields = json_documents.variant_fields(docs, "doc")
    assert {(r.field, r.kind): r.n_rows for r in fields.collect()} == {
        ("a", "BIGINT"): 1, ("a", "STRING"): 2, ("a", "OBJECT<n: BIGINT>"): 1, ("a", "ARRAY<BIGINT>"): 1,
        ("a", "VOID"): 1, ("b", "DECIMAL(2,1)"): 1}
    assert json_documents.variant_fields(docs.limit(0), "doc").collect() == []
