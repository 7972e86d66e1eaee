from dataclasses import replace
from datetime import date, datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slicewright import schemas
from slicewright.functions import dates
from slicewright.operators import exports, reconciliation
from slicewright.plans.inbound import (
    Load, file_state, load_epoch_files, load_files, load_source, save_counted)
from slicewright.plans.outbound import export_table
from slicewright.sources.dispatch import SourceSpec
from slicewright.storage import new_folder

AS_OF = datetime(2024, 3, 31, 20)
EXPECTED = "file_name string, data_dt date"
CONTROL = "file_name string, ctrl_dt string, ctrl_cnt long"


def feed(day):
    return f"FEED_{day:%Y%m%d}.csv"


@pytest.fixture
def zone(tmp_path):
    folder = tmp_path / "landing"
    folder.mkdir()
    return folder


def put(zone, day, rows):
    (zone / feed(day)).write_text("k|v\n" + "".join(f"{k}|{v}\n" for k, v in rows))


def new_load(spark, zone, run="run-1"):
    work = new_folder(spark, "test")
    return Load("INB", run, dates.clock(AS_OF), str(zone), f"{work}/target", f"{work}/log",
                f"{work}/ledger", "|")


def run(spark, load, days, controls):
    expected = spark.createDataFrame([(feed(d), d) for d in days], EXPECTED)
    control = spark.createDataFrame([(feed(d), c, n) for d, c, n in controls], CONTROL)
    verdicts = load_files(spark, load, expected, control)
    return {r.file_name: r.check_status for r in verdicts.collect()}


def target_rows(spark, load):
    return sorted((str(r.DATA_DT), r.k, r.v, r.PROC_RUN_ID)
                  for r in spark.read.parquet(load.target).collect())


D = [date(2024, 1, d) for d in range(1, 8)]


def test_verdicts_log_and_ledger(spark, zone):
    for d in D[:5]:
        put(zone, d, [("a", d.day), (" b ", 2)])
    load = new_load(spark, zone)
    got = run(spark, load, D[:6], [
        (D[0], "20240101", 2), (D[1], "20240102", 3), (D[2], "20240104", 2), (D[4], "20240105", 2),
        (D[5], "20240106", 2)])
    assert got == {feed(D[0]): "OK", feed(D[1]): "COUNT_MISMATCH", feed(D[2]): "DATE_MISMATCH",
                   feed(D[3]): "NO_CONTROL", feed(D[4]): "OK", feed(D[5]): "NO_DATA"}
    assert target_rows(spark, load) == [
        ("2024-01-01", "a", "1", "run-1"), ("2024-01-01", "b", "2", "run-1"),
        ("2024-01-05", "a", "5", "run-1"), ("2024-01-05", "b", "2", "run-1")]
    log = {r.file_name: r for r in file_state(spark, load.file_log).collect()}
    assert {n: r.proc_status for n, r in log.items()} == {
        n: "Success" if s == "OK" else "Failed" for n, s in got.items()}
    assert log[feed(D[1])].error_message == "rows loaded 2, rows announced 3"
    assert log[feed(D[1])].total_record == 2
    assert spark.read.parquet(load.file_log).count() == 12  # opened and closed once each
    ledger = spark.read.parquet(load.ledger).collect()
    assert {r.file_name for r in ledger} == {feed(D[0]), feed(D[4])}
    assert ledger[0].archive_path.startswith(f"{zone}/archived/20240401030000/FEED_2024010")


def test_second_run_takes_only_what_is_left(spark, zone):
    put(zone, D[0], [("a", 1)])
    put(zone, D[1], [("a", 1)])
    load = new_load(spark, zone)
    run(spark, load, D[:2], [(D[0], "20240101", 1), (D[1], "20240102", 9)])
    put(zone, D[1], [("fixed", 1), ("fixed", 2)])
    again = replace(load, run_id="run-2")
    assert run(spark, again, D[:2], [(D[0], "20240101", 1), (D[1], "20240102", 2)]) == {
        feed(D[0]): "ALREADY_LOADED", feed(D[1]): "OK"}
    assert target_rows(spark, load) == [
        ("2024-01-01", "a", "1", "run-1"), ("2024-01-02", "fixed", "1", "run-2"),
        ("2024-01-02", "fixed", "2", "run-2")]
    assert run(spark, again, D[:2], [(D[0], "20240101", 1)]) == {
        feed(D[0]): "ALREADY_LOADED", feed(D[1]): "ALREADY_LOADED"}
    put(zone, D[0], [("changed", 1), ("more", 2)])  # delivered again: the slice is replaced
    assert run(spark, again, D[:2], [(D[0], "20240101", 2)])[feed(D[0])] == "OK"
    assert [r[1] for r in target_rows(spark, load)] == ["changed", "more", "fixed", "fixed"]


def test_files_of_a_date_are_published_together(spark, zone):
    load = new_load(spark, zone)
    names = ["FEED_A.csv", "FEED_B.csv"]
    expected = spark.createDataFrame([(n, D[0]) for n in names] + [(names[0], D[0])], EXPECTED)

    def go(counts):
        rows = [(n, "20240101", c) for n, c in zip(names, counts)] * 2  # announced twice alike
        controls = spark.createDataFrame(rows, CONTROL)
        return {r.file_name: r.check_status for r in load_files(spark, load, expected, controls).collect()}

    for n in names:
        (zone / n).write_text(f"k|v\n{n}|1\n")
    assert go([1, 2]) == {names[0]: "SLICE_INCOMPLETE", names[1]: "COUNT_MISMATCH"}
    assert go([1, 1]) == {n: "OK" for n in names}
    assert [r[1] for r in target_rows(spark, load)] == names  # neither lost nor doubled
    (zone / names[1]).write_text("k|v\nlate|1\nlater|2\n")
    assert go([1, 2]) == {n: "OK" for n in names}
    assert [r[1] for r in target_rows(spark, load)] == [names[0], "late", "later"]


def test_each_file_has_its_own_header(spark, zone):
    load = new_load(spark, zone)
    put(zone, D[0], [("k", "v"), ("a", 1)])  # a row like the header is a row
    (zone / feed(D[1])).write_text("v|k|z\n1|a|9\n")
    (zone / "CTRL.csv").write_text("FILENAME,CNT_REC\nx,1\n")
    controls = [(D[0], "20240101", 2), (D[1], "20240102", 1)]
    assert run(spark, load, D[:2], controls) == {feed(D[0]): "OK", feed(D[1]): "HEADER_MISMATCH"}
    assert [r[1:3] for r in target_rows(spark, load)] == [("a", "1"), ("k", "v")]
    differing = [(D[0], "20240101", 2), (D[0], "20240101", 3)]
    fresh = replace(new_load(spark, zone))
    assert run(spark, fresh, D[:1], differing) == {feed(D[0]): "CONTROL_AMBIGUOUS"}


def test_absent_landing_folder(spark, tmp_path):
    load = new_load(spark, tmp_path / "nowhere")
    assert run(spark, load, D[:1], [(D[0], "20240101", 1)]) == {feed(D[0]): "NO_DATA"}
    assert file_state(spark, load.file_log).first().proc_status == "Failed"


def test_declared_layout(spark, zone):
    put(zone, D[0], [("a", 1), ("b", "x")])
    layout = T.StructType([T.StructField("k", T.StringType()), T.StructField("v", T.IntegerType())])
    load = replace(new_load(spark, zone), layout=layout)
    assert run(spark, load, D[:1], [(D[0], "20240101", 2)]) == {feed(D[0]): "OK"}
    assert sorted((r.k, r.v) for r in spark.read.parquet(load.target).collect()) == [("a", 1), ("b", None)]


def test_loading_a_slice_twice_is_loading_it_once(spark, zone):
    put(zone, D[0], [("a", 1), ("b", 2)])
    load = new_load(spark, zone)
    for _ in range(2):  # the second time with an empty ledger, as after a crash
        run(spark, load, D[:1], [(D[0], "20240101", 2)])
        load = replace(load, ledger=load.ledger + "x")
    assert len(target_rows(spark, load)) == 2


def test_slice_delivered_empty_is_emptied(spark, zone):
    put(zone, D[0], [("a", 1)])
    put(zone, D[1], [("a", 1)])
    load = new_load(spark, zone)
    run(spark, load, D[:2], [(D[0], "20240101", 1), (D[1], "20240102", 1)])
    put(zone, D[0], [])
    redo = replace(load, ledger=load.ledger + "x", run_id="run-2")
    assert run(spark, redo, D[:1], [(D[0], "20240101", 0)]) == {feed(D[0]): "OK"}
    assert target_rows(spark, load) == [("2024-01-02", "a", "1", "run-1")]


def test_epoch_load_reports_dates_without_files(spark, tmp_path):
    zone = tmp_path / "zone"
    for n, ms in enumerate([1704067200000, 1704153599999, 1704153600000]):
        spark.createDataFrame([(n,)], "n int").write.parquet(str(zone / f"landed=run-{ms}-part-0"))
    spark.createDataFrame([(9,)], "n int").write.parquet(str(zone / "landed=notes"))
    load = new_load(spark, zone)
    days = spark.createDataFrame([(D[0],), (D[1],), (D[2],)], "data_dt date")
    got = sorted((str(r.data_dt), r.check_status, r.data_cnt)
                 for r in load_epoch_files(spark, load, days).collect())
    assert got == [("2024-01-01", "OK", 1), ("2024-01-01", "OK", 1), ("2024-01-02", "OK", 1),
                   ("2024-01-03", "NO_DATA", None)]
    rows = sorted((str(r.DATA_DT), r.n) for r in spark.read.parquet(load.target).collect())
    assert rows == [("2024-01-01", 0), ("2024-01-01", 1), ("2024-01-02", 2)]


def test_load_that_breaks_off_is_logged(spark, zone):
    put(zone, D[0], [("a", 1)])
    load = new_load(spark, zone)
    broken = spark.createDataFrame([(feed(D[0]), "x")], "file_name string, other string")
    expected = spark.createDataFrame([(feed(D[0]), D[0])], EXPECTED)
    with pytest.raises(Exception, match="ctrl_"):
        load_files(spark, load, expected, broken)
    state = file_state(spark, load.file_log).first()
    assert state.proc_status == "Failed" and "ctrl_" in state.error_message


def test_save_counted(spark):
    saved, seen = save_counted(
        spark.range(123), new_folder(spark, "test"), n_even=F.count_if(F.col("id") % 2 == 0))
    assert seen == {"n_rows": 123, "n_even": 62} and saved.count() == 123


def one(spark, load, path, day, control, **options):
    controls = spark.createDataFrame([control] if control else [], CONTROL)
    spec = SourceSpec(path, "|")
    return load_source(spark, load, spec, file_name=feed(day), data_dt=day, controls=controls,
                       **options).first()


def test_one_source_with_lineage(spark, zone):
    put(zone, D[0], [("a", 1), ("b", 2)])
    load, path = new_load(spark, zone), str(zone / feed(D[0]))
    bad = one(spark, load, path, D[0], (feed(D[0]), "20240101", 3))
    assert (bad.check_status, bad.message) == (
        "COUNT_MISMATCH", "rows loaded 2, rows announced 3")
    assert one(spark, load, path, D[0], None).check_status == "NO_CONTROL"
    assert one(spark, load, path, D[0], (feed(D[0]), "20240102", 2)).check_status == "DATE_MISMATCH"
    gone = str(zone / "gone.csv")
    assert one(spark, load, gone, D[0], (feed(D[0]), "20240101", 2)).check_status == "NO_DATA"
    good = replace(load, run_id="run-2")
    assert one(spark, good, path, D[0], (feed(D[0]), "20240101", 2)).proc_status == "Success"
    assert len(target_rows(spark, load)) == 2
    states = [(r.proc_run_id, r.proc_status) for r in file_state(spark, load.file_log).collect()]
    assert sorted(states) == [("run-1", "Failed"), ("run-2", "Success")]
    put(zone, D[0], [])
    assert one(spark, good, path, D[0], (feed(D[0]), "20240101", 0)).proc_status == "Success"
    assert target_rows(spark, load) == []


def test_one_source_by_business_date(spark, zone):
    load = new_load(spark, zone)
    for day, rows in ((D[0], ["2024-01-01|x", "2024-01-01|y"]), (D[1], ["2024-01-02|z"]),
                      (D[0], ["2024-01-01|w"])):
        (zone / feed(day)).write_text("BUSINESSDAYDATE|v\n" + "\n".join(rows) + "\n")
        got = one(spark, load, str(zone / feed(day)), day,
                  (feed(day), f"{day:%Y%m%d}", len(rows)), slice_column="BUSINESSDAYDATE")
        assert got.check_status == "OK"
    rows = spark.read.parquet(load.target).collect()
    assert sorted((str(r.BUSINESSDAYDATE), r.v) for r in rows) == [
        ("2024-01-01", "w"), ("2024-01-02", "z")]
    (zone / feed(D[0])).write_text("BUSINESSDAYDATE|v\n2024-01-01|a\n2024-01-03|b\n|c\n")
    got = one(spark, load, str(zone / feed(D[0])), D[0], (feed(D[0]), "20240101", 3),
              slice_column="BUSINESSDAYDATE")
    assert (got.check_status, got.message) == (
        "STRAY_ROWS", "2 rows lie outside the slice 20240101")
    assert spark.read.parquet(load.target).count() == 2


def test_one_source_replaces_the_table(spark, zone):
    load = new_load(spark, zone)
    for rows in ([("a", 1), ("b", 2)], [("c", 3)]):
        put(zone, D[0], rows)
        one(spark, load, str(zone / feed(D[0])), D[0], (feed(D[0]), "20240101", len(rows)),
            slice_column=None)
    assert [tuple(r) for r in spark.read.parquet(load.target).collect()] == [("c", "3")]


HARD = [(1, 'say "hi", ok'), (2, " padded "), (3, "line\nbreak"), (4, None), (5, "ünï,cödé")]


def test_export_round_trip(spark):
    df = spark.createDataFrame(HARD, "k int, t string").repartition(3)
    path = new_folder(spark, "test")
    exports.write_delimited(df, path)
    back = exports.read_delimited(spark, path, df.schema)
    assert sorted(back.collect()) == sorted(df.collect())
    assert spark.read.format("binaryFile").load(path).count() == 3


def test_one_feed_file(spark, tmp_path):
    path = f"{tmp_path}/out/FEED_20240105.csv"
    df = spark.createDataFrame(HARD, "k int, t string").repartition(3)
    exports.write_feed(df, path, verify=True)
    assert [p.name for p in (tmp_path / "out").iterdir()] == ["FEED_20240105.csv"]
    assert sorted(exports.read_delimited(spark, path, df.schema).collect()) == sorted(df.collect())
    text = Path(path).read_text(encoding="utf-8")
    assert text.startswith("k,t\n") and text.count("k,t\n") == 1
    exports.write_feed(spark.range(200_000).repartitionByRange(7, "id").sortWithinPartitions("id"), path, sep="|")
    assert Path(path).read_text().split() == ["id", *map(str, range(200_000))]  # replaced, and in order
    exports.write_feed(df.limit(0), path, verify=True)
    assert Path(path).read_text() == "k,t\n"


def test_a_feed_that_reads_back_otherwise_is_not_sent(spark, tmp_path):
    path = f"{tmp_path}/FEED.csv"
    exports.write_feed(spark.createDataFrame([("old",)], "t string"), path)
    odd = spark.createDataFrame([(None,), ("x",)], "t string")  # an empty line is read as no row
    with pytest.raises(exports.ContentError, match="read back"):
        exports.write_feed(odd, path, verify=True)
    with pytest.raises(exports.ContentError, match="read back"):
        exports.write_delimited(odd, f"{tmp_path}/parts", verify=True)
    assert [p.name for p in tmp_path.iterdir() if p.is_file()] == ["FEED.csv"]
    assert Path(path).read_text() == "t\nold\n"


def test_digests_tell_contents_apart(spark):
    schema = "a string, b string, n long, x array<double>"
    rows = [("p", None, 1, [1.0]), (None, "p", 1, None), ("", "q", 2**62, [None, 2.0]), ("", "q", 2**62, [None, 2.0])]

    def of(rows, **how):
        df = spark.createDataFrame(rows, schema)
        return tuple(df.agg(*reconciliation.digest(df.schema, **how)).first())

    assert of(rows) == of(rows[::-1]) and of([]) == (0, 0, 0)
    changed = [rows[:3], [*rows[:2], rows[0], rows[0]], [("p", "p", 1, [1.0]), (None, None, 1, None), *rows[2:]], [(None, "p", 1, [1.0]), ("p", None, 1, None), *rows[2:]]]
    assert len({of(rows), *map(of, changed)}) == 5
    assert of([("", None, 1, None)]) != of([(None, "", 1, None)])
    assert of([("", None, 1, None)], blank_is_null=True) == of([(None, "", 1, None)], blank_is_null=True)
    df = spark.createDataFrame(rows, schema)
    slices = reconciliation.digest_slices(df, ["b"])
    other = reconciliation.digest_slices(spark.createDataFrame([rows[0], (None, "p", 2, None), ("", "z", 0, None)], schema), ["b"])
    got = {r.b: r.check_status for r in reconciliation.reconcile_contents(slices, other, ["b"]).collect()}
    assert got == {None: "OK", "p": "CONTENT_MISMATCH", "q": "NO_CONTROL", "z": "NO_DATA"}


def test_protected_feed(spark):
    key = F.lit("0123456789abcdef").cast("binary")
    df = spark.createDataFrame(HARD + [(6, "x" * 5000)], "k int, t string")
    path = new_folder(spark, "test")
    exports.protect(df, key).write.text(path)
    lines = spark.read.text(path)
    assert lines.count() == 6
    assert lines.select(F.split_part("value", F.lit(":"), F.lit(1))).distinct().count() > 1
    assert sorted(exports.unprotect(lines, key, df.schema).collect()) == sorted(df.collect())
    wrong = F.lit("fedcba9876543210").cast("binary")
    with pytest.raises(Exception, match="AES"):
        exports.unprotect(lines, wrong, df.schema).collect()


def test_export_records_what_it_sent(spark):
    work = new_folder(spark, "test")
    df = spark.createDataFrame(HARD, "k int, t string")
    paths = export_table(
        spark, df, folder=f"{work}/out", prefix="3_Sales", data_dt=date(2024, 1, 5),
        ledger=f"{work}/ledger", proc_name="OUTB", run_id="r", as_of=dates.clock(AS_OF),
        key=F.lit("0123456789abcdef").cast("binary"))
    assert paths["delimited"].endswith("3_Sales_20240105.csv")
    ledger = spark.read.schema(schemas.LEDGER).parquet(f"{work}/ledger").collect()
    assert {r.file_name for r in ledger} == {
        "3_Sales_20240105.csv", "3_Sales_20240105.csv.protected"}
    assert exports.read_delimited(spark, paths["delimited"], df.schema).count() == 5
    one = export_table(
        spark, df, folder=f"{work}/one", prefix="3_Sales", data_dt=date(2024, 1, 5), ledger=f"{work}/ledger2",
        proc_name="OUTB", run_id="r", as_of=dates.clock(AS_OF), one_file=True, verify=True)
    assert Path(one["delimited"]).is_file()
    assert exports.read_delimited(spark, one["delimited"], df.schema).count() == 5
