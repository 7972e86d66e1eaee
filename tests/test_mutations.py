from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from slicewright import schemas
from slicewright.operators import keys, mutations, reconciliation
from slicewright.storage import new_folder, save

DAY = date(2024, 1, 2)


def slices(spark, rows):
    return spark.createDataFrame(rows, "k int, v string, d date")


def content(df):
    return sorted(df.collect(), key=str)


def test_replace_slice(spark):
    target = slices(spark, [(1, "old", DAY), (2, "other", date(2024, 1, 3)), (3, "none", None)])
    new = slices(spark, [(9, "new", DAY)])
    once = mutations.replace_slice(target, new, "d", "20240102")
    assert {r.v for r in once.collect()} == {"new", "other", "none"}
    assert content(mutations.replace_slice(once, new, "d", DAY)) == content(once)
    stray = slices(spark, [(9, "new", date(2024, 1, 3))])
    with pytest.raises(Exception, match="outside the slice"):
        mutations.replace_slice(target, stray, "d", DAY).collect()
    with pytest.raises(Exception, match="outside the slice"):
        mutations.replace_slice(target, slices(spark, [(9, "n", None)]), "d", DAY).collect()


def test_replace_slices_equals_single_replacements(spark):
    target = slices(spark, [(i, "old", date(2024, 1, 1 + i % 5)) for i in range(50)] + [(99, "x", None)])
    new = slices(spark, [(i, "new", date(2024, 1, 1 + i % 2)) for i in range(4)])
    one_by_one = target
    for d in (date(2024, 1, 1), date(2024, 1, 2)):
        one_by_one = mutations.replace_slice(one_by_one, new.where(F.col("d") == d), "d", d)
    got = mutations.replace_slices(target, new, "d").select("k", "v", "d")
    assert content(got) == content(one_by_one)


def test_partition_slices_are_idempotent(spark):
    path = new_folder(spark, "test")
    rows = slices(spark, [(i, "old", date(2024, 1, 1 + i % 3)) for i in range(30)])
    mutations.write_slices(rows, path, "d", gather=True)
    new = slices(spark, [(100, "new", DAY)])
    for _ in range(2):
        mutations.write_slices(new, path, "d")
        got = spark.read.parquet(path)
        assert got.where(F.col("d") == DAY).collect()[0].v == "new"
        assert got.count() == 21


def test_update_matched(spark):
    target = spark.createDataFrame(
        [(1, "a", "open"), (1, "b", "open"), (2, "c", "shut"), (None, "n", "open")],
        "k int, v string, s string")
    changes = spark.createDataFrame([(1, None), (2, "x"), (None, "y"), (None, "z"), (7, "q")],
                                    "k int, v string")
    got = mutations.update_matched(
        target, changes, ["k"], {"v": F.col("new_v")}, when=F.col("s") == "open")
    assert content(got) == content(spark.createDataFrame(
        [(1, None, "open"), (1, None, "open"), (2, "c", "shut"), (None, "n", "open")],
        "k int, v string, s string"))
    twice = spark.createDataFrame([(1, "a"), (1, "b")], "k int, v string")
    with pytest.raises(Exception, match="several rows for key"):
        mutations.update_matched(target, twice, ["k"], {"v": F.lit("x")}).collect()


def test_merge_rejects_duplicate_source_keys(spark):
    target = spark.createDataFrame([("a", 1)], "k string, v int")
    source = spark.createDataFrame([("b", 1), ("b", 1)], "k string, v int")
    merged = mutations.merge_upsert(
        target, source, ["k"], update={"v": F.col("new_v")}, insert={"v": F.col("new_v")})
    with pytest.raises(Exception, match="several rows for key"):
        merged.collect()


def test_merge_upsert(spark):
    target = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y")], "k string, v int, w string")
    source = spark.createDataFrame([("b", None), ("c", 3)], "k string, v int")
    merged = mutations.merge_upsert(
        target, source, ["k"], update={"v": F.col("new_v")}, insert={"v": F.col("new_v")})
    assert merged.schema == target.schema
    assert content(merged) == content(spark.createDataFrame(
        [("a", 1, "x"), ("b", None, "y"), ("c", 3, None)], target.schema))


def test_keys_with_one_hot_key(spark):
    """A third of all rows share one key."""
    rows = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"),
        F.pmod(F.xxhash64("id"), F.lit(997)).alias("o"), "id")
    model = {}
    for r in rows.collect():
        model.setdefault(r.k, []).append((r.o, r.id))
    last = {r.k: r.id for r in keys.latest_per_key(rows, ["k"], ["o", "id"]).collect()}
    first = {r.k: r.id for r in keys.first_per_key(rows, ["k"], ["o", "id"]).collect()}
    assert last == {k: max(v)[1] for k, v in model.items()}
    assert first == {k: min(v)[1] for k, v in model.items()}
    bad = keys.key_violations(rows, ["k"]).collect()
    assert [(r.k, r.n_rows, r.violation) for r in bad] == [(0, 1000, "DUPLICATE_KEY")]


def test_insert(spark):
    path = new_folder(spark, "test")
    with pytest.raises(ValueError, match="run_period"):
        mutations.insert_select(
            spark.createDataFrame([("p",)], "proc_name string"), path, schemas.CONFIG)
    row = ("p", "inbound", 1, 1, 1, "D", "/job", "me", datetime(2024, 1, 1))
    names = [f.name for f in schemas.CONFIG if not f.nullable]
    mutations.insert_values(spark, [row], names, path, schemas.CONFIG)
    got = spark.read.parquet(path)
    assert got.columns == schemas.CONFIG.names
    assert got.first().proc_name == "p" and got.first().script_path is None


def test_reconcile(spark):
    counts = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "f string, data_cnt long")
    controls = spark.createDataFrame([("a", 1), ("b", 3), ("d", 0)], "f string, ctrl_cnt long")
    got = {r.f: (r.check_status, r.message) for r in
           reconciliation.reconcile(counts, controls, ["f"]).collect()}
    assert got == {
        "a": ("OK", None),
        "b": ("COUNT_MISMATCH", "rows loaded 2, rows announced 3"),
        "c": ("NO_CONTROL", None),
        "d": ("NO_DATA", None),
    }
    checked = reconciliation.reconcile(counts, controls, ["f"])
    failed = F.col("check_status") != "OK"
    path = new_folder(spark, "test")
    with pytest.raises(RuntimeError, match="^3 checks failed.*announced 3"):
        reconciliation.raise_on_failures(checked, failed, F.col("message"), path)
    assert {r.f for r in spark.read.parquet(path).collect()} == {"b", "c", "d"}  # all of them
    reconciliation.raise_on_failures(checked.where("f = 'a'"), failed, F.col("message"), path)


def test_partitioned_write_refuses_stray_rows(spark):
    path = new_folder(spark, "test")
    first = slices(spark, [(1, "a", DAY)])
    mutations.write_slices(first, path, "d")
    stray = slices(spark, [(2, "b", DAY), (3, "c", date(2031, 1, 1))])
    with pytest.raises(Exception, match="outside the slices to replace"):
        mutations.write_slices(stray, path, "d", slices=F.col("d") == F.lit(DAY))
    assert spark.read.parquet(path).count() == 1
    mutations.write_slices(stray.where(F.col("d") == F.lit(DAY)), path, "d", slices=F.col("d") == F.lit(DAY))
    assert [r[0] for r in spark.read.parquet(path).select(first.columns[0]).collect()] == [2]


def test_slice_counts_add_up(spark):
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    counts = reconciliation.count_slices(orders, "o_orderdate", "d")
    assert counts.agg(F.sum("data_cnt")).first()[0] == orders.count()


def test_save_reads_back_what_was_written(spark):
    df = slices(spark, [(1, "a", DAY)])
    assert save(df, new_folder(spark, "test")).collect() == df.collect()
