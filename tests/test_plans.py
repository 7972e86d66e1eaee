"""Properties of physical plans that must hold at any data size."""

from datetime import date

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from slicewright.catalog import QUERIES
from slicewright.operators import keys, mutations, predicates, projection, reconciliation
from slicewright.plans import progress, windows
from slicewright.storage import new_folder, shared_root

SF_DIR = "/root/testdata/sf0.001"
#: Queries whose result is one total of the whole table.
TOTALS = {"agg_count", "agg_required_violations"}

def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_pairing_of_all_rows_and_no_python(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    bad = ["CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEvalPython", "MapInPandas"]
    if name not in TOTALS:
        bad.append("SinglePartition")
    assert not [b for b in bad if b in text]


@pytest.fixture
def lines(spark):
    return spark.read.parquet(f"{SF_DIR}/lineitem.parquet")


def test_narrow_operators_do_not_shuffle(spark, lines):
    dated = lines.withColumn("d", F.col("l_shipdate").cast("date"))
    new = dated.where(F.col("d") == date(1997, 6, 17))
    window = spark.sql("SELECT 'p' AS proc_name, 'r' AS proc_run_id, 'N' AS run_mode, DATE'2024-01-01' "
                       "AS start_dt, DATE'2024-01-09' AS end_dt, DATE'2024-01-01' AS running_dt, "
                       "'D' AS data_freq, '/j' AS notebook_path")
    for df in (
        mutations.replace_slice(dated, new, "d", date(1997, 6, 17)),
        projection.with_lineage(lines, F.lit(date(2024, 1, 1)), "r", F.lit("2024-01-01")),
        windows.expand_calendar(window),
        entry.queries()["json_forecast_flatten"](spark, SF_DIR),
    ):
        assert "Exchange" not in plan(df)


def test_slice_filter_reaches_the_scan(lines):
    text = plan(lines.where(predicates.in_timestamp_slice("l_shipdate", date(1997, 6, 17)))
                .select("l_orderkey"))
    assert "GreaterThanOrEqual(l_shipdate" in text and "LessThan(l_shipdate" in text
    assert "ReadSchema: struct<l_orderkey:bigint,l_shipdate:timestamp_ntz>" in text


def test_partition_column_predicate_prunes(spark, lines):
    path = new_folder(spark, "test")
    year = F.make_date(F.year("l_shipdate"), F.lit(1), F.lit(1))
    mutations.write_slices(lines.withColumn("DATA_DT", year), path, gather=True)
    text = plan(spark.read.parquet(path).where(predicates.in_slice("DATA_DT", "19970101")))
    assert "PartitionFilters: [isnotnull(DATA_DT" in text


def test_aggregations_combine_before_the_shuffle(spark, lines):
    counted = reconciliation.count_slices(lines, "l_shipdate", "d")
    latest = keys.latest_per_key(lines, ["l_orderkey"], ["l_shipdate", "l_linenumber"])
    for df in (counted, latest, keys.key_violations(lines, ["l_orderkey"])):
        text = plan(df)
        assert "partial_" in text and text.count("Exchange") == 1


def test_key_check_of_an_upsert_adds_no_shuffle(spark, lines):
    orders = spark.read.parquet(f"{SF_DIR}/orders.parquet").withColumnRenamed("o_orderkey", "k")
    merged = mutations.merge_upsert(
        orders, orders.select("k", "o_orderstatus"), ["k"],
        update={"o_orderstatus": F.col("new_o_orderstatus")}, insert={})
    assert plan(merged).count("Exchange hashpartitioning") == 2


def test_few_changes_do_not_shuffle_the_table(spark, lines):
    changes = spark.range(1, 4).withColumnRenamed("id", "l_orderkey")
    updated = mutations.update_matched(lines, changes, ["l_orderkey"], {"l_tax": F.lit(0.0)})
    text = plan(updated)
    assert "BroadcastHashJoin" in text and "hashpartitioning" not in text


def test_building_an_update_starts_no_job(spark, lines):
    group = "building"
    changes = lines.select("l_orderkey").distinct()
    spark.sparkContext.setJobGroup(group, group)
    try:
        mutations.update_matched(lines, changes, ["l_orderkey"], {"l_tax": F.lit(0.0)})
        progress.stop_after_failure(lines, "l_orderkey", ["l_linenumber"], F.col("l_tax") > 0)
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup(group)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def _skewed_join_plan(spark, build):
    """Final plan with broadcasting off and every partition small enough to be split."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.0",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        df = build()
        rows = df.collect()
        return rows, plan(df)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_hot_keys_are_split_in_large_joins(spark):
    """A third of the rows share one key and no side can be broadcast."""
    hot = spark.range(0, 6000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("p"), F.col("id") % 50))
        .alias("proc_name"),
        F.col("id").alias("n"), F.xxhash64("id").alias("v"))

    def update():
        changes = spark.createDataFrame([("hot", 1), ("p1", 2)], "proc_name string, v long")
        return mutations.update_matched(hot, changes, ["proc_name"], {"v": F.col("new_v")})

    rows, text = _skewed_join_plan(spark, update)
    assert "skew=true" in text
    assert len(rows) == 6000 and sum(r.v == 1 for r in rows) == 2000

    def stop():
        return progress.stop_after_failure(hot, "proc_name", ["n"], F.col("n") == 3000)

    rows, text = _skewed_join_plan(spark, stop)
    assert "skew=true" in text
    assert sum(r.proc_name == "hot" for r in rows) == 1001


def test_shared_root_comes_from_the_session(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        assert shared_root(spark) == named.rstrip("/")
    assert new_folder(spark, "a").startswith(shared_root(spark))
    assert new_folder(spark, "a") != new_folder(spark, "a")


def test_request_rules_are_worked_out_once(spark):
    from slicewright.catalog import QUERIES

    plan = QUERIES["ctl_run_calendar"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("CASE WHEN") < 50 and len(plan) < 16_000
