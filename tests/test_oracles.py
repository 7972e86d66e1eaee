"""Every registered query against its DuckDB oracle, on the smallest data."""

import pytest
from oracle import compare, duck

import __spark_entry__ as entry
from slicewright.catalog import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(entry.queries()) and set(QUERIES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    fault = compare(spark, con, SF_DIR, entry.queries()[name], entry.oracle_sql()[name])
    assert fault is None, fault


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_results_do_not_depend_on_the_session_zone(spark, con):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        for name in ("fn_date", "json_forecast_flatten", "src_epoch_files", "ctl_run_window"):
            fault = compare(spark, con, SF_DIR, entry.queries()[name], entry.oracle_sql()[name])
            assert fault is None, (name, fault)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
