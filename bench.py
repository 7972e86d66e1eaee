"""Time the headline queries and print one JSON line.

BENCH_SF_DIR  data folder (default /root/testdata/sf0.1)
BENCH_CPUS    local executor threads (default 8)
--all         time every registered query
--by-date     also time the daily load run one date at a time, for comparison
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from slicewright.catalog import QUERIES  # noqa: E402

HEADLINE = [
    "agg_slice_reconcile",
    "ctl_run_calendar",
    "snk_merge_upsert",
    "snk_update_matched",
    "win_latest_status",
    "lim_first_per_key",
    "agg_key_violations",
    "json_forecast_flatten",
    "src_csv_trimmed",
    "snk_slice_replace",
    "snk_partition_replace",
    "inbound_load",
    "inbound_load_multi",
    "outbound_export",
]


def session(cpus: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("slicewright-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.checkpoint.dir", os.environ.get("BENCH_WORK_DIR", "/tmp/checkpoints"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def timed(spark: SparkSession, sf_dir: str, name: str) -> float:
    """Seconds to run a query and produce every row of its result."""
    started = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - started, 3)


def load_by_date(spark: SparkSession, sf_dir: str) -> float:
    """The daily load as a sequential loop with one run per date."""
    from pyspark.sql import functions as F

    from slicewright.catalog import loads
    from slicewright.plans.inbound import load_files

    landing = loads.land_daily_events(spark, sf_dir)
    load = loads.new_load(spark, landing)
    files = loads.daily_files(spark, sf_dir).cache()
    controls = loads.daily_controls(files)
    started = time.perf_counter()
    for row in files.select("data_dt").distinct().collect():
        one = files.where(F.col("data_dt") == row.data_dt).select("file_name", "data_dt")
        load_files(spark, load, one, controls)
    return round(time.perf_counter() - started, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = list(QUERIES) if "--all" in sys.argv else HEADLINE
    spark = session(cpus)
    timed(spark, sf_dir, "agg_count")  # start-up is not part of any query
    seconds = {name: timed(spark, sf_dir, name) for name in names}
    if "--by-date" in sys.argv:
        seconds["inbound_load, one date at a time"] = load_by_date(spark, sf_dir)
    total = round(sum(seconds[n] for n in names), 3)
    print(
        json.dumps(
            {
                "metric": "total seconds over the headline queries",
                "value": total,
                "unit": "sec",
                "queries": seconds,
                "sf": sf_dir.rsplit("sf", 1)[-1],
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
