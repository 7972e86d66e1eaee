"""Sending a table out as a dated feed."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from slicewright.operators import ledger as ledgers
from slicewright.operators.exports import protect, write_delimited, write_feed
from slicewright.operators.mutations import append
from slicewright.storage import new_folder, release, save

PROTECTED_SUFFIX = ".protected"


def export_table(
    spark: SparkSession,
    table: DataFrame,
    *,
    folder: str,
    prefix: str,
    data_dt: date,
    ledger: str,
    proc_name: str,
    run_id: str,
    as_of: Column,
    key: Column | None = None,
    one_file: bool = False,
    verify: bool = False,
) -> dict[str, str]:
    """Export ``table`` as ``<prefix>_<yyyyMMdd>.csv``, plus a protected copy when given a key.

    The name is that of a folder of headed parts, or with ``one_file`` of a single file.  ``verify``
    reads the delimited copy back before the ledger says that it was sent.
    For two copies the table is saved once, so both hold the same rows.
    Returns the paths written; the ledger records each of them.
    """
    name = f"{prefix}_{data_dt:%Y%m%d}.csv"
    paths = {"delimited": f"{folder}/{name}"}
    staged = new_folder(spark, "outbound")
    if key is not None:
        table = save(table, staged)
    (write_feed if one_file else write_delimited)(table, paths["delimited"], verify=verify)
    if key is not None:
        paths["protected"] = paths["delimited"] + PROTECTED_SUFFIX
        protect(table, key).write.mode("overwrite").text(paths["protected"])
        release(spark, staged)
    names = [(path.rsplit("/", 1)[1], data_dt) for path in paths.values()]
    sent = spark.createDataFrame(names, "file_name string, data_dt date")
    append(
        ledgers.entries(
            sent, folder=folder, proc_name=F.lit(proc_name), run_id=F.lit(run_id), as_of=as_of
        ),
        ledger,
    )
    return paths
