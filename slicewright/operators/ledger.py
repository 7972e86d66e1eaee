"""The ledger of processed files, which keeps a file from being loaded twice."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slicewright.functions import dates, filenames
from slicewright.schemas import LEDGER, conform


#: What makes a landed file the same one: a changed file of the same name is another.
IDENTITY = ["file_name", "n_bytes", "modified_dtm"]


def with_loaded(landed: DataFrame, ledger: DataFrame) -> DataFrame:
    """Landed files with a flag ``loaded``: whether the ledger holds just this file.

    Identity is name, size and time of change, as far as both tables have them.
    """
    shared = [c for c in IDENTITY if c in landed.columns and c in ledger.columns]
    known = ledger.select(*[F.col(c).alias(f"_k_{c}") for c in shared]).distinct()
    same = F.lit(True)
    for c in shared:
        same = same & F.col(c).eqNullSafe(F.col(f"_k_{c}"))
    found = landed.join(known.withColumn("loaded", F.lit(True)), same, "left")
    return found.drop(*[f"_k_{c}" for c in shared]).withColumn("loaded", F.coalesce("loaded", F.lit(False)))


def unprocessed(landed: DataFrame, ledger: DataFrame) -> DataFrame:
    """Landed files that the ledger does not hold."""
    return with_loaded(landed, ledger).where(~F.col("loaded")).drop("loaded")


def entries(
    files: DataFrame, *, folder: str, proc_name: Column, run_id: Column, as_of: Column
) -> DataFrame:
    """Ledger rows for loaded files (``file_name``, ``data_dt``)."""
    path = F.concat(F.lit(folder.rstrip("/") + "/"), F.col("file_name"))
    archived = filenames.archive_path(path, dates.compact(F.col("data_dt")), dates.stamp(as_of))
    rows = files.withColumns(
        {
            "proc_name": proc_name,
            "proc_run_id": run_id,
            "archive_path": archived,
            "processed_dtm": as_of,
        }
    )
    return conform(rows, LEDGER)
