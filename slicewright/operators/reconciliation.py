"""Checks of loaded slices against announced totals, and load metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slicewright.schemas import FAILED, SUCCESS

OK = "OK"
COUNT_MISMATCH = "COUNT_MISMATCH"
DATE_MISMATCH = "DATE_MISMATCH"
NO_CONTROL = "NO_CONTROL"
NO_DATA = "NO_DATA"
STRAY_ROWS = "STRAY_ROWS"
CONTENT_MISMATCH = "CONTENT_MISMATCH"
HEADER_MISMATCH = "HEADER_MISMATCH"
CONTROL_AMBIGUOUS = "CONTROL_AMBIGUOUS"
SLICE_INCOMPLETE = "SLICE_INCOMPLETE"
ALREADY_LOADED = "ALREADY_LOADED"


def count_slices(df: DataFrame, key: str | Column, name: str) -> DataFrame:
    """Rows per slice, added up in every task before the shuffle."""
    column = F.col(key) if isinstance(key, str) else key
    return df.groupBy(column.alias(name)).agg(F.count("*").alias("data_cnt"))


def count_message(data_cnt: Column, ctrl_cnt: Column) -> Column:
    return F.concat(
        F.lit("rows loaded "), data_cnt.cast("string"), F.lit(", rows announced "),
        ctrl_cnt.cast("string"),
    )


def date_message(run_dt: Column, ctrl_dt: Column) -> Column:
    return F.concat(F.lit("run date "), run_dt, F.lit(", control date "), ctrl_dt)


def date_differs(run_dt: Column, ctrl_dt: Column) -> Column:
    """Dates compared as ``yyyyMMdd`` text; a missing control date also differs."""
    return ~run_dt.eqNullSafe(ctrl_dt)


def check_dates(pairs: DataFrame) -> DataFrame:
    """Compare the run date with the control file's date, row by row."""
    differs = date_differs(F.col("run_dt"), F.col("ctrl_dt"))
    return pairs.withColumns(
        {
            "check_status": F.when(differs, DATE_MISMATCH).otherwise(OK),
            "message": F.when(
                differs, date_message(F.col("run_dt"), F.coalesce("ctrl_dt", F.lit("missing")))
            ),
        }
    )


def reconcile(counts: DataFrame, controls: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All slices against all control rows in one join of aggregates.

    ``counts`` holds (keys, data_cnt), ``controls`` (keys, ctrl_cnt), one row per slice each.
    """
    data, ctrl = F.col("data_cnt"), F.col("ctrl_cnt")
    status = (
        F.when(ctrl.isNull(), NO_CONTROL)
        .when(data.isNull(), NO_DATA)
        .when(data != ctrl, COUNT_MISMATCH)
        .otherwise(OK)
    )
    return (
        counts.join(controls, list(keys), "full_outer")
        .withColumn("check_status", status)
        .withColumn(
            "message",
            F.when(F.col("check_status") == COUNT_MISMATCH, count_message(data, ctrl)),
        )
    )


#: What a digest consists of.
DIGEST = ["n_rows", "hash_sum", "hash_xor"]


def digest(schema: T.StructType, *, blank_is_null: bool = False) -> list[Column]:
    """Aggregates that prove the contents of rows, whatever their order and partitioning.

    The number of rows, the sum of one hash of each row and the exclusive or of another: partial results
    add up, a repeated row counts as often as it occurs, and NULL differs from every value and from NULL in another column.
    ``blank_is_null`` takes empty texts for NULL, as a delimited file does.  Maps have no hash.
    """
    cells = []
    for field in schema.fields:
        value = F.col(f"`{field.name.replace('`', '``')}`")
        if blank_is_null and isinstance(field.dataType, T.StringType):
            value = F.nullif(value, F.lit(""))
        cells += [value, value.isNull()]
    first, second = (F.xxhash64(F.lit(seed), *cells) for seed in (1, 2))
    n_rows, hash_sum, hash_xor = DIGEST
    return [
        F.count("*").alias(n_rows),
        F.coalesce(F.sum(first.cast("decimal(20,0)")), F.lit(0)).cast("decimal(38,0)").alias(hash_sum),
        F.coalesce(F.bit_xor(second), F.lit(0)).cast("long").alias(hash_xor),
    ]


def digest_slices(df: DataFrame, keys: Sequence[str], *, blank_is_null: bool = False) -> DataFrame:
    """Digest of each slice, added up in every task before the shuffle."""
    return df.groupBy(*keys).agg(*digest(df.schema, blank_is_null=blank_is_null))


def reconcile_contents(data: DataFrame, proof: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Digests of what was read (``data``) against those taken when it was written (``proof``), slice by slice.

    Slices meet by keys of equal value, NULL included.
    """
    ours, theirs = data.select(F.struct(*keys).alias("k"), F.struct(*DIGEST).alias("d")), proof.select(
        F.struct(*keys).alias("k"), F.struct(*DIGEST).alias("p")
    )
    status = (
        F.when(F.col("p").isNull(), NO_CONTROL)
        .when(F.col("d").isNull(), NO_DATA)
        .when(F.col("d.n_rows") != F.col("p.n_rows"), COUNT_MISMATCH)
        .when(F.col("d") != F.col("p"), CONTENT_MISMATCH)
        .otherwise(OK)
    )
    return ours.join(theirs, "k", "full_outer").select(
        "k.*", F.col("d.n_rows").alias("data_cnt"), F.col("p.n_rows").alias("ctrl_cnt"), status.alias("check_status")
    )


def load_metrics(file_log: DataFrame) -> DataFrame:
    """Files, rows and time span per process and outcome."""
    return file_log.groupBy("proc_name", "proc_status").agg(
        F.count("*").alias("n_files"),
        F.sum("total_record").alias("total_record"),
        F.min("start_proc_dtm").alias("first_start"),
        F.max("end_proc_dtm").alias("last_end"),
    )


def raise_on_failures(df: DataFrame, failed: Column, message: Column, path: str) -> None:
    """Raise when any row fails.

    The failing rows go to a table at ``path``, whole, with their ``message``; the
    error names it, how many there are, and the first message.
    """
    found = df.where(failed).withColumn("message", message.cast("string"))
    seen = Observation()
    counts = (F.count("*").alias("n"), F.min("message").alias("first"))
    found.observe(seen, *counts).write.mode("overwrite").parquet(path)
    if seen.get["n"]:
        raise RuntimeError(f"{seen.get['n']} checks failed, first: {seen.get['first']}; all are in {path}")


def outcome(check_status: Column) -> Column:
    """Log status of a check result."""
    return F.when(check_status.isin(OK, ALREADY_LOADED), SUCCESS).otherwise(FAILED)
