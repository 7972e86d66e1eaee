"""What has landed, what was announced, and what is missing."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from slicewright.functions import filenames, text
from slicewright.sources.columnar import read_landed
from slicewright.sources.delimited import trimming_reader


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    """One row per landed name with size, last change (UTC) and a path; no file is opened.

    A folder that does not exist has landed nothing.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    try:
        files = reader.load(folder).select("path", "length", "modificationTime")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        files = spark.createDataFrame([], "path string, length long, modificationTime timestamp")
    changed = F.max("modificationTime")
    return files.groupBy(filenames.landed_name(F.col("path")).alias("file_name")).agg(
        F.sum("length").alias("n_bytes"),
        F.count("*").alias("n_parts"),
        F.convert_timezone(F.current_timezone(), F.lit("UTC"), changed.cast("timestamp_ntz")).alias("modified_dtm"),
        F.min(F.when(F.col("length") > 0, F.col("path"))).alias("path"),
    )


def read_controls(spark: SparkSession, path: str, shared_prefix: str) -> DataFrame:
    """Announced row count and date per data file, over every control file in ``path``.

    A data file whose name starts with ``shared_prefix`` is listed in a shared
    control file and carries the date itself; any other has a control file of
    its own, whose name carries the date.
    """
    own_date = filenames.date_after_first_underscore(F.col("FILENAME"))
    rows = read_landed(trimming_reader(spark), "csv", path)
    control_date = filenames.date_after_last_underscore(F.col("file_name"))
    return rows.select(
        F.col("FILENAME").alias("file_name"),
        F.when(F.col("FILENAME").startswith(shared_prefix), own_date)
        .otherwise(control_date)
        .alias("ctrl_dt"),
        text.whole_number(F.col("CNT_REC")).alias("ctrl_cnt"),
    )


def expected_files(
    calendar: DataFrame, config: DataFrame, dated: Column | None = None
) -> DataFrame:
    """Data and control file names for each process and run date.

    The configured name is a prefix to which the date is added; where ``dated``
    is given and false, it is the whole name.
    """
    prefix, run_day = F.col("src_file_name"), F.col("running_dt")
    full = filenames.dated_name(prefix, run_day)
    if dated is not None:
        full = F.when(dated, full).otherwise(prefix)
    data_name = F.when(~text.is_blank(prefix), full)
    return (
        calendar.select("proc_name", "running_dt")
        .join(config.select("proc_name", "src_file_name"), "proc_name")
        .select(
            "proc_name",
            "running_dt",
            data_name.alias("file_name"),
            filenames.control_name(data_name, run_day).alias("control_name"),
        )
    )


def resolve(expected: DataFrame, landed: DataFrame) -> DataFrame:
    """Expected files with a ``missing`` flag and what the manifest knows; ``landed`` lists each name once.

    Processes without a file name miss their file.  However many there are,
    they are spread over the tasks by a key that no file name can equal.
    """
    nameless = F.concat(F.lit("/"), F.xxhash64(*expected.columns).cast("string"))
    wanted = expected.withColumn("_name", F.coalesce("file_name", nameless))
    known = [c for c in landed.columns if c not in expected.columns]
    present = landed.select(F.col("file_name").alias("_name"), F.lit(True).alias("_landed"), *known)
    return wanted.join(present, "_name", "left").select(
        *expected.columns, F.col("_landed").isNull().alias("missing"), *known
    )
