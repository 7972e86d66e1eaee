"""Parquet files and tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F

from slicewright.functions import dates, filenames
from slicewright.schemas import quoted


def cast_list(types: dict[str, str]) -> list[Column]:
    """Cast projection; a value that does not fit its type becomes NULL."""
    return [F.col(quoted(name)).try_cast(to).alias(name) for name, to in types.items()]


def read_cast(spark: SparkSession, path: str, types: dict[str, str]) -> DataFrame:
    """Parquet files under a cast projection; dotted column names are allowed."""
    return spark.read.parquet(path).select(*cast_list(types))


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """Whole table, named in the catalog or by its storage path."""
    return spark.read.parquet(name) if "/" in name else spark.table(name)


def read_landed(reader: DataFrameReader, format_name: str, folder: str) -> DataFrame:
    """Rows of a landing folder with the landed name they came from as ``file_name``.

    A landed file is a plain file, or a ``landed=<name>`` directory.  Either
    way the name is a constant of the scan: it is not worked out row by row,
    and a filter on it keeps Spark from opening the other files.
    """
    rows = reader.format(format_name).load(folder)
    if filenames.LANDED_COLUMN in rows.columns:
        name = F.col(filenames.LANDED_COLUMN).cast("string")
    else:
        name = F.col("_metadata.file_name")
    return rows.withColumn("file_name", name).drop(filenames.LANDED_COLUMN)


def read_epoch_files(spark: SparkSession, folder: str, data_dt=None) -> DataFrame:
    """Rows of the epoch-named Parquet files of one UTC date, or of every date.

    Adds ``file_name`` and ``file_dt``.
    """
    rows = read_landed(spark.read, "parquet", folder)
    file_dt = filenames.epoch_file_date(F.col("file_name"))
    if data_dt is None:
        return rows.withColumn("file_dt", file_dt).where(F.col("file_dt").isNotNull())
    wanted = dates.day(data_dt)
    return rows.where(file_dt == wanted).withColumn("file_dt", wanted)
