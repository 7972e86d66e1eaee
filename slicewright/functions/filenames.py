"""Names of landed, control and archived files, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from slicewright.functions import dates, text

# Epoch-named files, and the suffix of per-file control files.
EPOCH_NAME = r"run-(\d+)-part"
CONTROL_INFIX = "_ctrl_"

# A landing zone written by Spark keeps each landed file as one directory.
LANDED_COLUMN = "landed"


def last_element(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def landed_name(path: Column) -> Column:
    """Landed name of a file: its own, or that of its ``landed=<name>`` directory."""
    directory = F.regexp_extract(path, LANDED_COLUMN + r"=([^/]+)/", 1)
    return F.when(directory != "", directory).otherwise(last_element(path))


def stem(name: Column) -> Column:
    """Name up to its first dot."""
    return F.split_part(name, F.lit("."), F.lit(1))


def extension(name: Column) -> Column:
    """Name after its last dot; a name without a dot is its own extension."""
    return F.element_at(F.split(name, r"\."), -1)


def dated_name(prefix: Column, value: Column, suffix: str = ".csv") -> Column:
    """``<prefix>_<yyyyMMdd>.csv``"""
    return F.concat(prefix, F.lit("_"), dates.compact(value), F.lit(suffix))


def control_name(name: Column, value: Column) -> Column:
    """Name of the control file that belongs to one data file and date."""
    return F.concat(stem(name), F.lit(CONTROL_INFIX), dates.compact(value), F.lit(".csv"))


def date_after_first_underscore(name: Column) -> Column:
    """Date text in a data file name: between its first underscore and the next mark."""
    return stem(F.split_part(name, F.lit("_"), F.lit(2)))


def date_after_last_underscore(name: Column) -> Column:
    """Date text in a control file name: after its last underscore."""
    return stem(F.element_at(F.split(name, "_"), -1))


def epoch_millis(name: Column) -> Column:
    """Epoch milliseconds in an epoch-named file, NULL for other names."""
    return text.whole_number(F.regexp_extract(name, EPOCH_NAME, 1))


def epoch_file_date(name: Column) -> Column:
    """UTC date of an epoch-named file, NULL for other names."""
    return dates.epoch_date(epoch_millis(name))


def archive_path(path: Column, data_date_text: Column, stamp: Column) -> Column:
    """``<dir>/archived/<stamp>/<stem>_<date>_<stamp>.<extension>``"""
    name = last_element(path)
    folder = F.regexp_extract(path, r"^(.*)/[^/]*$", 1)
    file = F.concat_ws(
        ".", F.concat_ws("_", stem(name), data_date_text, stamp), extension(name)
    )
    return F.concat_ws("/", folder, F.lit("archived"), stamp, file)
