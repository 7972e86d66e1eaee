"""Row filters."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

from slicewright.functions import dates


def active(proc_name: str | None = None) -> Column:
    """Active config rows, of one process or of all."""
    switched_on = F.col("is_active") == 1
    return switched_on if proc_name is None else switched_on & (F.col("proc_name") == proc_name)


def in_slice(column: str, data_dt: date | str) -> Column:
    """Rows of one date of a date column; prunes when it is the partition column."""
    return F.col(column) == dates.day(data_dt)


def in_timestamp_slice(column: str, data_dt: date) -> Column:
    """Rows of one date of a timestamp column, as a range that reaches the Parquet scan."""
    start = dates.clock(F.lit(data_dt))
    end = dates.clock(F.lit(data_dt + timedelta(days=1)))
    return (F.col(column) >= start) & (F.col(column) < end)


def not_like(column: str, pattern: str) -> Column:
    return ~F.col(column).like(pattern)
