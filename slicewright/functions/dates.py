"""Business dates and clocks.

Clocks are zone-less UTC timestamps.  Nothing here reads the current time or
the session time zone.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

# Business time zone and text formats.
BUSINESS_ZONE = "Asia/Bangkok"
COMPACT_DATE = "yyyyMMdd"
ISO_DATE = "yyyy-MM-dd"
STAMP = "yyyyMMddHHmmss"

_COMPACT_SHAPE = r"^\d{8}\z"
_ISO_SHAPE = r"^\d{4}-\d{1,2}-\d{1,2}\z"
_MINUTE_SHAPE = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}\z"
_MILLIS_PER_DAY = 86_400_000


def clock(value: datetime | Column) -> Column:
    """A zone-less timestamp column from a Python value or a column."""
    column = value if isinstance(value, Column) else F.lit(value.isoformat(sep=" "))
    return column.cast("timestamp_ntz")


def day(value: date | str | Column) -> Column:
    """A date column from a date, from ``yyyyMMdd`` or ``yyyy-MM-dd`` text, or from a column."""
    if isinstance(value, Column):
        return value.cast("date")
    if isinstance(value, str):
        value = datetime.strptime(value.replace("-", ""), "%Y%m%d").date()
    return F.lit(value)


def local_time(utc: Column, zone: str = BUSINESS_ZONE) -> Column:
    """Wall-clock time in ``zone`` for a UTC timestamp."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), utc)


def business_date(utc: Column, zone: str = BUSINESS_ZONE) -> Column:
    """Calendar date in the business zone at a UTC time."""
    return local_time(utc, zone).cast("date")


def stamp(utc: Column, zone: str = BUSINESS_ZONE) -> Column:
    """Archive stamp ``yyyyMMddHHmmss`` in the business zone."""
    return F.date_format(local_time(utc, zone), STAMP)


def parse_compact(text: Column) -> Column:
    """Date of a ``yyyyMMdd`` text, NULL when it is not exactly that."""
    dashed = F.concat_ws(
        "-", F.substring(text, 1, 4), F.substring(text, 5, 2), F.substring(text, 7, 2)
    )
    return F.when(text.rlike(_COMPACT_SHAPE), dashed.try_cast("date"))


def parse_iso(text: Column) -> Column:
    """Date of a ``yyyy-MM-dd`` text (one-digit month and day allowed), else NULL."""
    return F.when(text.rlike(_ISO_SHAPE), text.try_cast("date"))


def parse_minute(text: Column) -> Column:
    """Timestamp of a ``yyyy-MM-ddTHH:mm`` text, NULL when it is not exactly that."""
    return F.when(text.rlike(_MINUTE_SHAPE), text.try_cast("timestamp_ntz"))


def compact(value: Column) -> Column:
    """``yyyyMMdd`` text of a date."""
    return F.date_format(value, COMPACT_DATE)


def epoch_date(millis: Column) -> Column:
    """UTC date of an epoch-millisecond value."""
    days = F.floor(millis / F.lit(_MILLIS_PER_DAY))
    return F.date_from_unix_date(days.try_cast("int"))


def month_end(value: Column, months: Column | int = 0) -> Column:
    """Last day of the month that lies ``months`` after ``value``."""
    return F.last_day(F.add_months(value, months))
