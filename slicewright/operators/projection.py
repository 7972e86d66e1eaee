"""Projections: casts, lineage columns, nested documents to rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slicewright.functions import dates

# Type and unit of flattened forecast values.
FORECAST_NUMBER = "decimal(12,2)"
FORECAST_UNIT = "Celsius"

#: Columns that ``with_lineage`` adds.
LINEAGE = ("DATA_DT", "PROC_RUN_ID", "INS_PROC_DTM")


def with_lineage(df: DataFrame, data_dt: Column, run_id: str | Column, as_of) -> DataFrame:
    """Stamp rows with their business date, the run that loaded them and the load time."""
    run = run_id if isinstance(run_id, Column) else F.lit(run_id)
    return df.withColumns(
        {"DATA_DT": data_dt, "PROC_RUN_ID": run, "INS_PROC_DTM": dates.clock(as_of)}
    )


def with_parameters(df: DataFrame, values: dict[str, object]) -> DataFrame:
    """Give every row the same parameter values; literals, so no join is planned."""
    return df.withColumns({name: F.lit(value) for name, value in values.items()})


def zip_readings(documents: DataFrame, *, keep_empty: bool = False) -> DataFrame:
    """One row per reading, pairing the two parallel arrays of each document.

    The shorter array is padded with NULL.  Documents without readings vanish
    unless ``keep_empty``.  Each row keeps its own document's coordinates.
    """
    unnest = F.explode_outer if keep_empty else F.explode
    others = [c for c in documents.columns if c != "hourly"]
    return documents.select(
        *others, unnest(F.arrays_zip("hourly.time", "hourly.temperature_2m")).alias("reading")
    )


def flatten_forecast(
    documents: DataFrame, *, unit: str = FORECAST_UNIT, keep: tuple[str, ...] = ()
) -> DataFrame:
    """Weather documents to typed forecast rows."""
    moment = F.col("reading.time")
    return zip_readings(documents).select(
        *keep,
        F.col("latitude").try_cast(FORECAST_NUMBER).alias("LATITUDE"),
        F.col("longitude").try_cast(FORECAST_NUMBER).alias("LONGITUDE"),
        dates.parse_iso(F.substring(moment, 1, 10)).alias("FORECAST_DATE"),
        dates.parse_minute(moment).alias("FORECAST_TIME"),
        F.col("reading.temperature_2m").try_cast(FORECAST_NUMBER).alias("FORECAST_TEMP"),
        F.lit(unit).alias("FORECAST_TEMP_UNIT"),
    )
