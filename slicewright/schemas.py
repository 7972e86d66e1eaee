"""Schemas of the control tables and of the files whose layout is declared."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Clocks are UTC wall-clock values without a zone, so no result depends on the
# session time zone.
CLOCK = T.TimestampNTZType()


STRING, INT, LONG, DATE = T.StringType(), T.IntegerType(), T.LongType(), T.DateType()


# Columns of the control tables, in their order.
CONFIG = T.StructType(
    [
        T.StructField("proc_name", STRING, False),
        T.StructField("proc_type", STRING, False),
        T.StructField("is_active", INT, False),
        T.StructField("run_period", INT, False),
        T.StructField("data_back_day", INT, False),
        T.StructField("data_freq", STRING, False),
        T.StructField("notebook_path", STRING, False),
        T.StructField("script_path", STRING, True),
        T.StructField("src_system", STRING, True),
        T.StructField("src_file_name", STRING, True),
        T.StructField("src_delimeter", STRING, True),
        T.StructField("src_volume_name", STRING, True),
        T.StructField("trgt_tbl_name", STRING, True),
        T.StructField("created_by", STRING, False),
        T.StructField("created_dtm", CLOCK, False),
        T.StructField("updated_by", STRING, True),
        T.StructField("updated_dtm", CLOCK, True),
    ]
)
FILE_LOG = T.StructType(
    [
        T.StructField("proc_name", STRING, False),
        T.StructField("proc_run_id", STRING, False),
        T.StructField("proc_status", STRING, False),
        T.StructField("file_name", STRING, False),
        T.StructField("total_record", LONG, False),
        T.StructField("start_proc_dtm", CLOCK, False),
        T.StructField("end_proc_dtm", CLOCK, True),
        T.StructField("error_message", STRING, True),
    ]
)
STATUS = T.StructType(
    [
        T.StructField("proc_name", STRING, False),
        T.StructField("proc_run_id", STRING, False),
        T.StructField("proc_status", STRING, False),
        T.StructField("run_mode", STRING, False),
        T.StructField("running_dt", DATE, True),
        T.StructField("start_dt", DATE, True),
        T.StructField("end_dt", DATE, True),
        T.StructField("start_proc_dtm", CLOCK, True),
        T.StructField("end_proc_dtm", CLOCK, True),
        T.StructField("ins_proc_dtm", CLOCK, False),
        T.StructField("upd_proc_dtm", CLOCK, True),
    ]
)
RUN_LOG = T.StructType(
    [
        T.StructField("proc_name", STRING, False),
        T.StructField("proc_run_id", STRING, False),
        T.StructField("proc_status", STRING, False),
        T.StructField("run_mode", STRING, False),
        T.StructField("running_dt", DATE, True),
        T.StructField("start_dt", DATE, True),
        T.StructField("end_dt", DATE, True),
        T.StructField("start_proc_dtm", CLOCK, False),
        T.StructField("end_proc_dtm", CLOCK, True),
        T.StructField("error_message", STRING, True),
    ]
)
# Files loaded or sent.  A landed file is known by name, size and time of change.
LEDGER = T.StructType(
    [
        T.StructField("file_name", STRING, False),
        T.StructField("proc_name", STRING, False),
        T.StructField("proc_run_id", STRING, False),
        T.StructField("archive_path", STRING, False),
        T.StructField("processed_dtm", CLOCK, False),
        T.StructField("data_dt", DATE, True),
        T.StructField("n_bytes", LONG, True),
        T.StructField("modified_dtm", CLOCK, True),
    ]
)

# Who may run a process, until when.
LEASE = T.StructType(
    [
        T.StructField("proc_name", STRING, False),
        T.StructField("proc_run_id", STRING, False),
        T.StructField("taken_dtm", CLOCK, False),
        T.StructField("expires_dtm", CLOCK, False),
        T.StructField("released", T.BooleanType(), False),
    ]
)

# Keys of the control tables.  A run covers several dates, so the run log is
# keyed by date as well.
CONFIG_KEY = ["proc_name"]
STATUS_KEY = ["proc_name"]
FILE_LOG_KEY = ["proc_name", "proc_run_id", "file_name"]
RUN_LOG_KEY = ["proc_name", "proc_run_id", "running_dt"]

# Status, frequency and run-mode vocabulary.
RUNNING, SUCCESS, FAILED, PROCESSING = "Running", "Success", "Failed", "Processing"
DAILY, MONTHLY = "D", "M"
NORMAL, RERUN = "N", "R"

# One nested weather document.
FORECAST_DOCUMENT = T.StructType(
    [
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField(
            "hourly",
            T.StructType(
                [
                    T.StructField("time", T.ArrayType(STRING)),
                    T.StructField("temperature_2m", T.ArrayType(T.DoubleType())),
                ]
            ),
        ),
    ]
)

# Field names and lengths of the fixed-width rate reference file.
RATE_REFERENCE_WIDTHS = {
    "RATE_SHD_CODE": 8,
    "EFF_DT": 8,
    "TERM_CTF_DYS": 5,
    "MN_BAL_IN_TERM": 12,
    "RATE_ASSC_MN_BAL": 8,
    "BTCH_DT": 8,
    "SRC_STM_ID": 3,
    "FILLER": 22,
}

# Column types of the iris measurement file.
IRIS_TYPES = {
    "sepal.length": "decimal(10,1)",
    "sepal.width": "decimal(10,1)",
    "petal.length": "decimal(10,1)",
    "petal.width": "decimal(10,1)",
    "variety": "string",
}


def fixed_width_schema(widths: dict[str, int]) -> T.StructType:
    """String schema whose field metadata carries the slice length of each field."""
    return T.StructType(
        [T.StructField(name, T.StringType(), True, {"length": n}) for name, n in widths.items()]
    )


def declared_layout(file_name: str) -> T.StructType | dict[str, str] | None:
    """Declared layout of a known file: a fixed-width schema, column types, or None."""
    return {
        "RATEREF": fixed_width_schema(RATE_REFERENCE_WIDTHS),
        "iris.parquet": IRIS_TYPES,
    }.get(file_name)


def quoted(name: str) -> str:
    """Column name safe to use in an expression, also when it holds dots."""
    return "`" + name.replace("`", "``") + "`"


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select ``df`` into the column order and types of ``schema``.

    Columns absent from ``df`` become NULL; a missing column that the schema
    requires is an error, raised while the plan is built.
    """
    present = set(df.columns)
    missing = [f.name for f in schema.fields if not f.nullable and f.name not in present]
    if missing:
        raise ValueError(f"required columns missing: {', '.join(missing)}")

    def field(f: T.StructField) -> Column:
        source = F.col(quoted(f.name)) if f.name in present else F.lit(None)
        return source.cast(f.dataType).alias(f.name)

    return df.select(*[field(f) for f in schema.fields])
