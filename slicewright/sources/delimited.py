"""Delimited text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slicewright.sources.columnar import read_landed
from slicewright.storage import new_folder, save

#: Verdicts on the rows of a file.
ROWS_ACCEPTED, ROWS_REJECTED = "OK", "ROWS_REJECTED"


def trimming_reader(spark: SparkSession, sep: str = ",") -> DataFrameReader:
    """Reader of headed text without a declared schema: strings, outer blanks removed."""
    return spark.read.options(
        sep=sep, header=True, ignoreLeadingWhiteSpace=True, ignoreTrailingWhiteSpace=True
    )


def read_trimmed(spark: SparkSession, path: str | list[str], sep: str = ",") -> DataFrame:
    """Headed text without a declared schema."""
    return trimming_reader(spark, sep).csv(path)


def read_typed(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType,
    sep: str = ",",
    header: bool = True,
) -> DataFrame:
    """Text with a declared schema, untrimmed.

    A field that is missing or cannot be read as its type is NULL; the row
    stays, so row counts always match the file.
    """
    return spark.read.csv(path, schema=schema, sep=sep, header=header, mode="PERMISSIVE")


def read_checked(spark: SparkSession, path: str, schema: T.StructType, sep: str = ",", header: bool = True) -> DataFrame:
    """Text with a declared schema, every line with what is wrong with it.

    Adds ``file_name``, ``line`` (the whole line, of bad lines only) and ``reason`` (NULL for a good line): another
    number of fields than declared, the fields that cannot be read as their type, or those that are empty but required.
    The lines are read once and stored, so accepted and rejected rows come from the same pass.
    """
    names = schema.names
    text_schema = T.StructType([T.StructField(f"_c{i}", T.StringType()) for i in range(len(names))] + [T.StructField("_line", T.StringType())])
    reader = spark.read.schema(text_schema).options(sep=sep, header=header, mode="PERMISSIVE", columnNameOfCorruptRecord="_line")
    lines = save(read_landed(reader, "csv", path), new_folder(spark, "checked"))
    cells = [F.col(f"_c{i}") for i in range(len(names))]
    typed = [c.try_cast(f.dataType) for c, f in zip(cells, schema)]
    unread = _listed((c.isNotNull() & t.isNull(), n) for c, t, n in zip(cells, typed, names))
    lacking = _listed((c.isNull() & F.lit(not f.nullable), f.name) for c, f in zip(cells, schema))
    reason = (
        F.when(F.col("_line").isNotNull(), F.lit("number of fields"))
        .when(unread != "", F.concat(F.lit("not of its type: "), unread))
        .when(lacking != "", F.concat(F.lit("required: "), lacking))
    )
    whole = F.coalesce("_line", F.concat_ws(sep, *(F.coalesce(c, F.lit("")) for c in cells)))
    marked = lines.select(*(t.alias(n) for t, n in zip(typed, names)), "file_name", whole.alias("line"), reason.alias("reason"))
    return marked.withColumn("line", F.when(F.col("reason").isNotNull(), F.col("line")))


def _listed(named) -> Column:
    return F.concat_ws(", ", *(F.when(holds, F.lit(name)) for holds, name in named))


def rejected(checked: DataFrame) -> DataFrame:
    """``file_name``, ``line`` and ``reason`` of the bad lines, to be kept as a table."""
    return checked.where(F.col("reason").isNotNull()).select("file_name", "line", "reason")


def accepted(checked: DataFrame) -> DataFrame:
    """The good lines, typed, with their ``file_name``."""
    return checked.where(F.col("reason").isNull()).drop("line", "reason")


def reject_verdicts(checked: DataFrame, most: float = 0.0) -> DataFrame:
    """``file_name``, ``n_rows``, ``n_rejected`` and ``row_status`` of every file with rows.

    A file is refused when more than the share ``most`` of its rows is bad.
    """
    counts = checked.groupBy("file_name").agg(F.count("*").alias("n_rows"), F.count("reason").alias("n_rejected"))
    over = F.col("n_rejected") > F.lit(most) * F.col("n_rows")
    return counts.withColumn("row_status", F.when(over, ROWS_REJECTED).otherwise(ROWS_ACCEPTED))
