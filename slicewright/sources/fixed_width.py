"""Fixed-width text."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def cut(lines: DataFrame, schema: T.StructType, column: str = "value") -> DataFrame:
    """Cut each line at the lengths in the schema's field metadata; trim each piece."""
    widths = [int(field.metadata["length"]) for field in schema.fields]
    ends = list(accumulate(widths))
    return lines.select(
        *[
            F.trim(F.substring(column, end - width + 1, width)).alias(field.name)
            for field, width, end in zip(schema.fields, widths, ends)
        ]
    )


def read_fixed_width(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return cut(spark.read.text(path), schema)
