"""Nested JSON, by a declared schema or as variants where fields drift."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slicewright.schemas import FORECAST_DOCUMENT


def read_documents(
    spark: SparkSession, path: str, schema: T.StructType | None = None
) -> DataFrame:
    """JSON files that each hold one document, or one array of documents, over many lines.

    A declared schema saves the extra pass that inference makes over the files.
    """
    return spark.read.json(path, schema=schema, multiLine=True)


def parse_payload(payload: Column, schema: T.StructType = FORECAST_DOCUMENT) -> Column:
    """Document in a text column, as a struct; NULL fields where the text is malformed."""
    return F.from_json(payload, schema)


def as_variant(payload: Column) -> Column:
    """Document in a text column whatever its fields; NULL where the text is malformed."""
    return F.try_parse_json(payload)


def drifting(document: Column, paths: Sequence[str], kind: str) -> Column:
    """The first of ``paths`` in a variant that holds a value of ``kind`` or can be cast to one, else NULL."""
    return F.coalesce(*(F.try_variant_get(document, path, kind) for path in paths))


def variant_fields(df: DataFrame, document: str) -> DataFrame:
    """``field``, ``kind`` and ``n_rows``: the top-level fields of the variants in a column, for each type they occur with.

    Counts add up in each task before the shuffle, so what travels grows with the kinds of fields only.
    Documents that are no objects, or NULL, have no fields.
    """
    entries = df.select(document).lateralJoin(df.sparkSession.tvf.variant_explode(F.col(document).outer()))
    kinds = entries.select(F.col("key").alias("field"), F.schema_of_variant("value").alias("kind"))
    return kinds.where("field IS NOT NULL").groupBy("field", "kind").agg(F.count("*").alias("n_rows"))
