"""One entry point for every configured source."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from slicewright.schemas import declared_layout
from slicewright.sources import columnar, delimited, fixed_width, json_documents

# Fixed value: the delimiter code that marks a source that is not delimited text.
NOT_DELIMITED = "FIX"


@dataclass(frozen=True)
class SourceSpec:
    """Where a source lies and how it is laid out.

    ``layout`` is a schema (fixed-width when its fields carry lengths), a map of
    column types for a cast projection, or None.
    """

    path: str
    delimiter: str = ","
    layout: T.StructType | dict[str, str] | None = None
    epoch_named: bool = False
    data_dt: str | None = None
    json: bool = False

    @classmethod
    def from_config(
        cls, row: dict, root: str, single_file_volume: str, layouts=declared_layout, **rest
    ) -> SourceSpec:
        """Spec of one config row; any other volume is a folder of epoch-named files.

        ``layouts`` tells the declared layout of a file name.
        """
        single = row["src_volume_name"] == single_file_volume
        tail = row["src_file_name"] if single else row["src_volume_name"]
        return cls(
            path=f"{root.rstrip('/')}/{tail}",
            delimiter=row["src_delimeter"],
            layout=layouts(row["src_file_name"]) if single else None,
            epoch_named=not single,
            **rest,
        )


def _has_widths(layout) -> bool:
    return isinstance(layout, T.StructType) and all("length" in f.metadata for f in layout)


def read_source(spark: SparkSession, spec: SourceSpec) -> DataFrame:
    """Lazy DataFrame over the source that ``spec`` describes."""
    if spec.epoch_named:
        rows = columnar.read_epoch_files(spark, spec.path, spec.data_dt)
        return rows.drop("file_name", "file_dt")
    if spec.json:
        return json_documents.read_documents(spark, spec.path, spec.layout)
    if spec.delimiter != NOT_DELIMITED:
        if spec.layout is None:
            return delimited.read_trimmed(spark, spec.path, spec.delimiter)
        return delimited.read_typed(spark, spec.path, spec.layout, spec.delimiter)
    if _has_widths(spec.layout):
        return fixed_width.read_fixed_width(spark, spec.path, spec.layout)
    if spec.layout is None:
        return spark.read.parquet(spec.path)
    return columnar.read_cast(spark, spec.path, spec.layout)
