"""Tables whose changes appear in one step, and rewrite only the files they touch.

A table is a folder of immutable Parquet files, and for each version a list of the
files that belong to it, with the number of rows and the span of the ``spans`` columns
of each.  A version comes into being when its numbered file is created in ``_versions``,
which exactly one writer can do.  Until then the version before it is read, so a job
that breaks off leaves nothing but unlisted files; a writer that comes second
works its change out again from the newer version.

A change looks for the files it touches by the spans in the list, then by reading
the key columns of those that may be touched.  All other files are kept as
they are.  The list of files goes through the driver, as it does when
Spark lists a folder: one short row for each file.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slicewright.operators import mutations
from slicewright.operators.keys import latest_per_key
from slicewright.storage import create_new, names_in, read_text, save

#: How often a writer starts again that another one was faster than.
ATTEMPTS = 20
#: Files below this size are put together by ``compact``.
SMALL_BYTES = 64 << 20


class Conflict(RuntimeError):
    """Others were faster each time."""


class VersionedTable:
    """A table at ``path``; ``spans`` are the columns whose least and greatest values are kept for each file."""

    def __init__(self, spark: SparkSession, path: str, spans: Sequence[str] = ()):
        self.spark, self.path, self.spans = spark, path.rstrip("/"), list(spans)

    # --- reading

    def version(self) -> int:
        """Number of the newest version; 0 for a table never written."""
        numbers = [int(n) for n in names_in(self.spark, f"{self.path}/_versions") if n.isdigit()]
        return max(numbers, default=0)

    def files(self, version: int | None = None) -> DataFrame | None:
        """``file``, ``n_rows``, ``n_bytes`` and the spans of the files of a version; None for version 0."""
        number = self.version() if version is None else version
        if not number:
            return None
        return self.spark.read.parquet(f"{self.path}/_lists/{read_text(self.spark, self._pointer(number))}")

    def read(self, version: int | None = None, only: Column | None = None) -> DataFrame:
        """Rows of a version, the newest by default; ``only`` is a condition on the list of files."""
        listed = self.files(version)
        if listed is None:
            raise FileNotFoundError(f"no version of {self.path}")
        return self.rows_of(listed if only is None else listed.where(only))

    def rows_of(self, listed: DataFrame) -> DataFrame:
        """Rows of a list of files."""
        return self._rows(self._named(listed))

    def _rows(self, files: list[str]) -> DataFrame:
        schema = T.StructType.fromJson(json.loads(read_text(self.spark, f"{self.path}/_schema")))
        if not files:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*(f"{self.path}/{f}" for f in files))

    def _pointer(self, number: int) -> str:
        return f"{self.path}/_versions/{number:012d}"

    # --- writing

    def _write(self, rows: DataFrame) -> DataFrame:
        """Write rows as new files; the list of them, worked out from their footers and the span columns."""
        folder = f"{self.path}/data-{uuid.uuid4().hex}"
        create_new(self.spark, f"{self.path}/_schema", rows.schema.json())
        written = save(rows, folder).select(_own_name(), "_metadata.file_size", *self.spans)
        spans = [f(c).alias(f"{name}_{c}") for c in self.spans for f, name in ((F.min, "low"), (F.max, "high"))]
        return written.groupBy("file").agg(
            F.count("*").alias("n_rows"), F.max("file_size").alias("n_bytes"), *spans
        )

    def _commit(self, number: int, listed: DataFrame) -> bool:
        """Make ``listed`` version ``number``, unless there is one."""
        name = uuid.uuid4().hex
        listed.coalesce(1).write.parquet(f"{self.path}/_lists/{name}")  # a row for each file
        return create_new(self.spark, self._pointer(number), name)

    def change(self, work: Callable[[DataFrame | None], tuple[DataFrame | None, DataFrame | None]]) -> int:
        """Commit what ``work`` makes of the list of files: the list it keeps and the rows it adds.

        ``work`` is called again with the newer list when another writer was faster.
        Returns the number of the new version.
        """
        for _ in range(ATTEMPTS):
            number = self.version()
            kept, rows = work(self.files(number))
            parts = [x for x in (kept, None if rows is None else self._write(rows)) if x is not None]
            if not parts:
                return number
            listed = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
            if self._commit(number + 1, listed):
                return number + 1
        raise Conflict(f"{self.path}: {ATTEMPTS} times another writer was faster")

    def overwrite(self, rows: DataFrame) -> int:
        return self.change(lambda listed: (None, rows))

    def append(self, rows: DataFrame) -> int:
        return self.change(lambda listed: (listed, rows))

    def replace_slices(self, rows: DataFrame, slices: DataFrame) -> int:
        """Replace the slices that ``slices`` names (its one column, one of the spans) by ``rows``, in one step.

        A slice named without rows is emptied.  Files that only hold named slices are left out
        unread; those that also hold others are rewritten without the named ones.
        """
        (column,) = slices.columns
        days = slices.distinct()

        def work(listed):
            if listed is None:
                return None, rows
            # bounded by the calendar
            inside = listed.join(F.broadcast(days), F.col(column).between(F.col(f"low_{column}"), F.col(f"high_{column}")), "left_semi")
            touched = [r.file for r in inside.select("file").collect()]
            mixed = [r.file for r in inside.where(F.col(f"low_{column}") != F.col(f"high_{column}")).select("file").collect()]
            whole = [r.file for r in inside.where(f"low_{column} = high_{column}").select("file").collect()]
            # a file of one slice may also hold rows without any
            bare = self._rows(whole).where(F.col(column).isNull()) if whole else None
            new = rows
            if mixed:
                new = new.unionByName(self._rows(mixed).join(F.broadcast(days), column, "left_anti"))
            if bare is not None and not bare.isEmpty():
                new = new.unionByName(bare)
            return self._without(listed, touched), new

        return self.change(work)

    def update_matched(self, changes: DataFrame, keys: Sequence[str], assignments: Mapping[str, Column], when: Column | None = None) -> int:
        """``mutations.update_matched`` of the files that hold a changed key."""

        def work(listed):
            touched = self._touched(listed, changes, keys)
            if not touched:
                return None, None
            return self._without(listed, touched), mutations.update_matched(self._rows(touched), changes, keys, assignments, when)

        return self.change(work)

    def merge_upsert(self, source: DataFrame, keys: Sequence[str], *, update: Mapping[str, Column], insert: Mapping[str, Column]) -> int:
        """``mutations.merge_upsert`` of the files that hold a key of ``source``; other keys go to new files."""

        def work(listed):
            touched = self._touched(listed, source, keys)
            merged = mutations.merge_upsert(self._rows(touched), source, keys, update=update, insert=insert)
            return None if listed is None else self._without(listed, touched), merged

        return self.change(work)

    def compact(self, keys: Sequence[str] | None = None, order: Sequence[Column | str] = (), small: int = SMALL_BYTES) -> int:
        """Put small files together into few; with ``keys`` keep only the latest row of each, over all files."""

        def work(listed):
            if listed is None:
                return None, None
            if keys is not None:
                return None, latest_per_key(self._rows(self._named(listed)), keys, order).hint("rebalance")
            few = listed.where(F.col("n_bytes") < small)
            names = self._named(few)
            return (listed.where(F.col("n_bytes") >= small), self._rows(names).hint("rebalance")) if len(names) > 1 else (None, None)

        return self.change(work)

    def _named(self, listed: DataFrame) -> list[str]:
        return [r.file for r in listed.select("file").collect()]

    def _without(self, listed: DataFrame, files: list[str]) -> DataFrame:
        return listed.where(~F.col("file").isin(files)) if files else listed

    def _touched(self, listed: DataFrame | None, changed: DataFrame, keys: Sequence[str]) -> list[str]:
        """Files that hold a row with one of the keys.

        The span of the changed keys leaves out files by the list, and the rest are asked for
        their key columns alone.
        """
        if listed is None:
            return []
        spanned = [k for k in keys if k in self.spans]
        maybe = listed
        if spanned:
            ends = changed.agg(*[f(k).alias(f"{n}_{k}") for k in spanned for f, n in ((F.min, "low"), (F.max, "high"))]).first()
            for k in spanned:
                maybe = maybe.where((F.col(f"high_{k}") >= F.lit(ends[f"low_{k}"])) & (F.col(f"low_{k}") <= F.lit(ends[f"high_{k}"])))
        names = self._named(maybe)
        if not names:
            return []
        held = self._rows(names).select(*keys, _own_name())
        hit = held.join(changed.select(*keys).dropna().distinct(), list(keys), "left_semi")
        return self._named(hit.select("file").distinct())


def _own_name() -> Column:
    """Name of the file a row comes from, within its table."""
    return F.concat_ws("/", F.slice(F.split("_metadata.file_path", "/"), -2, 2)).alias("file")
