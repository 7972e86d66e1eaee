"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import gc
import shutil
import tempfile
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from slicewright.storage import new_folder, save

#: White space that separates words; everything else belongs to a word.
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"
#: Stands for a NULL doc_id where documents are compared by id: after every id.
NO_ID = 2**63 - 1
#: Text handled at once inside a Python task.
SLICE_BYTES = 2 << 20


_sent_to: dict[str, tempfile.TemporaryDirectory] = {}


def send_package(spark: SparkSession) -> None:
    """Let the Python workers of this session import the package, wherever they run.

    The driver serves the archive to every executor, and drops it when it ends.
    """
    context = spark.sparkContext
    if context.applicationId not in _sent_to:
        root = Path(__file__).resolve().parents[2]
        folder = tempfile.TemporaryDirectory(prefix="slicewright-")
        context.addPyFile(shutil.make_archive(f"{folder.name}/slicewright", "zip", root, "slicewright"))
        _sent_to[context.applicationId] = folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: Column) -> Column:
    """crc32 of the id written as text, modulo 5; the rows of a NULL id are in fold 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5, F.lit(0))


def saved(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read back: computed once, no lineage."""
    return save(df, new_folder(df.sparkSession, label))


def pieces_of(total: int, size: int) -> int:
    """How many pieces of about ``size`` make up ``total``, one at least."""
    return max(1, -(-int(total) // size))


def text_bytes(df: DataFrame, text: str) -> int:
    """Bytes of all texts together; one number, whatever the input."""
    return df.agg(F.sum(F.octet_length(text))).first()[0] or 0


_forgets: list[Callable[[], None]] = []
_stage: int | None = None


def lasts_a_stage(forget: Callable[[], None]) -> None:
    """Have ``forget`` called in a worker when its first task of another stage starts.

    Workers live on from stage to stage; what one stage remembers is of no use to the next.
    """
    _forgets.append(forget)


def _new_stage() -> None:
    global _stage
    context = TaskContext.get()
    if context is None or context.stageId() == _stage:
        return
    if _stage is not None:
        for forget in _forgets:
            forget()
        gc.collect()
        pa.default_memory_pool().release_unused()
    _stage = context.stageId()


def small_slices(batches: Iterable[pa.RecordBatch], text: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in record batches of about ``most`` bytes of text each.

    At the end what Arrow keeps for later batches goes back, as the worker lives on for other stages.
    """
    _new_stage()
    for batch in batches:
        sizes = pa.compute.binary_length(batch[text]).fill_null(0).to_numpy(zero_copy_only=False)
        start = held = 0
        for i, size in enumerate(sizes):
            if held and held + size > most:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += int(size)
        if start < batch.num_rows:
            yield batch.slice(start)
    pa.default_memory_pool().release_unused()
