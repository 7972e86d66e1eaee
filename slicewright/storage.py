"""Folders and tables on the storage that every executor can reach."""

from __future__ import annotations

import os
import shutil
import uuid
from collections.abc import Sequence
from urllib.parse import urlparse

from pyspark.sql import DataFrame, SparkSession

_root_of_local_sessions: list[str] = []


def use_root(path: str) -> None:
    """Folder for sessions that run in this process alone and name none themselves."""
    _root_of_local_sessions[:] = [path]


def shared_root(spark: SparkSession) -> str:
    """Shared folder named by the session's ``spark.checkpoint.dir``.

    A session without one is an error, since executors would not see each
    other's files; only for a plain local session may ``use_root`` name a folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    master = spark.conf.get("spark.master", "")
    local = master == "local" or master.startswith("local[")
    if not (local and _root_of_local_sessions):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return _root_of_local_sessions[0].rstrip("/")


def new_folder(spark: SparkSession, label: str) -> str:
    """A path under the shared root that no other write uses."""
    return f"{shared_root(spark)}/slicewright/{label}-{uuid.uuid4().hex}"


def save(df: DataFrame, path: str, *, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` to ``path`` and return a scan of what was written.

    The scan has exact file sizes, so later joins are planned on facts, and no
    lineage back to the inputs, so a lost executor never recomputes them.
    """
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession, path: str) -> None:
    """Empty a staging table that has been published, so it does not take up storage."""
    spark.createDataFrame([], "released boolean").write.mode("overwrite").parquet(path)


def create_new(spark: SparkSession, path: str, text: str) -> bool:
    """Create a file with ``text`` in one step; False, and nothing changed, where it exists.

    The file is written under another name and then linked or renamed to its own, which of several
    writers only one can do.  This needs a store whose rename does not replace, as HDFS.
    """
    spare = f"{path}.{uuid.uuid4().hex}.tmp"
    if (plain := _local(path)) is not None:
        os.makedirs(os.path.dirname(plain), exist_ok=True)
        other = _local(spare)
        with open(other, "x", encoding="utf-8") as f:
            f.write(text)
        try:
            os.link(other, plain)
        except FileExistsError:
            return False
        finally:
            os.unlink(other)
        return True
    hadoop, fs = _file_system(spark, path)
    out = fs.create(hadoop.Path(spare))
    out.write(bytearray(text, "utf-8"))
    out.close()
    if fs.rename(hadoop.Path(spare), hadoop.Path(path)):
        return True
    fs.delete(hadoop.Path(spare), False)
    return False


def names_in(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder; none where it does not exist."""
    if (plain := _local(folder)) is not None:
        return sorted(os.listdir(plain)) if os.path.isdir(plain) else []
    hadoop, fs = _file_system(spark, folder)
    where = hadoop.Path(folder)
    return sorted(f.getPath().getName() for f in fs.listStatus(where)) if fs.exists(where) else []


def sizes_in(spark: SparkSession, folder: str) -> dict[str, int]:
    """Names and sizes of the files in a folder that Spark wrote; hidden ones are left out."""
    if (plain := _local(folder)) is not None:
        found = [(e.name, e.stat().st_size) for e in os.scandir(plain) if e.is_file()]
    else:
        hadoop, fs = _file_system(spark, folder)
        found = [(f.getPath().getName(), f.getLen()) for f in fs.listStatus(hadoop.Path(folder)) if f.isFile()]
    return {name: size for name, size in sorted(found) if name[0] not in "._"}


def join_files(spark: SparkSession, parts: Sequence[str], target: str) -> None:
    """Put files together in this order as ``target``, which they replace in one step; the parts are used up.

    The store does it: HDFS concatenates by handing over the blocks, without moving a byte.  On a plain
    local path the bytes are copied.  A store that cannot concatenate refuses.
    """
    spare = f"{target}.{uuid.uuid4().hex}.tmp"
    if (plain := _local(target)) is not None:
        with open(_local(spare), "xb") as out:
            for part in parts:
                with open(_local(part), "rb") as f:
                    shutil.copyfileobj(f, out, 1 << 20)
        os.replace(_local(spare), plain)
        return
    hadoop, fs = _file_system(spark, target)
    first, *rest = (hadoop.Path(p) for p in parts)
    fs.rename(first, hadoop.Path(spare))
    if rest:
        fs.concat(hadoop.Path(spare), _java_array(spark, hadoop.Path, rest))
    replace = hadoop.Options.Rename.OVERWRITE
    context = hadoop.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    context.rename(hadoop.Path(spare), hadoop.Path(target), _java_array(spark, hadoop.Options.Rename, [replace]))


def remove_staging(spark: SparkSession, folder: str) -> None:
    """Remove a staging folder whose files have been published."""
    if (plain := _local(folder)) is not None:
        shutil.rmtree(plain)
        return
    hadoop, fs = _file_system(spark, folder)
    fs.delete(hadoop.Path(folder), True)


def read_text(spark: SparkSession, path: str) -> str:
    """A small file, whole."""
    if (plain := _local(path)) is not None:
        with open(plain, encoding="utf-8") as f:
            return f.read()
    return spark.read.text(path, wholetext=True).first()[0]


def _local(path: str) -> str | None:
    parts = urlparse(path)
    return parts.path if parts.scheme in ("", "file") else None


def _file_system(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs
    return hadoop, hadoop.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())


def _java_array(spark: SparkSession, kind, items: Sequence):
    out = spark.sparkContext._gateway.new_array(kind, len(items))
    for i, item in enumerate(items):
        out[i] = item
    return out
