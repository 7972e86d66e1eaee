"""Outgoing feeds."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slicewright.operators.reconciliation import DIGEST, digest
from slicewright.storage import join_files, remove_staging, sizes_in

# The feed is comma-separated with a header.
FEED_SEPARATOR = ","

# Full precision, and text kept exactly as it is.
_EXACT = {
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
}
_JSON_EXACT = {
    "timestampNTZFormat": _EXACT["timestampNTZFormat"],
    "timestampFormat": _EXACT["timestampFormat"],
}
PART_ROWS = 5_000_000
KEY_GROUPS = 65_536


class ContentError(RuntimeError):
    """What was written does not read back as it was."""


def _proved(df: DataFrame, write: Callable[[DataFrame], None], read: Callable[[], DataFrame]) -> None:
    """Write, taking the digest of the rows on their way out, and compare it with that of what is read back."""
    seen = Observation()
    write(df.observe(seen, *digest(df.schema, blank_is_null=True)))
    back = read()
    found = back.agg(*digest(back.schema, blank_is_null=True)).first()
    if any(found[c] != seen.get[c] for c in DIGEST):
        raise ContentError(f"written {seen.get}, read back {found.asDict()}")


def write_delimited(
    df: DataFrame,
    path: str,
    *,
    sep: str = FEED_SEPARATOR,
    part_rows: int = PART_ROWS,
    verify: bool = False,
) -> None:
    """Headed delimited export of the whole table, in parts of at most ``part_rows`` rows.

    ``verify`` reads the parts back and fails with ``ContentError`` where they hold other rows.
    """

    def write(rows: DataFrame) -> None:
        (
            rows.write.mode("overwrite")
            .options(**_EXACT)
            .option("maxRecordsPerFile", part_rows)
            .csv(path, sep=sep, header=True)
        )

    if verify:
        _proved(df, write, lambda: read_delimited(df.sparkSession, path, df.schema, sep))
    else:
        write(df)


def write_feed(df: DataFrame, path: str, *, sep: str = FEED_SEPARATOR, verify: bool = False) -> None:
    """One headed delimited file of the whole table.

    All tasks write parts, without a header, into a folder beside it, which the store then puts together
    behind one of the header alone, in the order of the partitions (so a sorted table gives a sorted
    feed).  The file appears in one step and replaces an earlier one.  ``verify`` reads the parts back
    before that, each in a task, and leaves the earlier file where they hold other rows.  A table without rows
    gives a header.
    """
    spark, (folder, name) = df.sparkSession, path.rsplit("/", 1)
    staged = f"{folder}/_{name}-{uuid.uuid4().hex}"
    rows, head = f"{staged}/rows", f"{staged}/head"

    def write(body: DataFrame) -> None:
        body.write.options(**_EXACT).csv(rows, sep=sep, header=False)

    try:
        if verify:
            _proved(df, write, lambda: _read(spark, rows, df.schema, sep, header=False, line_breaks=True))
        else:
            write(df)
        spark.createDataFrame([], df.schema).coalesce(1).write.options(**_EXACT).csv(head, sep=sep, header=True)
        parts = [f"{head}/{part}" for part in sizes_in(spark, head)]
        sizes = sizes_in(spark, rows)
        parts += [f"{rows}/{part}" for part in sorted(sizes, key=_part_number) if sizes[part]]
        join_files(spark, parts, path)
    finally:
        remove_staging(spark, staged)


def _part_number(name: str) -> tuple[int, str]:
    """Spark numbers its part files with five digits, or more where it needs them."""
    return int(name.split("-")[1]), name


def _read(spark, path: str, schema: T.StructType, sep: str, *, header: bool, line_breaks: bool) -> DataFrame:
    return (
        spark.read.options(**_EXACT)
        .option("multiLine", line_breaks)
        .csv(path, schema=schema, sep=sep, header=header)
    )


def read_delimited(
    spark, path: str, schema: T.StructType, sep: str = FEED_SEPARATOR, *, line_breaks: bool = True
) -> DataFrame:
    """Read an export back.

    Fields may hold line breaks, so a part is read by one task; without ``line_breaks`` large files are split.
    """
    return _read(spark, path, schema, sep, header=True, line_breaks=line_breaks)


def _row_key(key: Column, group: Column) -> Column:
    """Key of one group of rows, derived from the feed's key."""
    return F.unhex(F.sha2(F.concat(key, group.cast("binary")), 256))


def protect(df: DataFrame, key: Column) -> DataFrame:
    """Each row as one line of encrypted text: key group, colon, AES-GCM code.

    Random nonces are safe for about four billion uses of a key, fewer than a
    large feed has rows, so rows are spread evenly over derived keys.
    """
    body = F.to_json(F.struct(*df.columns), _JSON_EXACT)
    group = F.pmod(F.monotonically_increasing_id(), F.lit(KEY_GROUPS)).cast("string")
    rows = df.select(body.cast("binary").alias("body"), group.alias("key_group"))
    coded = F.base64(F.aes_encrypt("body", _row_key(key, F.col("key_group"))))
    one_line = F.translate(coded, "\r\n", "")
    return rows.select(F.concat("key_group", F.lit(":"), one_line).alias("value"))


def unprotect(lines: DataFrame, key: Column, schema: T.StructType) -> DataFrame:
    """Rows of a protected feed; a line that was tampered with fails the job."""
    group, code = (F.split_part(F.col("value"), F.lit(":"), F.lit(i)) for i in (1, 2))
    body = F.aes_decrypt(F.unbase64(code), _row_key(key, group)).cast("string")
    return lines.select(F.from_json(body, schema, _JSON_EXACT).alias("row")).select("row.*")
