"""Loading landed files into a sliced table, with the checks around it.

Every pending file of a process is loaded in one go.  The text is parsed once,
into a staging table; row counts come from the footers of that table, and only
files that pass their checks reach the target.  Logs are append-only: the
latest row of a file is its state, and a run that dies half-way leaves a
Processing row and an untouched or fully replaced slice, so it can be repeated.
"""

from __future__ import annotations

from contextlib import contextmanager
from dataclasses import dataclass, replace
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from slicewright.functions import dates, filenames, text
from slicewright.operators import ledger as ledgers
from slicewright.operators import reconciliation as checks
from slicewright.operators.keys import latest_per_key
from slicewright.operators.mutations import append, overwrite, write_slices
from slicewright.operators.projection import LINEAGE, with_lineage
from slicewright.schemas import (
    FAILED,
    FILE_LOG,
    FILE_LOG_KEY,
    LEDGER,
    PROCESSING,
    SUCCESS,
    conform,
    declared_layout,
)
from slicewright.sources import landing as landings
from slicewright.sources.columnar import read_landed
from slicewright.sources.delimited import trimming_reader
from slicewright.sources.dispatch import SourceSpec, read_source
from slicewright.storage import new_folder, release, save
from slicewright.versions import VersionedTable


@dataclass(frozen=True)
class Load:
    """Where one process reads from and writes to, and the run it does so for."""

    proc_name: str
    run_id: str
    as_of: Column
    landing: str
    target: str
    file_log: str
    ledger: str
    sep: str = ","
    layout: StructType | None = None
    #: Whether the target is a versioned table, in which a load appears whole or not at all.
    versioned: bool = False


def _table(spark: SparkSession, path: str, schema) -> DataFrame:
    """A control table; one that was never written is empty."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def file_state(spark: SparkSession, file_log: str) -> DataFrame:
    """Current log row of every file."""
    finished = F.col("end_proc_dtm").isNotNull()
    log = _table(spark, file_log, FILE_LOG)
    return latest_per_key(log, FILE_LOG_KEY, ["start_proc_dtm", finished])


def _open_run(spark: SparkSession, load: Load, expected: DataFrame, work: str) -> DataFrame:
    """Every expected file, what has landed of it, and whether its date is due.

    A date is due when any file of it has not been loaded as it is now. Then all
    its files are loaded, also those that the ledger holds, since the slice is
    replaced as a whole. The others have nothing to do and are not logged.
    """
    landed = landings.manifest(spark, load.landing)
    own = _table(spark, load.ledger, LEDGER).where(F.col("proc_name") == load.proc_name)
    files = landings.resolve(expected.select("file_name", "data_dt").distinct(), landed)
    known = ledgers.with_loaded(files, own)
    fresh = known.where(~F.col("loaded")).select(F.col("data_dt").alias("_d"), F.lit(True).alias("due"))
    pending = known.join(fresh.distinct(), F.col("data_dt").eqNullSafe(F.col("_d")), "left").drop("_d")
    pending = pending.withColumns(
        {"due": F.coalesce("due", F.lit(False)), "proc_status": F.lit(PROCESSING)}
    )
    pending = save(pending, f"{work}/pending")
    opened = pending.where("due")
    append(conform(_log_rows(load, opened, total=F.lit(0)), FILE_LOG), load.file_log)
    return pending


def _log_rows(load: Load, files: DataFrame, total: Column) -> DataFrame:
    return files.withColumns(
        {
            "proc_name": F.lit(load.proc_name),
            "proc_run_id": F.lit(load.run_id),
            "total_record": total,
            "start_proc_dtm": load.as_of,
        }
    )


@contextmanager
def _failure_logged(load: Load, pending: DataFrame):
    """Log the pending files as Failed when the load breaks off, and pass the error on."""
    try:
        yield
    except Exception as error:
        failed = pending.withColumns(
            {
                "proc_status": F.lit(FAILED),
                "end_proc_dtm": load.as_of,
                "error_message": text.clean_message(F.lit(str(error))),
            }
        )
        append(conform(_log_rows(load, failed, total=F.lit(0)), FILE_LOG), load.file_log)
        raise


def _due_rows(rows: DataFrame, pending: DataFrame) -> DataFrame:
    """Rows of the files to load.

    The span of their names prunes the listing; within it the join does, by
    dynamic pruning where a landed name is a folder, and it keeps exactly them.
    """
    landed = pending.where(F.col("due") & ~F.col("missing"))
    return rows.where(_span(landed)).join(landed.select("file_name").distinct(), "file_name", "left_semi")


def _span(files: DataFrame) -> Column:
    span = files.agg(F.min("file_name").alias("lo"), F.max("file_name").alias("hi")).first()
    return F.col("file_name").between(F.lit(span.lo), F.lit(span.hi))


def _close_run(spark: SparkSession, load: Load, verdicts: DataFrame) -> DataFrame:
    """Outcome rows in the log, loaded files in the ledger."""
    closed = verdicts.withColumns(
        {
            "proc_status": checks.outcome(F.col("check_status")),
            "end_proc_dtm": load.as_of,
            "error_message": F.col("message"),
        }
    )
    total = F.coalesce("data_cnt", F.lit(0))
    logged = closed.where(F.col("check_status") != checks.ALREADY_LOADED)
    append(conform(_log_rows(load, logged, total), FILE_LOG), load.file_log)
    kept = [c for c in ("n_bytes", "modified_dtm") if c in closed.columns]
    accepted = closed.where(F.col("check_status") == checks.OK).select("file_name", "data_dt", *kept)
    append(
        ledgers.entries(
            accepted,
            folder=load.landing,
            proc_name=F.lit(load.proc_name),
            run_id=F.lit(load.run_id),
            as_of=load.as_of,
        ),
        load.ledger,
    )
    return closed.select(
        "file_name", "data_dt", "data_cnt", "ctrl_cnt", "check_status", "proc_status", "message"
    )


def _hold_back(verdicts: DataFrame) -> DataFrame:
    """A slice is published when all its files are accepted; else none of them is."""
    refused = verdicts.where(~F.col("check_status").isin(checks.OK, checks.ALREADY_LOADED))
    dates_held = refused.select(F.col("data_dt").alias("_d"), F.lit(True).alias("_held")).distinct()
    held = F.col("_held").isNotNull() & (F.col("check_status") == checks.OK)
    return (
        verdicts.join(dates_held, F.col("data_dt").eqNullSafe(F.col("_d")), "left")
        .withColumn("message", F.when(held, "another file of the date was refused").otherwise(F.col("message")))
        .withColumn("check_status", F.when(held, checks.SLICE_INCOMPLETE).otherwise(F.col("check_status")))
        .drop("_d", "_held")
    )


def _publish(rows: DataFrame, verdicts: DataFrame, load: Load) -> None:
    """Replace the target slices of the accepted files.  Staging is already sliced: no shuffle."""
    accepted = verdicts.where(F.col("check_status") == checks.OK)
    slices = accepted.select("file_name", F.col("data_dt").alias("_slice")).distinct()
    stamped = with_lineage(rows.join(slices, "file_name"), F.col("_slice"), load.run_id, load.as_of)
    stamped = stamped.drop("file_name", "_slice")
    if load.versioned:
        days = accepted.select(F.col("data_dt").alias("DATA_DT")).distinct()
        VersionedTable(rows.sparkSession, load.target, ["DATA_DT"]).replace_slices(stamped, days)
        return
    write_slices(stamped, load.target)
    # A slice announced and delivered empty has no rows to overwrite the old ones with.
    sizes = accepted.groupBy("data_dt").agg(F.sum("data_cnt").alias("n"))
    clear_slices(stamped, load.target, [r.data_dt for r in sizes.where(F.col("n") == 0).collect()])


def clear_slices(like: DataFrame, target: str, days: list[date], column: str = "DATA_DT") -> None:
    """Empty slices of a table partitioned by date.

    One file without rows, with the columns of ``like``, is written once and
    stands in every emptied slice, so the table can be read when all are empty.
    A calendar bounds their number; beyond that file no job is run.
    """
    if not days:
        return
    spark = like.sparkSession
    none = new_folder(spark, "no-rows")
    like.drop(column).limit(0).write.parquet(none)
    fs = spark._jvm.org.apache.hadoop.fs
    conf = spark._jsc.hadoopConfiguration()
    source = fs.Path(f"{none}/part-*.parquet")
    files = [f.getPath() for f in source.getFileSystem(conf).globStatus(source)]
    for day in days:
        folder = fs.Path(f"{target}/{column}={day.isoformat()}")
        there = folder.getFileSystem(conf)
        there.delete(folder, True)
        there.mkdirs(folder)
        for file in files:
            fs.FileUtil.copy(file.getFileSystem(conf), file, there, fs.Path(folder, file.getName()), False, conf)


def load_files(
    spark: SparkSession, load: Load, expected: DataFrame, controls: DataFrame
) -> DataFrame:
    """Load delimited files checked against their control rows; one verdict per file.

    ``expected`` holds (file_name, data_dt), ``controls`` (file_name, ctrl_dt, ctrl_cnt).
    """
    work = new_folder(spark, "load")
    pending = _open_run(spark, load, expected, work)
    with _failure_logged(load, pending.where("due")):
        staged = _stage_text(spark, load, pending, f"{work}/staged")
        found = _check_files(pending, staged, controls)
        verdicts = save(_hold_back(found), f"{work}/verdicts")
        if staged is not None:
            _publish(staged.rows, verdicts, load)
            release(spark, f"{work}/staged")
        closed = _close_run(spark, load, verdicts)
    release(spark, f"{work}/pending")
    return closed


@dataclass(frozen=True)
class Staged:
    """Text files parsed once: their rows, and for each file its row count and whether its header fits."""

    rows: DataFrame
    files: DataFrame


def _feed_columns(spark: SparkSession, load: Load, present: DataFrame) -> list[str]:
    """Columns of the feed: of its declared layout, else of the table it has been loaded into.

    A feed with neither has the header that most of its first files have; of equally
    frequent ones, that of the first file.  Only then their text is read once more.
    """
    if load.layout is not None:
        return load.layout.names
    known = _target_columns(spark, load)
    if known:
        return known
    lines = read_landed(spark.read, "text", load.landing).withColumns(
        {"_path": F.col("_metadata.file_path"), "_start": F.col("_metadata.file_block_start")}
    )
    lines = lines.where(_span(present)).where("_start = 0").withColumn("_line", F.monotonically_increasing_id())
    lines = lines.join(present.select("file_name").distinct(), "file_name", "left_semi")
    heads = lines.groupBy("_path", "file_name").agg(F.min_by("value", "_line").alias("head"))
    heads = heads.groupBy("head").agg(F.count("*").alias("n"), F.min(F.struct("file_name", "_path")).alias("first"))
    best = heads.orderBy(F.col("n").desc(), "first").select("first._path").first()
    return trimming_reader(spark, load.sep).csv(best._path).columns if best else []


def _target_columns(spark: SparkSession, load: Load) -> list[str]:
    """Columns of a loaded table without the lineage that loading adds; none where there is no table."""
    if load.versioned:
        table = VersionedTable(spark, load.target, ["DATA_DT"])
        columns = table.read().columns if table.version() else []
    else:
        try:
            columns = spark.read.parquet(load.target).columns
        except AnalysisException as missing:
            if missing.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
            columns = []
    return [c for c in columns if c not in LINEAGE]


def due_lines(spark: SparkSession, load: Load, pending: DataFrame, names: list[str]) -> DataFrame:
    """Lines of the due files, cut into cells, and whether a line is like the header of ``names``.

    Everything about a line is worked out from itself, so the filter on the file names
    reaches the scan, and only due files are opened.
    """
    # one column more than the feed has shows lines that are too long
    cells = [f"_c{i}" for i in range(len(names) + 1)]
    trim = load.layout is None
    reader = spark.read.schema(", ".join(f"{c} string" for c in cells)).options(
        sep=load.sep, header=False, ignoreLeadingWhiteSpace=trim, ignoreTrailingWhiteSpace=trim
    )
    wanted = [F.trim(c).eqNullSafe(F.lit(n)) for c, n in zip(cells, names)]
    like_head = F.col(cells[-1]).isNull() & (F.col("_metadata.file_block_start") == 0)
    for same in wanted:
        like_head = like_head & same
    lines = read_landed(reader, "csv", load.landing)
    marked = lines.withColumns({"_path": F.col("_metadata.file_path"), "_head": like_head})
    return _due_rows(marked, pending)


def _stage_text(spark: SparkSession, load: Load, pending: DataFrame, path: str) -> Staged | None:
    """Parse the due files, every one under its own header; None when there is nothing to parse.

    A file fits the feed when each of its parts has the feed's header in its first block.
    Where lines like the header repeat there, one is the header and the others are rows.
    """
    present = pending.where(F.col("due") & ~F.col("missing") & F.col("path").isNotNull())
    if present.isEmpty():
        return None
    names = _feed_columns(spark, load, present)
    cells = [f"_c{i}" for i in range(len(names) + 1)]
    staged = save(due_lines(spark, load, pending, names), path, partition_by=["file_name"])
    parts = staged.groupBy("file_name", "_path").agg(
        F.count("*").alias("n"), F.count_if("_head").alias("n_heads"), F.min(F.when(F.col("_head"), F.array(*cells))).alias("_cells")
    )
    parts = save(parts, f"{path}_parts")
    # a part without its header still has a first line that is no row
    files = parts.groupBy("file_name").agg(
        (F.sum("n") - F.count("*")).alias("data_cnt"), F.bool_and(F.col("n_heads") > 0).alias("fits")
    )
    again = parts.where("n_heads > 1").select("file_name", "_cells", F.explode(F.sequence(F.lit(2), F.col("n_heads").cast("int"))))
    rows = staged.where(~F.col("_head")).select("file_name", *cells)
    rows = rows.unionByName(again.select("file_name", *(F.col("_cells")[i].alias(c) for i, c in enumerate(cells))))
    kinds = [f.dataType for f in load.layout] if load.layout is not None else ["string"] * len(names)
    typed = [F.col(c).try_cast(k).alias(n) for c, n, k in zip(cells, names, kinds)]
    return Staged(rows.select(*typed, "file_name"), files)


def _check_files(pending: DataFrame, staged: Staged | None, controls: DataFrame) -> DataFrame:
    """Verdict per expected file: present, laid out as the feed, announced, on its date, and complete.

    Control rows that say the same count once; a file with different ones is refused.
    """
    run_dt, ctrl_dt = dates.compact(F.col("data_dt")), F.col("ctrl_dt")
    ctrl = F.col("ctrl_cnt")
    one = controls.distinct().groupBy("file_name").agg(
        F.count("*").alias("_n_ctrl"), F.min("ctrl_dt").alias("ctrl_dt"), F.min("ctrl_cnt").alias("ctrl_cnt")
    )
    files = pending.withColumns({"data_cnt": F.lit(None).cast("long"), "fits": F.lit(None).cast("boolean")})
    if staged is not None:
        files = pending.join(staged.files, "file_name", "left")
    data = F.coalesce("data_cnt", F.lit(0))
    status = (
        F.when(~F.col("due"), checks.ALREADY_LOADED)
        .when(F.col("missing"), checks.NO_DATA)
        .when(~F.col("fits"), checks.HEADER_MISMATCH)
        .when(ctrl.isNull(), checks.NO_CONTROL)
        .when(F.col("_n_ctrl") > 1, checks.CONTROL_AMBIGUOUS)
        .when(checks.date_differs(run_dt, ctrl_dt), checks.DATE_MISMATCH)
        .when(data != ctrl, checks.COUNT_MISMATCH)
        .otherwise(checks.OK)
    )
    message = (
        F.when(F.col("check_status") == checks.NO_DATA, "data file not found")
        .when(F.col("check_status") == checks.HEADER_MISMATCH, "header is not that of the feed")
        .when(F.col("check_status") == checks.NO_CONTROL, "control row not found")
        .when(F.col("check_status") == checks.CONTROL_AMBIGUOUS, "control rows differ")
        .when(F.col("check_status") == checks.DATE_MISMATCH, checks.date_message(run_dt, ctrl_dt))
        .when(F.col("check_status") == checks.COUNT_MISMATCH, checks.count_message(data, ctrl))
    )
    return (
        files.join(one, "file_name", "left")
        .withColumn("data_cnt", F.when(F.col("due") & ~F.col("missing"), data))
        .withColumn("check_status", status)
        .withColumn("message", message)
        .drop("_n_ctrl", "fits")
    )


def load_epoch_files(spark: SparkSession, load: Load, run_dates: DataFrame) -> DataFrame:
    """Load epoch-named Parquet files of the run dates; no control file, one verdict per file.

    A run date (``data_dt``) without a file is reported under the landing folder's name.
    """
    work = new_folder(spark, "load")
    landed = landings.manifest(spark, load.landing)
    dated = landed.select(
        "file_name", filenames.epoch_file_date(F.col("file_name")).alias("file_dt")
    )
    expected = run_dates.join(dated, run_dates["data_dt"] == dated["file_dt"], "left").select(
        F.coalesce("file_name", F.concat(F.lit("no file for "), F.col("data_dt").cast("string")))
        .alias("file_name"),
        "data_dt",
    )
    pending = _open_run(spark, load, expected, work)
    present = pending.where(F.col("due") & ~F.col("missing"))
    with _failure_logged(load, pending.where("due")):
        found, staged = pending.withColumn("data_cnt", F.lit(None).cast("long")), None
        if not present.isEmpty():
            source = read_landed(spark.read.option("mergeSchema", "true"), "parquet", load.landing)
            staged = save(_due_rows(source, pending), f"{work}/staged", partition_by=["file_name"])
            found = pending.join(checks.count_slices(staged, "file_name", "file_name"), "file_name", "left")
        n_rows = F.when(F.col("due") & ~F.col("missing"), F.coalesce("data_cnt", F.lit(0)))
        status = F.when(~F.col("due"), checks.ALREADY_LOADED).when(F.col("missing"), checks.NO_DATA)
        verdicts = found.withColumns(
            {
                "data_cnt": n_rows,
                "ctrl_cnt": F.lit(None).cast("bigint"),
                "check_status": status.otherwise(checks.OK),
                "message": F.when(F.col("due") & F.col("missing"), "no files found for the date"),
            }
        )
        verdicts = save(verdicts, f"{work}/verdicts")
        if staged is not None:
            _publish(staged, verdicts, load)
            release(spark, f"{work}/staged")
        closed = _close_run(spark, load, verdicts)
    release(spark, f"{work}/pending")
    return closed


def load_source(
    spark: SparkSession,
    load: Load,
    spec: SourceSpec,
    *,
    file_name: str,
    data_dt: date,
    controls: DataFrame,
    slice_column: str | None = "DATA_DT",
) -> DataFrame:
    """Load one configured source for one date; returns its verdict as a row.

    ``DATA_DT`` stamps lineage columns and replaces that date's slice.  Another
    column is a business date of the rows themselves: the table is partitioned
    by it, and every row must lie on the run date.  None replaces the table.
    The source is read once: staging it also counts it.
    """
    work = new_folder(spark, "load")
    opened = spark.createDataFrame([(file_name, data_dt, PROCESSING)], _OPENED)
    append(conform(_log_rows(load, opened, total=F.lit(0)), FILE_LOG), load.file_log)
    control = controls.where(F.col("file_name") == file_name).select("ctrl_dt", "ctrl_cnt").first()
    business = slice_column not in (None, "DATA_DT")
    n_inside = F.count("*")
    if business:
        n_inside = F.count_if(F.col(slice_column).try_cast("date") == F.lit(data_dt))
    staged, seen = None, {"n_rows": None, "n_inside": None}
    with _failure_logged(load, opened):
        try:
            rows = read_source(spark, spec)
            staged, seen = save_counted(rows, f"{work}/staged", n_inside=n_inside)
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
        verdict = _judge(seen, control, f"{data_dt:%Y%m%d}")
        if verdict[0] == checks.OK:
            if slice_column is None:
                overwrite(staged, load.target)
            elif business:
                dated = staged.withColumn(slice_column, F.lit(data_dt))
                inside = F.col(slice_column) == F.lit(data_dt)
                write_slices(dated, load.target, slice_column, slices=inside)
                if seen["n_rows"] == 0:
                    clear_slices(dated, load.target, [data_dt], slice_column)
            else:
                stamped = with_lineage(staged, F.lit(data_dt), load.run_id, load.as_of)
                write_slices(stamped, load.target)
                if seen["n_rows"] == 0:
                    clear_slices(stamped, load.target, [data_dt])
        if staged is not None:
            release(spark, f"{work}/staged")
        closed = spark.createDataFrame(
            [(file_name, data_dt, seen["n_rows"], control and control.ctrl_cnt, *verdict)], _CLOSED
        )
        return _close_run(spark, load, closed)


def load_configured(
    spark: SparkSession,
    load: Load,
    row: dict,
    *,
    root: str,
    single_file_volume: str,
    run_dates: DataFrame,
    controls: DataFrame,
    layouts=declared_layout,
    slice_column: str | None = "DATA_DT",
) -> DataFrame:
    """Load the source that a config row names, for its run dates; returns the verdicts.

    A single file has one run date and is checked against its control row; a
    folder of epoch-named files has no control file and takes any number of dates.
    """
    spec = SourceSpec.from_config(row, root, single_file_volume, layouts=layouts)
    if spec.epoch_named:
        return load_epoch_files(spark, replace(load, landing=spec.path), run_dates)
    days = [r.data_dt for r in run_dates.select("data_dt").distinct().limit(2).collect()]
    if len(days) != 1:
        raise ValueError("a single file is loaded for one run date")
    return load_source(
        spark, load, spec, file_name=row["src_file_name"], data_dt=days[0], controls=controls, slice_column=slice_column
    )


_OPENED = "file_name string, data_dt date, proc_status string"
_CLOSED = (
    "file_name string, data_dt date, data_cnt bigint, ctrl_cnt bigint, check_status string, "
    "message string"
)


def _judge(seen: dict, control, run_dt: str) -> tuple[str, str | None]:
    """Check result of one source, in the order in which a load is checked."""
    n = seen["n_rows"]
    if n is None:
        return checks.NO_DATA, "data file not found"
    if control is None or control.ctrl_cnt is None:
        return checks.NO_CONTROL, "control row not found"
    if control.ctrl_dt != run_dt:
        return checks.DATE_MISMATCH, f"run date {run_dt}, control date {control.ctrl_dt}"
    if n != control.ctrl_cnt:
        return checks.COUNT_MISMATCH, f"rows loaded {n}, rows announced {control.ctrl_cnt}"
    if seen["n_inside"] != n:
        return checks.STRAY_ROWS, f"{n - seen['n_inside']} rows lie outside the slice {run_dt}"
    return checks.OK, None


def save_counted(df: DataFrame, path: str, **metrics: Column) -> tuple[DataFrame, dict]:
    """Write ``df`` and learn its row count, and any other metrics, from the same pass."""
    seen = Observation()
    counts = [F.count("*").alias("n_rows"), *[m.alias(name) for name, m in metrics.items()]]
    return save(df.observe(seen, *counts), path), seen.get
