import calendar
import itertools
from collections import Counter
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from slicewright import schemas
from slicewright.functions import dates
from slicewright.plans import progress, requests, steps, windows

REQUEST = "proc_name string, proc_run_id string, run_mode string, start_dt string, end_dt string"
AS_OF = datetime(2024, 3, 31, 20, 0)  # 1 April in the business zone
TODAY = date(2024, 4, 1)


def request(mode=None, start=None, end=None, name="p"):
    return (name, "r", mode, start, end)


def test_request_rules(spark):
    cases = [
        (request(), None),
        (request(""), None),
        (request("N"), None),
        (request("R"), "a re-run needs both a start and an end date"),
        (request("R", "2024-01-01"), "a re-run needs both a start and an end date"),
        (request("R", "2024-01-01", " "), "a re-run needs both a start and an end date"),
        (request("N", "2024-01-01", "2024-01-02"), "a start date needs mode R and an end date"),
        (request(None, None, "2024-01-02"), "an end date needs mode R and a start date"),
        (request("R", "2024-13-01", "2024-01-02"), "start date is not a yyyy-MM-dd date"),
        (request("R", "2024-01-01", "2024/01/02"), "end date is not a yyyy-MM-dd date"),
        (request("R", "2024-01-03", "2024-01-02"), "end date lies before start date"),
        (request("R", "2024-9-01", "2024-10-01"), None),
        (request("R", "2024-1-5", "2024-1-5"), None),
        (request("X"), "mode must be R, N or empty"),
        (request("r"), "mode must be R, N or empty"),
    ]
    rows = [("p", f"{i:02}", *row[2:]) for i, (row, _) in enumerate(cases)]
    checked = requests.validate_requests(spark.createDataFrame(rows, REQUEST))
    got = [r.error for r in checked.orderBy("proc_run_id").collect()]
    assert got == [error for _, error in cases]


def config_row(name, freq="D", period=1, back=1, active=1):
    return (name, active, freq, period, back, "/job")


CONFIG = ("proc_name string, is_active int, data_freq string, run_period int, "
          "data_back_day int, notebook_path string")
STATUS = ("proc_name string, proc_status string, run_mode string, running_dt date, start_dt date, "
          "end_dt date")


def last_day(d):
    return d.replace(day=calendar.monthrange(d.year, d.month)[1])


def shift_months(d, n):
    index = d.year * 12 + d.month - 1 + n
    year, month = divmod(index, 12)
    return date(year, month + 1, min(d.day, calendar.monthrange(year, month + 1)[1]))


def model_window(req, cfg, st):
    """Run window worked out row by row, as a check on the set-based plan."""
    _, _, freq, period, back, _ = cfg
    failed = st is not None and st[1] == "Failed"
    start = date.fromisoformat(req[3]) if req[3] else None
    end = date.fromisoformat(req[4]) if req[4] else None
    if failed:
        w_end = st[5]
    elif freq == "D":
        w_end = end or TODAY - timedelta(days=back)
    elif freq == "M":
        w_end = last_day(end or shift_months(TODAY, -back))
    else:
        w_end = None
    if failed and st[4]:
        w_start = st[4]
    elif freq == "D":
        w_start = start or w_end - timedelta(days=period - 1)
    elif freq == "M":
        w_start = last_day(start or shift_months(w_end, -(period - 1)))
    else:
        w_start = None
    running = (st[3] or w_start) if failed else w_start
    mode = st[2] if failed else (req[2] or "N")
    return mode, running, w_start, w_end


def model_calendar(freq, running, end):
    days, step = [], 0
    while running and end:
        d = running + timedelta(days=step) if freq == "D" else last_day(shift_months(running, step))
        if freq == "M" and days and d <= days[-1]:
            d = last_day(shift_months(days[-1], 1))
        if d > end:
            break
        days.append(d)
        step += 1
    return days


def cases():
    periods = [(None, None, None), ("N", None, None), ("R", "2024-01-31", "2024-03-15"),
               ("R", "2023-12-30", "2024-01-02"), ("R", "2024-02-29", "2024-02-29")]
    states = [
        None,
        ("Success", "R", None, date(2024, 1, 1), date(2024, 1, 5)),
        ("Failed", "R", date(2024, 1, 3), date(2024, 1, 1), date(2024, 1, 5)),
        ("Failed", "N", None, date(2024, 1, 31), date(2024, 4, 30)),
        ("Failed", "N", None, None, date(2024, 3, 31)),
        ("Failed", "R", date(2024, 5, 1), None, date(2024, 3, 31)),
    ]
    for i, (ask, state, freq, period, back) in enumerate(
        itertools.product(periods, states, ["D", "M", "W"], [1, 3], [1, 2])
    ):
        name = f"p{i}"
        yield (
            request(*ask, name=name),
            config_row(name, freq, period, back),
            (name, *state) if state else None,
        )


@pytest.fixture(scope="module")
def resolved(spark):
    all_cases = list(cases())
    asked = spark.createDataFrame([c[0] for c in all_cases], REQUEST)
    config = spark.createDataFrame([c[1] for c in all_cases], CONFIG)
    status = spark.createDataFrame([c[2] for c in all_cases if c[2]], STATUS)
    context = requests.guard_runs(requests.validate_requests(asked), config, status)
    return all_cases, windows.resolve_windows(context, dates.clock(AS_OF))


def test_windows_against_model(resolved):
    all_cases, plan = resolved
    got = {r.proc_name: (r.run_mode, r.running_dt, r.start_dt, r.end_dt) for r in plan.collect()}
    want = {c[0][0]: model_window(*c) for c in all_cases}
    assert got == want


def test_unknown_frequency_is_flagged(resolved):
    _, plan = resolved
    for row in plan.where("data_freq = 'W'").collect():
        assert (row.window_error is None) == (row.running_dt is not None and row.end_dt is not None)


def test_calendar_against_model(resolved):
    all_cases, plan = resolved
    got = {}
    for r in windows.expand_calendar(plan).orderBy("proc_name", "loop_no").collect():
        got.setdefault(r.proc_name, []).append(r.running_dt)
    want = {}
    for ask, cfg, st in all_cases:
        if cfg[2] in "DM":
            _, running, _, end = model_window(ask, cfg, st)
            want[ask[0]] = model_calendar(cfg[2], running, end)
    assert got == {k: v for k, v in want.items() if v}


def test_guard(spark):
    asked = spark.createDataFrame([request(name=n) for n in ("a", "b", "c", "d")], REQUEST)
    config = spark.createDataFrame(
        [config_row("a"), config_row("b"), config_row("c", active=0)], CONFIG)
    status = spark.createDataFrame([("b", "Running", "N", None, None, None)], STATUS)
    context = requests.guard_runs(requests.validate_requests(asked), config, status)
    assert {r.proc_name: r.guard_error for r in context.collect()} == {
        "a": None,
        "b": "process is running already",
        "c": "process is unknown or not active",
        "d": "process is unknown or not active",
    }


def test_every_request_is_accepted_or_rejected(spark):
    import __spark_entry__ as entry

    sf = "/root/testdata/sf0.001"
    checked = entry.queries()["ctl_request_validate"](spark, sf)
    counts = Counter(r.error is None for r in checked.select("error").collect())
    assert counts[True] > 0 and counts[False] > 0
    assert sum(counts.values()) == spark.read.parquet(f"{sf}/orders.parquet").count()


def status_table(spark, rows):
    """rows: (proc_name, status, running_dt, end_proc_dtm)"""
    full = [
        (n, "old", s, "N", d, d, d, AS_OF, e, AS_OF, None) for n, s, d, e in rows
    ]
    return spark.createDataFrame(full, schemas.STATUS)


def test_start_twice_is_start_once(spark):
    ended = datetime(2024, 1, 2)
    status = status_table(spark, [("a", "Success", date(2024, 1, 1), ended),
                                  ("b", "Failed", date(2024, 1, 1), None)])
    later = datetime(2024, 4, 1)
    new = spark.createDataFrame(
        [("a", "new", "Running", "R", None, date(2024, 2, 1), date(2024, 2, 2), later, later),
         ("z", "new", "Running", "N", date(2024, 2, 1), date(2024, 2, 1), date(2024, 2, 2), later, later)],
        "proc_name string, proc_run_id string, proc_status string, run_mode string, running_dt date, "
        "start_dt date, end_dt date, start_proc_dtm timestamp_ntz, ins_proc_dtm timestamp_ntz")
    new = new.withColumn("window_error", F.lit(None).cast("string"))
    bad = new.where("proc_name = 'z'").withColumns(
        {"proc_name": F.lit("y"), "window_error": F.lit("run window has no dates")})
    new = new.unionByName(bad)
    once = progress.start_status(status, new)
    rows = {r.proc_name: r for r in once.collect()}
    assert set(rows) == {"a", "b", "z"}
    # a NULL from the source overwrites; first-seen and last end times stay
    assert rows["a"].running_dt is None and rows["a"].proc_status == "Running"
    assert (rows["a"].ins_proc_dtm, rows["a"].end_proc_dtm) == (AS_OF, ended)
    assert rows["a"].upd_proc_dtm == later
    assert (rows["z"].ins_proc_dtm, rows["z"].upd_proc_dtm) == (later, None)
    assert rows["b"] == status.where("proc_name = 'b'").first()
    twice = progress.start_status(once, new).drop("upd_proc_dtm", "ins_proc_dtm")
    assert sorted(twice.collect()) == sorted(once.drop("upd_proc_dtm", "ins_proc_dtm").collect())


def test_finish(spark):
    status = status_table(spark, [(n, "Running", date(2024, 1, 1), None) for n in "abc"])
    results = spark.createDataFrame([("a", "Success"), ("b", "Failed")],
                                    "proc_name string, proc_status string")
    rows = {r.proc_name: r for r in
            progress.finish_status(status, results, dates.clock(AS_OF)).collect()}
    assert (rows["a"].proc_status, rows["a"].running_dt, rows["a"].end_proc_dtm) == (
        "Success", None, AS_OF)
    assert (rows["b"].proc_status, rows["b"].running_dt, rows["b"].end_proc_dtm) == (
        "Failed", date(2024, 1, 1), None)
    assert (rows["c"].proc_status, rows["c"].upd_proc_dtm) == ("Running", None)


def test_stop_after_failure_and_marker(spark):
    runs = spark.createDataFrame(
        [("a", date(2024, 1, d), "Failed" if d == 3 else "Success") for d in range(1, 6)]
        + [("b", date(2024, 1, 1), "Success")],
        "proc_name string, running_dt date, proc_status string")
    kept = progress.stop_after_failure(
        runs, "proc_name", ["running_dt"], F.col("proc_status") == "Failed")
    assert [r.running_dt.day for r in kept.where("proc_name = 'a'").orderBy("running_dt").collect()] \
        == [1, 2, 3]
    status = status_table(spark, [("a", "Running", date(2024, 1, 1), None),
                                  ("b", "Running", date(2024, 1, 1), None)])
    moved = {r.proc_name: r for r in
             progress.move_marker(status, kept, dates.clock(AS_OF)).collect()}
    assert moved["a"].running_dt == date(2024, 1, 3) and moved["a"].upd_proc_dtm == AS_OF
    assert moved["b"].running_dt == date(2024, 1, 1) and moved["b"].upd_proc_dtm is None
    results = {r.proc_name: r.proc_status for r in progress.results_of(kept).collect()}
    assert results == {"a": "Failed", "b": "Success"}
    entered = spark.createDataFrame(
        [("a", None), ("b", None), ("nothing to do", None), ("bad", "run window has no dates")],
        "proc_name string, window_error string")
    every = {r.proc_name: r.proc_status for r in progress.results_of(kept, entered).collect()}
    assert every == {"a": "Failed", "b": "Success", "nothing to do": "Success"}


def test_doubled_config_stops_its_process_alone(spark):
    rows = [(n, "transform", 1, 1, 1, "D", "/j", "s", None, None, None, None, None, "me", AS_OF, None, None)
            for n in ("once", "twice", "twice")]
    config = spark.createDataFrame(rows, schemas.CONFIG)
    checked = requests.validate_config(config).select("proc_name", "error").collect()
    assert sorted((r.proc_name, r.error) for r in checked if r.error) == [
        ("twice", "process is configured twice")] * 2
    asked = spark.createDataFrame([("once",), ("twice",), ("none",)], "proc_name string")
    guarded = requests.guard_runs(asked, config, spark.createDataFrame([], schemas.STATUS))
    assert {r.proc_name: r.guard_error for r in guarded.collect()} == {
        "once": None, "twice": "process is configured twice", "none": "process is unknown or not active"}


def test_steps(spark):
    one = spark.createDataFrame([(1,), (2,)], "n int")
    last = steps.run_steps(
        spark,
        [("a", "SELECT n * 10 AS n FROM {src} WHERE n > 1"), ("b", " "),
         ("c", "SELECT n, :data_dt AS d, '${proc_run_id}' AS r FROM {a}")],
        data_dt="2024-01-01", proc_run_id="run-1", sources={"src": one})
    assert [tuple(r) for r in last.collect()] == [(20, "2024-01-01", "run-1")]
    with pytest.raises(ValueError):
        steps.bind_markers("SELECT '${data_dt}'", {"data_dt": "x' OR '1'='1"})
    with pytest.raises(Exception, match="no_such_table"):
        steps.run_steps(spark, [("a", "SELECT * FROM no_such_table")], data_dt="", proc_run_id="")


def test_script(spark):
    run = lambda text, **more: steps.run_script(spark, text, data_dt="2024-01-01", proc_run_id="r", **more)
    one = spark.createDataFrame([(1, "a;b"), (2, None)], "n int, t string")
    got = run("""DECLARE turns INT DEFAULT 0;
        WHILE turns < 3 DO SET turns = turns + 1; END WHILE;
        SELECT t, turns, :data_dt AS d, '${proc_run_id}' AS r FROM {src} WHERE t LIKE '%;%'""", sources={"src": one})
    assert [tuple(r) for r in got.collect()] == [("a;b", 3, "2024-01-01", "r")]
    handled = run("""BEGIN
          DECLARE EXIT HANDLER FOR SQLEXCEPTION SELECT 'failed; logged' AS t;
          SELECT 1 / 0 AS t;
          SELECT 'not reached' AS t;
        END;""")
    assert [r.t for r in handled.collect()] == ["failed; logged"]
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        run("SELECT 1 / 0; SELECT 2;").collect()
    with pytest.raises(ValueError):
        run(" \n")


def test_outcomes_from_envelopes(spark):
    reports = spark.createDataFrame(
        [("a", "r", date(2024, 1, 1), '{"status": "Success", "message": null}'),
         ("b", "r", date(2024, 1, 1), '{"status": "Failed", "message": "x"}'),
         ("c", "r", date(2024, 1, 1), "Traceback"), ("d", "r", date(2024, 1, 1), None)],
        "proc_name string, proc_run_id string, running_dt date, envelope string")
    got = {r.proc_name: (r.proc_status, r.error_message)
           for r in progress.read_outcomes(reports).collect()}
    assert got == {"a": ("Success", None), "b": ("Failed", "x"),
                   "c": ("Failed", "no readable result"), "d": ("Failed", "no readable result")}
