from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from test_loads import D, feed, new_load, put, run, zone  # noqa: F401

from slicewright import storage
from slicewright.functions import dates
from slicewright.plans import inbound, leases
from slicewright.sources import delimited
from slicewright.storage import new_folder
from slicewright.versions import Conflict, VersionedTable

SCHEMA = "k long, day date, v string"


def days(spark, *wanted):
    return spark.createDataFrame([(d,) for d in wanted], "day date")


@pytest.fixture
def table(spark):
    """Forty rows over eight files by key; four days."""
    out = VersionedTable(spark, new_folder(spark, "test"), ["k", "day"])
    rows = [(k, D[k // 10], "old") for k in range(40)]
    out.overwrite(spark.createDataFrame(rows, SCHEMA).repartitionByRange(8, "k"))
    return out


def names(table, version=None):
    return {r.file for r in table.files(version).collect()}


def values(table, version=None):
    return {r.k: r.v for r in table.read(version).collect()}


def merge(table, rows):
    new = {c: F.col(f"new_{c}") for c in ("day", "v")}
    return table.merge_upsert(rows, ["k"], update=new, insert=new)


def test_a_merge_of_one_key_rewrites_the_file_that_holds_it(spark, table):
    one = spark.createDataFrame([(7, D[0], "new")], SCHEMA)
    before = values(table)
    assert merge(table, one) == 2
    assert len(names(table, 1) - names(table)) == 1 and len(names(table, 1) & names(table)) == 7
    assert values(table) == before | {7: "new"} and values(table, 1) == before
    fresh = spark.createDataFrame([(99, D[1], "added"), (7, D[0], "again"), (None, D[0], "no key")], SCHEMA)
    kept = names(table)
    merge(table, fresh)
    assert len(kept - names(table)) == 1
    assert values(table) == before | {7: "again", 99: "added", None: "no key"}
    untouched = names(table)
    merge(table, spark.createDataFrame([(1000, D[1], "far")], SCHEMA))
    assert untouched < names(table)  # an insert alone rewrites nothing


def test_an_update_touches_what_it_changes(spark, table):
    assert table.update_matched(spark.createDataFrame([(500,)], "k long"), ["k"], {"v": F.lit("x")}) == 1  # no such key, no version
    table.update_matched(spark.createDataFrame([(11,), (12,), (12000,)], "k long"), ["k"], {"v": F.lit("x")})
    assert {k for k, v in values(table).items() if v == "x"} == {11, 12} and len(values(table)) == 40
    assert len(names(table, 1) - names(table)) <= 2


def test_slices_are_replaced_by_file(spark, table):
    bare = spark.createDataFrame([(70, None, "undated"), (71, D[1], "dated")], SCHEMA).coalesce(1)
    table.append(bare)
    new = spark.createDataFrame([(50, D[1], "new")], SCHEMA)
    before = names(table)
    table.replace_slices(new, days(spark, D[1], D[2]))
    got = values(table)
    assert set(got) == {*range(10), *range(30, 40), 50, 70}
    assert len(before & names(table)) >= 3  # the files of other days are as they were
    assert [f.n_rows for f in table.files().where("low_day IS NULL").collect()] in ([1], [])
    table.replace_slices(new.limit(0), days(spark, *D[:4]))
    assert set(values(table)) == {70}


def test_a_write_that_breaks_off_leaves_the_old_version(spark, table):
    before = values(table)
    broken = spark.createDataFrame([(1, D[0], "x")], SCHEMA).withColumn("v", F.raise_error(F.lit("stop")).cast("string"))
    with pytest.raises(Exception, match="stop"):
        table.replace_slices(broken, days(spark, D[0]))
    assert table.version() == 1 and values(table) == before
    assert VersionedTable(spark, table.path + "-none").files() is None
    with pytest.raises(FileNotFoundError):
        VersionedTable(spark, table.path + "-none").read()


def test_of_two_writers_one_starts_again(spark, table):
    calls = []

    def slow(listed):
        calls.append(listed)
        if len(calls) == 1:  # another writer commits in between
            VersionedTable(spark, table.path, table.spans).append(spark.createDataFrame([(200, D[0], "other")], SCHEMA))
        return listed, spark.createDataFrame([(201, D[0], "mine")], SCHEMA)

    assert table.change(slow) == 3 and len(calls) == 2
    assert {200, 201} < set(values(table)) and len(values(table)) == 42

    def beaten(listed):
        storage.create_new(spark, table._pointer(table.version() + 1), storage.read_text(spark, table._pointer(table.version())))
        return listed, spark.createDataFrame([(1, D[0], "x")], SCHEMA)

    with pytest.raises(Conflict):
        table.change(beaten)


def test_create_new_lets_one_win(spark):
    path = new_folder(spark, "test") + "/one"
    with ThreadPoolExecutor(8) as pool:
        won = list(pool.map(lambda i: storage.create_new(spark, path, f"writer {i}"), range(16)))
    assert won.count(True) == 1 and storage.read_text(spark, path) == f"writer {won.index(True)}"
    assert storage.names_in(spark, path.rsplit("/", 1)[0]) == ["one"]


def test_compaction(spark):
    table = VersionedTable(spark, new_folder(spark, "test"), ["k"])
    for i in range(6):
        table.append(spark.createDataFrame([(k, D[i], f"v{i}") for k in range(i, 10)], SCHEMA).repartition(3))
    rows = sorted(map(str, table.read().collect()))
    many = len(names(table))
    table.compact()
    assert len(names(table)) < many / 4 and sorted(map(str, table.read().collect())) == rows
    version = table.version()
    table.compact(small=1)  # nothing is that small
    assert table.version() == version
    old = table.read()
    table.compact(["k"], ["day"])
    assert values(table) == {k: f"v{min(k, 5)}" for k in range(10)}
    assert sorted(map(str, old.collect())) == rows  # a reader of the version before is not disturbed


NOW = datetime(2024, 3, 31, 20)
STARTS = "proc_name string, proc_run_id string, asked int"
HOUR = timedelta(hours=1)


def start(spark, table, rows, now=NOW):
    got = leases.acquire(table, spark.createDataFrame(rows, STARTS), dates.clock(now), HOUR, ["asked"])
    return {r.proc_run_id: r.verdict for r in got.collect()}


def holders(table):
    return {r.proc_name: (r.proc_run_id, r.released) for r in table.read().collect()}


def test_a_lease_is_held_given_back_and_taken_over(spark):
    table = leases.lease_table(spark, new_folder(spark, "test"))
    first = [("A", "a2", 2), ("A", "a1", 1), ("B", "b1", 1), (None, "n", 1)]
    assert start(spark, table, first) == {"a2": "OUTRUN", "a1": "GRANTED", "b1": "GRANTED", "n": "HELD"}
    assert start(spark, table, [("A", "a3", 1)]) == {"a3": "HELD"}
    assert start(spark, table, [("A", "a1", 1)]) == {"a1": "GRANTED"}  # its own
    runs = lambda *r: spark.createDataFrame(r, "proc_name string, proc_run_id string")
    leases.release(table, runs(("A", "a1"), ("B", "other")), dates.clock(NOW))
    assert holders(table) == {"A": ("a1", True), "B": ("b1", False)}
    assert start(spark, table, [("A", "a3", 1)]) == {"a3": "GRANTED"}
    late = NOW + HOUR
    leases.renew(table, runs(("A", "a3")), dates.clock(late - timedelta(minutes=1)), HOUR)
    assert start(spark, table, [("A", "a4", 1), ("B", "b2", 1)], late) == {"a4": "HELD", "b2": "TAKEN_OVER"}
    leases.release(table, runs(("B", "b1")), dates.clock(late))  # the crashed run wakes up
    leases.renew(table, runs(("B", "b1")), dates.clock(late), HOUR)
    assert holders(table)["B"] == ("b2", False)
    assert start(spark, table, []) == {}


def test_of_two_concurrent_starts_one_wins(spark):
    path = new_folder(spark, "test")
    with ThreadPoolExecutor(2) as pool:
        got = list(pool.map(lambda r: start(spark, leases.lease_table(spark, path), [("A", r, 1)]), ["x", "y"]))
    verdicts = got[0] | got[1]
    assert sorted(verdicts.values()) == ["GRANTED", "HELD"]
    assert holders(leases.lease_table(spark, path)) == {"A": ([r for r, v in verdicts.items() if v == "GRANTED"][0], False)}


def test_a_load_into_a_versioned_table_appears_whole(spark, zone, monkeypatch):  # noqa: F811
    for d in D[:2]:
        put(zone, d, [("a", 1)])
    load = replace(new_load(spark, zone), versioned=True)
    control = [(d, f"{d:%Y%m%d}", 1) for d in D[:3]]
    assert set(run(spark, load, D[:2], control).values()) == {"OK"}
    target = VersionedTable(spark, load.target, ["DATA_DT"])
    before = sorted(map(str, target.read().collect()))
    put(zone, D[0], [("b", 2)])
    put(zone, D[1], [])
    with monkeypatch.context() as patch:  # the driver dies when all is written but the version
        patch.setattr(VersionedTable, "_commit", lambda *a: (_ for _ in ()).throw(RuntimeError("gone")))
        with pytest.raises(RuntimeError, match="gone"):
            run(spark, load, D[:2], [control[0], (D[1], "20240102", 0)])
    assert sorted(map(str, target.read().collect())) == before
    assert set(run(spark, load, D[:2], [control[0], (D[1], "20240102", 0)]).values()) == {"OK"}
    assert [(r.k, r.DATA_DT) for r in target.read().collect()] == [("b", D[0])]


def test_a_bad_first_file_is_refused_alone(spark, zone):  # noqa: F811
    (zone / feed(D[0])).write_text("a|wrong\n1|2\n")
    for d in D[1:3]:
        put(zone, d, [("x", 1)])
    control = [(d, f"{d:%Y%m%d}", 1) for d in D[:4]]
    load = new_load(spark, zone)
    assert run(spark, load, D[:3], control) == {feed(D[0]): "HEADER_MISMATCH", feed(D[1]): "OK", feed(D[2]): "OK"}
    # from then on the table says what the feed's columns are, whatever most files say
    (zone / feed(D[3])).write_text("a|wrong\n1|2\n")
    assert run(spark, load, [D[0], D[3]], control) == {feed(D[0]): "HEADER_MISMATCH", feed(D[3]): "HEADER_MISMATCH"}


def test_only_due_files_are_opened(spark, zone):  # noqa: F811
    for d in D[:5]:
        put(zone, d, [("a", d.day), ("k", "v"), ("k", "v")])
    load = new_load(spark, zone)
    control = [(d, f"{d:%Y%m%d}", 3) for d in D[:5]]
    assert set(run(spark, load, D[:4], control).values()) == {"OK"}
    expected = spark.createDataFrame([(feed(d), d) for d in D[:5]], "file_name string, data_dt date")
    pending = inbound._open_run(spark, load, expected, new_folder(spark, "test"))
    assert pending.where("due").count() == 1
    lines = inbound.due_lines(spark, load, pending, ["k", "v"])
    assert lines.where("_head").count() == 3  # the header, and two rows like it
    plan = lines._jdf.queryExecution()
    plan.toRdd().count()
    scans = [n for n in _nodes(plan.executedPlan()) if n.nodeName().startswith("Scan csv")]
    assert [s.metrics().apply("numFiles").value() for s in scans] == [1]


def _nodes(node):
    inner = node.executedPlan() if node.nodeName() == "AdaptiveSparkPlan" else node.plan() if "QueryStage" in node.nodeName() else None
    children = [inner] if inner is not None else [node.children().apply(i) for i in range(node.children().size())]
    return [node] + [n for c in children for n in _nodes(c)]


LAYOUT = T.StructType([T.StructField("n", T.IntegerType(), False), T.StructField("d", T.DateType()), T.StructField("t", T.StringType())])


def test_rejected_rows(spark, tmp_path):
    (tmp_path / "a.csv").write_text('n,d,t\n1,2024-01-01,x\nz,2024-01-01,"a,b"\n2,2024-13-01,\n3,,y\n,2024-01-01,q\n4\n5,2024-01-01,x,9\nq,nope,x\n')
    (tmp_path / "b.csv").write_text("n,d,t\n1,2024-01-01,x\n")
    (tmp_path / "c.csv").write_text("")
    checked = delimited.read_checked(spark, str(tmp_path), LAYOUT)
    bad = {r.line: r.reason for r in delimited.rejected(checked).collect()}
    assert bad == {
        "z,2024-01-01,a,b": "not of its type: n", "2,2024-13-01,": "not of its type: d", ",2024-01-01,q": "required: n",
        "4": "number of fields", "5,2024-01-01,x,9": "number of fields", "q,nope,x": "not of its type: n, d",
    }
    assert sorted((r.n, r.d, r.t, r.file_name) for r in delimited.accepted(checked).collect() if r.d) == [
        (1, date(2024, 1, 1), "x", "a.csv"), (1, date(2024, 1, 1), "x", "b.csv")]
    verdicts = {r.file_name: (r.n_rows, r.n_rejected, r.row_status) for r in delimited.reject_verdicts(checked, 0.5).collect()}
    assert verdicts == {"a.csv": (8, 6, "ROWS_REJECTED"), "b.csv": (1, 0, "OK")}
    assert {r.row_status for r in delimited.reject_verdicts(checked, 0.75).collect()} == {"OK"}
