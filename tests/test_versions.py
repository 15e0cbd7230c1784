"""Versioned tables, the session index and touched buckets: what a run reads, rewrites and leaves alone."""

from dataclasses import replace
from datetime import date, timedelta

import pytest
from helpers import raw_event, spark_rows
from pyspark.sql import functions as F
from test_models import CFG, at, frame

from parity.deployment import Deployment
from trailweave.operators.versions import ConcurrentCommit, VersionedTable, bucket_of, from_value
from trailweave.plans import first_visit, product, sessions
from trailweave.plans.pipeline import Warehouse
from trailweave.plans.session_index import REF, SessionIndex, session_ref

SF_DIR = "/root/testdata/sf0.001"
DAYS = [date(2024, 2, n) for n in range(1, 6)]


def days_table(spark, path):
    return VersionedTable(spark, str(path), ("d",), keep=2)


def values(spark, *rows):
    return spark.createDataFrame(list(rows), "d date, v int")


def content(table):
    return spark_rows(table.read())


def files(path):
    return {str(p.relative_to(path)) for p in path.rglob("*.parquet")}


def test_a_window_is_replaced_and_the_rest_stays(spark, tmp_path):
    table = days_table(spark, tmp_path)
    assert table.read() is None
    table.commit(values(spark, *[(d, 1) for d in DAYS]))
    before = files(tmp_path)
    for _ in range(2):  # rerunning changes nothing
        table.commit(values(spark, (DAYS[3], 2), (DAYS[3], 3)), from_value("d", "2024-02-03"))
        assert content(table) == [(DAYS[0], 1), (DAYS[1], 1), (DAYS[3], 2), (DAYS[3], 3)]
    kept = {f for f in before if "d=2024-02-01" in f or "d=2024-02-02" in f}
    assert kept and kept <= files(tmp_path)
    table.commit(values(spark), from_value("d", "2024-02-01"))
    assert content(table) == []


@pytest.mark.parametrize("step", ["_write", "_folders", "_publish"])
def test_a_commit_that_dies_leaves_the_old_table(spark, tmp_path, monkeypatch, step):
    table = days_table(spark, tmp_path)
    table.commit(values(spark, *[(d, 1) for d in DAYS]))
    reader = table.read()

    def dies(*args, own=getattr(VersionedTable, step)):
        if step == "_write":
            own(*args)  # the data are there, all else is not
        raise RuntimeError("lost")

    with monkeypatch.context() as patched:
        patched.setattr(VersionedTable, step, dies)
        with pytest.raises(RuntimeError, match="lost"):
            table.commit(values(spark, (DAYS[4], 9)), from_value("d", "2024-02-02"))
    assert content(table) == spark_rows(reader) == [(d, 1) for d in DAYS]
    table.commit(values(spark, (DAYS[4], 9)), from_value("d", "2024-02-02"))
    assert content(table) == [(DAYS[0], 1), (DAYS[4], 9)]
    # a reader from before the commit still has its version
    assert spark_rows(reader) == [(d, 1) for d in DAYS]


def test_a_dead_removal_leaves_the_new_table(spark, tmp_path, monkeypatch):
    table = days_table(spark, tmp_path)
    for n in range(2):
        table.commit(values(spark, (DAYS[0], n)))
    with monkeypatch.context() as patched:
        patched.setattr(VersionedTable, "_remove_old", lambda self: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            table.commit(values(spark, (DAYS[0], 2)))
    assert content(table) == [(DAYS[0], 2)]
    table.commit(values(spark, (DAYS[0], 3)))
    assert content(table) == [(DAYS[0], 3)] and table._versions() == [3, 4] and len(files(tmp_path)) == 2


def test_of_two_commits_at_once_one_fails(spark, tmp_path, monkeypatch):
    table = days_table(spark, tmp_path)
    table.commit(values(spark, (DAYS[0], 1)))
    seen = table.version()
    table.commit(values(spark, (DAYS[0], 2)))
    with monkeypatch.context() as patched:
        patched.setattr(VersionedTable, "version", lambda self, number=None: seen)
        with pytest.raises(ConcurrentCommit):
            table.commit(values(spark, (DAYS[0], 3)))
    assert content(table) == [(DAYS[0], 2)]


def test_odd_partition_values(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path), ("k",))
    rows = [("a b/c=d%", 1), (None, 2), ("é", 3)]
    table.commit(spark.createDataFrame(rows, "k string, v int"))
    assert sorted((r.k or "", r.v) for r in table.read().collect()) == [("", 2), ("a b/c=d%", 1), ("é", 3)]


# ---------------------------------------------------------------- session index


def moved(df, scan):
    """The operators between the scan whose line holds `scan` and the join above it."""
    lines = df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple").splitlines()
    depth = lambda line: len(line) - len(line.lstrip(" :+-*()0123456789"))
    found = []
    for at, line in enumerate(lines):
        if "FileScan" in line and scan in line:
            assert "Bucketed: true" in line
            level, above = depth(line), []
            for upper in reversed(lines[:at]):
                if depth(upper) < level:
                    level = depth(upper)
                    if "Join" in upper:
                        break
                    above.append(upper)
            found.append(above)
    return found


@pytest.fixture(scope="module")
def index(spark, tmp_path_factory):
    d = Deployment.of(spark, SF_DIR)
    found = SessionIndex(spark, str(tmp_path_factory.mktemp("index")), 8)
    found.refresh(d.sessions)
    return found


@pytest.mark.parametrize("kind", ["sessions", "product"])
def test_stored_sessions_are_not_moved(spark, index, kind):
    d = Deployment.of(spark, SF_DIR)
    if kind == "sessions":
        df = sessions.sessions(d.staged, d.cfg, incremental=True, index=index)
    else:
        df = product.product_performance(d.staged, d.sessions, d.cfg, incremental=True, index=index)
    paths = moved(df, "trailweave_")
    assert len(paths) == 1 and paths[0]
    assert not any("Exchange" in line for line in paths[0]), paths


def test_the_test_above_can_fail(spark, index):
    """Joined on anything but the reference, stored sessions have to move."""
    fresh = Deployment.of(spark, SF_DIR).sessions.withColumn(REF, session_ref())
    stored = index.table.bucketed().select(F.col(REF).alias("stored"), "session_date").hint("merge")
    joined = fresh.join(stored, (F.col(REF) == F.col("stored")) & (fresh.session_date == stored.session_date))
    lines = spark._jvm.PythonSQLUtils.explainString(joined._jdf.queryExecution(), "simple").splitlines()
    scan = next(at for at, line in enumerate(lines) if "FileScan" in line and "trailweave_" in line)
    assert any("Exchange" in line for line in lines[scan - 4 : scan])


def test_a_lookup_reads_the_touched_buckets_only(spark, index):
    stored = index.table.read()
    one = stored.orderBy(REF).limit(1).select(REF)
    bucket = one.select(bucket_of(REF, 8)).first()[0]
    read = index.near(one).inputFiles()
    assert read and all(f"/bucket={bucket}/" in name for name in read)
    assert len(read) < len(index.table.bucketed().inputFiles())
    assert index.with_flags(one, one).where("is_bounced_flag IS NOT NULL").count() == 1


def test_no_index_yet(spark, tmp_path):
    d = Deployment.of(spark, SF_DIR)
    empty = SessionIndex(spark, str(tmp_path), 4)
    one = d.sessions.limit(3).select(session_ref().alias(REF))
    assert empty.near(one) is None and empty.with_flags(one, one).where("is_bounced_flag IS NULL").count() == 3


def test_references_are_unambiguous(spark):
    rows = [(None, 1), ("", 1), ("-", 1), ("u", 1), ("u:1", 1), ("u", 11), ("a:1", 2), ("a", 12)]
    df = spark.createDataFrame(rows, "user_pseudo_id string, ga_session_id long")
    assert df.select(session_ref()).distinct().count() == len(rows)


def views(days, user="u1", sid=1):
    return [raw_event(f"{d:%Y%m%d}", "page_view", user=user, micros=at(1) + (d - date(2024, 2, 1)).days * 86_400_000_000, sid=sid) for d in days]


def test_a_session_that_pauses_for_months_is_stored_once(spark, tmp_path):
    """The index has no limit on how far back it looks; users without an id have sessions too."""
    first, later = date(2024, 1, 3), date(2024, 3, 10)
    none = frame(spark, [])
    cfg = replace(CFG, as_of_date=first + timedelta(days=2))
    warehouse = Warehouse(spark, cfg, str(tmp_path / "w"))
    start = [*views([first]), *views([first], user=None, sid=7)]
    warehouse.refresh_silver(frame(spark, start), none)
    warehouse.cfg = replace(CFG, as_of_date=later)
    resumed = [*views([later]), *views([later], user=None, sid=7), *views([later], sid=2)]
    warehouse.refresh_silver(frame(spark, start + resumed), none, incremental=True)
    got = sorted((r.user_pseudo_id or "", r.ga_session_id, r.session_date) for r in warehouse.sessions().collect())
    assert got == [("", 7, first), ("u1", 1, first), ("u1", 2, later)]
    indexed = {(r[REF], r.session_date) for r in warehouse.session_index.table.read().collect()}
    assert indexed == {("-:7", first), ("uu1:1", first), ("uu1:2", later)}


def test_index_catches_up_after_a_run_that_died(spark, tmp_path, monkeypatch):
    none, days = frame(spark, []), [date(2024, 2, n) for n in (3, 9, 10, 11)]
    warehouse = Warehouse(spark, replace(CFG, as_of_date=days[0]), str(tmp_path / "w"))
    warehouse.refresh_silver(frame(spark, views(days[:1])), none)
    warehouse.cfg = replace(CFG, as_of_date=days[1])
    with monkeypatch.context() as patched:
        follow = SessionIndex.follow

        def dies(self, table, boundary=None):
            if table.version().number > 1:
                raise RuntimeError("lost")
            follow(self, table, boundary)

        patched.setattr(SessionIndex, "follow", dies)
        with pytest.raises(RuntimeError, match="lost"):
            warehouse.refresh_silver(frame(spark, views(days[:1]) + views([days[1]], sid=2)), none, incremental=True)
    # nobody reran it; later the session of the lost run goes on
    warehouse.cfg = replace(CFG, as_of_date=date(2024, 2, 20))
    events = views(days[:1]) + views([days[1]], sid=2) + views([date(2024, 2, 20)], sid=2)
    warehouse.refresh_silver(frame(spark, events), none, incremental=True)
    assert sorted((r.ga_session_id, r.session_date) for r in warehouse.sessions().collect()) == [(1, days[0]), (2, days[1])]


# ---------------------------------------------------------------- first visits


def test_only_buckets_that_change_are_rewritten(spark, tmp_path):
    cfg = replace(CFG, user_buckets=64)
    table = VersionedTable(spark, str(tmp_path / "f"), ("bucket",), ("user_pseudo_id",))
    dated = lambda rows: first_visit._earliest(rows, cfg)
    users = spark.range(1000).select(F.concat(F.lit("u"), "id").alias("user_pseudo_id"), F.lit(date(2024, 1, 5)).alias("first_visit_date"))
    first_visit.commit_first_visits(table, dated(users), cfg)
    before, files_before = table.version().partitions, files(tmp_path)

    def seen(names, day):
        return dated(spark.createDataFrame([(n, day) for n in names], "user_pseudo_id string, first_visit_date date"))

    # known users come back later: nothing is written
    first_visit.commit_first_visits(table, seen([f"u{n}" for n in range(500)], date(2024, 2, 1)), cfg, incremental=True)
    assert files(tmp_path) == files_before and table.version().number == 1
    # one in a hundred is new, one was there earlier than known
    names = [f"n{n}" for n in range(9)]
    fresh = seen([*names, *[f"u{n}" for n in range(400)]], date(2024, 2, 2)).unionByName(seen(["u999"], date(2024, 1, 2)))
    first_visit.commit_first_visits(table, fresh, cfg, incremental=True)
    after = table.version().partitions
    touched = {p for p in after if after[p] != before[p]}
    wanted = spark.createDataFrame([(n,) for n in [*names, "u999"]], "u string").select(bucket_of("u", 64)).distinct().collect()
    assert touched == {f"bucket={r[0]}" for r in wanted} and len(touched) <= 10
    assert files_before <= files(tmp_path)
    dates = {r.user_pseudo_id: r.first_visit_date for r in table.read().collect()}
    assert len(dates) == 1009 and dates["u999"] == date(2024, 1, 2) and dates["u7"] == date(2024, 1, 5) and dates["n3"] == date(2024, 2, 2)
