"""The base of the monthly marts: same reports as from the events, which are then not read, and months left alone."""

from datetime import date

import pytest
from helpers import assert_same, item, raw_event, spark_rows
from pyspark.sql import functions as F
from test_models import CFG, frame, stage

from parity.deployment import Deployment
from trailweave.functions.calendar import month_start
from trailweave.operators.versions import VersionedTable, from_value
from trailweave.plans import monthly_base, sessions
from trailweave.plans.pipeline import MARTS

SF_DIR = "/root/testdata/sf0.001"
MONTHLY = sorted(name for name, mart in MARTS.items() if mart.from_base)
DAY = 86_400_000_000
FIRST = 1_704_067_200_000_000  # 2024-01-01


def event(day, name, **extra):
    """An event of the day that many days after New Year."""
    at = date.fromordinal(date(2024, 1, 1).toordinal() + day)
    return raw_event(f"{at:%Y%m%d}", name, micros=FIRST + day * DAY + 1, **extra)


def events():
    """Two months; a user of two devices, places and channels, events without user or session, an order seen twice."""
    phone = {"platform": "ANDROID", "device": {"category": "mobile", "web_info": None}}
    away = {"geo": {"city": None, "region": "", "country": "India"}}
    rows = []
    for start in (3, 40):
        rows += [
            event(start, "view_item", user="a", items=[item("x"), item("x"), item("y")]),
            event(start + 1, "view_item", user="a", sid=2, items=[item("x")], **phone),
            event(start + 1, "add_to_cart", user="a", sid=2, items=[item("y")], **away),
            event(start + 1, "add_to_wishlist", user="b", sid=None),
            event(start + 2, "view_item", user=None, items=[item(None)]),
            event(start + 2, "purchase", user="a", sid=2, tx="T1", usd=9.99, items=[item("x")], **phone),
            event(start + 2, "purchase", user="b", tx="T1", usd=None, **away),
            event(start + 3, "purchase", user="b", tx="(not set)", usd=0.015),
            event(start + 3, "scroll", user="c", items=[item("z")], **phone),
        ]
    return rows


def source(staged):
    rows = staged.withColumn("month", month_start(F.col("event_date")))
    return monthly_base.BaseSource(*[build(rows) for build, _ in monthly_base.TABLES.values()])


@pytest.mark.parametrize("name", MONTHLY)
@pytest.mark.parametrize("kept", ["true", "event_name = 'scroll'", "false"])
def test_reports_are_those_of_the_events(spark, name, kept):
    staged = stage(spark, events()).where(kept)
    visits = sessions.sessions(staged, CFG)
    plain = MARTS[name].build(staged, visits, CFG)
    assert_same(MARTS[name].build(staged, visits, CFG, base=source(staged)), plain)
    assert (kept == "false") == (plain.count() == 0)


@pytest.mark.parametrize("incremental", [False, True])
@pytest.mark.parametrize("name", MONTHLY)
def test_staged_events_are_not_read(spark, name, incremental):
    before = spark.conf.get("spark.sql.maxMetadataStringLength")
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")  # else a scan's line does not name its table
    try:
        df = Deployment.of(spark, SF_DIR).warehouse.build_mart(name, incremental=incremental)
        text = spark.sparkContext._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")
    finally:
        spark.conf.set("spark.sql.maxMetadataStringLength", before)
    scans = [line for line in text.splitlines() if "FileScan" in line]
    assert any("/monthly_activity/" in line for line in scans)
    assert not any("/staged_events/" in line for line in scans)
    base = [line for line in scans if "/monthly_" in line]
    assert not incremental or all("month#" in line.split("PartitionFilters", 1)[1] for line in base)


@pytest.fixture
def stored(spark, tmp_path):
    """Staged events of two months and the base's tables, not built yet."""
    staged = VersionedTable(spark, str(tmp_path / "staged"), ("event_date",), keep=3)
    staged.commit(stage(spark, events()))
    tables = [
        (VersionedTable(spark, str(tmp_path / name), ("month",), cluster, keep=2), build)
        for name, (build, cluster) in monthly_base.TABLES.items()
    ]
    return staged, tables


def follow(staged, tables):
    return [monthly_base.follow(table, build, staged) for table, build in tables]


def check(staged, tables):
    """The tables hold what building them anew would give."""
    rows = staged.read().withColumn("month", month_start(F.col("event_date")))
    for table, build in tables:
        assert spark_rows(table.read()) == spark_rows(build(rows).select(*table.read().columns))


def test_only_months_of_changed_days_are_combined_again(spark, stored):
    staged, tables = stored
    assert follow(staged, tables) == [None] * 3
    check(staged, tables)
    before = [table.version().partitions for table, _ in tables]
    assert all(len(p) == 2 for p in before)
    assert follow(staged, tables) == [set()] * 3  # nothing new, nothing written
    assert [table.version().partitions for table, _ in tables] == before

    # the tenth is restated; the other days of February are combined again with it
    late = stage(spark, [event(40, "purchase", user="d", tx="T2", usd=1.0), event(40, "view_item", user="d", items=[item("q")])])
    staged.commit(late, lambda day: day == "event_date=2024-02-10")
    assert follow(staged, tables) == [{"month=2024-02-01"}] * 3
    check(staged, tables)
    for (table, _), old in zip(tables, before):
        now = table.version().partitions
        assert now["month=2024-01-01"] == old["month=2024-01-01"] and now["month=2024-02-01"] != old["month=2024-02-01"]


def test_days_that_vanish_leave_the_base(spark, stored):
    staged, tables = stored
    follow(staged, tables)
    staged.commit(staged.read().where("false"), from_value("event_date", "2024-02-01"))
    assert follow(staged, tables) == [{"month=2024-02-01"}] * 3
    check(staged, tables)
    assert all(list(table.version().partitions) == ["month=2024-01-01"] for table, _ in tables)


def test_runs_that_died_are_caught_up(spark, stored):
    """A staged commit that the base missed counts in the next run; one too old to be compared rebuilds all."""
    staged, tables = stored
    follow(staged, tables)
    january = stage(spark, [event(5, "view_item", user="late", items=[item("w")])])
    staged.commit(january, lambda day: day == "event_date=2024-01-06")
    assert follow(staged, tables[:1]) == [{"month=2024-01-01"}]  # the run dies after the first table
    february = stage(spark, [event(41, "view_item", user="later", items=[item("v")])])
    staged.commit(february, lambda day: day == "event_date=2024-02-11")
    assert follow(staged, tables[:2]) == [{"month=2024-02-01"}, {"month=2024-01-01", "month=2024-02-01"}]
    staged.commit(february, lambda day: day == "event_date=2024-02-11")
    assert follow(staged, tables) == [{"month=2024-02-01"}, {"month=2024-02-01"}, None]
    check(staged, tables)


def test_events_without_a_date_have_a_month_of_their_own(spark, stored):
    staged, tables = stored
    follow(staged, tables)
    nowhen = stage(spark, [event(5, "purchase", tx="T9", usd=1.0, items=[item("n")]), event(5, "view_item", items=[item("n")])])
    staged.commit(nowhen.withColumn("event_date", F.lit(None).cast("date")), lambda day: False)
    assert follow(staged, tables) == [{"month=__HIVE_DEFAULT_PARTITION__"}] * 3
    check(staged, tables)


def test_a_stale_base_is_not_used(spark, tmp_path):
    from trailweave.plans.pipeline import Warehouse

    warehouse = Warehouse(spark, CFG, str(tmp_path / "w"))
    warehouse.refresh_silver(frame(spark, events()), frame(spark, []))
    assert warehouse.monthly_base() is not None
    fresh = warehouse.build_mart("funnel_events")
    staged = warehouse.table(warehouse.STAGED)
    staged.commit(stage(spark, events()[:5]))
    assert warehouse.monthly_base() is None
    assert spark_rows(warehouse.build_mart("funnel_events")) != spark_rows(fresh)
