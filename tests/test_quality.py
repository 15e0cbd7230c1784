"""Each check with an input that passes and one that fails."""

from dataclasses import replace
from datetime import date

from helpers import item, raw_event
from test_models import CFG, at, frame, stage

from trailweave.plans import quality as q


def day(n, name="page_view", **extra):
    return raw_event(f"202402{n:02d}", name, micros=at(n), **extra)


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_freshness(spark):
    daily, intraday = frame(spark, [day(13)]), frame(spark, [day(14)])
    assert rows(q.export_freshness(daily, intraday, CFG)) == []
    late = replace(CFG, as_of_date=date(2024, 2, 16))
    assert rows(q.export_freshness(daily, intraday, late)) == [(date(2024, 2, 14), date(2024, 2, 16))]


def test_freshness_fails_on_a_dead_export(spark):
    """Shards of forty days ago, or none at all: the worst outage is reported like a late shard."""
    old, none = raw_event("20240106", "page_view"), frame(spark, [])
    assert rows(q.export_freshness(frame(spark, [old]), none, CFG)) == [(date(2024, 1, 6), date(2024, 2, 15))]
    assert rows(q.export_freshness(none, none, CFG)) == [(None, date(2024, 2, 15))]


def test_continuity(spark):
    daily = frame(spark, [day(n) for n in (8, 9, 10, 11, 13)])
    assert rows(q.export_continuity(spark, daily, frame(spark, [day(12), day(14)]), CFG)) == []
    assert rows(q.export_continuity(spark, daily, frame(spark, [day(14)]), CFG)) == [(date(2024, 2, 12),)]


def test_reconcile(spark):
    events = [day(12), day(12, "scroll"), day(13)]
    daily = frame(spark, events)
    assert rows(q.staging_reconciles_raw(daily, stage(spark, events), CFG)) == []
    assert rows(q.staging_reconciles_raw(daily, stage(spark, events[1:]), CFG)) == [(date(2024, 2, 12), 2, 1, 1)]
    # a date that staging lacks altogether is left to the freshness and continuity checks
    assert rows(q.staging_reconciles_raw(daily, stage(spark, events[:2]), CFG)) == []


def test_user_id(spark):
    staged = stage(spark, [day(12, user=None), day(12), day(13)])
    assert rows(q.user_id_completeness(staged, replace(CFG, max_null_user_pct=50))) == []
    assert rows(q.user_id_completeness(staged, CFG)) == [(3, 1, 33.33)]
    assert rows(q.user_id_completeness(staged.where("false"), CFG)) == []


def test_transaction_id(spark):
    staged = stage(spark, [day(12, "purchase", tx=t) for t in ("T1", "", "(not set)", None)] + [day(11, "purchase")])
    assert sorted(r.transaction_id or "" for r in q.transaction_id_completeness(staged, CFG).collect()) == ["", "", "(not set)"]


def test_transaction_revenue(spark):
    def buy(tx, usd, user="a", items=None):
        return day(12, "purchase", tx=tx, usd=usd, user=user, items=items)

    fine = [buy("T1", 10.0, items=[item("x", usd=9.0)]), buy("T2", 5.0), buy("T2", 5.0)]
    assert rows(q.transaction_revenue_consistency(stage(spark, fine), CFG)) == []
    defects = [buy("T3", -1.0), buy("T4", 10.0, items=[item("x", usd=20.0)]), buy("T5", 1.0), buy("T5", 1.0, user="b"), buy("T6", 1.0), buy("T6", None)]
    assert sorted(rows(q.transaction_revenue_consistency(stage(spark, defects), CFG))) == [
        ("T3", "negative or header/items mismatch", "-1.0"),
        ("T4", "negative or header/items mismatch", "10.0"),
        ("T5", "transaction id shared across users or amounts", "2 users / 1 amounts"),
        ("T6", "transaction id shared across users or amounts", "1 users / 2 amounts"),
    ]


def test_engagement(spark):
    staged = stage(spark, [day(12, sid=1, engaged="0"), day(12, sid=1), day(12, sid=2), day(12, user=None, sid=3), day(12, user=None, sid=4)])
    strict = replace(CFG, max_missing_engagement_pct=10)
    # events without a user id share one unnamed session
    assert rows(q.session_engagement_coverage(staged, strict)) == [(3, 2, 66.67)]
    assert rows(q.session_engagement_coverage(staged, replace(CFG, max_missing_engagement_pct=70))) == []


def test_volume(spark):
    steady = [day(n) for n in range(1, 11) for _ in range(40)]
    quiet = [day(n) for n in (12, 13, 14)]
    # the three newest days against the days up to as_of - 4
    assert rows(q.event_volume_collapse(stage(spark, steady + quiet), CFG)) == [(date(2024, 2, 12), date(2024, 2, 14), 1, 40)]
    busy = [day(14) for _ in range(40)]
    assert rows(q.event_volume_collapse(stage(spark, steady + quiet + busy), CFG)) == []


def test_declared_rules(spark):
    df = spark.createDataFrame([(1, "a", 5), (1, "b", None), (2, None, -1)], "k int, s string, v int")
    assert rows(q.duplicate_keys(df, ["k"])) == [(1, 2)]
    assert rows(q.null_columns(df, ["k", "s"])) == [(2, None, -1)]
    # an undecided condition passes
    assert rows(q.broken_conditions(df, ["v >= 0", "k < 2"])) == [(2, None, -1, "v >= 0"), (2, None, -1, "k < 2")]
