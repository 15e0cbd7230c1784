"""Committed runs: a full build, then incremental ones, must equal one full build."""

from dataclasses import replace
from datetime import date

import pytest
from helpers import assert_same, duck, raw_event, spark_rows
from pyspark.sql import functions as F
from test_models import CFG, at, frame

from parity.deployment import Deployment
from trailweave.operators.incremental import cluster_write, latest_snapshot, merge_by_key, write_snapshot, write_window
from trailweave.plans.pipeline import MARTS, Warehouse
from trailweave.session import sized_shuffles
from trailweave.sources import adapter
from trailweave.sources.export import read_shards
from trailweave.streaming.intraday import read_intraday_stream, start_intraday_feed

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def runs(spark, tmp_path_factory):
    """(incrementally refreshed, fully built) warehouses as of 15 February."""
    root = str(tmp_path_factory.mktemp("warehouses"))
    d = Deployment.of(spark, SF_DIR)
    yesterday = replace(d.cfg, as_of_date=date(2024, 2, 14))

    # the day before, the 12th was still intraday, the 13th incomplete, and the 14th had not begun
    landed = d.daily.where(F.col("shard_date") < "20240212")
    provisional = (
        d.intraday.where(F.col("shard_date") < "20240214")
        .where((F.col("shard_date") < "20240213") | (F.col("batch_event_index") > 0))
        .unionByName(d.daily.where(F.col("shard_date") == "20240212"))
    )
    stepwise = Warehouse(spark, yesterday, f"{root}/stepwise")
    stepwise.refresh_silver(landed, provisional)
    for name in MARTS:
        stepwise.refresh_mart(name)

    # today the daily shard of the 12th landed and the 13th was filled up
    stepwise.cfg = d.cfg
    stepwise.refresh_silver(d.daily, d.intraday, incremental=True)
    for name in MARTS:
        stepwise.refresh_mart(name, incremental=True)

    whole = Warehouse(spark, d.cfg, f"{root}/whole")
    whole.refresh(
        adapter.family_path(d._export, "daily"), adapter.family_path(d._export, "intraday")
    )
    return stepwise, whole


@pytest.mark.parametrize("table", ["sessions", "first_visits"])
def test_silver(runs, table):
    stepwise, whole = runs
    assert_same(getattr(stepwise, table)(), getattr(whole, table)())


def test_staged(runs):
    flat = lambda w: w.staged().withColumn("items", F.to_json("items"))
    stepwise, whole = runs
    assert_same(flat(stepwise), flat(whole))


@pytest.mark.parametrize("name", sorted(MARTS))
def test_mart(runs, name):
    stepwise, whole = runs
    assert_same(stepwise.mart(name), whole.mart(name))


@pytest.mark.parametrize("name", sorted(MARTS))
def test_mart_built_from_written_silver(spark, runs, name):
    assert_same(runs[1].mart(name), Deployment.of(spark, SF_DIR).mart(name))


def test_missed_month_rollover_is_caught_up(spark, tmp_path):
    """No run happened in the first days of March; the next one still closes February."""
    events = [
        raw_event(f"2024{m:02d}{n:02d}", "view_item", micros=at(n) + (m - 2) * 29 * 86_400_000_000, sid=m * 100 + n, items=[])
        for m, n in ((1, 20), (2, 6), (2, 20), (3, 12))
    ]
    for e in events:
        e["items"] = [dict(item_id="a", item_name="a", item_category="c", item_category3="d", quantity=1, item_revenue=1.0,
                           item_revenue_in_usd=1.0, item_list_name=None, item_params=[])]
    none = frame(spark, [])
    warehouse = Warehouse(spark, replace(CFG, as_of_date=date(2024, 2, 25)), str(tmp_path / "w"))
    warehouse.refresh_silver(frame(spark, events[:3]), none)
    warehouse.refresh_mart("product_performance")
    warehouse.cfg = replace(CFG, as_of_date=date(2024, 3, 14))
    warehouse.refresh_silver(frame(spark, events), none, incremental=True)
    warehouse.refresh_mart("product_performance", incremental=True)
    periods = {r.period_label for r in warehouse.mart("product_performance").collect()}
    assert periods == {"Jan-2024", "Feb-2024", "11 Mar - 17 Mar"}


def test_window_write_drops_stale_partitions(spark, tmp_path):
    path, schema = str(tmp_path / "t"), "d date, v int"
    days = [date(2024, 2, n) for n in range(1, 6)]
    cluster_write(spark.createDataFrame([(d, 1) for d in days], schema), path, "d")
    fresh = spark.createDataFrame([(days[3], 2), (days[3], 3)], schema)
    for _ in range(2):  # rerunning changes nothing
        write_window(spark, fresh, path, "d", days[2], ["v"])
        got = spark.read.schema(schema).parquet(path)
        assert spark_rows(got) == [(days[0], 1), (days[1], 1), (days[3], 2), (days[3], 3)]


def test_window_write_of_nothing_empties_the_window(spark, tmp_path):
    path, schema = str(tmp_path / "t"), "d date, v int"
    cluster_write(spark.createDataFrame([(date(2024, 2, 1), 1), (date(2024, 2, 2), 1)], schema), path, "d")
    write_window(spark, spark.createDataFrame([], schema), path, "d", date(2024, 2, 2))
    assert spark_rows(spark.read.schema(schema).parquet(path)) == [(date(2024, 2, 1), 1)]


def test_merge_by_key(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([(2, "B"), (3, "C")], "k int, v string")
    assert spark_rows(merge_by_key(old, new, ["k"])) == [(1, "a"), (2, "B"), (3, "C")]


def test_snapshots(spark, tmp_path):
    path = str(tmp_path / "s")
    assert latest_snapshot(spark, path) is None
    write_snapshot(spark.range(2), path, "1", ["id"])
    write_snapshot(latest_snapshot(spark, path).union(spark.range(5, 6)), path, "2")
    assert spark_rows(latest_snapshot(spark, path)) == [(0,), (1,), (5,)]


def test_snapshots_keep_the_newest(spark, tmp_path):
    path = str(tmp_path / "s")
    for n in range(5):
        write_snapshot(spark.range(n, n + 1), path, str(n), keep=2)
    assert sorted(p.name for p in (tmp_path / "s").iterdir()) == ["version=3", "version=4"]
    assert spark_rows(latest_snapshot(spark, path)) == [(4,)]


def test_shards_are_pruned(spark):
    d = Deployment.of(spark, SF_DIR)
    pruned = read_shards(spark, adapter.family_path(d._export, "daily"), since="20240210")
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(shard_date" in plan and ">= 20240210" in plan
    assert {r.shard_date for r in pruned.select("shard_date").distinct().collect()} == {"20240210", "20240211", "20240212"}


def test_feed_survives_a_restart(spark, tmp_path):
    """Replays reaching the feed in a later run, after a restart, are still recognised."""
    source, out, checkpoint = (str(tmp_path / n) for n in ("source", "out", "checkpoint"))
    event = raw_event("20240213", "page_view", micros=at(13))
    for batch in ([event, dict(event), raw_event("20240213", "page_view", micros=at(13), index=1)], [dict(event), raw_event("20240214", "scroll", micros=at(14))]):
        frame(spark, batch).write.mode("append").partitionBy("shard_date").parquet(source)
        start_intraday_feed(read_intraday_stream(spark, source), out, checkpoint, available_now=True).awaitTermination()
    got = spark.read.parquet(out)
    assert sorted((r.event_name, r.shard_type) for r in got.collect()) == [("page_view", "intraday"), ("page_view", "intraday"), ("scroll", "intraday")]


def test_feed_is_the_same_in_any_order(spark, tmp_path):
    """Shards that arrive newest first, one file a batch, give what one batch of all gives."""
    days = [f"202402{n:02d}" for n in (5, 9, 13, 14)]
    rows = [raw_event(day, "page_view", micros=at(int(day[6:])) + k, index=k) for day in days for k in range(5)]
    rows += [dict(r) for r in rows[::3]]
    feeds = []
    for name, order, options in (("once", days, {}), ("late", days[::-1], {"max_files": 1})):
        source, out, checkpoint = (str(tmp_path / f"{name}-{n}") for n in ("source", "out", "checkpoint"))
        for day in order:
            shard = [r for r in rows if r["event_date"] == day]
            frame(spark, shard).coalesce(1).write.mode("append").partitionBy("shard_date").parquet(source)
            if options:
                start_intraday_feed(read_intraday_stream(spark, source, **options), out, checkpoint, available_now=True).awaitTermination()
        if not options:
            start_intraday_feed(read_intraday_stream(spark, source), out, checkpoint, available_now=True).awaitTermination()
        feeds.append(spark_rows(spark.read.parquet(out).select("event_date", "event_name", "event_timestamp", "raw_batch_event_index")))
    assert feeds[0] == feeds[1] and len(feeds[0]) == len(days) * 5


@pytest.mark.parametrize("sf_dir", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_items_are_all_there(spark, sf_dir):
    """Every line number and part of an order with a commerce event is one item of it."""
    raw = adapter.raw_events(spark, sf_dir).where(F.col("items").isNotNull())
    found = raw.select("batch_ordering_id", F.explode("items").alias("i")).groupBy().agg(
        F.count("*").alias("n"), F.sum("i.quantity").alias("quantity")
    ).first()
    n, quantity = duck(sf_dir).execute(
        "SELECT count(DISTINCT (l_orderkey, l_linenumber, l_partkey)), sum(l_quantity) FROM lineitem JOIN events ON event_id = l_orderkey "
        "WHERE event_type IN ('purchase', 'click') OR (event_type = 'view' AND CAST(props ->> '$.k' AS INT) >= 60) "
        "OR (event_type NOT IN ('view', 'click', 'purchase', 'signup') AND CAST(props ->> '$.k' AS INT) < 50)"
    ).fetchone()
    assert (found.n, found.quantity) == (n, quantity)


def test_shuffle_sizing_is_put_back(spark):
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    before = spark.conf.get(key, None)
    big = spark.range(1 << 45)
    with sized_shuffles(big, big) as wanted:
        assert wanted > 20_000 and spark.conf.get(key) == str(wanted)
    assert spark.conf.get(key, None) == before
