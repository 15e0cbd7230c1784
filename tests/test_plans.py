"""Physical plans: pruned scans, no pair-wise joins, no text aggregates over events."""

import pytest
from pyspark.sql import functions as F

from parity.deployment import Deployment
from trailweave.plans import product, sessions
from trailweave.plans.pipeline import MARTS
from trailweave.session import size_shuffles
from trailweave.sources import adapter
from trailweave.sources.export import read_shards

SF_DIR = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


@pytest.mark.parametrize("name", sorted(MARTS))
def test_no_pairwise_join(spark, name):
    text = plan(Deployment.of(spark, SF_DIR).mart(name))
    assert "CartesianProduct" not in text and "NestedLoopJoin" not in text


@pytest.mark.parametrize("name", sorted(n for n, m in MARTS.items() if m.partition))
def test_incremental_prunes_partitions(spark, name):
    text = plan(Deployment.of(spark, SF_DIR).mart(name, incremental=True))
    filters = [line for line in text.splitlines() if "PartitionFilters" in line]
    assert sum("event_date" in f and ">=" in f for f in filters) >= 1


def test_product_reads_only_the_item_fields_it_reports(spark):
    d = Deployment.of(spark, SF_DIR)
    text = plan(product.product_performance(d.staged, d.sessions, d.cfg))
    assert "items:array<struct<item_category:string,item_category_3:string" in text
    assert "item_name" not in text.split("ReadSchema", 1)[1].split("\n", 1)[0]


def test_purchases_are_filtered_in_the_scan(spark):
    text = plan(Deployment.of(spark, SF_DIR).mart("funnel_events"))
    assert "EqualTo(event_name,purchase)" in text


def test_sessions_hash_the_events(spark):
    """The aggregate over the events hashes; only the combined rows are sort-aggregated."""
    d = Deployment.of(spark, SF_DIR)
    text = d.spark.sparkContext._jvm.PythonSQLUtils.explainString(
        sessions.sessions(d.staged, d.cfg)._jdf.queryExecution(), "simple"
    )
    lines = [line for line in text.splitlines() if "Aggregate" in line]
    assert "HashAggregate" in lines[-1] and "HashAggregate" in lines[-2]


@pytest.mark.parametrize("name", sorted(MARTS))
def test_events_are_combined_before_they_are_copied_for_totals(spark, name):
    """Below every Expand of staged events or sessions there is a shuffle of combined rows."""
    d = Deployment.of(spark, SF_DIR)
    before = spark.conf.get("spark.sql.maxMetadataStringLength")
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")  # else a scan's line does not name its table
    try:
        text = d.spark.sparkContext._jvm.PythonSQLUtils.explainString(d.mart(name)._jdf.queryExecution(), "simple")
    finally:
        spark.conf.set("spark.sql.maxMetadataStringLength", before)
    below_expand, seen = False, 0
    for line in text.splitlines():
        if "Exchange" in line:
            below_expand = False
        elif "Expand [" in line:
            below_expand = True
        elif "FileScan" in line:
            stored = "/staged_events/" in line or "/sessions/" in line
            seen += stored
            assert not (below_expand and stored), name
            below_expand = False
    assert seen


def test_export_moves_flat_rows(spark, tmp_path):
    """What is dealt out to the shards are flat rows; written and read back, they are the raw events of each family."""
    flat = adapter.flat_events(spark, SF_DIR)
    dealt = adapter.dealt_events(flat)
    assert not {"event_params", "items", "device"} & set(dealt.columns)
    plan = adapter.nested_events(dealt, "family")._jdf.queryExecution().optimizedPlan().toString()
    assert "item_params" not in plan[plan.index("RebalancePartitions") :]
    adapter.write_export(flat, str(tmp_path))
    raw = adapter.raw_events(spark, SF_DIR)
    for family in ("daily", "intraday"):
        stored = read_shards(spark, adapter.family_path(str(tmp_path), family))
        wanted = adapter.family_rows(raw, family).select(*stored.columns)
        key = F.xxhash64(*[F.to_json(F.struct(c)) for c in stored.columns if c != "shard_date"])
        keys = [sorted(r[0] for r in df.select(key).collect()) for df in (stored, wanted)]
        assert keys[0] == keys[1] and keys[0]


def test_shuffles_are_cut_small(spark):
    """100 MB of shuffled rows go to several tasks, and the count to start with follows the tables for later queries too."""
    wide = spark.range(1_500_000).select(*[F.xxhash64("id", F.lit(k)).alias(f"c{k}") for k in range(8)])
    assert wide.groupBy(*wide.columns).count().rdd.getNumPartitions() > 2
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    before = spark.conf.get(key, None)
    try:
        n = size_shuffles(spark.range(1 << 30))
        assert n >= (8 << 30) // (16 << 20) and spark.conf.get(key) == str(n)
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def test_scans_are_cut_small(spark, tmp_path):
    """A task reads 32 MB of a file at most, however few tasks the tables' size asks for."""
    wide = spark.range(0, 700_000, 1, 1).select(*[F.xxhash64("id", F.lit(k)).alias(f"c{k}") for k in range(8)])
    wide.write.parquet(str(tmp_path / "wide"))
    key = "spark.sql.files.minPartitionNum"
    spark.conf.set(key, 1)
    try:
        assert spark.read.parquet(str(tmp_path / "wide")).rdd.getNumPartitions() > 1
    finally:
        spark.conf.unset(key)
