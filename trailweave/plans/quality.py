"""Data-quality checks. Each returns its failing rows; an empty result is a pass."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import EngineConfig
from ..functions import metrics as m
from ..functions.nested import items_revenue_usd
from ..operators.incremental import since
from ..sources.export import shard_dates


def export_freshness(daily: DataFrame, intraday: DataFrame, cfg: EngineConfig) -> DataFrame:
    """Fails when the newest covered date is older than yesterday, or there is none."""
    covered = shard_dates(daily).unionByName(shard_dates(intraday))
    stale = F.col("newest_covered_date").isNull() | (F.col("newest_covered_date") < F.lit(cfg.days_ago(1)))
    newest = F.max(F.to_date("shard_date", "yyyyMMdd")).alias("newest_covered_date")
    return covered.agg(newest, F.lit(cfg.as_of_date).alias("checked_at")).where(stale)


def export_continuity(
    spark: SparkSession, daily: DataFrame, intraday: DataFrame, cfg: EngineConfig
) -> DataFrame:
    """One row per day of the last week that neither shard family covers."""
    first = cfg.days_ago(8).strftime("%Y%m%d")
    covered = (
        shard_dates(daily.where(F.col("shard_date") >= first))
        .unionByName(shard_dates(intraday.where(F.col("shard_date") >= first)))
        .select("shard_date")
        .distinct()
    )
    days = F.sequence(F.lit(cfg.days_ago(7)), F.lit(cfg.days_ago(1)))
    return (
        spark.range(1)
        .select(F.explode(days).alias("missing_date"))
        .withColumn("shard_date", F.date_format("missing_date", "yyyyMMdd"))
        .join(covered, "shard_date", "left_anti")
        .select("missing_date")
    )


def staging_reconciles_raw(daily: DataFrame, staged: DataFrame, cfg: EngineConfig) -> DataFrame:
    """One row per date of the window on which staging and the daily shard disagree."""
    raw_side = (
        daily.where(F.col("shard_date") >= cfg.lookback_suffix)
        .groupBy(F.to_date("event_date", "yyyyMMdd").alias("event_date"))
        .agg(F.count("*").alias("raw_rows"))
        .where(F.col("event_date") >= F.lit(cfg.lookback_date))
    )
    staged_side = (
        since(staged, "event_date", cfg.lookback_date)
        .groupBy("event_date")
        .agg(F.count("*").alias("stg_rows"), F.count_distinct("shard_type").alias("shard_types"))
    )
    return raw_side.join(staged_side, "event_date").where(
        (F.col("raw_rows") != F.col("stg_rows")) | (F.col("shard_types") > 1)
    )


def user_id_completeness(staged: DataFrame, cfg: EngineConfig) -> DataFrame:
    """Fails when the share of events without a user id passes the tolerance."""
    share = m.safe_divide(F.col("null_pseudo_ids") * 100, F.col("events_in_window"))
    return (
        since(staged, "event_date", cfg.lookback_date)
        .agg(
            F.count("*").alias("events_in_window"),
            F.count_if(F.col("user_pseudo_id").isNull()).alias("null_pseudo_ids"),
        )
        .where(share > cfg.max_null_user_pct)
        .withColumn("null_pct", m.round_half_up(share, 2))
    )


def transaction_id_completeness(staged: DataFrame, cfg: EngineConfig) -> DataFrame:
    """One row per purchase of the window that cannot be tied to an order."""
    tx = F.col("transaction_id")
    return (
        since(staged, "event_date", cfg.lookback_date)
        .where(m.is_event("purchase") & (tx.isNull() | tx.isin("", "(not set)")))
        .select("event_date", "event_timestamp", "user_pseudo_id", "transaction_id", "revenue_usd")
    )


def transaction_revenue_consistency(staged: DataFrame, cfg: EngineConfig) -> DataFrame:
    """Negative or mismatching revenue per event, and ids shared by users or amounts."""
    usd, items_usd = F.col("revenue_usd"), F.col("items_revenue_usd")
    purchases = (
        since(staged, "event_date", cfg.lookback_date)
        .where(m.is_event("purchase") & (F.col("transaction_id") != ""))
        .select("transaction_id", "user_pseudo_id", "revenue_usd", items_revenue_usd().alias("items_revenue_usd"))
    )
    event_level = purchases.where(
        (usd < 0) | ((usd > 0) & (items_usd > 0) & (F.abs(usd - items_usd) > usd * 0.25))
    ).select(
        "transaction_id",
        F.lit("negative or header/items mismatch").alias("issue"),
        usd.cast("string").alias("detail"),
    )
    users, amounts = F.col("users"), F.col("amounts")
    id_level = (
        purchases.groupBy("transaction_id")
        .agg(
            F.count_distinct("user_pseudo_id").alias("users"),
            F.count_distinct(F.coalesce("revenue_usd", F.lit(0.0))).alias("amounts"),
        )
        .where((users > 1) | (amounts > 1))
        .select(
            "transaction_id",
            F.lit("transaction id shared across users or amounts").alias("issue"),
            F.concat(users.cast("string"), F.lit(" users / "), amounts.cast("string"), F.lit(" amounts")).alias("detail"),
        )
    )
    return event_level.unionByName(id_level)


def session_engagement_coverage(staged: DataFrame, cfg: EngineConfig) -> DataFrame:
    """Fails when too many sessions of the window never carried the engagement parameter."""
    # events without a user id share one unnamed session
    named = F.col("user_pseudo_id").isNotNull()
    covered = (
        since(staged, "event_date", cfg.lookback_date)
        .where(F.col("ga_session_id").isNotNull())
        .groupBy("user_pseudo_id", F.when(named, F.col("ga_session_id")).alias("ga_session_id"))
        .agg(F.max(F.col("session_engaged").isNotNull()).alias("has_param"))
    )
    share = m.safe_divide(F.col("sessions_missing_param") * 100, F.col("sessions_in_window"))
    return (
        covered.agg(
            F.count("*").alias("sessions_in_window"),
            F.count_if(~F.col("has_param")).alias("sessions_missing_param"),
        )
        .where(share > cfg.max_missing_engagement_pct)
        .withColumn("missing_pct", m.round_half_up(share, 2))
    )


def event_volume_collapse(staged: DataFrame, cfg: EngineConfig) -> DataFrame:
    """Fails when each of the three newest days fell below a share of the median day before."""
    volume = (
        since(staged, "event_date", cfg.days_ago(31)).groupBy("event_date").agg(F.count("*").alias("events"))
    )
    # both inputs come from at most 32 daily counts
    baseline = volume.where(F.col("event_date") < F.lit(cfg.days_ago(3))).agg(
        F.percentile_approx("events", 0.5, 10_000).alias("median_events")
    )
    recent = volume.orderBy(F.col("event_date").desc()).limit(3)
    return (
        recent.agg(
            F.min("event_date").alias("collapse_from"),
            F.max("event_date").alias("collapse_to"),
            F.max("events").alias("busiest_recent_day"),
            F.count("*").alias("days"),
        )
        .withColumn("median_events", baseline.scalar())
        .where(
            (F.col("days") == 3)
            & (F.col("busiest_recent_day") < F.col("median_events") * cfg.min_volume_vs_median_pct / 100)
        )
        .drop("days")
    )


def all_checks(
    spark: SparkSession, daily: DataFrame, intraday: DataFrame, staged: DataFrame, cfg: EngineConfig
) -> dict[str, DataFrame]:
    """Every stand-alone check by name."""
    return {
        "export_freshness": export_freshness(daily, intraday, cfg),
        "export_continuity": export_continuity(spark, daily, intraday, cfg),
        "staging_reconciles_raw": staging_reconciles_raw(daily, staged, cfg),
        "user_id_completeness": user_id_completeness(staged, cfg),
        "transaction_id_completeness": transaction_id_completeness(staged, cfg),
        "transaction_revenue_consistency": transaction_revenue_consistency(staged, cfg),
        "session_engagement_coverage": session_engagement_coverage(staged, cfg),
        "event_volume_collapse": event_volume_collapse(staged, cfg),
    }


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values held by more than one row."""
    return df.groupBy(*keys).agg(F.count("*").alias("row_count")).where(F.col("row_count") > 1)


def null_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows in which a mandatory column is NULL."""
    missing = F.lit(False)
    for c in columns:
        missing = missing | F.col(c).isNull()
    return df.where(missing)


def broken_conditions(df: DataFrame, conditions: Sequence[str]) -> DataFrame:
    """Rows breaking a condition, with the condition; an undecided (NULL) one passes.

    All conditions are tested in one pass over the table.
    """
    broken = F.array_compact(F.array(*[F.when(~F.expr(c), F.lit(c)) for c in conditions]))
    return df.withColumn("failed_condition", F.explode(broken))
