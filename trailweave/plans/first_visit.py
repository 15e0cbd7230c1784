"""First-visit dimension: one row per user."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import EngineConfig
from ..functions import metrics as m
from ..functions.calendar import week_start
from ..operators.incremental import since
from ..operators.versions import VersionedTable, bucket_of, touched

FIRST_VISIT = "user_pseudo_id string, first_visit_date date, first_visit_week date"


def first_visits(staged: DataFrame, cfg: EngineConfig, incremental: bool = False) -> DataFrame:
    """Earliest date on which the user's first visit, or first session, was recorded."""
    boundary = cfg.lookback_date if incremental else None
    firsts = (
        since(staged, "event_date", boundary)
        .where(F.col("user_pseudo_id").isNotNull())
        .where(m.is_event("first_visit") | (F.col("ga_session_number") == 1))
    )
    return _earliest(firsts.select("user_pseudo_id", F.col("event_date").alias("first_visit_date")), cfg)


def merge_first_visits(existing: DataFrame, fresh: DataFrame, cfg: EngineConfig) -> DataFrame:
    """Keyed merge that keeps the earlier date.

    Replacing the stored date outright would move a user's first visit forward when their
    first session reaches into a later window; the minimum makes a series of incremental
    runs equal one full build.
    """
    return _earliest(existing.unionByName(fresh), cfg)


def _earliest(dates: DataFrame, cfg: EngineConfig) -> DataFrame:
    return (
        dates.groupBy("user_pseudo_id")
        .agg(F.min("first_visit_date").alias("first_visit_date"))
        .withColumn("first_visit_week", week_start(F.col("first_visit_date"), cfg.week_start_day))
    )


def commit_first_visits(table: VersionedTable, fresh: DataFrame, cfg: EngineConfig, incremental: bool = False) -> None:
    """Store ``fresh`` in buckets of the user; an incremental run rewrites those in which something changes.

    Stored users are looked up in the buckets of the fresh ones, by user and date alone. Most users
    seen in a window are known with an earlier date and change nothing.
    """
    user, buckets = "user_pseudo_id", cfg.user_buckets
    fresh = fresh.withColumn("bucket", bucket_of(user, buckets))
    if not incremental:
        table.commit(fresh)
        return
    stored = table.read()
    near = stored.where(F.col("bucket").isin(list(touched(fresh, user, buckets))))
    known = near.select(F.col(user).alias("known"), F.col("first_visit_date").alias("stored"))
    changed = fresh.join(known, F.col(user) == F.col("known"), "left").where("stored IS NULL OR first_visit_date < stored")
    changed = changed.select(fresh.columns)
    rewritten = touched(changed, user, buckets)
    if not rewritten:
        return
    before = stored.where(F.col("bucket").isin(list(rewritten))).drop("bucket")
    merged = merge_first_visits(before, changed.drop("bucket"), cfg).withColumn("bucket", bucket_of(user, buckets))
    names = {f"bucket={n}" for n in rewritten}
    table.commit(merged, lambda partition: partition in names)
