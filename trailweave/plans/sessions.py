"""Session table: one row per user and session id."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import EngineConfig
from ..functions import metrics as m
from ..functions.text import UNKNOWN
from ..operators.incremental import append_new_keys, since
from .session_index import REF, SessionIndex, session_ref

SESSION = """
    session_key string,
    user_pseudo_id string,
    ga_session_id bigint,
    session_number bigint,
    session_start timestamp,
    session_end timestamp,
    duration_seconds bigint,
    is_bounced_flag int,
    is_bounced_3cond int,
    events bigint,
    pageviews bigint,
    product_views bigint,
    cart_additions bigint,
    wishlist_additions bigint,
    purchase_events bigint,
    engagement_time_msec bigint,
    device_category string,
    device_class string,
    channel_group string,
    manual_source string,
    manual_medium string,
    geo_city string,
    geo_region string,
    geo_country string,
    session_date date
    """

COLUMNS = (
    "session_key",
    "user_pseudo_id",
    "ga_session_id",
    "session_number",
    "session_date",
    "session_start",
    "session_end",
    "duration_seconds",
    "is_bounced_flag",
    "is_bounced_3cond",
    "events",
    "pageviews",
    "product_views",
    "cart_additions",
    "wishlist_additions",
    "purchase_events",
    "engagement_time_msec",
    "device_category",
    "device_class",
    "channel_group",
    "manual_source",
    "manual_medium",
    "geo_city",
    "geo_region",
    "geo_country",
)

SESSION_ID = ["user_pseudo_id", "ga_session_id"]

# session-scoped dimensions, with the placeholder that any known value beats
_PLACEHOLDERS = {
    "device_category": None,
    "device_class": UNKNOWN,
    "channel_group": "Unassigned",
    "manual_source": None,
    "manual_medium": None,
    "geo_city": UNKNOWN,
    "geo_region": UNKNOWN,
    "geo_country": UNKNOWN,
}
_COUNTERS = {
    "pageviews": "page_view",
    "product_views": "view_item",
    "cart_additions": "add_to_cart",
    "wishlist_additions": "add_to_wishlist",
    "purchase_events": "purchase",
}


def known_max(column: str, placeholder: str | None) -> Column:
    """Largest value, a known one always beating the placeholder."""
    if placeholder is None:
        return F.max(column).alias(column)
    known = F.max(F.nullif(F.col(column), F.lit(placeholder)))
    return F.coalesce(known, F.lit(placeholder)).alias(column)


def sessions(
    staged: DataFrame,
    cfg: EngineConfig,
    incremental: bool = False,
    stored: DataFrame | None = None,
    index: SessionIndex | None = None,
) -> DataFrame:
    """Sessions of the staged events.

    Incremental: the scan reaches one day behind the window, so a session over its edge is
    seen whole, and only sessions starting inside the window come out. ``stored`` is the
    present session table; a session it already holds with an earlier start, one that paused
    over the whole extra day, is not emitted a second time. With an ``index`` of that table the
    lookup reads the buckets of the run's own sessions only, and moves no stored row.

    Built in two steps. The events are first combined per session and dimension values:
    those hardly vary within a session, and with the texts in the key all aggregates are
    numbers, which hash aggregation can hold. The maximum of a text needs sorting, and is
    left to the few combined rows.
    """
    boundary = cfg.lookback_date if incremental else None
    scan_from = boundary - timedelta(days=1) if boundary else None
    combined = (
        since(staged, "event_date", scan_from)
        .where(F.col("ga_session_id").isNotNull())
        # the session key is a function of these two, so it need not widen the grouping key
        .groupBy(*SESSION_ID, *_PLACEHOLDERS)
        .agg(
            F.max("ga_session_number").alias("session_number"),
            F.min("event_date").alias("session_date"),
            F.min("event_timestamp").alias("session_start"),
            F.max("event_timestamp").alias("session_end"),
            F.count_if(F.col("session_engaged") == "1").alias("engaged_events"),
            F.count("*").alias("events"),
            *[F.count_if(m.is_event(event)).alias(name) for name, event in _COUNTERS.items()],
            F.sum(F.coalesce("engagement_time_msec", F.lit(0))).alias("engagement_time_msec"),
        )
    )
    sums = ("engaged_events", "events", *_COUNTERS, "engagement_time_msec")
    built = (
        combined.groupBy(*SESSION_ID)
        .agg(
            F.max("session_number").alias("session_number"),
            F.min("session_date").alias("session_date"),
            F.min("session_start").alias("session_start"),
            F.max("session_end").alias("session_end"),
            *[F.sum(c).alias(c) for c in sums],
            *[known_max(c, placeholder) for c, placeholder in _PLACEHOLDERS.items()],
        )
        .withColumns(
            {
                "session_key": m.session_key(),
                "duration_seconds": m.seconds_between(F.col("session_start"), F.col("session_end")),
                "is_bounced_flag": m.flag_bounce(F.col("engaged_events")),
            }
        )
        .withColumn(
            "is_bounced_3cond",
            m.conditions_bounce(F.col("duration_seconds"), F.col("pageviews"), F.col("purchase_events")),
        )
    )
    fresh = since(built, "session_date", boundary)
    if boundary and index is not None:
        seen = since(staged, "event_date", scan_from).where(F.col("ga_session_id").isNotNull())
        fresh = index.unknown(fresh, boundary, seen.select(session_ref().alias(REF)))
    elif boundary and stored is not None:
        fresh = append_new_keys(fresh, stored.where(F.col("session_date") < F.lit(boundary)), SESSION_ID)
    return fresh.select(*COLUMNS)
