"""Typed event table: merge of the shard families, parameter extraction and cleaning."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import EngineConfig
from ..functions import nested as n
from ..functions import text as t
from ..sources.export import uncovered_intraday
from ..sources.schema import PHYSICAL_KEY

STAGED_EVENT = """
    event_timestamp timestamp,
    event_name string,
    user_pseudo_id string,
    ga_session_id bigint,
    ga_session_number bigint,
    session_engaged string,
    engagement_time_msec bigint,
    page_location string,
    page_path string,
    page_title string,
    page_type string,
    device_category string,
    device_class string,
    platform string,
    hostname string,
    geo_city string,
    geo_region string,
    geo_country string,
    channel_group string,
    manual_source string,
    manual_medium string,
    transaction_id string,
    revenue_local double,
    revenue_usd double,
    item_quantity bigint,
    items array<struct<
        item_id: string,
        item_name: string,
        item_category: string,
        item_category_3: string,
        quantity: bigint,
        item_revenue: double,
        item_revenue_in_usd: double,
        item_list_name: string
    >>,
    shard_type string,
    item_list_name string,
    event_date date
    """

COLUMNS = (
    "event_date",
    "event_timestamp",
    "event_name",
    "user_pseudo_id",
    "ga_session_id",
    "ga_session_number",
    "session_engaged",
    "engagement_time_msec",
    "page_location",
    "page_path",
    "page_title",
    "page_type",
    "device_category",
    "device_class",
    "platform",
    "hostname",
    "geo_city",
    "geo_region",
    "geo_country",
    "channel_group",
    "manual_source",
    "manual_medium",
    "transaction_id",
    "revenue_local",
    "revenue_usd",
    "item_quantity",
    "items",
    "shard_type",
    "item_list_name",
)


def typed_events(raw: DataFrame, *keep: str) -> DataFrame:
    """Raw rows to staged columns, one to one. ``keep`` carries raw columns along as ``raw_<name>``."""
    campaign = F.col("session_traffic_source_last_click")
    manual = campaign.getField("manual_campaign")
    category = F.col("device.category")
    return raw.select(
        F.to_date("event_date", "yyyyMMdd").alias("event_date"),
        F.timestamp_micros("event_timestamp").alias("event_timestamp"),
        "event_name",
        "user_pseudo_id",
        n.param_int("ga_session_id").alias("ga_session_id"),
        n.param_int("ga_session_number").alias("ga_session_number"),
        n.param_any("session_engaged").alias("session_engaged"),
        n.param_int("engagement_time_msec").alias("engagement_time_msec"),
        n.param_string("page_location").alias("page_location"),
        t.page_path(n.param_string("page_location")).alias("page_path"),
        n.param_string("page_title").alias("page_title"),
        t.page_type(n.param_string("page_type")).alias("page_type"),
        category.alias("device_category"),
        t.device_class(F.col("platform"), category).alias("device_class"),
        "platform",
        F.col("device.web_info.hostname").alias("hostname"),
        t.geo_clean(F.col("geo.city")).alias("geo_city"),
        t.geo_clean(F.col("geo.region")).alias("geo_region"),
        t.geo_clean(F.col("geo.country")).alias("geo_country"),
        F.coalesce(
            campaign.getField("cross_channel_campaign").getField("primary_channel_group"), F.lit("Unassigned")
        ).alias("channel_group"),
        manual.getField("source").alias("manual_source"),
        manual.getField("medium").alias("manual_medium"),
        F.col("ecommerce.transaction_id").alias("transaction_id"),
        F.col("ecommerce.purchase_revenue").alias("revenue_local"),
        F.col("ecommerce.purchase_revenue_in_usd").alias("revenue_usd"),
        F.col("ecommerce.total_item_quantity").alias("item_quantity"),
        n.trim_items().alias("items"),
        n.first_list_name().alias("item_list_name"),
        *[F.col(c).alias(f"raw_{c}") for c in keep],
    )


def without_replays(raw: DataFrame) -> DataFrame:
    """Typed events with each physical event once.

    Typing comes first: what the deduplication then shuffles is the slim staged row, not the
    parameter arrays. Copies collapse within each task before the shuffle, so an event that
    was replayed millions of times does not pile up in one place.
    """
    extra = [c for c in PHYSICAL_KEY if c not in ("user_pseudo_id", "event_name", "event_timestamp")]
    key = ["user_pseudo_id", "event_name", "event_timestamp", *(f"raw_{c}" for c in extra)]
    return typed_events(raw, *extra).dropDuplicates(key).drop(*(f"raw_{c}" for c in extra))


def staged_events(
    daily: DataFrame, intraday: DataFrame, cfg: EngineConfig, incremental: bool = False
) -> DataFrame:
    """One row per event: the daily shard of a date where it landed, else its intraday shard."""
    if incremental:
        daily, intraday = (df.where(F.col("shard_date") >= cfg.lookback_suffix) for df in (daily, intraday))
    provisional = uncovered_intraday(daily, intraday)
    if incremental:
        # a late hit can sit in a fresh shard yet belong to a date before the window; compared
        # as text, yyyyMMdd like the suffix, the filter reaches the Parquet scan
        daily, provisional = (df.where(F.col("event_date") >= cfg.lookback_suffix) for df in (daily, provisional))
    final = typed_events(daily).withColumn("shard_type", F.lit("daily"))
    filler = without_replays(provisional).withColumn("shard_type", F.lit("intraday"))
    return final.unionByName(filler).select(*COLUMNS)
