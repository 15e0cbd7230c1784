"""Registered queries: each takes the deployment and returns a DataFrame.

Timestamps leave as microseconds and nested items as flat rows, so that results compare by
value with another engine.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import date
from functools import reduce
from uuid import uuid4

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trailweave.functions import calendar, channels, metrics, nested, text
from trailweave.operators.incremental import merge_by_key, replace_window
from trailweave.plans import first_visit, pages, quality, sessions, staging
from trailweave.plans.pipeline import MARTS
from trailweave.plans.rules import RULES
from trailweave.plans.session_index import SessionIndex
from trailweave.sources.export import uncovered_intraday
from trailweave.streaming.intraday import read_feed, read_intraday_stream, start_intraday_feed

from .deployment import Deployment

Query = Callable[[Deployment], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _micros(c: str) -> Column:
    return F.unix_micros(F.col(c))


# ---------------------------------------------------------------- sources


@query
def src_daily_wins_merge(d: Deployment) -> DataFrame:
    def rows(df: DataFrame, kind: str) -> DataFrame:
        return df.select("shard_date", F.lit(kind).alias("shard_type"), "event_name", "event_timestamp", "batch_ordering_id")

    return rows(d.daily, "daily").unionByName(rows(uncovered_intraday(d.daily, d.intraday), "intraday"))


@query
def src_shard_pruned(d: Deployment) -> DataFrame:
    return d.daily.where(F.col("shard_date") >= d.cfg.lookback_suffix).select(
        "shard_date", "event_date", "event_name", "event_timestamp", "batch_ordering_id"
    )


@query
def src_intraday_dedupe(d: Deployment) -> DataFrame:
    return staging.without_replays(d.intraday).select(
        "event_date", _micros("event_timestamp").alias("event_us"), "event_name", "user_pseudo_id", "ga_session_id", "page_title"
    )


# ---------------------------------------------------------------- nested values


@query
def nested_params(d: Deployment) -> DataFrame:
    return d.events.select(
        "batch_ordering_id",
        nested.param_int("ga_session_id").alias("ga_session_id"),
        nested.param_int("ga_session_number").alias("ga_session_number"),
        nested.param_any("session_engaged").alias("session_engaged"),
        nested.param_any("engagement_time_msec").alias("engagement_text"),
        nested.param_string("session_engaged").alias("engaged_string"),
        nested.param_string("page_location").alias("page_location"),
        nested.param_string("page_title").alias("page_title"),
        nested.param_any("scroll_depth").alias("scroll_depth"),
        nested.param_string("no_such_key").alias("absent"),
    )


@query
def nested_items_trim(d: Deployment) -> DataFrame:
    items = d.events.select("batch_ordering_id", F.explode(nested.trim_items()).alias("item"))
    return items.select("batch_ordering_id", "item.*")


@query
def nested_item_explode(d: Deployment) -> DataFrame:
    opened = d.staged.select(
        "event_date", "event_name", "user_pseudo_id", "ga_session_id", F.explode("items").alias("item")
    )
    return opened.select(
        "event_date",
        "event_name",
        metrics.session_key().alias("session_key"),
        F.concat("item.item_category", F.lit(" - "), "item.item_category_3").alias("product_category"),
        F.col("item.item_id").alias("item_id"),
        F.col("item.quantity").alias("quantity"),
        F.col("item.item_revenue_in_usd").alias("item_revenue_in_usd"),
    )


@query
def nested_item_params(d: Deployment) -> DataFrame:
    items = d.events.select("batch_ordering_id", F.explode("items").alias("item"))
    return items.select(
        "batch_ordering_id",
        F.col("item.item_id").alias("item_id"),
        nested.item_param_string("line", "item").alias("line"),
        nested.item_param_string("colour", "item").alias("colour"),
    )


@query
def nested_item_sum(d: Deployment) -> DataFrame:
    return d.events.select(
        "batch_ordering_id",
        nested.items_revenue_usd().alias("items_revenue_usd"),
        F.size(nested.trim_items()).cast("bigint").alias("n_items"),
        nested.first_list_name().alias("item_list_name"),
    )


# ---------------------------------------------------------------- metric library


@query
def metric_ratios(d: Deployment) -> DataFrame:
    views, carts, buys = (F.count_if(metrics.is_event(e)) for e in ("view_item", "add_to_cart", "purchase"))
    usd = metrics.money_sum(F.col("revenue_usd"), metrics.is_event("purchase"))
    return d.staged.groupBy("event_date", "device_class").agg(
        metrics.pct(carts, views).alias("cart_pct"),
        metrics.pct(buys, F.count("*"), 4).alias("purchase_pct"),
        metrics.ratio(views, carts).alias("views_per_cart"),
        metrics.ratio(F.count("*"), F.count_distinct("user_pseudo_id"), 3).alias("events_per_user"),
        metrics.money(usd).alias("revenue_usd"),
    )


@query
def metric_session_key(d: Deployment) -> DataFrame:
    return d.staged.groupBy(metrics.session_key().alias("session_key")).agg(F.count("*").alias("events"))


@query
def metric_orders(d: Deployment) -> DataFrame:
    return d.staged.groupBy("event_date").agg(
        metrics.distinct_orders().alias("orders"),
        metrics.distinct_orders(F.col("device_class") == "Desktop").alias("orders_desktop"),
        metrics.distinct_orders(F.col("revenue_usd") >= 100).alias("orders_large"),
    )


@query
def metric_bounce(d: Deployment) -> DataFrame:
    return (
        d.staged.where(F.col("ga_session_id").isNotNull())
        .groupBy("user_pseudo_id", "ga_session_id")
        .agg(
            metrics.duration_seconds().alias("duration_seconds"),
            metrics.bounced_by_flag().alias("by_flag"),
            metrics.bounced_by_conditions().alias("by_conditions"),
            metrics.bounced_by_conditions(custom_events=["first_visit", "add_to_cart"]).alias("by_custom"),
        )
    )


@query
def metric_bounce_rate(d: Deployment) -> DataFrame:
    return d.sessions.groupBy("session_date", "device_class").agg(
        metrics.bounce_rate_pct("is_bounced_flag", F.count("*")).alias("bounce_rate_flag_pct"),
        metrics.bounce_rate_pct("is_bounced_3cond", F.count("*"), 4).alias("bounce_rate_3cond_pct"),
    )


@query
def metric_channel_bucket(d: Deployment) -> DataFrame:
    bucket = channels.organic_paid_bucket(F.col("channel_group"))
    return d.staged.groupBy("channel_group", bucket.alias("bucket")).agg(F.count("*").alias("events"))


@query
def metric_legacy_channel(d: Deployment) -> DataFrame:
    legacy = channels.legacy_channel(F.col("manual_source"), F.col("manual_medium"))
    return d.staged.groupBy("manual_source", "manual_medium", legacy.alias("legacy_channel")).agg(
        F.count("*").alias("events")
    )


@query
def metric_calendar(d: Deployment) -> DataFrame:
    day = F.col("event_date")
    start, end = calendar.week_start(day), calendar.week_end(day)
    return d.staged.groupBy("event_date").agg(F.count("*").alias("events")).select(
        "event_date",
        "events",
        start.alias("week_start"),
        end.alias("week_end"),
        calendar.week_start(day, "SUNDAY").alias("sunday_week_start"),
        calendar.month_start(day).alias("month_start"),
        F.last_day(day).alias("month_end"),
        calendar.days_elapsed(start, end, d.cfg.as_of_date).cast("bigint").alias("week_days"),
        calendar.days_elapsed(calendar.month_start(day), F.last_day(day), d.cfg.as_of_date)
        .cast("bigint")
        .alias("month_days"),
        (day >= F.lit(d.cfg.lookback_date)).alias("in_window"),
        F.date_format(day, "yyyyMMdd").alias("suffix"),
        F.date_format(day, "MMM-yyyy").alias("month_label"),
        F.date_format(day, "dd MMM").alias("day_label"),
    )


@query
def metric_geo(d: Deployment) -> DataFrame:
    city, region, country = (F.col(f"geo.{c}") for c in ("city", "region", "country"))
    joint = text.geo_all_or_unknown(city, region, country)
    clean = [text.geo_clean(c) for c in (city, region, country)]
    return (
        d.events.select(
            *[c.alias(f"clean_{i}") for i, c in enumerate(clean)],
            *[c.alias(f"joint_{i}") for i, c in enumerate(joint)],
            text.city_state_country(*clean).alias("month_label"),
            text.city_comma_label(*joint).alias("week_label"),
        )
        .groupBy(*[f"{k}_{i}" for k in ("clean", "joint") for i in range(3)], "month_label", "week_label")
        .agg(F.count("*").alias("events"))
    )


@query
def metric_device_page_type(d: Deployment) -> DataFrame:
    raw_type = nested.param_string("page_type")
    return d.events.groupBy(
        "platform",
        F.col("device.category").alias("category"),
        text.device_class(F.col("platform"), F.col("device.category")).alias("device_class"),
        raw_type.alias("raw_type"),
        text.page_type(raw_type).alias("page_type"),
    ).agg(F.count("*").alias("events"))


@query
def metric_page_path(d: Deployment) -> DataFrame:
    location = nested.param_string("page_location")
    return d.events.groupBy(location.alias("location"), text.page_path(location).alias("path")).agg(
        F.count("*").alias("events")
    )


@query
def metric_list_segment(d: Deployment) -> DataFrame:
    return d.staged.groupBy(
        "item_list_name", text.last_path_segment(F.col("item_list_name")).alias("segment")
    ).agg(F.count("*").alias("events"))


# ---------------------------------------------------------------- silver tables


def _staged_out(df: DataFrame) -> DataFrame:
    def text(item: Column) -> Column:
        amounts = [item[c].cast("decimal(18,2)") for c in ("item_revenue", "item_revenue_in_usd")]
        plain = [item[c] for c in ("item_id", "item_name", "item_category", "item_category_3", "quantity", "item_list_name")]
        return F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit("-")) for c in (*plain, *amounts)])

    return df.withColumns(
        {"event_us": _micros("event_timestamp"), "items": F.array_join(F.transform("items", text), "; ")}
    ).drop("event_timestamp")


def _sessions_out(df: DataFrame) -> DataFrame:
    return df.withColumns({"start_us": _micros("session_start"), "end_us": _micros("session_end")}).drop(
        "session_start", "session_end"
    )


@query
def stg_events(d: Deployment) -> DataFrame:
    return _staged_out(d.staged)


@query
def int_sessions(d: Deployment) -> DataFrame:
    return _sessions_out(d.sessions)


@query
def int_first_visit(d: Deployment) -> DataFrame:
    return d.first_visits


# ---------------------------------------------------------------- marts

_GOLD = {
    "gold_weekly": "weekly_performance",
    "gold_channel": "channel_performance",
    "gold_device": "device_performance",
    "gold_city": "city_performance",
    "gold_product": "product_performance",
    "gold_plp_views": "plp_views_weekly",
    "gold_custom_page_views": "custom_page_views_weekly",
    "gold_city_depth": "city_browsing_depth_weekly",
    "gold_funnel_user": "funnel_users",
    "gold_funnel_events": "funnel_events",
}
for _key, _mart in _GOLD.items():
    QUERIES[_key] = lambda d, name=_mart: d.mart(name)


def _from_base(name: str) -> Query:
    """The report as the warehouse builds it, from the combined events of the monthly base."""
    return lambda d: d.warehouse.build_mart(name) if d.warehouse else d.mart(name)


for _key, _mart in _GOLD.items():
    if MARTS[_mart].from_base:
        QUERIES[_key.replace("gold_", "base_")] = _from_base(_mart)


@query
def gold_plp_views_until(d: Deployment) -> DataFrame:
    """The list-page report with its cut-off date set."""
    cfg = replace(d.cfg, plp_until_date=date(2024, 2, 1))
    return pages.plp_views_weekly(d.staged, d.sessions, cfg)


# ---------------------------------------------------------------- incremental runs

# The stored tables of these runs are one day older than the data.


def _earlier(d: Deployment) -> DataFrame:
    return d.staged.where(F.col("event_date") < F.lit(d.cfg.days_ago(1)))


@query
def inc_stg_window(d: Deployment) -> DataFrame:
    """A stale staged table, all of whose in-window rows are replaced."""
    fresh = staging.staged_events(d.daily, d.intraday, d.cfg, incremental=True)
    stale = d.staged.withColumn("page_title", F.lit("stale")).where(F.col("event_date") >= F.lit(d.cfg.lookback_date))
    before = d.staged.where(F.col("event_date") < F.lit(d.cfg.lookback_date))
    return _staged_out(replace_window(before.unionByName(stale), fresh, "event_date", d.cfg.lookback_date))


@query
def inc_sessions_window(d: Deployment) -> DataFrame:
    stored = sessions.sessions(_earlier(d), d.cfg)
    index = SessionIndex(d.spark, f"{d.root}/earlier-{uuid4().hex}", d.cfg.session_buckets)
    index.refresh(stored)
    fresh = sessions.sessions(d.staged, d.cfg, incremental=True, index=index)
    return _sessions_out(replace_window(stored, fresh, "session_date", d.cfg.lookback_date))


@query
def inc_first_visit_merge(d: Deployment) -> DataFrame:
    stored = first_visit.first_visits(_earlier(d), d.cfg)
    return first_visit.merge_first_visits(stored, first_visit.first_visits(d.staged, d.cfg, incremental=True), d.cfg)


@query
def inc_merge_by_key(d: Deployment) -> DataFrame:
    """Plain keyed merge: the first visit dates of the window replace the stored ones."""
    stored = first_visit.first_visits(_earlier(d), d.cfg)
    return merge_by_key(stored, first_visit.first_visits(d.staged, d.cfg, incremental=True), ["user_pseudo_id"])


def _window_run(name: str, column: str) -> Query:
    def run(d: Deployment) -> DataFrame:
        mart = MARTS[name]
        was = [first_visit.first_visits(_earlier(d), d.cfg)] if mart.needs_first_visits else []
        stored = mart.build(_earlier(d), sessions.sessions(_earlier(d), d.cfg), *was, d.cfg)
        fresh = d.mart(name, incremental=True)
        return replace_window(stored, fresh, column, mart.boundary(d.cfg))

    return run


for _key, _mart in _GOLD.items():
    if MARTS[_mart].partition is not None:
        QUERIES[_key.replace("gold_", "inc_") + "_window"] = _window_run(_mart, MARTS[_mart].partition)


# ---------------------------------------------------------------- quality checks
# Inputs or tolerances are set so that each check has something to report.


@query
def dq_freshness(d: Deployment) -> DataFrame:
    return quality.export_freshness(d.daily, d.intraday, replace(d.cfg, as_of_date=date(2024, 2, 17)))


@query
def dq_continuity(d: Deployment) -> DataFrame:
    return quality.export_continuity(d.spark, d.daily, d.intraday.where(F.lit(False)), d.cfg)


@query
def dq_reconcile(d: Deployment) -> DataFrame:
    """Staging that lost one kind of event."""
    lossy = d.staged.where(F.col("event_name") != "session_start")
    return quality.staging_reconciles_raw(d.daily, lossy, d.cfg)


@query
def dq_reconcile_double_load(d: Deployment) -> DataFrame:
    """Staging that holds daily and intraday rows of one date."""
    doubled = d.staged.unionByName(d.staged.withColumn("shard_type", F.lit("intraday")))
    return quality.staging_reconciles_raw(d.daily, doubled, d.cfg)


@query
def dq_user_id(d: Deployment) -> DataFrame:
    return quality.user_id_completeness(d.staged, replace(d.cfg, max_null_user_pct=0.1))


@query
def dq_tx_id(d: Deployment) -> DataFrame:
    found = quality.transaction_id_completeness(d.staged, d.cfg)
    return found.withColumn("event_us", _micros("event_timestamp")).drop("event_timestamp")


@query
def dq_tx_revenue(d: Deployment) -> DataFrame:
    return quality.transaction_revenue_consistency(d.staged, d.cfg)


@query
def dq_engagement(d: Deployment) -> DataFrame:
    return quality.session_engagement_coverage(d.staged, replace(d.cfg, max_missing_engagement_pct=5.0))


@query
def dq_volume(d: Deployment) -> DataFrame:
    """Staging that holds a fortieth of the last three days."""
    kept = F.col("event_date") < F.lit(date(2024, 2, 12))
    return quality.event_volume_collapse(d.staged.where(kept | (F.unix_seconds("event_timestamp") % 40 == 0)), d.cfg)


@query
def dq_unique_key(d: Deployment) -> DataFrame:
    """Sessions with the buying ones loaded twice."""
    doubled = d.sessions.unionByName(d.sessions.where(F.col("purchase_events") > 0))
    return quality.duplicate_keys(doubled, ["session_key"])


@query
def dq_non_null(d: Deployment) -> DataFrame:
    return _sessions_out(quality.null_columns(d.sessions, ["session_key", "user_pseudo_id", "session_date"]))


_CONDITIONS = ("duration_seconds >= 10", "pageviews <= events", "session_number <> 3", "manual_source <> 'google'")


@query
def dq_row_conditions(d: Deployment) -> DataFrame:
    return quality.broken_conditions(d.sessions, _CONDITIONS).select(
        "failed_condition", "session_key", "ga_session_id", "events"
    )


@query
def dq_model_rules(d: Deployment) -> DataFrame:
    """Every declared rule of every model; sessions without a user id break two of theirs."""
    tables = {"sessions": d.sessions, "first_visits": d.first_visits} | {name: d.stored_mart(name) for name in MARTS}
    found = [rules.violations(tables[name]).withColumn("model", F.lit(name)) for name, rules in RULES.items()]
    return reduce(DataFrame.unionByName, found)


# ---------------------------------------------------------------- streaming


@query
def stream_intraday(d: Deployment) -> DataFrame:
    """The intraday feed run to the end of the available shards, a file a batch, then read back."""
    out = f"{d.root}/stream-{d.spark.sparkContext.startTime}"
    feed = start_intraday_feed(
        read_intraday_stream(d.spark, d.intraday_path, max_files=1), f"{out}/events", f"{out}/checkpoint", available_now=True
    )
    feed.awaitTermination()
    return read_feed(d.spark, f"{out}/events").select(
        "event_date", _micros("event_timestamp").alias("event_us"), "event_name", "user_pseudo_id", "ga_session_id", "page_title"
    )
