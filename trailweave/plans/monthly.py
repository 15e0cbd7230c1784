"""Monthly marts: channel, device and city performance, and the two funnels.

Each takes staged events and, where there is one, the base combined from them in their place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import EngineConfig
from ..functions import metrics as m
from ..functions.calendar import days_elapsed, month_start
from ..functions.text import city_state_country
from ..operators.incremental import since
from ..operators.rollup import IS_TOTAL, row_sort, total_rollup
from .monthly_base import BaseSource, StagedSource
from .reach import carry, keys_of, session_quality, visit_reach

MONTH = ["month"]


def _monthly(df: DataFrame, day: str, cfg: EngineConfig, incremental: bool) -> DataFrame:
    """Adds the month; an incremental run starts at the first month the window touches."""
    boundary = cfg.month_boundary if incremental else None
    return since(df, day, boundary).withColumn("month", month_start(F.col(day)))


def _source(
    staged: DataFrame, cfg: EngineConfig, incremental: bool, base: BaseSource | None
) -> StagedSource | BaseSource:
    if base is None:
        return StagedSource(_monthly(staged, "event_date", cfg, incremental))
    return base.each(lambda df: since(df, "month", cfg.month_boundary if incremental else None))


def _share_of_rows(column: str) -> Column:
    """Share of the sum over the month's own rows, which always adds up to 100."""
    own = F.when(F.col(IS_TOTAL) == 1, F.lit(0)).otherwise(F.col(column))
    return m.pct(F.col(column), F.sum(own).over(Window.partitionBy("month")))


def _share_of_total(column: str) -> Column:
    """Share of the month's total row."""
    total = F.max(F.when(F.col(IS_TOTAL) == 1, F.col(column))).over(Window.partitionBy("month"))
    return m.pct(F.col(column), total)


def _ticket_sizes() -> list[Column]:
    return [
        m.ratio(F.col(f"revenue_{c}"), F.col("orders")).alias(f"ticket_size_{c}") for c in ("local", "usd")
    ]


def _orders() -> Column:
    """Orders of the joined order side; groups without purchases have none."""
    return F.coalesce("orders", F.lit(0)).alias("orders")


def _revenue() -> dict[str, Column]:
    """Rounded before anything is divided by it."""
    return {c: m.money(F.col(c)) for c in ("revenue_local", "revenue_usd")}


def channel_performance(
    staged: DataFrame,
    sessions: DataFrame,
    cfg: EngineConfig,
    incremental: bool = False,
    base: BaseSource | None = None,
) -> DataFrame:
    """Month by marketing channel, with the month's Total row."""
    dims = ["marketing_channel"]
    keys = keys_of(MONTH, dims)
    source = _source(staged, cfg, incremental, base).renamed({"channel_group": dims[0]})
    visits = _monthly(sessions, "session_date", cfg, incremental).withColumnRenamed("channel_group", dims[0])

    counters = ("product_views", "cart_additions", "revenue_local", "revenue_usd")
    per_user = total_rollup(
        source.rows,
        MONTH,
        dims,
        *source.counts(product_views="view_item", cart_additions="add_to_cart"),
        *source.revenue(),
        grain=["user_pseudo_id"],
    )
    known = F.col("user_pseudo_id").isNotNull()
    event_side = per_user.groupBy(*keys).agg(
        F.count("user_pseudo_id").alias("unique_visitors"),
        F.count_if(known & (F.col("product_views") > 0)).alias("unique_product_viewers"),
        F.count_if(known & (F.col("cart_additions") > 0)).alias("unique_cart_users"),
        *carry(*counters),
    )
    session_side = session_quality(
        visits,
        MONTH,
        dims,
        F.count("*").alias("visits"),
        F.sum("duration_seconds").alias("duration_seconds"),
    ).withColumn("avg_time_on_site_secs", m.ratio(F.col("duration_seconds"), F.col("visits")))
    return (
        event_side.join(session_side, keys, "left")
        .join(source.orders(MONTH, dims), keys, "left")
        .join(source.items(MONTH, dims), keys, "left")
        .withColumns({"visits": F.coalesce("visits", F.lit(0)), "orders": _orders(), **_revenue()})
        .select(
            "month",
            "marketing_channel",
            "visits",
            "unique_visitors",
            "avg_time_on_site_secs",
            "bounce_rate_flag_pct",
            "bounce_rate_3cond_pct",
            "product_views",
            "cart_additions",
            "orders",
            "revenue_local",
            "revenue_usd",
            m.pct(F.col("orders"), F.col("visits"), 4).alias("conversion_pct"),
            "unique_product_viewers",
            "unique_cart_users",
            "unique_product_view",
            "unique_cart",
            _share_of_rows("unique_visitors").alias("traffic_contribution_pct"),
            _share_of_rows("orders").alias("order_contribution_pct"),
            *_ticket_sizes(),
            row_sort(),
        )
    )


def device_performance(
    staged: DataFrame,
    sessions: DataFrame,
    cfg: EngineConfig,
    incremental: bool = False,
    base: BaseSource | None = None,
) -> DataFrame:
    """Month by device class, with the month's Total row; traffic is sessions."""
    dims = ["device_class"]
    keys = keys_of(MONTH, dims)
    source = _source(staged, cfg, incremental, base)
    event_side = total_rollup(
        source.rows,
        MONTH,
        dims,
        *source.counts(product_views="view_item", add_to_cart="add_to_cart"),
        source.quantity(),
        *source.revenue(),
    )
    session_side = session_quality(
        _monthly(sessions, "session_date", cfg, incremental), MONTH, dims, F.count("*").alias("traffic")
    )
    return (
        event_side.join(session_side, keys, "left")
        .join(source.orders(MONTH, dims), keys, "left")
        .join(source.items(MONTH, dims), keys, "left")
        .withColumns({"traffic": F.coalesce("traffic", F.lit(0)), "orders": _orders()})
        .withColumns({c: m.money(F.col(c)) for c in ("revenue_local", "revenue_usd")})
        .select(
            "month",
            "device_class",
            "traffic",
            "product_views",
            "add_to_cart",
            "bounce_rate_flag_pct",
            "bounce_rate_3cond_pct",
            "orders",
            "quantity",
            "revenue_local",
            "revenue_usd",
            m.pct(F.col("orders"), F.col("traffic"), 4).alias("conversion_pct"),
            *_ticket_sizes(),
            _share_of_total("revenue_usd").alias("contribution_pct"),
            "unique_product_view",
            "unique_cart",
            _share_of_total("traffic").alias("traffic_contribution_pct"),
            m.pct(F.col("unique_product_view"), F.col("traffic")).alias("product_view_per_traffic_pct"),
            m.pct(F.col("unique_cart"), F.col("unique_product_view")).alias("cart_per_product_view_pct"),
            row_sort(),
        )
    )


def city_performance(
    staged: DataFrame,
    sessions: DataFrame,
    cfg: EngineConfig,
    incremental: bool = False,
    base: BaseSource | None = None,
) -> DataFrame:
    """Month by city, with the month's Total row; contribution is the share of users."""
    dims = ["city", "state", "country"]
    keys = keys_of(MONTH, dims)
    places = {"geo_city": "city", "geo_region": "state", "geo_country": "country"}
    source = _source(staged, cfg, incremental, base).renamed(places)
    visits = _monthly(sessions, "session_date", cfg, incremental).withColumnsRenamed(places)

    counts = dict(product_detail_views="view_item", add_to_wishlist="add_to_wishlist", add_to_cart="add_to_cart")
    event_side = visit_reach(
        source.rows,
        MONTH,
        dims,
        [*source.counts(**counts), *source.revenue()],
        [*counts, "revenue_local", "revenue_usd"],
    ).withColumnsRenamed({"users": "unique_visitors", "sessions": "visits"})
    label = F.when(F.col(IS_TOTAL) == 1, F.lit("Total")).otherwise(
        city_state_country(*[F.col(d) for d in dims])
    )
    return (
        event_side.join(session_quality(visits, MONTH, dims), keys, "left")
        .join(source.orders(MONTH, dims), keys, "left")
        .withColumns({"orders": _orders(), **_revenue()})
        .select(
            "month",
            label.alias("city_display"),
            *dims,
            "visits",
            "unique_visitors",
            "product_detail_views",
            "add_to_wishlist",
            "add_to_cart",
            "orders",
            "revenue_local",
            "revenue_usd",
            "bounce_rate_flag_pct",
            "bounce_rate_3cond_pct",
            m.pct(F.col("orders"), F.col("visits"), 4).alias("conversion_pct"),
            _share_of_total("unique_visitors").alias("contribution_pct"),
            *_ticket_sizes(),
            m.pct(F.col("add_to_cart"), F.col("product_detail_views")).alias("ac_vs_pv_pct"),
            m.ratio(
                F.col("unique_visitors"),
                days_elapsed(F.col("month"), F.last_day("month"), cfg.as_of_date),
            ).alias("auv"),
            row_sort(),
        )
    )


def _funnel(event_side: DataFrame, sessions: DataFrame, cfg: EngineConfig, incremental: bool) -> DataFrame:
    keys = keys_of(MONTH, ["device_class"])
    # one row per session, so counting non-NULL keys counts distinct sessions
    session_side = total_rollup(
        _monthly(sessions, "session_date", cfg, incremental),
        MONTH,
        ["device_class"],
        F.count("session_key").alias("visits"),
    )
    return (
        event_side.join(session_side, keys, "left")
        .withColumn("visits", F.coalesce("visits", F.lit(0)))
        .select(
            "month",
            "device_class",
            "visits",
            "product_views",
            "cart",
            "orders",
            m.pct(F.col("cart"), F.col("product_views")).alias("cart_per_prod_view"),
            m.pct(F.col("orders"), F.col("cart")).alias("order_per_cart"),
            m.pct(F.col("orders"), F.col("visits"), 4).alias("conversion"),
            row_sort(),
        )
    )


def funnel_users(
    staged: DataFrame,
    sessions: DataFrame,
    cfg: EngineConfig,
    incremental: bool = False,
    base: BaseSource | None = None,
) -> DataFrame:
    """Open funnel by month and device class, counting distinct users at each step."""
    steps = dict(product_views="view_item", cart="add_to_cart", orders="purchase")
    source = _source(staged, cfg, incremental, base)
    per_user = total_rollup(
        source.rows, MONTH, ["device_class"], *source.counts(**steps), grain=["user_pseudo_id"]
    )
    known = F.col("user_pseudo_id").isNotNull()
    event_side = per_user.groupBy(*keys_of(MONTH, ["device_class"])).agg(
        *[F.count_if(known & (F.col(s) > 0)).alias(s) for s in steps]
    )
    return _funnel(event_side, sessions, cfg, incremental)


def funnel_events(
    staged: DataFrame,
    sessions: DataFrame,
    cfg: EngineConfig,
    incremental: bool = False,
    base: BaseSource | None = None,
) -> DataFrame:
    """Open funnel by month and device class, counting events and distinct orders."""
    source = _source(staged, cfg, incremental, base)
    counts = source.counts(product_views="view_item", cart="add_to_cart")
    event_side = (
        total_rollup(source.rows, MONTH, ["device_class"], *counts)
        .join(source.orders(MONTH, ["device_class"]), keys_of(MONTH, ["device_class"]), "left")
        .withColumn("orders", _orders())
    )
    return _funnel(event_side, sessions, cfg, incremental)
