"""Product category mart: closed months as months, the running month as weeks."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import EngineConfig
from ..functions import metrics as m
from ..functions.calendar import days_elapsed, month_start, week_end, week_start
from ..operators.incremental import since
from ..operators.rollup import IS_TOTAL, row_sort, total_rollup, with_totals
from .reach import carry, event_counts
from .session_index import FLAGS, REF, SessionIndex, session_ref
from .sessions import SESSION_ID

GRAND_TOTAL = "Grand Total"
_ITEM_COUNTS = dict(product_views="view_item", add_to_wishlist="add_to_wishlist", cart_additions="add_to_cart")


def period_spine(days: DataFrame, cfg: EngineConfig, boundary: date | None = None) -> DataFrame:
    """Reporting periods the event dates call for: each closed month, and the running month's weeks."""
    day = F.col("event_date")
    month, running = month_start(day), F.lit(cfg.month_floor(cfg.as_of_date))
    first, last = week_start(day, cfg.week_start_day), week_end(day, cfg.week_start_day)

    def period(start: Column, end: Column, label: Column, kind: str) -> Column:
        return F.struct(
            start.alias("period_start_date"),
            end.alias("period_end_date"),
            label.alias("period_label"),
            F.lit(kind).alias("period_type"),
        )

    week_label = F.concat(F.date_format(first, "dd MMM"), F.lit(" - "), F.date_format(last, "dd MMM"))
    periods = days.select(
        F.when(month < running, period(month, F.last_day(day), F.date_format(day, "MMM-yyyy"), "month"))
        .when(month == running, period(first, last, week_label, "week"))
        .alias("period")
    )
    spine = periods.where(F.col("period").isNotNull()).select("period.*").distinct()
    return since(spine, "period_start_date", boundary)


def product_performance(
    staged: DataFrame,
    sessions: DataFrame,
    cfg: EngineConfig,
    incremental: bool = False,
    last_closed_month: date | None = None,
    index: SessionIndex | None = None,
) -> DataFrame:
    """Period by product category, with a Grand Total row per period.

    Views, wishlist and cart additions count item rows. A week over the edge of the running
    month also holds days of the closed month before it. Categories are reported where some
    identified session touched them.
    """
    boundary = cfg.product_boundary(last_closed_month) if incremental else None
    events = since(staged, "event_date", boundary)
    spine = period_spine(events.select("event_date").distinct(), cfg, boundary)
    # one row per period and day: a date range join becomes an equi-join, and the broadcast
    # holds at most two rows per calendar day
    period_days = spine.select(
        "*", F.explode(F.sequence("period_start_date", "period_end_date")).alias("event_date")
    )
    period = ["period_start_date", "period_end_date", "period_label", "period_type"]
    dims = ["product_category"]
    keys = [*period, *dims, IS_TOTAL]

    def item_rows(source: DataFrame, *fields: str) -> DataFrame:
        # zipping just the fields in use keeps the others out of the scan, which opening the
        # items as a whole would not
        needed = ("item_category", "item_category_3", *fields)
        opened = source.select(
            "event_date",
            "event_name",
            *SESSION_ID,
            "transaction_id",
            F.inline(F.arrays_zip(*[F.col(f"items.{f}") for f in needed])).alias(*needed),
        )
        category = F.concat("item_category", F.lit(" - "), "item_category_3")
        return opened.withColumn("product_category", category).join(F.broadcast(period_days), "event_date")

    identified = F.col("user_pseudo_id").isNotNull() & F.col("ga_session_id").isNotNull()
    touched = (
        item_rows(events)
        # rows outside any identified session only add to the item counts
        .withColumns({c: F.when(identified, F.col(c)) for c in SESSION_ID})
        .groupBy(*period, *dims, *SESSION_ID)
        .agg(*event_counts(**_ITEM_COUNTS))
    )
    # the join partitions on the session; the per-session aggregate below reuses that
    session = SESSION_ID
    if index is None:
        touched = touched.join(sessions.select(*SESSION_ID, *FLAGS), SESSION_ID, "left")
    else:
        # rows outside any identified session have no reference, so nothing is looked up for them
        ref = F.when(F.col("user_pseudo_id").isNotNull(), session_ref()).alias(REF)
        with_items = events.where(F.size("items.item_id") > 0)
        touched = index.with_flags(touched.select("*", ref), seen=with_items.select(ref))
        session = [*SESSION_ID, REF]
    per_session = (
        with_totals(touched, dims, GRAND_TOTAL)
        .groupBy(*keys, *session)
        .agg(F.max("is_bounced_flag").alias("flag"), F.max("is_bounced_3cond").alias("3cond"), *carry(*_ITEM_COUNTS))
    )
    named = F.col("user_pseudo_id").isNotNull()
    per_user = per_session.groupBy(*keys, "user_pseudo_id").agg(
        F.count_if(named).alias("visits"),
        *[F.sum(F.when(named, F.col(c))).alias(c) for c in ("flag", "3cond")],
        *carry(*_ITEM_COUNTS),
    )
    visit_side = (
        per_user.groupBy(*keys)
        .agg(F.count("user_pseudo_id").alias("unique_visitors"), *carry("visits", "flag", "3cond", *_ITEM_COUNTS))
        .where(F.col("visits") > 0)
    )

    purchases = item_rows(
        events.where(m.is_event("purchase")), "item_revenue", "item_revenue_in_usd", "quantity"
    ).withColumn("order_id", m.order_id())
    # the order id is part of the grain; rows without one keep their revenue under a NULL id
    order_side = (
        total_rollup(
            purchases,
            period,
            dims,
            m.money_sum(F.col("item_revenue")).alias("revenue_local"),
            m.money_sum(F.col("item_revenue_in_usd")).alias("revenue_usd"),
            F.sum(F.coalesce("quantity", F.lit(0))).alias("quantity"),
            grain=["order_id"],
            label=GRAND_TOTAL,
        )
        .groupBy(*keys)
        .agg(F.count("order_id").alias("orders"), *carry("revenue_local", "revenue_usd", "quantity"))
    )

    zero = F.lit(0)
    return (
        visit_side.join(order_side, keys, "left")
        .withColumns(
            {
                "orders": F.coalesce("orders", zero),
                "quantity": F.coalesce("quantity", zero),
                **{c: F.coalesce(m.money(F.col(c)), F.lit(0.0)) for c in ("revenue_local", "revenue_usd")},
            }
        )
        .select(
            *period,
            "product_category",
            "visits",
            "unique_visitors",
            "product_views",
            m.ratio(F.col("product_views"), F.col("visits")).alias("product_views_per_visit"),
            "add_to_wishlist",
            "cart_additions",
            "orders",
            "revenue_local",
            "revenue_usd",
            "quantity",
            m.pct(F.col("flag"), F.col("visits")).alias("bounce_rate_flag_pct"),
            m.pct(F.col("3cond"), F.col("visits")).alias("bounce_rate_3cond_pct"),
            m.pct(F.col("orders"), F.col("visits"), 4).alias("conversion_pct"),
            m.pct(F.col("cart_additions"), F.col("product_views")).alias("ac_vs_pv_pct"),
            m.pct(F.col("orders"), F.col("cart_additions")).alias("order_vs_cart_pct"),
            m.ratio(F.col("revenue_local"), F.col("orders")).alias("ticket_size_local"),
            m.ratio(F.col("revenue_usd"), F.col("orders")).alias("ticket_size_usd"),
            m.ratio(
                F.col("unique_visitors"),
                days_elapsed(F.col("period_start_date"), F.col("period_end_date"), cfg.as_of_date),
            ).alias("auv"),
            row_sort(),
        )
    )
