"""City browsing depth: weekly sessions, page depth and product intent by city."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import EngineConfig
from ..functions import metrics as m
from ..functions.calendar import week_start
from ..functions.text import city_comma_label, geo_all_or_unknown
from ..operators.incremental import since
from ..operators.rollup import IS_TOTAL, row_sort
from .reach import event_counts, keys_of, session_quality, visit_reach
from .sessions import SESSION_ID

GRAND_TOTAL = "Grand Total"


def distinct_products_per_session(staged: DataFrame) -> DataFrame:
    """How many different items each identified session viewed."""
    return (
        staged.where(m.is_event("view_item"))
        .where(F.col("user_pseudo_id").isNotNull() & F.col("ga_session_id").isNotNull())
        .select(*SESSION_ID, F.explode("items.item_id").alias("item_id"))
        .where(F.col("item_id").isNotNull())
        .distinct()
        .groupBy(*SESSION_ID)
        .agg(F.count("*").alias("distinct_product_views"))
    )


def city_browsing_depth_weekly(
    staged: DataFrame, sessions: DataFrame, cfg: EngineConfig, incremental: bool = False
) -> DataFrame:
    """Week by city, with a Grand Total row per week.

    An incremental run also works out the week before its first one, which growth against
    the previous week needs, and leaves it out of the result.
    """
    boundary = cfg.week_boundary if incremental else None
    scan_from = boundary - timedelta(days=7) if boundary else None
    week = ["week_start_date"]
    dims = ["city", "state", "country"]
    keys = keys_of(week, dims)

    def placed(df: DataFrame, day: str) -> DataFrame:
        places = geo_all_or_unknown(F.col("geo_city"), F.col("geo_region"), F.col("geo_country"))
        return since(df, day, scan_from).withColumns(
            {week[0]: week_start(F.col(day), cfg.week_start_day), **dict(zip(dims, places))}
        )

    counts = dict(page_views="page_view", cart_additions="add_to_cart", wishlist_additions="add_to_wishlist")
    event_side = visit_reach(
        placed(staged, "event_date"), week, dims, event_counts(**counts), [*counts], label=GRAND_TOTAL
    )
    products = distinct_products_per_session(since(staged, "event_date", scan_from))
    viewed = F.coalesce("distinct_product_views", F.lit(0))
    session_side = session_quality(
        placed(sessions, "session_date").join(products, SESSION_ID, "left"),
        week,
        dims,
        F.count_if(viewed >= 5).alias("sessions_5plus_pdp"),
        F.count_if(viewed >= 10).alias("sessions_10plus_pdp"),
        label=GRAND_TOTAL,
    )

    history = Window.partitionBy(*dims, IS_TOTAL).orderBy(week[0])
    adjacent = F.datediff(week[0], F.lag(week[0]).over(history)) == 7
    previous = F.when(adjacent, F.lag("sessions").over(history))
    label = F.when(F.col(IS_TOTAL) == 1, F.lit(GRAND_TOTAL)).otherwise(
        city_comma_label(*[F.col(d) for d in dims])
    )
    report = event_side.join(session_side, keys, "left").select(
        week[0],
        F.date_add(week[0], 6).alias("week_end_date"),
        label.alias("city"),
        "users",
        "sessions",
        "page_views",
        m.ratio(F.col("sessions"), F.col("users")).alias("sessions_per_user"),
        m.ratio(F.col("page_views"), F.col("sessions")).alias("pages_per_session"),
        m.pct(F.col("sessions_5plus_pdp"), F.col("sessions")).alias("pdp_intent_5_pct"),
        m.pct(F.col("sessions_10plus_pdp"), F.col("sessions")).alias("pdp_intent_10_pct"),
        m.ratio(F.col("cart_additions"), F.col("wishlist_additions")).alias("cart_per_wishlist"),
        "bounce_rate_flag_pct",
        "bounce_rate_3cond_pct",
        m.pct(F.col("sessions") - previous, previous).alias("session_increase_previous"),
        row_sort(),
    )
    return since(report, week[0], boundary)
