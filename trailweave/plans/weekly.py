"""Weekly performance mart with the new / repeat split."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import EngineConfig
from ..functions import metrics as m
from ..functions.calendar import week_start
from ..operators.incremental import since
from .reach import event_counts, revenue_sums

KINDS = ("new", "repeat", "total")
_EVENTS = dict(product_views="view_item", add_to_wishlist="add_to_wishlist", add_to_cart="add_to_cart")
_SUMS = (*_EVENTS, "revenue_local", "revenue_usd")


def weekly_performance(
    staged: DataFrame,
    sessions: DataFrame,
    first_visits: DataFrame,
    cfg: EngineConfig,
    incremental: bool = False,
) -> DataFrame:
    """One row per week. A user is new for the whole week their first visit falls into."""
    boundary = cfg.week_boundary if incremental else None
    week = "week_start_date"

    first_session = F.col("session_number") == 1
    session_side = (
        since(sessions, "session_date", boundary)
        .groupBy(week_start(F.col("session_date"), cfg.week_start_day).alias(week))
        .agg(
            F.count_if(first_session).alias("visits_new"),
            F.count_if(~F.coalesce(first_session, F.lit(False))).alias("visits_repeat"),
            F.count("*").alias("visits_total"),
        )
    )

    events = since(staged, "event_date", boundary).withColumn(
        week, week_start(F.col("event_date"), cfg.week_start_day)
    )
    newcomers = first_visits.select("user_pseudo_id", F.col("first_visit_week").alias(week), F.lit(True).alias("is_new"))

    def typed(rows: DataFrame) -> DataFrame:
        """Adds the user type. Rows are per week and user by now, so the join moves those, not events."""
        return rows.join(newcomers, ["user_pseudo_id", week], "left").withColumn(
            "is_new", F.coalesce("is_new", F.lit(False))
        )

    is_new = F.col("is_new")
    per_user = typed(events.groupBy(week, "user_pseudo_id").agg(*event_counts(**_EVENTS), *revenue_sums()))
    user = F.col("user_pseudo_id")
    user_side = per_user.groupBy(week).agg(
        F.count(F.when(is_new, user)).alias("unique_visitors_new"),
        F.count(F.when(~is_new, user)).alias("unique_visitors_repeat"),
        F.count(user).alias("unique_visitors_total"),
        *[
            F.sum(F.when(condition, F.col(c)).otherwise(F.lit(0))).alias(f"{c}_{kind}")
            for c in _SUMS
            for kind, condition in (("new", is_new), ("repeat", ~is_new))
        ],
        *[F.sum(c).alias(f"{c}_total") for c in _SUMS],
    )

    # an id fired by a new and by a repeat user counts once for each, and once in total
    order_side = (
        typed(
            events.where(m.is_event("purchase"))
            .withColumn("order_id", m.order_id())
            .where(F.col("order_id").isNotNull())
            .select(week, "user_pseudo_id", "order_id")
            .distinct()
        )
        .groupBy(week, "order_id")
        .agg(F.max(is_new.cast("int")).alias("new"), F.max((~is_new).cast("int")).alias("repeat"))
        .withColumn("total", F.lit(1))
        .groupBy(week)
        .agg(*[F.sum(kind).alias(f"orders_{kind}") for kind in KINDS])
    )

    joined = (
        user_side.join(session_side, week, "left")
        .join(order_side, week, "left")
        .withColumns({f"orders_{kind}": F.coalesce(f"orders_{kind}", F.lit(0)) for kind in KINDS})
    )
    return joined.select(
        week,
        F.date_add(week, 6).alias("week_end_date"),
        *[F.coalesce(f"visits_{kind}", F.lit(0)).alias(f"visits_{kind}") for kind in KINDS],
        *[f"unique_visitors_{kind}" for kind in KINDS],
        *[f"{c}_{kind}" for c in _EVENTS for kind in KINDS],
        *[f"orders_{kind}" for kind in KINDS],
        *[
            m.money(F.col(f"revenue_{currency}_{kind}")).alias(f"revenue_{currency}_{kind}")
            for currency in ("local", "usd")
            for kind in KINDS
        ],
        *[
            m.pct(F.col(f"orders_{kind}"), F.col(f"visits_{kind}"), 4).alias(f"conversion_pct_{kind}")
            for kind in KINDS
        ],
    )
