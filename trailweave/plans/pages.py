"""Weekly page matrix: page by traffic kind, with views, visitors, bounce and exit rates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import EngineConfig
from ..functions import metrics as m
from ..functions.calendar import week_start
from ..functions.channels import organic_paid_bucket
from ..functions.text import last_path_segment
from ..operators.rollup import IS_TOTAL, row_sort, with_totals
from .reach import carry
from .sessions import SESSION_ID

WEEK = "week_start_date"
KINDS = ("organic", "paid", "total")
GRAND_TOTAL = "Grand Total"


def _per_kind(make) -> list[Column]:
    """One column per traffic kind; the total takes every bucket."""
    bucket = F.col("bucket")
    conditions = {"organic": bucket == "organic", "paid": bucket == "paid", "total": F.lit(True)}
    return [make(kind, condition) for kind, condition in conditions.items()]


def weekly_page_matrix(
    events: DataFrame,
    sessions: DataFrame,
    cfg: EngineConfig,
    page: Column,
    page_column: str,
    event_names: Sequence[str] = ("page_view",),
    where: Column | None = None,
) -> DataFrame:
    """Week by page, with a Grand Total row per week.

    A page view is a distinct combination of page, user, session, bucket and timestamp. A
    session's exit is its last view over all weeks, ties going to the larger page, bucket
    and week. Views without a user id form one unnamed session: it counts in the bounce
    denominators and takes one exit, but is not counted as a session.

    The views are first reduced to one row per session, page and bucket; everything after
    works on those. Exits need the latest row per session only, which a window over the
    reduced rows finds without sorting the events, however many share one (or no) session.
    """
    rows = events.where(m.is_event(*event_names) & F.col("ga_session_id").isNotNull())
    if where is not None:
        rows = rows.where(where)
    visits = (
        rows.select(
            week_start(F.col("event_date"), cfg.week_start_day).alias(WEEK),
            page.alias("page"),
            "user_pseudo_id",
            F.when(F.col("user_pseudo_id").isNotNull(), F.col("ga_session_id")).alias("ga_session_id"),
            organic_paid_bucket(F.col("channel_group")).alias("bucket"),
            "event_timestamp",
        )
        .groupBy(WEEK, "page", *SESSION_ID, "bucket")
        .agg(F.count_distinct("event_timestamp").alias("views"), F.max("event_timestamp").alias("last_view"))
        # the join partitions on the session; window and per-session aggregate below reuse that
        .join(sessions.select(*SESSION_ID, "is_bounced_flag", "is_bounced_3cond"), SESSION_ID, "left")
    )
    last = F.struct("last_view", "page", "bucket", WEEK)
    visits = visits.withColumn(
        "exits", (last == F.max(last).over(Window.partitionBy(*SESSION_ID))).cast("int")
    )

    group = [WEEK, "page", IS_TOTAL]
    per_session = (
        with_totals(visits, ["page"], GRAND_TOTAL)
        .groupBy(*group, *SESSION_ID)
        .agg(
            *_per_kind(lambda kind, is_kind: F.sum(F.when(is_kind, F.col("views")).otherwise(0)).alias(f"page_views_{kind}")),
            *_per_kind(lambda kind, is_kind: F.sum(F.when(is_kind, F.col("exits")).otherwise(0)).alias(f"exits_{kind}")),
            # bounces go to the bucket that sorts last: paid, then other, then organic
            F.max(F.when(F.col("bucket") == "organic", 0).when(F.col("bucket") == "other", 1).otherwise(2)).alias("rank"),
            F.max("is_bounced_flag").alias("flag"),
            F.max("is_bounced_3cond").alias("3cond"),
        )
    )
    named = F.col("user_pseudo_id").isNotNull()
    sides = {"organic": F.col("rank") == 0, "paid": F.col("rank") == 2, "total": F.lit(True)}
    counters = [f"{c}_{kind}" for c in ("page_views", "exits") for kind in KINDS]
    session_counters = [f"sessions_{kind}" for kind in KINDS]
    bounce_counters = [
        *(f"sided_{kind}" for kind in KINDS),
        *(f"{method}_{kind}" for method in ("flag", "3cond") for kind in KINDS),
    ]
    per_user = per_session.groupBy(*group, "user_pseudo_id").agg(
        *carry(*counters),
        *[F.count_if(named & (F.col(f"page_views_{kind}") > 0)).alias(f"sessions_{kind}") for kind in KINDS],
        *[F.count_if(side).alias(f"sided_{kind}") for kind, side in sides.items()],
        *[
            F.sum(F.when(side, F.col(method))).alias(f"{method}_{kind}")
            for method in ("flag", "3cond")
            for kind, side in sides.items()
        ],
    )
    matrix = per_user.groupBy(*group).agg(
        *[F.count_if(named & (F.col(f"page_views_{kind}") > 0)).alias(f"unique_visitors_{kind}") for kind in KINDS],
        *carry(*counters, *session_counters, *bounce_counters),
    )

    def per_kind(make) -> list[Column]:
        return [make(kind) for kind in KINDS]

    return matrix.select(
        WEEK,
        F.date_add(WEEK, 6).alias("week_end_date"),
        F.col("page").alias(page_column),
        *per_kind(lambda k: F.col(f"unique_visitors_{k}")),
        *per_kind(lambda k: F.col(f"page_views_{k}")),
        *per_kind(
            lambda k: m.ratio(F.col(f"page_views_{k}"), F.col(f"sessions_{k}")).alias(f"page_views_per_visit_{k}")
        ),
        *per_kind(lambda k: m.pct(F.col(f"flag_{k}"), F.col(f"sided_{k}")).alias(f"bounce_rate_flag_{k}")),
        *per_kind(lambda k: m.pct(F.col(f"3cond_{k}"), F.col(f"sided_{k}")).alias(f"bounce_rate_3cond_{k}")),
        *per_kind(lambda k: m.pct(F.col(f"exits_{k}"), F.col(f"page_views_{k}")).alias(f"exit_rate_{k}")),
        row_sort(),
    )


def plp_views_weekly(staged: DataFrame, sessions: DataFrame, cfg: EngineConfig) -> DataFrame:
    """List-page views by the last segment of the item list name."""
    where = F.col("item_list_name").isNotNull()
    if cfg.plp_until_date is not None:
        where = where & (F.col("event_date") < F.lit(cfg.plp_until_date))
    return weekly_page_matrix(
        staged,
        sessions,
        cfg,
        page=last_path_segment(F.col("item_list_name")),
        page_column="plp_page",
        event_names=("view_item_list",),
        where=where,
    )


def custom_page_views_weekly(staged: DataFrame, sessions: DataFrame, cfg: EngineConfig) -> DataFrame:
    """Page views by page type."""
    return weekly_page_matrix(
        staged,
        sessions,
        cfg,
        page=F.coalesce("page_type", F.lit("Others")),
        page_column="page_name",
    )
