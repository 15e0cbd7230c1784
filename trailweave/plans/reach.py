"""Aggregates several marts share: reach by user and session, orders, items and session quality."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import metrics as m
from ..operators.rollup import IS_TOTAL, total_rollup


def event_counts(**names: str) -> list[Column]:
    """``alias=event name`` pairs as counters."""
    return [F.count_if(m.is_event(event)).alias(alias) for alias, event in names.items()]


def revenue_sums() -> list[Column]:
    return [
        m.money_sum(F.col(c), m.is_event("purchase")).alias(c) for c in ("revenue_local", "revenue_usd")
    ]


def carry(*columns: str) -> list[Column]:
    """Sums that lift finer-grained counters one level up."""
    return [F.sum(c).alias(c) for c in columns]


def keys_of(period: Sequence[str], dims: Sequence[str]) -> list[str]:
    return [*period, *dims, IS_TOTAL]


def named_orders(events: DataFrame) -> DataFrame:
    """Purchases that name their order.

    The filter reaches the scan, where the event-name clustering of the staged table skips the
    other row groups.
    """
    purchases = events.where(m.is_event("purchase")).withColumn("order_id", m.order_id())
    return purchases.where(F.col("order_id").isNotNull())


def count_orders(named: DataFrame, period: Sequence[str], dims: Sequence[str], label: str = "Total") -> DataFrame:
    """Distinct order ids per group and in total."""
    return (
        total_rollup(named, period, dims, grain=["order_id"], label=label)
        .groupBy(*keys_of(period, dims))
        .agg(F.count("*").alias("orders"))
    )


def order_counts(events: DataFrame, period: Sequence[str], dims: Sequence[str], label: str = "Total") -> DataFrame:
    """Distinct order ids of the events' purchases, which are the only rows read."""
    return count_orders(named_orders(events), period, dims, label)


def items_seen(events: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Items of the events, opened up, with what happened to them.

    Item rows of other events than views and carts only prove presence, so those events
    contribute a single row without an id instead of being opened up.
    """
    ids = F.col("items.item_id")
    return events.select(
        *keys,
        m.is_event("view_item").cast("int").alias("viewed"),
        m.is_event("add_to_cart").cast("int").alias("carted"),
        F.explode(
            F.when(m.is_event("view_item", "add_to_cart"), F.array_distinct(ids)).when(
                F.size(ids) > 0, F.array(F.lit(None).cast("string"))
            )
        ).alias("item_id"),
    )


def count_items(seen: DataFrame, period: Sequence[str], dims: Sequence[str], label: str = "Total") -> DataFrame:
    """Distinct items viewed and carted.

    A group without any item row is absent, and one whose items were neither viewed nor
    carted counts zero.
    """
    named = F.col("item_id").isNotNull()
    return (
        total_rollup(
            seen, period, dims, F.max("viewed").alias("viewed"), F.max("carted").alias("carted"),
            grain=["item_id"], label=label, merge=F.max,
        )
        .groupBy(*keys_of(period, dims))
        .agg(
            F.count_if(named & (F.col("viewed") == 1)).alias("unique_product_view"),
            F.count_if(named & (F.col("carted") == 1)).alias("unique_cart"),
        )
    )


def item_reach(events: DataFrame, period: Sequence[str], dims: Sequence[str], label: str = "Total") -> DataFrame:
    """Distinct items viewed and carted by the events."""
    return count_items(items_seen(events, [*period, *dims]), period, dims, label)


def visit_reach(
    events: DataFrame,
    period: Sequence[str],
    dims: Sequence[str],
    counters: Sequence[Column],
    names: Sequence[str],
    label: str = "Total",
) -> DataFrame:
    """Distinct users and sessions of the events, with summed counters.

    Built bottom-up, session grain to user grain to group: each level shuffles the result of
    the one below, already combined within tasks, so neither one heavy user nor the events
    without any user id gather in one task.
    """
    keys = keys_of(period, dims)
    per_session = total_rollup(
        events, period, dims, *counters, grain=["user_pseudo_id", "ga_session_id"], label=label
    )
    identified = F.col("user_pseudo_id").isNotNull() & F.col("ga_session_id").isNotNull()
    per_user = per_session.groupBy(*keys, "user_pseudo_id").agg(
        F.count_if(identified).alias("sessions"), *carry(*names)
    )
    return per_user.groupBy(*keys).agg(
        F.count("user_pseudo_id").alias("users"), *carry("sessions", *names)
    )


def session_quality(
    sessions: DataFrame, period: Sequence[str], dims: Sequence[str], *extra: Column, label: str = "Total"
) -> DataFrame:
    """Both bounce rates per group and in total; ``extra`` are sums or counts of sessions."""
    flags = ("is_bounced_flag", "is_bounced_3cond")
    totals = total_rollup(
        sessions,
        period,
        dims,
        F.count("*").alias("quality_sessions"),
        *[F.sum(c).alias(c) for c in flags],
        *extra,
        label=label,
    )
    rates = {
        f"bounce_rate_{c.removeprefix('is_bounced_')}_pct": m.pct(F.col(c), F.col("quality_sessions")) for c in flags
    }
    return totals.withColumns(rates).drop("quality_sessions", *flags)
