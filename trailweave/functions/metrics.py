"""Shared metric definitions: ratios, money, session keys, orders and bounces."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Money is summed as exact decimals: the result then does not depend on the order in which
# tasks finish. Six decimals keep sub-cent amounts.
MONEY = "decimal(24,6)"


def round_half_up(x: Column, decimals: int) -> Column:
    """Half away from zero, on the binary value."""
    scale = F.lit(float(10**decimals))
    return F.signum(x) * F.floor(F.abs(x) * scale + F.lit(0.5)) / scale


def safe_divide(numerator: Column, denominator: Column) -> Column:
    """Double division; NULL on a zero or NULL denominator."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def pct(numerator: Column, denominator: Column, decimals: int = 2) -> Column:
    return round_half_up(safe_divide(numerator, denominator) * 100, decimals)


def ratio(numerator: Column, denominator: Column, decimals: int = 2) -> Column:
    return round_half_up(safe_divide(numerator, denominator), decimals)


def money_sum(amount: Column, when: Column | None = None) -> Column:
    """Exact sum of ``amount``, missing amounts as zero, over the rows meeting ``when``."""
    zero = F.lit(0).cast(MONEY)
    value = F.coalesce(amount.cast(MONEY), zero)
    return F.sum(value if when is None else F.when(when, value).otherwise(zero))


def money(total: Column) -> Column:
    """A finished money total, in cents precision."""
    return F.round(total, 2).cast("double")


def session_key(user: Column | str = "user_pseudo_id", session: Column | str = "ga_session_id") -> Column:
    """Session ids are unique per user only; NULL when either part is."""
    user = F.col(user) if isinstance(user, str) else user
    session = F.col(session) if isinstance(session, str) else session
    return F.concat(user, F.lit("-"), session.cast("string"))


def is_event(*names: str) -> Column:
    event = F.col("event_name")
    return event == names[0] if len(names) == 1 else event.isin(*names)


def order_id(extra: Column | None = None) -> Column:
    """The transaction id where the row is an identified order, else NULL."""
    tx = F.col("transaction_id")
    counts = is_event("purchase") & (tx != "")
    return F.when(counts if extra is None else counts & extra, tx)


def distinct_orders(extra: Column | None = None) -> Column:
    return F.count_distinct(order_id(extra))


def flag_bounce(engaged_events: Column) -> Column:
    """1 unless some event of the session was flagged as engaged."""
    return F.when(engaged_events > 0, F.lit(0)).otherwise(F.lit(1))


def conditions_bounce(
    seconds: Column, pageviews: Column, purchases: Column, custom: Column | None = None
) -> Column:
    """1 unless the session ran 10 s, saw two pages, bought, or fired a custom event."""
    engaged = (seconds >= 10) | (pageviews >= 2) | (purchases > 0)
    if custom is not None:
        engaged = engaged | (custom > 0)
    return F.when(engaged, F.lit(0)).otherwise(F.lit(1))


def bounced_by_flag(engaged: Column | str = "session_engaged") -> Column:
    """``flag_bounce`` as an aggregate over a session's events."""
    engaged = F.col(engaged) if isinstance(engaged, str) else engaged
    return flag_bounce(F.count_if(engaged == "1"))


def seconds_between(start: Column, end: Column) -> Column:
    """Whole elapsed seconds."""
    return F.timestamp_diff("SECOND", start, end)


def duration_seconds(ts: Column | str = "event_timestamp") -> Column:
    """Whole seconds between the first and last event of a session, as an aggregate."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    return seconds_between(F.min(ts), F.max(ts))


def bounced_by_conditions(
    ts: Column | str = "event_timestamp",
    name: Column | str = "event_name",
    custom_events: Sequence[str] = (),
) -> Column:
    """``conditions_bounce`` as an aggregate over a session's events."""
    name = F.col(name) if isinstance(name, str) else name
    return conditions_bounce(
        duration_seconds(ts),
        F.count_if(name == "page_view"),
        F.count_if(name == "purchase"),
        F.count_if(name.isin(*custom_events)) if custom_events else None,
    )


def bounce_rate_pct(flag: Column | str, sessions: Column, decimals: int = 2) -> Column:
    """Share of sessions whose stored 0/1 flag is set, as an aggregate."""
    flag = F.col(flag) if isinstance(flag, str) else flag
    return pct(F.sum(flag), sessions, decimals)
