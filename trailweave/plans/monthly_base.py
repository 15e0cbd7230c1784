"""What the monthly marts are rolled up from: staged events, or tables combined from them once for all five.

The base is three tables by month. ``activity`` has one row per user and session with its channel,
device and place and the counters any of the marts reports; ``orders`` each order id once, and
``items`` each item once, with the dimensions they were seen under. All hold details that add up,
never distinct counts, so every mart's distinct users, sessions, orders and items are exact.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import metrics as m
from ..functions.calendar import month_start
from ..operators.versions import VersionedTable
from .reach import carry, count_items, count_orders, event_counts, items_seen, named_orders, revenue_sums

PLACE = ("geo_city", "geo_region", "geo_country")
DIMS = ("channel_group", "device_class", *PLACE)
#: Event names that some monthly mart counts; the columns of the base are called the same.
COUNTED = ("view_item", "add_to_cart", "add_to_wishlist", "purchase")


def quantity_sum() -> Column:
    return F.sum(F.when(m.is_event("purchase"), F.coalesce("item_quantity", F.lit(0))).otherwise(F.lit(0)))


@dataclass(frozen=True)
class StagedSource:
    """Events with their month, combined by each mart for itself."""

    rows: DataFrame

    def renamed(self, names: dict[str, str]) -> StagedSource:
        return StagedSource(self.rows.withColumnsRenamed(names))

    def counts(self, **names: str) -> list[Column]:
        return event_counts(**names)

    def revenue(self) -> list[Column]:
        return revenue_sums()

    def quantity(self) -> Column:
        return quantity_sum().alias("quantity")

    def orders(self, period: Sequence[str], dims: Sequence[str]) -> DataFrame:
        return count_orders(named_orders(self.rows), period, dims)

    def items(self, period: Sequence[str], dims: Sequence[str]) -> DataFrame:
        return count_items(items_seen(self.rows, [*period, *dims]), period, dims)


@dataclass(frozen=True)
class BaseSource:
    """The three tables of the base in place of the events."""

    rows: DataFrame
    order_rows: DataFrame
    item_rows: DataFrame

    def each(self, change: Callable[[DataFrame], DataFrame]) -> BaseSource:
        return replace(self, rows=change(self.rows), order_rows=change(self.order_rows), item_rows=change(self.item_rows))

    def renamed(self, names: dict[str, str]) -> BaseSource:
        return self.each(lambda df: df.withColumnsRenamed(names))

    def counts(self, **names: str) -> list[Column]:
        return [F.sum(event).alias(alias) for alias, event in names.items()]

    def revenue(self) -> list[Column]:
        return carry("revenue_local", "revenue_usd")

    def quantity(self) -> Column:
        return F.sum("quantity").alias("quantity")

    def orders(self, period: Sequence[str], dims: Sequence[str]) -> DataFrame:
        return count_orders(self.order_rows, period, dims)

    def items(self, period: Sequence[str], dims: Sequence[str]) -> DataFrame:
        return count_items(self.item_rows, period, dims)


def activity(events: DataFrame) -> DataFrame:
    return events.groupBy("month", *DIMS, "user_pseudo_id", "ga_session_id").agg(
        *event_counts(**{e: e for e in COUNTED}), quantity_sum().alias("quantity"), *revenue_sums()
    )


def orders(events: DataFrame) -> DataFrame:
    return named_orders(events).select("month", *DIMS, "order_id").distinct()


def items(events: DataFrame) -> DataFrame:
    keys = ["month", "channel_group", "device_class"]
    return items_seen(events, keys).groupBy(*keys, "item_id").agg(
        F.max("viewed").alias("viewed"), F.max("carted").alias("carted")
    )


#: The tables of the base in the order of BaseSource, with what their files are sorted on.
TABLES: dict[str, tuple[Callable[[DataFrame], DataFrame], tuple[str, ...]]] = {
    "monthly_activity": (activity, ("user_pseudo_id",)),
    "monthly_orders": (orders, ("order_id",)),
    "monthly_items": (items, ("item_id",)),
}


def _month_folder(day_folder: str) -> str:
    """``event_date=2024-02-09`` lies in ``month=2024-02-01``; events without a date have a month of their own."""
    day = day_folder.partition("=")[2]
    return f"month={day[:7]}-01" if day[:1].isdigit() else f"month={day}"


def follow(table: VersionedTable, build: Callable[[DataFrame], DataFrame], staged: VersionedTable) -> set[str] | None:
    """Bring one table of the base to the newest version of the staged events; what months were built, None for all.

    The table remembers the version that it follows. Days whose files differ since then name the
    months to combine again, so a day that was restated, dropped or left behind by a run that died
    counts, whatever the window; other months are neither read nor listed.
    """
    now, own = staged.version(), table.version()
    followed = staged.find(own.notes["follows"]) if own else None
    with_month = lambda df: df.withColumn("month", month_start(F.col("event_date")))
    if followed is None:
        table.commit(build(with_month(staged.read())), follows=now.number)
        return None
    changed = dict(followed.partitions.items() ^ now.partitions.items())
    months = {_month_folder(day) for day in changed}
    if own.notes["follows"] != now.number:
        events = staged.read(lambda day: _month_folder(day) in months)
        table.commit(build(with_month(events)), lambda month: month in months, follows=now.number)
    return months
