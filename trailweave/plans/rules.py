"""Declared rules of each model: unique key, mandatory columns, row conditions."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rules:
    unique_key: tuple[str, ...]
    non_null: tuple[str, ...] = ()
    row_conditions: tuple[str, ...] = ()

    def violations(self, df: DataFrame) -> DataFrame:
        """One row per broken rule, with the number of rows (or key values) breaking it.

        All rules are tested in one pass: rows are counted per key, and the counts added up.
        """
        tests = {}
        if self.non_null:
            missing = reduce(lambda a, b: a | b, (F.col(c).isNull() for c in self.non_null))
            tests[f"not null ({', '.join(self.non_null)})"] = missing
        # an undecided (NULL) condition passes
        tests |= {condition: ~F.expr(condition) for condition in self.row_conditions}
        by_key = df.groupBy(*self.unique_key).agg(
            F.count("*").alias("_rows"), *[F.count_if(test).alias(f"_{k}") for k, test in enumerate(tests.values())]
        )
        counted = by_key.agg(
            F.count_if(F.col("_rows") > 1).alias("_unique"), *[F.sum(f"_{k}").alias(f"_{k}") for k in range(len(tests))]
        )
        columns = {f"unique key ({', '.join(self.unique_key)})": "_unique"} | {rule: f"_{k}" for k, rule in enumerate(tests)}
        rows = [F.struct(F.lit(rule).alias("rule"), F.col(c).alias("failures")) for rule, c in columns.items()]
        return counted.select(F.inline(F.array(*rows))).where(F.col("failures") > 0)


# Keys, mandatory columns and row conditions of each model.


def _percentage(column: str) -> str:
    return f"{column} IS NULL OR ({column} BETWEEN 0 AND 100)"


def _not_negative(*columns: str) -> tuple[str, ...]:
    return tuple(f"{c} IS NULL OR {c} >= 0" for c in columns)


_BOUNCE = (_percentage("bounce_rate_flag_pct"), _percentage("bounce_rate_3cond_pct"))
_SALES = "orders >= 0 AND revenue_usd >= 0"
_PAGES = (
    "unique_visitors_total <= page_views_total",
    _percentage("exit_rate_total"),
    _percentage("bounce_rate_flag_total"),
)
_FUNNEL = Rules(
    unique_key=("month", "device_class"),
    non_null=("month", "device_class", "visits"),
    row_conditions=(
        "visits >= 0",
        "product_views >= 0",
        "cart >= 0",
        "orders >= 0",
        *_not_negative("cart_per_prod_view", "order_per_cart", "conversion"),
    ),
)

RULES: dict[str, Rules] = {
    "sessions": Rules(
        ("session_key",),
        ("session_key", "user_pseudo_id", "session_date"),
        ("duration_seconds >= 0", "events > 0", "pageviews <= events"),
    ),
    "first_visits": Rules(("user_pseudo_id",)),
    "weekly_performance": Rules(
        ("week_start_date",),
        ("week_start_date", "week_end_date", "visits_total", "unique_visitors_total"),
        (
            "datediff(week_end_date, week_start_date) = 6",
            "visits_new + visits_repeat = visits_total",
            "unique_visitors_new + unique_visitors_repeat = unique_visitors_total",
            "orders_total >= 0 AND revenue_usd_total >= 0",
        ),
    ),
    "channel_performance": Rules(
        ("month", "marketing_channel"),
        ("month", "marketing_channel", "visits", "unique_visitors"),
        (_SALES, *_BOUNCE),
    ),
    "device_performance": Rules(
        ("month", "device_class"),
        ("month", "device_class", "traffic"),
        (f"{_SALES} AND quantity >= 0", *_BOUNCE),
    ),
    "city_performance": Rules(
        ("month", "city_display"),
        ("month", "city_display", "visits", "unique_visitors"),
        (_SALES, *_BOUNCE, _percentage("contribution_pct")),
    ),
    "product_performance": Rules(
        ("period_label", "product_category"),
        ("period_start_date", "period_label", "product_category"),
        ("period_end_date >= period_start_date", _SALES),
    ),
    "plp_views_weekly": Rules(
        ("week_start_date", "plp_page"), ("week_start_date", "plp_page", "page_views_total"), _PAGES
    ),
    "custom_page_views_weekly": Rules(
        ("week_start_date", "page_name"), ("week_start_date", "page_name", "page_views_total"), _PAGES
    ),
    "city_browsing_depth_weekly": Rules(
        ("week_start_date", "city"),
        ("week_start_date", "city", "sessions", "users"),
        (_percentage("pdp_intent_5_pct"), _percentage("pdp_intent_10_pct"), _percentage("bounce_rate_flag_pct")),
    ),
    "funnel_users": _FUNNEL,
    "funnel_events": _FUNNEL,
}
