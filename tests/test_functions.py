"""Column builders on hand-made rows."""

from datetime import date, datetime, timedelta

import pytest
from helpers import item, param, raw_event
from pyspark.sql import functions as F

from trailweave.config import EngineConfig
from trailweave.functions import calendar, channels, metrics, nested, text
from trailweave.sources.schema import RAW_EVENT


def one(spark, column, **values):
    """Value of ``column`` over a single row of the given values."""
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()]) if values else spark.range(1)
    return row.select(column.alias("x")).first()["x"]


# -- ratios and rounding; the figures are published report cells


@pytest.mark.parametrize(
    "n, d, decimals, expected",
    [(498790, 3456584, 2, 14.43), (3375, 3456584, 4, 0.0976), (1, 3, 2, 33.33), (2, 3, 2, 66.67), (5, 0, 2, None), (5, None, 2, None)],
)
def test_pct(spark, n, d, decimals, expected):
    assert one(spark, metrics.pct(F.lit(n), F.lit(d).cast("bigint"), decimals)) == expected


def test_average_daily_visitors(spark):
    days = calendar.days_elapsed(F.lit(date(2022, 4, 1)), F.lit(date(2022, 4, 30)), date(2022, 6, 1))
    assert one(spark, days) == 30
    assert one(spark, metrics.ratio(F.lit(3456584), days)) == 115219.47


def test_days_elapsed_of_running_period(spark):
    assert one(spark, calendar.days_elapsed(F.lit(date(2024, 2, 12)), F.lit(date(2024, 2, 18)), date(2024, 2, 15))) == 4


@pytest.mark.parametrize("x, expected", [(0.125, 0.13), (-0.125, -0.13), (2.5, 2.5), (0.0, 0.0)])
def test_round_half_up(spark, x, expected):
    assert one(spark, metrics.round_half_up(F.lit(x), 2)) == expected


def test_money_sum_is_exact(spark):
    df = spark.createDataFrame([("purchase", 0.1)] * 10 + [("purchase", None), ("refund", 5.0)], "event_name string, x double")
    total = df.agg(metrics.money(metrics.money_sum(F.col("x"), metrics.is_event("purchase"))).alias("t")).first()["t"]
    assert total == 1.0


# -- keys, orders, bounces


def test_session_key_is_null_without_user(spark):
    assert one(spark, metrics.session_key("u", "s"), u="a", s=7) == "a-7"
    assert one(spark, metrics.session_key("u", "s"), u=None, s=7) is None
    assert one(spark, metrics.session_key("u", "s"), u="a", s=None) is None


def test_distinct_orders(spark):
    rows = [("purchase", t) for t in ("A", "A", "B", "", None, "(not set)")] + [("refund", "C")]
    df = spark.createDataFrame(rows, "event_name string, transaction_id string")
    got = df.agg(metrics.distinct_orders().alias("n"), metrics.distinct_orders(F.col("transaction_id") == "A").alias("a"))
    assert tuple(got.first()) == (3, 1)


@pytest.mark.parametrize(
    "events, flag, conditions, custom",
    [
        ([("scroll", 0, None), ("scroll", 9.9, "0")], 1, 1, 1),
        ([("scroll", 0, None), ("scroll", 10, None)], 1, 0, 0),
        ([("page_view", 0, "1"), ("page_view", 1, None)], 0, 0, 0),
        ([("purchase", 0, None)], 1, 0, 0),
        ([("sign_up", 0, None)], 1, 1, 0),
    ],
)
def test_bounces(spark, events, flag, conditions, custom):
    start = datetime(2024, 1, 1)
    rows = [(n, start + timedelta(seconds=s), e) for n, s, e in events]
    df = spark.createDataFrame(rows, "event_name string, event_timestamp timestamp, session_engaged string")
    got = df.agg(
        metrics.bounced_by_flag().alias("f"),
        metrics.bounced_by_conditions().alias("c"),
        metrics.bounced_by_conditions(custom_events=["sign_up"]).alias("x"),
    )
    assert tuple(got.first()) == (flag, conditions, custom)


def test_duration_counts_whole_seconds(spark):
    start = datetime(2024, 1, 1)
    df = spark.createDataFrame([(start,), (start + timedelta(seconds=9, milliseconds=999),)], "event_timestamp timestamp")
    assert df.agg(metrics.duration_seconds().alias("s")).first()["s"] == 9


# -- calendar


@pytest.mark.parametrize("first_day", ["MONDAY", "SUNDAY", "THURSDAY"])
def test_week_start_agrees_with_config(spark, first_day):
    cfg = EngineConfig(date(2024, 2, 15), week_start_day=first_day)
    days = [date(2024, 1, 1) + timedelta(days=i) for i in range(15)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    for row in df.select("d", calendar.week_start(F.col("d"), first_day).alias("w"), calendar.week_end(F.col("d"), first_day).alias("e")).collect():
        assert row.w == cfg.week_floor(row.d)
        assert row.e == row.w + timedelta(days=6)


def test_config_boundaries():
    cfg = EngineConfig(date(2024, 3, 2))
    assert cfg.lookback_date == date(2024, 2, 28)
    assert cfg.lookback_suffix == "20240228"
    assert cfg.week_boundary == date(2024, 2, 26)
    assert cfg.month_boundary == date(2024, 2, 1)
    assert cfg.product_boundary() == date(2024, 1, 29)
    # January never got its month row: go back to it
    assert cfg.product_boundary(date(2023, 12, 1)) == date(2024, 1, 1)
    # everything closed is stored: no further back than usual
    assert cfg.product_boundary(date(2024, 2, 1)) == date(2024, 1, 29)


@pytest.mark.parametrize("bad", [{"week_start_day": "FUNDAY"}, {"lookback_days": -1}])
def test_config_rejects(bad):
    with pytest.raises(ValueError):
        EngineConfig(date(2024, 1, 1), **bad)


# -- text


@pytest.mark.parametrize(
    "raw, expected",
    [
        ("order-confirmation", "Order-Confirmation"),
        ("a_b c.d", "A_B C.D"),
        ("HOME page", "Home Page"),
        ("o'neil", "O'neil"),
        ("", ""),
        (None, None),
    ],
)
def test_init_cap(spark, raw, expected):
    assert one(spark, text.init_cap(F.lit(raw).cast("string"))) == expected


@pytest.mark.parametrize("raw, expected", [("pDp", "PDP"), ("plp", "PLP"), ("CART", "Cart"), (None, None)])
def test_page_type(spark, raw, expected):
    assert one(spark, text.page_type(F.lit(raw).cast("string"))) == expected


@pytest.mark.parametrize(
    "url, path",
    [
        ("https://shop.example/a/b?x=1#y", "/a/b"),
        ("http://shop.example", "/"),
        ("https://shop.example/?q", "/"),
        ("not-a-url", "/"),
        (None, "/"),
    ],
)
def test_page_path(spark, url, path):
    assert one(spark, text.page_path(F.lit(url).cast("string"))) == path


@pytest.mark.parametrize(
    "platform, category, expected",
    [("IOS", "mobile", "Mobile App"), ("ANDROID", None, "Mobile App"), ("WEB", None, "Unknown"), ("WEB", "smart tv", "Smart Tv"), (None, "tablet", "Tablet")],
)
def test_device_class(spark, platform, category, expected):
    got = one(spark, text.device_class(F.lit(platform).cast("string"), F.lit(category).cast("string")))
    assert got == expected


@pytest.mark.parametrize("raw, expected", [(" Pune\t", "Pune"), ("", "Unknown"), ("\n ", "Unknown"), (" (not set) ", "Unknown"), (None, "Unknown")])
def test_geo_clean(spark, raw, expected):
    assert one(spark, text.geo_clean(F.lit(raw).cast("string"))) == expected


def test_geo_all_or_unknown(spark):
    for place, expected in ((("Pune", "MH", "India"), ("Pune", "MH", "India")), (("Pune", "", "India"), ("Unknown",) * 3)):
        assert tuple(one(spark, F.array(*text.geo_all_or_unknown(*map(F.lit, place))))) == expected


@pytest.mark.parametrize("raw, expected", [("/home/rings/Gold ", "Gold"), ("plain", "plain"), ("/home/", "Unknown"), ("  ", "Unknown")])
def test_last_path_segment(spark, raw, expected):
    assert one(spark, text.last_path_segment(F.lit(raw))) == expected


# -- channels


@pytest.mark.parametrize(
    "channel, expected",
    [*((c, "organic") for c in channels.ORGANIC_GROUPS), *((c, "paid") for c in channels.PAID_GROUPS), ("Direct", "other"), (None, "other")],
)
def test_bucket(spark, channel, expected):
    assert one(spark, channels.organic_paid_bucket(F.lit(channel).cast("string"))) == expected


@pytest.mark.parametrize(
    "source, medium, expected",
    [
        ("(Direct)", "(NONE)", "Direct"),
        ("google", "Organic", "Organic"),
        ("x", "partner-referral-2", "Referring Domains"),
        ("x", "internal", "Internal"),
        (None, None, "Unassigned"),
        ("x", None, "Paid"),
        ("(direct)", None, "Paid"),
        ("google", "cpc", "Paid"),
    ],
)
def test_legacy_channel(spark, source, medium, expected):
    assert one(spark, channels.legacy_channel(F.lit(source).cast("string"), F.lit(medium).cast("string"))) == expected


# -- nested values


def test_params(spark):
    params = [param("a", text="x"), param("b", number=5), param("c", double=1.0), param("d", double=2.5), param("a", text="second")]
    event = raw_event("20240201", "page_view", params=params, sid=None, number=None)
    df = spark.createDataFrame([event], RAW_EVENT)
    got = df.select(
        nested.param_string("a").alias("a"),
        nested.param_int("b").alias("b"),
        nested.param_any("b").alias("b_text"),
        nested.param_any("c").alias("c_text"),
        nested.param_any("d").alias("d_text"),
        nested.param_any("missing").alias("none"),
        nested.param_int("a").alias("wrong_type"),
    ).first()
    assert tuple(got) == ("x", 5, "5", "1", "2.5", None, None)


def test_doubles_as_text_have_no_exponent(spark):
    cases = [(1e-4, "0.0001"), (-2.5e-4, "-0.00025"), (0.5, "0.5"), (7.0, "7"), (1e7, "10000000"), (12345678.5, "12345678.5"),
             (1e9, "1000000000"), (-1234567890.25, "-1234567890.25"), (0.0, "0"), (None, None)]
    got = spark.createDataFrame([(x, i) for i, (x, _) in enumerate(cases)], "x double, i int").select("i", nested.plain_double(F.col("x")).alias("t"))
    assert [r.t for r in got.orderBy("i").collect()] == [t for _, t in cases]


def test_params_of_missing_array(spark):
    event = {**raw_event("20240201", "page_view"), "event_params": None}
    assert spark.createDataFrame([event], RAW_EVENT).select(nested.param_int("ga_session_id")).first()[0] is None


def test_items(spark):
    items = [item("a", category=" ", usd=None), item("b", category3=None, usd=1.25, item_list_name="/l/b"), item("c", usd=2.5, item_list_name="/l/c")]
    df = spark.createDataFrame(
        [raw_event("20240201", "view_item", items=items), raw_event("20240201", "view_item", items=None)], RAW_EVENT
    )
    full, empty = df.select(
        nested.trim_items().alias("items"), nested.first_list_name().alias("first"), nested.items_revenue_usd().alias("usd")
    ).collect()
    assert [(i.item_category, i.item_category_3) for i in full["items"]] == [("(not set)", "Gold"), ("Rings", "(not set)"), ("Rings", "Gold")]
    assert (full["first"], full["usd"]) == ("/l/b", 3.75)
    assert (empty["items"], empty["first"], empty["usd"]) == ([], None, None)
