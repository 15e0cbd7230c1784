"""Derives a raw event export from the driver's tables, following FIXTURES.md section 6.

Arithmetic is integer, or single steps on doubles, so another SQL engine reproduces every
value. Items come from ``lineitem``: every line number and part of an order is one item.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import EngineConfig

DEMO = EngineConfig(as_of_date=date(2024, 2, 15))

DAY_SECONDS = 86_400
SHIFT_DAYS = 15

# Dates without a daily shard, and dates with an intraday shard. 2024-02-10 has
# both, so its intraday rows must be ignored.
DAILY_MISSING = ("20240205", "20240213", "20240214")
INTRADAY_PRESENT = ("20240205", "20240210", "20240213", "20240214")

# Traffic per user and session, indexed by (user_id + sid) mod 9.
CHANNELS = (
    ("Direct", "(direct)", "(none)"),
    ("Organic Search", "google", "organic"),
    ("Paid Search", "google", "cpc"),
    ("Organic Social", "facebook", "organic"),
    ("Display", "dv360", "display"),
    ("Referral", "partner", "referral"),
    ("Email", "newsletter", "internal"),
    ("Cross-network", "google", "cross-network"),
    (None, None, None),
)
# Page types, indexed by event_id mod 8.
PAGE_TYPES = ("home", "PLP", "plp", "pdp", "Cart", "checkout", "order-confirmation", None)
# Shares of the page scrolled, indexed by event_id mod 7; doubles of all sizes.
DEPTHS = (0.0001, 0.5, 12345678.0, 1e9, 1234567.25, 100.0, None)
# Device categories, indexed by user_id mod 4.
DEVICES = ("desktop", "mobile", "tablet", None)
COMMERCE = ("view_item", "view_item_list", "add_to_cart", "add_to_wishlist", "purchase")


def _pick(index: Column, values) -> Column:
    return F.get(F.array(*[F.lit(v).cast("string") for v in values]), index.cast("int"))


def _param(
    key: str, text: Column | None = None, number: Column | None = None, double: Column | None = None
) -> Column:
    return F.struct(
        F.lit(key).alias("key"),
        F.struct(
            (F.lit(None) if text is None else text).cast("string").alias("string_value"),
            (F.lit(None) if number is None else number).cast("bigint").alias("int_value"),
            (F.lit(None) if double is None else double).cast("double").alias("double_value"),
        ).alias("value"),
    )


def _event_name(kind: Column, k: Column) -> Column:
    return (
        F.when(kind == "view", F.when(k < 60, "page_view").otherwise("view_item_list"))
        .when(kind == "click", F.when(k < 40, "view_item").when(k < 70, "add_to_cart").otherwise("add_to_wishlist"))
        .when(kind == "purchase", "purchase")
        .when(kind == "signup", F.when(k < 10, "first_visit").otherwise("session_start"))
        .otherwise(F.when(k < 50, "view_item").otherwise("page_view"))
    )


def order_lines(spark: SparkSession, sf_dir: str, wanted: DataFrame) -> DataFrame:
    """One row per wanted order (``event_id``): its lines as an array, by line number and part.

    Lines that repeat both are one item, with their quantities and revenues summed. They are
    combined before they meet the wanted orders, so that an order holding a large share of all
    lines has shrunk by then; the items are formed from the flat lines where events are nested.
    One raw event row holds all items of its order, as the export's schema has it.
    """
    lines = (
        spark.read.parquet(f"{sf_dir}/lineitem.parquet")
        .groupBy(
            F.col("l_orderkey").alias("event_id"), F.col("l_linenumber").alias("line"), F.col("l_partkey").alias("p_partkey")
        )
        .agg(
            F.sum(F.col("l_quantity").cast("decimal(18,2)")).cast("bigint").alias("quantity"),
            F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("double").alias("revenue"),
        )
        .join(wanted.select("event_id"), "event_id", "left_semi")
    )
    parts = spark.read.parquet(f"{sf_dir}/part.parquet").select("p_partkey", "p_name", "p_type", "p_brand")
    flat = F.struct("line", "p_partkey", "p_name", "p_type", "p_brand", "quantity", "revenue")
    return lines.join(parts, "p_partkey", "left").groupBy("event_id").agg(F.array_sort(F.collect_list(flat)).alias("lines"))


def _item(x: Column) -> Column:
    """The item of a flat line."""
    line, kind, brand = x["line"], x["p_type"], x["p_brand"]
    return F.struct(
        F.concat(F.lit("p"), x["p_partkey"].cast("string")).alias("item_id"),
        x["p_name"].alias("item_name"),
        F.when(line == 5, F.lit("")).otherwise(kind).alias("item_category"),
        brand.alias("item_category3"),
        x["quantity"].alias("quantity"),
        x["revenue"].alias("item_revenue"),
        x["revenue"].alias("item_revenue_in_usd"),
        F.when(line % 2 == 1, F.concat(F.lit("/home/"), kind, F.lit("/"), brand)).alias("item_list_name"),
        F.array(_param("line", text=F.concat(F.lit("L"), line.cast("string")))).alias("item_params"),
    )


def flat_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event once, with all that its raw row is made of, and its ``shard_date``."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    page_count = pages.agg(F.count("*").alias("pages"))
    places = (
        spark.read.parquet(f"{sf_dir}/customer.parquet")
        .select(F.col("c_custkey").alias("user_id"), F.col("c_nationkey").alias("n_nationkey"))
        .join(spark.read.parquet(f"{sf_dir}/nation.parquet"), "n_nationkey")
        .join(spark.read.parquet(f"{sf_dir}/region.parquet").withColumnRenamed("r_regionkey", "n_regionkey"), "n_regionkey")
        .select("user_id", "n_name", "r_name", "n_regionkey")
    )
    eid, uid, k, sid = (F.col(n) for n in ("event_id", "user_id", "k", "sid"))
    events = (
        spark.read.parquet(f"{sf_dir}/events.parquet")
        .withColumns(
            {
                "k": F.get_json_object("props", "$.k").cast("int"),
                "t_us": F.unix_micros(F.col("ts").cast("timestamp")) + SHIFT_DAYS * DAY_SECONDS * 1_000_000,
            }
        )
        .withColumn("sid", F.expr(f"(t_us div 1000000 - 21600) div {DAY_SECONDS}"))
        .withColumns({"c": (uid + sid) % 9, "event_name": _event_name(F.col("event_type"), k)})
        .withColumn("page_id", eid % page_count.scalar())
    )
    commerce = events.where(F.col("event_name").isin(*COMMERCE))
    return (
        events.drop("ts", "event_type", "props")
        .join(pages, "page_id", "left")
        .join(places, "user_id", "left")
        .join(order_lines(spark, sf_dir, commerce), "event_id", "left")
        .withColumn("shard_date", F.date_format(F.timestamp_micros("t_us"), "yyyyMMdd"))
    )


def nested_events(flat: DataFrame, *keep: str) -> DataFrame:
    """Flat events, one to one, with the raw schema; ``keep`` carries other columns along."""
    eid, uid, k, sid, c = (F.col(n) for n in ("event_id", "user_id", "k", "sid", "c"))
    us, day = F.col("t_us"), F.date_format(F.timestamp_micros("t_us"), "yyyyMMdd")
    location = F.when(eid % 11 == 0, F.lit(None)).when(eid % 23 == 0, F.lit("not-a-url")).otherwise(F.col("url"))
    page_kind = _pick(eid % 8, PAGE_TYPES)
    depth = F.get(F.array(*[F.lit(v).cast("double") for v in DEPTHS]), (eid % len(DEPTHS)).cast("int"))
    params = F.array_compact(
        F.array(
            F.when(eid % 53 != 0, _param("ga_session_id", number=sid)),
            _param("ga_session_number", number=sid - 19736),
            F.when(k % 4 == 0, _param("session_engaged", text=F.lit("1")))
            .when(k % 4 == 1, _param("session_engaged", number=F.lit(1)))
            .when(k % 4 == 2, _param("session_engaged", text=F.lit("0"))),
            F.when(eid % 3 != 0, _param("engagement_time_msec", number=k * 100)),
            F.when(location.isNotNull(), _param("page_location", text=location)),
            _param("page_title", text=F.concat(F.lit("Page "), F.col("page_id").cast("string"))),
            F.when(page_kind.isNotNull(), _param("page_type", text=page_kind)),
            F.when(depth.isNotNull(), _param("scroll_depth", double=depth)),
        )
    )
    buys = F.col("event_name") == "purchase"
    platform = F.when(uid % 10 == 0, "ANDROID").when(uid % 10 == 5, "IOS").otherwise("WEB")
    return flat.select(
        day.alias("event_date"),
        us.alias("event_timestamp"),
        "event_name",
        F.when(eid % 101 != 0, F.concat(F.lit("u"), uid.cast("string"))).alias("user_pseudo_id"),
        platform.alias("platform"),
        F.expr("event_id div 4").alias("event_bundle_sequence_id"),
        (eid % 4).alias("batch_event_index"),
        k.cast("bigint").alias("batch_page_id"),
        eid.alias("batch_ordering_id"),
        params.alias("event_params"),
        F.struct(
            _pick(uid % 4, DEVICES).alias("category"),
            F.struct(F.when(platform == "WEB", F.lit("www.example.com")).alias("hostname")).alias("web_info"),
        ).alias("device"),
        F.struct(
            F.when(eid % 13 == 0, F.lit("")).when(eid % 17 == 0, F.lit("(not set)")).otherwise(F.col("n_name")).alias("city"),
            F.when(eid % 19 != 0, F.col("r_name")).alias("region"),
            F.concat(F.lit("Country "), F.col("n_regionkey").cast("string")).alias("country"),
        ).alias("geo"),
        F.struct(
            F.struct(_pick(c, [x[0] for x in CHANNELS]).alias("primary_channel_group")).alias("cross_channel_campaign"),
            F.struct(
                _pick(c, [x[1] for x in CHANNELS]).alias("source"),
                _pick(c, [x[2] for x in CHANNELS]).alias("medium"),
            ).alias("manual_campaign"),
        ).alias("session_traffic_source_last_click"),
        F.when(
            buys,
            F.struct(
                F.when(k == 0, F.lit(None))
                .when(k == 1, F.lit(""))
                .when(k == 2, F.lit("(not set)"))
                .otherwise(F.concat(F.lit("T"), F.expr("event_id div 20").cast("string")))
                .alias("transaction_id"),
                # parts of a cent, so that rounding before or after a division shows
                F.when(k % 10 != 9, F.col("value") * 4 + (eid % 7).cast("double") * 0.001).alias("purchase_revenue"),
                F.when(k == 50, -F.col("value")).otherwise(F.col("value")).alias("purchase_revenue_in_usd"),
                (k % 5 + 1).cast("bigint").alias("total_item_quantity"),
            ),
        ).alias("ecommerce"),
        F.when(F.col("event_name").isin(*COMMERCE), F.transform("lines", _item)).alias("items"),
        "shard_date",
        *keep,
    )


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event once, with the raw schema; ``shard_date`` is its own date."""
    return nested_events(flat_events(spark, sf_dir))


def export_rows(events: DataFrame, number: str = "batch_ordering_id") -> DataFrame:
    """Each event once per shard it is exported in, tagged with the shard ``family``.

    Intraday shards hold every tenth of their events twice, as a replay would.
    """
    day = F.col("shard_date")
    in_daily, in_intraday = ~day.isin(*DAILY_MISSING), day.isin(*INTRADAY_PRESENT)
    families = F.array_compact(
        F.array(
            F.when(in_daily, F.lit("daily")),
            F.when(in_intraday, F.lit("intraday")),
            F.when(in_intraday & (F.col(number) % 10 == 0), F.lit("intraday")),
        )
    )
    return events.withColumn("family", F.explode(families))


def family_rows(raw: DataFrame, family: str) -> DataFrame:
    return export_rows(raw).where(F.col("family") == family).drop("family")


def dealt_events(flat: DataFrame) -> DataFrame:
    """Events dealt out to the shards of both families: flat, as nested they are several times the size."""
    return export_rows(flat, "event_id").hint("rebalance", "family", "shard_date")


def write_export(flat: DataFrame, root: str) -> None:
    """Both shard families in one pass over the events; read ``family_path`` of either back."""
    (
        nested_events(dealt_events(flat), "family")
        .sortWithinPartitions("family", "shard_date", "event_timestamp")
        .write.mode("overwrite")
        .partitionBy("family", "shard_date")
        .parquet(root)
    )


def family_path(root: str, family: str) -> str:
    return f"{root}/family={family}"
