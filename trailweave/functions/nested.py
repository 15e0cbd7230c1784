"""Readers for the export's key/value parameter arrays and item arrays.

Keys are looked up with ``array_position`` over the projected key array: unlike a lambda
``filter`` this stays inside generated code, and unlike a map it tolerates repeated keys
(the first occurrence wins).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import NOT_SET, strip


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def param_value(key: str, params: Column | str = "event_params") -> Column:
    """The typed value union stored under ``key``; NULL when absent."""
    params = _col(params)
    at = F.array_position(params.getField("key"), F.lit(key)) - 1
    return F.get(params, at.cast("int")).getField("value")


def param_string(key: str, params: Column | str = "event_params") -> Column:
    return param_value(key, params).getField("string_value")


def param_int(key: str, params: Column | str = "event_params") -> Column:
    return param_value(key, params).getField("int_value")


def plain_double(c: Column) -> Column:
    """A double as text: no fraction if whole, and digits instead of an exponent from 1e-4 up to 1e15."""
    text = F.regexp_replace(c.cast("string"), r"\.0$", "")
    sign, digits = F.regexp_extract(text, "^-", 0), F.regexp_replace(F.regexp_extract(text, r"^-?([0-9.]+)E", 1), r"\.", "")
    power = F.regexp_extract(text, r"E(-?[0-9]+)$", 1)
    e = F.when(power != "", power.cast("int"))
    digits = F.rtrim(digits, F.lit("0"))
    whole = F.rpad(F.substring(digits, F.lit(1), e + 1), e + 1, F.lit("0"))
    fraction = F.substring(digits, e + 2, F.length(digits))
    large = F.concat(sign, whole, F.when(fraction != "", F.concat(F.lit("."), fraction)).otherwise(F.lit("")))
    small = F.concat(sign, F.lit("0."), F.repeat(F.lit("0"), -e - 1), digits)
    return F.when(e.between(7, 14), large).when(e.between(-4, -1), small).otherwise(text)


def param_any(key: str, params: Column | str = "event_params") -> Column:
    """Whichever variant of the union is set, as text: string, then int, then double."""
    value = param_value(key, params)
    return F.coalesce(
        value.getField("string_value"),
        value.getField("int_value").cast("string"),
        plain_double(value.getField("double_value")),
    )


def item_param_string(key: str, item: Column | str) -> Column:
    return param_string(key, _col(item).getField("item_params"))


def _category(c: Column) -> Column:
    return F.coalesce(F.nullif(strip(c), F.lit("")), F.lit(NOT_SET))


def trim_items(items: Column | str = "items") -> Column:
    """Items reduced to the eight reported fields, blank categories named; NULL becomes empty."""

    def keep(item: Column) -> Column:
        return F.struct(
            item.getField("item_id").alias("item_id"),
            item.getField("item_name").alias("item_name"),
            _category(item.getField("item_category")).alias("item_category"),
            _category(item.getField("item_category3")).alias("item_category_3"),
            item.getField("quantity").alias("quantity"),
            item.getField("item_revenue").alias("item_revenue"),
            item.getField("item_revenue_in_usd").alias("item_revenue_in_usd"),
            item.getField("item_list_name").alias("item_list_name"),
        )

    return F.coalesce(F.transform(_col(items), keep), F.array())


def first_list_name(items: Column | str = "items") -> Column:
    """First item list name that is set, in item order."""
    return F.get(F.array_compact(_col(items).getField("item_list_name")), F.lit(0))


def items_revenue_usd(items: Column | str = "items") -> Column:
    """USD revenue over the row's items; NULL when no item carries any.

    Summed as exact decimals, so the total does not depend on item order.
    """
    amounts = F.array_compact(_col(items).getField("item_revenue_in_usd"))
    total = F.aggregate(
        amounts,
        F.lit(0).cast("decimal(34,6)"),
        lambda acc, x: (acc + x.cast("decimal(24,6)")).cast("decimal(34,6)"),
    )
    return F.when(F.size(amounts) > 0, F.round(total, 2).cast("double"))
