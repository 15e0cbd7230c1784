"""Normalisers for page, device and geography text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters after which a new word starts, as a regex character class body.
WORD_BREAKS = r"\s\[\](){}/|\\<>!?@\"^#$&~_,.:;*%+\-"

_ADDED = "\x01 "

# Placeholder texts.
UNKNOWN = "Unknown"
NOT_SET = "(not set)"

# Fixed value: the characters trimmed off both ends of a text.
BLANKS = " \t\n\r\x0b\x0c"

# Fixed value: scheme and host, then the path up to the query or fragment.
PATH_PATTERN = r"^https?://[^/]+(/[^?#]*)"


def strip(c: Column) -> Column:
    """Trim every kind of white space; Spark's plain ``trim`` only takes spaces."""
    return F.trim(c, F.lit(BLANKS))


def init_cap(c: Column) -> Column:
    """Capitalise each word, words ending at punctuation as well as at spaces.

    Spark's own ``initcap`` only breaks at spaces, so it gets one after every break and the
    added ones are taken out again; a control character tells them from the text's own.
    """
    spaced = F.regexp_replace(c, f"([{WORD_BREAKS}])", "$1" + _ADDED)
    return F.replace(F.initcap(spaced), F.lit(_ADDED), F.lit(""))


def page_path(location: Column) -> Column:
    return F.coalesce(F.nullif(F.regexp_extract(location, PATH_PATTERN, 1), F.lit("")), F.lit("/"))


def page_type(raw: Column) -> Column:
    folded = F.lower(raw)
    return (
        F.when(folded == "pdp", F.lit("PDP"))
        .when(folded == "plp", F.lit("PLP"))
        .otherwise(init_cap(raw))
    )


def device_class(platform: Column, category: Column) -> Column:
    return (
        F.when(platform.isin("ANDROID", "IOS"), F.lit("Mobile App"))
        .when(category.isNull(), F.lit(UNKNOWN))
        .otherwise(init_cap(category))
    )


def geo_clean(c: Column) -> Column:
    trimmed = strip(c)
    return F.when(trimmed.isin("", NOT_SET), F.lit(UNKNOWN)).otherwise(F.coalesce(trimmed, F.lit(UNKNOWN)))


def geo_all_or_unknown(city: Column, region: Column, country: Column) -> tuple[Column, Column, Column]:
    """All three places, or all three Unknown when any one of them is unresolved."""
    places = [geo_clean(c) for c in (city, region, country)]
    unresolved = (places[0] == UNKNOWN) | (places[1] == UNKNOWN) | (places[2] == UNKNOWN)
    return tuple(F.when(unresolved, F.lit(UNKNOWN)).otherwise(p) for p in places)


def city_state_country(city: Column, state: Column, country: Column) -> Column:
    return F.concat(city, F.lit(" ("), state, F.lit(", "), country, F.lit(")"))


def city_comma_label(city: Column, state: Column, country: Column) -> Column:
    return F.when(city == UNKNOWN, F.lit(NOT_SET)).otherwise(F.concat(city, F.lit(", "), state, F.lit(", "), country))


def last_path_segment(c: Column) -> Column:
    """Text after the last slash, trimmed; Unknown when nothing is left."""
    return F.coalesce(F.nullif(strip(F.substring_index(strip(c), "/", -1)), F.lit("")), F.lit(UNKNOWN))
