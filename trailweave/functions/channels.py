"""Traffic channel groupings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Default channel groups counted as organic and as paid; the rest is 'other'.
ORGANIC_GROUPS = ("Organic Search", "Organic Social", "Organic Video", "Organic Shopping")
PAID_GROUPS = (
    "Paid Search",
    "Paid Social",
    "Paid Video",
    "Paid Shopping",
    "Paid Other",
    "Display",
    "Cross-network",
)


def organic_paid_bucket(channel: Column) -> Column:
    return (
        F.when(channel.isin(*ORGANIC_GROUPS), F.lit("organic"))
        .when(channel.isin(*PAID_GROUPS), F.lit("paid"))
        .otherwise(F.lit("other"))
    )


def legacy_channel(source: Column, medium: Column) -> Column:
    """The older source/medium grouping; the first matching rule names the channel."""
    source_key, medium_key = F.lower(source), F.lower(medium)
    return (
        F.when((source_key == "(direct)") & (medium_key == "(none)"), F.lit("Direct"))
        .when(medium_key == "organic", F.lit("Organic"))
        .when(medium_key.like("%referral%"), F.lit("Referring Domains"))
        .when(medium_key == "internal", F.lit("Internal"))
        .when(source.isNull() & medium.isNull(), F.lit("Unassigned"))
        .otherwise(F.lit("Paid"))
    )
