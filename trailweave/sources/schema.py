"""Raw event schema. Fixed up front: no inference, and structs missing from a file read as NULL."""

from __future__ import annotations

_PARAMS = """array<struct<
    key: string,
    value: struct<string_value: string, int_value: bigint, double_value: double>
>>"""

RAW_EVENT = f"""
    event_date string,
    event_timestamp bigint,
    event_name string,
    user_pseudo_id string,
    platform string,
    event_bundle_sequence_id bigint,
    batch_event_index bigint,
    batch_page_id bigint,
    batch_ordering_id bigint,
    event_params {_PARAMS},
    device struct<category: string, web_info: struct<hostname: string>>,
    geo struct<city: string, region: string, country: string>,
    session_traffic_source_last_click struct<
        cross_channel_campaign: struct<primary_channel_group: string>,
        manual_campaign: struct<source: string, medium: string>
    >,
    ecommerce struct<
        transaction_id: string,
        purchase_revenue: double,
        purchase_revenue_in_usd: double,
        total_item_quantity: bigint
    >,
    items array<struct<
        item_id: string,
        item_name: string,
        item_category: string,
        item_category3: string,
        quantity: bigint,
        item_revenue: double,
        item_revenue_in_usd: double,
        item_list_name: string,
        item_params: {_PARAMS}
    >>,
    shard_date string
    """

# What makes a raw event physically unique. The first four columns alone are not enough:
# the export puts several events into one bundle and microsecond.
PHYSICAL_KEY = (
    "user_pseudo_id",
    "event_name",
    "event_timestamp",
    "event_bundle_sequence_id",
    "batch_event_index",
    "batch_page_id",
    "batch_ordering_id",
)
