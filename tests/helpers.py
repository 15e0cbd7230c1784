"""Comparison of Spark results with DuckDB, and builders of raw rows."""

from __future__ import annotations

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def _cell(v):
    return float(f"{v:.12g}") if isinstance(v, float) else v


def _order(row):
    return tuple((v is None, 0 if v is None else v) for v in row)


def canonical(columns, rows):
    """Rows with columns in name order, sorted."""
    by_name = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_cell(r[i]) for i in by_name) for r in rows), key=_order)


def spark_rows(df):
    return canonical(df.columns, [tuple(r) for r in df.collect()])


def assert_same(left, right):
    assert sorted(left.columns) == sorted(right.columns)
    assert spark_rows(left) == spark_rows(right)


def assert_matches_sql(df, con, sql):
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    assert spark_rows(df) == canonical(columns, cursor.fetchall())


def param(key, text=None, number=None, double=None):
    return {"key": key, "value": {"string_value": text, "int_value": number, "double_value": double}}


def raw_event(
    day, name, user="u1", micros=0, sid=1, number=1, engaged=None, shard=None, index=0, items=None, tx=None, usd=None, **extra
):
    """One raw event as a dict of the raw schema's columns."""
    params = list(extra.pop("params", []))
    if sid is not None:
        params.append(param("ga_session_id", number=sid))
    if number is not None:
        params.append(param("ga_session_number", number=number))
    if engaged is not None:
        params.append(param("session_engaged", text=engaged))
    row = {
        "event_date": day,
        "event_timestamp": micros,
        "event_name": name,
        "user_pseudo_id": user,
        "platform": "WEB",
        "event_bundle_sequence_id": 1,
        "batch_event_index": index,
        "batch_page_id": 1,
        "batch_ordering_id": 1,
        "event_params": params,
        "device": {"category": "desktop", "web_info": {"hostname": "www.example.com"}},
        "geo": {"city": "Pune", "region": "MH", "country": "India"},
        "session_traffic_source_last_click": {
            "cross_channel_campaign": {"primary_channel_group": "Direct"},
            "manual_campaign": {"source": None, "medium": None},
        },
        "ecommerce": {
            "transaction_id": tx,
            "purchase_revenue": usd,
            "purchase_revenue_in_usd": usd,
            "total_item_quantity": None,
        },
        "items": items,
        "shard_date": shard or day,
    }
    row.update(extra)
    return row


def item(item_id, category="Rings", category3="Gold", usd=10.0, **extra):
    row = {
        "item_id": item_id,
        "item_name": item_id,
        "item_category": category,
        "item_category3": category3,
        "quantity": 1,
        "item_revenue": usd,
        "item_revenue_in_usd": usd,
        "item_list_name": None,
        "item_params": [],
    }
    row.update(extra)
    return row
