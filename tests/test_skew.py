"""Skewed inputs: results stay whole when one key holds a large share of the rows.

A third of all events belongs to one user, another third has no user id, a third of all
lines belongs to one order, and a third of the events happens on one day.
"""

import pytest
from helpers import TABLES, assert_matches_sql, duck

from parity.deployment import Deployment
from parity.expected import EXPECTED
from parity.queries import QUERIES

SOURCE = "/root/testdata/sf0.001"
NAMES = sorted(n for n in QUERIES if n.startswith(("gold_", "int_", "stg_", "nested_item_sum", "inc_sessions")))


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    folder = tmp_path_factory.mktemp("skewed")
    con = duck(SOURCE)
    for table in TABLES:
        rows = f"SELECT * FROM {table}"
        if table == "events":
            # ids that are multiples of 101 carry no user id; the hot user acts on one day
            rows = """
              SELECT * FROM events
              UNION ALL SELECT event_id, ts, 7, event_type, value, props FROM events
              UNION ALL SELECT event_id * 101, TIMESTAMP '2024-01-20 12:00:00' + to_seconds(event_id), user_id,
                event_type, value, props FROM events"""
        elif table == "lineitem":
            rows = "SELECT * FROM lineitem UNION ALL SELECT * REPLACE (42 AS l_orderkey) FROM lineitem"
        con.execute(f"COPY ({rows}) TO '{folder}/{table}.parquet' (FORMAT parquet)")
    return str(folder)


@pytest.fixture(scope="module")
def skewed_con(skewed):
    return duck(skewed)


@pytest.mark.parametrize("name", NAMES)
def test_skewed(spark, skewed, skewed_con, name):
    assert_matches_sql(QUERIES[name](Deployment.of(spark, skewed)), skewed_con, EXPECTED[name])
