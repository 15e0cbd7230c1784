"""Every registered query of the event models against independent SQL on the same tables.

The training-data queries, which SQL expresses in part only, have tests of their own.
"""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import __spark_entry__ as entry_module  # noqa: E402
from helpers import assert_matches_sql, duck  # noqa: E402

from parity.queries import QUERIES as OWN  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"
QUERIES, EXPECTED = entry_module.queries(), entry_module.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_every_query_has_sql():
    assert set(OWN) <= set(QUERIES) and set(OWN) <= set(EXPECTED) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(OWN))
def test_query(spark, con, name):
    assert_matches_sql(QUERIES[name](spark, SF_DIR), con, EXPECTED[name])


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0
