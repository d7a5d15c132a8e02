"""Registered queries against their SQL on the smallest driver tables (oracle_check.py runs all of them)."""

import os

import pytest

from oracle_check import connect, difference
from roadledger.catalog import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"
SLOW = {"e_cross_counts"}
FAST = [n for n in QUERIES if n[:2] in ("b_", "c_", "d_", "e_", "f_") and n not in SLOW]

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables are not here")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(ORACLES) == set(QUERIES)


@pytest.mark.parametrize("name", FAST)
def test_query(spark, con, name):
    assert difference(QUERIES[name](spark, SF_DIR), con, ORACLES[name]) is None
