"""Every registered query against its SQL on the smallest sample."""

from pathlib import Path

import pytest
from oracle_check import compare, connect

from __spark_entry__ import entry
from verification.oracles import ORACLES
from verification.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no sample tables here")


@pytest.fixture(scope="module")
def connection():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, connection, name):
    assert compare(connection, spark, SF_DIR, QUERIES[name], ORACLES[name]) == ""


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_entry(spark):
    assert entry(spark).columns[0] == "user_id"
