"""Every registered query against its SQL on the given tables."""

import pytest

from tallyhawk.plans.oracles import ORACLES
from tallyhawk.plans.registry import QUERIES
from tests.oracle import compare, connect

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, db, name):
    assert compare(QUERIES[name](spark, SF_DIR), db, ORACLES[name]) == []
