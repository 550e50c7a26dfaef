"""Every query against its SQL on the smallest tables."""

import os

import pytest

from tests.oracle import connect
from tests.oracle import compare
from weftline.plans import queries

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_oracle(spark, con, name):
    assert compare(spark, con, name, queries.QUERIES[name], queries.ORACLES[name], SF) > 0


def test_queries_without_sql(spark):
    capped = queries.QUERIES["analogy_capped"](spark, SF)
    assert capped.count() > 0
    assert capped.groupBy("src").count().where("count > 3").isEmpty() and capped.groupBy("dst").count().where("count > 2").isEmpty()
