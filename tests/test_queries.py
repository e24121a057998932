"""Every registered query against its SQL, on whole tables."""

import os

import pytest

import __spark_entry__ as entry_module
from sensorloom import plans
from tests import oracle

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES = plans.queries()
ORACLES = plans.oracles()


@pytest.fixture(scope="module")
def duck():
    return oracle.connect(SF_DIR)


def test_all_queries_have_sql():
    assert set(QUERIES) == set(ORACLES)
    assert QUERIES.keys() <= entry_module.queries().keys() and ORACLES.keys() <= entry_module.oracle_sql().keys()


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(name, spark, duck):
    assert oracle.check(QUERIES[name](spark, SF_DIR), duck, ORACLES[name]) > 0


def test_entry(spark):
    frames = entry_module.entry(spark)
    assert frames.count() == frames.filter("is_hash_valid").count() > 0
