"""Registered queries against their SQL twins, all of them."""

import os

import pytest

import __spark_entry__ as entry_point
from workload.compare import compare, connect

FOLDER = "/root/testdata/sf0.001"
NAMES = list(entry_point.queries())
ORACLES = [n for n in NAMES if n in entry_point.oracle_sql()]

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


def test_every_oracle_has_a_query():
    assert set(entry_point.oracle_sql()) <= set(NAMES)


# The queries of the optional subpackage have tests of their own.
@pytest.mark.parametrize("name", [n for n in ORACLES if n not in entry_point.LLM_QUERIES])
def test_query(spark, duck, name):
    problem = compare(spark, duck, name, FOLDER)
    assert problem is None, problem


def test_entry(spark):
    assert entry_point.entry(spark).columns[0] == "id_client"
