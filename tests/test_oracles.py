"""Every registered query beside its oracle SQL on the smallest data set."""

import os

import pytest

from sensorgrid.plans.catalog import ORACLES, QUERIES
from tests.compare import compare, connect

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    diff = compare(spark, duck, SF_DIR, QUERIES[name], ORACLES.get(name))
    assert diff == "", diff


def test_oracles_belong_to_queries():
    assert set(ORACLES) <= set(QUERIES)
