import os

import pytest

from __spark_entry__ import entry
from firstprint.plans.registry import ORACLES, QUERIES
from tools.check import compare, duck

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_entry_runs(spark):
    assert entry(spark).count() > 0


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, con, name):
    text, ok = compare(spark, con, SF, name, QUERIES[name], ORACLES[name])
    assert ok, text
