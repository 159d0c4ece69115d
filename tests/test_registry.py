"""Every registered query against its SQL, on the smallest data set."""

from pathlib import Path

import pytest
from check_oracle import compare, connect

from folioscope.plans.oracle import ORACLE
from folioscope.plans.registry import QUERIES

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(DATA).exists(), reason="no test data")


@pytest.fixture(scope="module")
def con():
    return connect(DATA)


@pytest.mark.parametrize("key", list(QUERIES))
def test_query(spark, con, key):
    agrees, note = compare(spark, con, DATA, key)
    assert agrees, note


def test_oracles_belong_to_queries():
    assert set(ORACLE) <= set(QUERIES)


def test_statistics_never_read_texts(spark, plan_of):
    plan = plan_of(QUERIES["author_stats_by_year_min"](spark, DATA))
    scans = [line for line in plan.splitlines() if "ReadSchema" in line]
    assert any("doc_id" in line for line in scans) and not any("text" in line for line in scans)
