"""Each registered query against its check query on the smallest tables."""

import pytest

import __spark_entry__ as entry
from jobtide.plans.catalogue import ALL
from compare import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def check():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(ALL))
def test_query(spark, check, name):
    problem = compare(spark, check, SF, name, entry.queries()[name], entry.oracle_sql().get(name))
    # the smallest tables hold no line beyond the limit
    if name == "long_lines" and problem == "no rows on either side":
        return
    assert problem is None, problem


def test_entry(spark):
    assert entry.entry(spark).columns == ["routing_key", "events", "jobs", "retries"]
