"""The registered queries against their check SQL on the smallest tables."""

import pytest

from compare import compare, connect
from jobtide.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def check():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(n for n, (_, sql) in QUERIES.items() if sql))
def test_query(spark, check, name):
    problem = compare(spark, check, SF, name, *QUERIES[name])
    assert problem is None, problem


def test_registered():
    import __spark_entry__ as entry

    names = list(entry.queries())
    assert [n.split("_")[0] for n in names if n.startswith("op")] == [f"op{i}" for i in range(1, 14)] and "pipeline" in names
