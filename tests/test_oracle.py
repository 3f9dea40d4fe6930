"""Every published query against its SQL, at the scale the results are judged at."""

import os

import pytest
from oracle import compare, connect

from sparrowmill.registry import all_queries

SF = os.environ.get("ORACLE_SF", "0.01")
QUERIES = all_queries()


@pytest.fixture(scope="module")
def duck():
    return connect(f"/root/testdata/sf{SF}")


@pytest.mark.parametrize("name", [n for n, q in QUERIES.items() if q.oracle])
def test_matches_sql(name, spark, duck):
    rows, problem = compare(QUERIES[name], spark, f"/root/testdata/sf{SF}", duck)
    assert problem is None, problem
    if SF == "0.01":
        assert rows > 0


def test_every_query_has_an_oracle():
    assert [n for n, q in QUERIES.items() if not q.oracle] == []
