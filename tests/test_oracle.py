"""Every registered query against its SQL counterpart."""

import pytest

import __spark_entry__ as contract
from compare import compare, duck

from millrace.workload import oracle, queries as workload

QUERIES = workload.queries()
ORACLE = oracle.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLE.keys()
    assert len(QUERIES) == 64
    assert QUERIES.keys() <= contract.queries().keys()
    assert ORACLE.items() <= contract.oracle_sql().items()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_sql(spark, sf_dir, con, name):
    count, problems = compare(QUERIES[name](spark, sf_dir), con, ORACLE[name])
    assert problems == []
    assert count > 0


def test_entry_runs(spark):
    assert contract.entry(spark).columns == ["category", "rank", "term", "score"]
