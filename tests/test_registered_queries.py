"""Every registered query against its SQL; queries without SQL must give rows."""

import pytest

import __spark_entry__ as registry
import compare

QUERIES, ORACLE = registry.queries(), registry.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    pytest.importorskip("duckdb")
    return compare.connect(sf_dir)


def test_every_sql_belongs_to_a_query():
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, sf_dir, duck, name):
    assert compare.difference(QUERIES[name](spark, sf_dir), duck, ORACLE[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_query_without_sql_gives_rows(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_entry(spark):
    rows = registry.entry(spark).collect()
    assert len(rows) == 200 and {r.split for r in rows} == {"train", "test"}
