"""Every registered query against its SQL twin at the smallest scale."""

from concurrent.futures import ThreadPoolExecutor

import pytest

import __spark_entry__ as entry
from fixtures.catalog import ORACLES, QUERIES
from fixtures.catalog.registry import STAGES, stage
from tools.check import norm, rows


@pytest.fixture(scope="session")
def results(spark, duck, sf):
    """Both results of every query; queries run side by side, their stages are written before."""
    for name in STAGES:
        stage(spark, sf, name)

    def both(name):
        try:
            df = QUERIES[name](spark, sf)
            got = rows(df.collect(), df.columns)
            result = duck.cursor().execute(ORACLES[name])
            columns = [d[0] for d in result.description]
            return sorted(df.columns), got, sorted(columns), rows(result.fetchall(), columns)
        except Exception as e:  # reported by the query's own test
            return e

    with ThreadPoolExecutor(8) as pool:
        return dict(zip(QUERIES, pool.map(both, QUERIES)))


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(results, name):
    result = results[name]
    if isinstance(result, Exception):
        raise result
    spark_columns, spark_rows, sql_columns, sql_rows = result
    assert spark_columns == sql_columns
    assert spark_rows == sql_rows


def test_entry_registers_all_of_them():
    assert QUERIES.items() <= entry.queries().items() and ORACLES.items() <= entry.oracle_sql().items()


def test_entry_gives_key_counts(spark):
    df = entry.entry(spark)
    assert df.columns == ["mkey", "n"] and df.count() > 10


def test_norm_treats_negative_zero_as_zero():
    assert repr(norm(-0.0)) == "0.0"
