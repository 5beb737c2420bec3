"""The registered queries against their SQL, on the smallest test tables."""

import pytest

import __spark_entry__ as contract
from checks import oracle, registry
from checks.compare import difference, duckdb_over

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def sql_engine():
    return duckdb_over(SF_DIR)


def test_every_query_has_sql():
    assert set(registry.queries()) == set(oracle.queries())


def test_the_contract_has_all_queries_of_the_library():
    assert set(registry.queries()) <= set(contract.queries())
    assert set(oracle.queries()) <= set(contract.oracle_sql()) <= set(contract.queries())


def test_entry_gives_rows(spark):
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("name", list(registry.queries()))
def test_query_equals_its_sql(spark, sql_engine, name):
    got = registry.queries()[name](spark, SF_DIR).toPandas()
    assert difference(got, sql_engine.execute(oracle.queries()[name]).df()) is None


def test_nothing_is_empty_but_the_empty_result(sql_engine):
    rows = {n: sql_engine.execute(f"SELECT count(*) FROM ({q})").fetchone()[0] for n, q in oracle.queries().items()}
    assert [n for n, count in rows.items() if not count] == ["empty_result"]


@pytest.mark.parametrize("optimizer", ["", "filter_pushdown"])
def test_sql_needs_no_particular_optimizer(optimizer):
    engine = duckdb_over(SF_DIR)
    engine.execute("SET threads = 1")
    engine.execute("SET memory_limit = '1GB'")
    engine.execute(f"SET disabled_optimizers = '{optimizer}'")
    for sql in oracle.queries().values():
        engine.execute(sql).fetchall()
