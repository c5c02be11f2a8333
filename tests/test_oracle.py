"""Every query with a SQL twin must equal it on the smallest data."""

import check
import pytest

import __spark_entry__ as entry

QUERIES = entry.queries()
ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = check.connect(sf_dir)
    yield con
    con.close()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(name, spark, duck, sf_dir):
    df = QUERIES[name](spark, sf_dir)
    rows = [tuple(r) for r in df.collect()]
    cursor = duck.execute(ORACLES[name])
    fault = check.difference(rows, df.columns, cursor.fetchall(), [c[0] for c in cursor.description])
    assert fault is None, fault


def test_oracles_belong_to_queries():
    assert set(ORACLES) <= set(QUERIES)


def test_entry_runs(spark):
    assert entry.entry(spark).count() == 5
