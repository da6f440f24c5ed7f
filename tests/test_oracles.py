"""Every registered query against its SQL, on whole tables."""

import pytest
from oracle import compare, connect

import __spark_entry__ as entries
from fragcube.plans.registry import QUERIES

NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(spark, sf_dir, duck, name):
    df = entries.queries()[name](spark, sf_dir)
    got = [tuple(r) for r in df.collect()]
    sql = entries.oracle_sql().get(name)
    assert sql is not None
    cursor = duck.execute(sql)
    columns = [d[0] for d in cursor.description]
    assert compare(df.columns, got, columns, cursor.fetchall()) is None


def test_entry_runs(spark):
    assert entries.entry(spark).count() > 0
