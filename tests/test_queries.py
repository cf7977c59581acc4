import pytest

import __spark_entry__ as entry_point
from sportlake.plans.oracles import ORACLES
from sportlake.plans.registry import QUERIES

TABLES = """region nation customer supplier part orders lineitem events documents embeddings
    pages benchmark labels conversations""".split()


@pytest.fixture(scope="module")
def duck(sf_dir):
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(
            f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'"
        )
    return connection


def test_every_sql_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
    assert set(QUERIES) <= set(entry_point.queries())
    assert set(ORACLES) <= set(entry_point.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, sf_dir, name):
    frame = QUERIES[name](spark, sf_dir)
    columns = sorted(frame.columns)
    got = sorted((tuple(r[c] for c in columns) for r in frame.collect()), key=repr)
    result = duck.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    expected = sorted((tuple(r[i] for i in order) for r in result.fetchall()), key=repr)
    assert got == expected
    assert got


def test_without_sql(spark, sf_dir):
    for name in sorted(set(QUERIES) - set(ORACLES)):
        assert QUERIES[name](spark, sf_dir).count() > 0


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0
