"""Every registered query against its SQL, and what all their plans must not hold."""

import duckdb
import pytest

import __spark_entry__ as entry

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def sql(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return repr(round(value, 6))
    return None if value is None else str(value)


def ordered(rows):
    return sorted(rows, key=lambda row: tuple((v is not None, v or "") for v in row))


@pytest.mark.parametrize("name", list(entry.queries()))
def test_query(spark, sf_dir, sql, name):
    made = entry.queries()[name](spark, sf_dir)
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    columns = sorted(made.columns)
    got = ordered(tuple(plain(r[c]) for c in columns) for r in made.collect())
    if name not in entry.oracle_sql():
        assert got
        return
    result = sql.execute(entry.oracle_sql()[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    assert got == ordered(tuple(plain(row[i]) for i in at) for row in result.fetchall())


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
