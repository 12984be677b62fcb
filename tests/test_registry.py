import duckdb
import pytest

import __spark_entry__ as entry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
OWN = sorted(n for n in entry.queries() if not n.startswith("op") and n != "pipeline")


@pytest.fixture(scope="session")
def duck(small):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{small}/{t}.parquet'")
    return con


def shown(value):
    if value is None or value != value:
        return None
    return f"{value:.5f}" if isinstance(value, float) else str(value)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted((tuple(shown(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", OWN)
def test_query(spark, small, duck, name):
    df = entry.queries()[name](spark, small)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if name in entry.oracle_sql():
        found = duck.execute(entry.oracle_sql()[name])
        assert got == rows_of([c[0] for c in found.description], found.fetchall())
    else:
        assert got[1]


def test_entry(spark):
    assert entry.entry(spark).count() > 0
