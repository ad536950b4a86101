"""Every query with SQL gives DuckDB's rows, column names and types."""

import duckdb
import pytest

from cladeworks.plans import queries

DATA = "/root/testdata/sf0.001"
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("lineitem", "supplier"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


def plain(rows):
    return sorted(tuple(f"{x:.6f}" if isinstance(x, float) else str(x) for x in r) for r in rows)


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query(spark, duck, name):
    df = queries.QUERIES[name](spark, DATA)
    want = duck.sql(queries.SQL[name])
    columns = sorted(df.columns)
    assert columns == sorted(want.columns)
    kinds = dict(zip(want.columns, map(str, want.types), strict=True))
    assert {c: TYPES[k] for c, k in df.dtypes} == kinds
    rows = want.fetchall()
    assert plain(tuple(r[c] for c in columns) for r in df.collect()) == plain(tuple(r[want.columns.index(c)] for c in columns) for r in rows)


def test_all_run(spark):
    for name in sorted(set(queries.QUERIES) - set(queries.SQL)):
        assert queries.QUERIES[name](spark, DATA).count() > 0, name


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
