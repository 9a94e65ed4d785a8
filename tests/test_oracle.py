"""Every registered query with a SQL twin equals DuckDB on the same parquet tables (sf0.001)."""

import pytest

import __spark_entry__ as entry
from scripts.check_oracle import digest

from conftest import SMALL

SQL = entry.oracle_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_duckdb(spark, duck, name):
    sdf = entry.queries()[name](spark, SMALL)
    srows = [tuple(r) for r in sdf.collect()]
    cur = duck.execute(SQL[name])
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    assert sorted(sdf.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert digest(sdf.columns, srows)[0] == digest(dcols, drows)[0]


def test_every_sql_key_is_a_query():
    assert set(SQL) <= set(entry.queries())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert set(df.columns) == {"user_id", "rank", "item_id", "score"}
