"""Driver contract: every registered query against its DuckDB oracle on the
smallest driver tables (row count, column names, order-insensitive values)."""

import os
import sys

import pytest

from conftest import ROOT, SF_SMALL

sys.path.insert(0, os.path.join(ROOT, "scripts"))

import __spark_entry__ as E  # noqa: E402

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_SMALL), reason="driver tables not present")


@pytest.fixture(scope="module")
def duck():
    import duckdb
    from oracle_check import TABLES

    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{p}'")
    yield con
    con.close()


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert [f.name for f in df.schema.fields] == ["item_id", "doc_id", "chunk_id", "similarity"]
    assert df.count() >= 0


def test_every_query_registered_with_oracle():
    qs, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(qs)
    assert set(qs) - set(sql) == E.NO_ORACLE


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    from oracle_check import value_hash

    s = E.queries()[name](spark, SF_SMALL).toPandas()
    o = duck.execute(E.oracle_sql()[name]).df()
    assert sorted(s.columns) == sorted(o.columns)
    assert len(s) == len(o)
    assert value_hash(s) == value_hash(o)
