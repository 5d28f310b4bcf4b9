"""Every registered query against its DuckDB oracle (sf0.001)."""

import pytest

import __spark_entry__ as E
from docweave.plans import load_all
from scripts.oracle_check import canon, duck_conn, rows_of_duck

# the training-data subpackage has its own tests
QUERIES = {k: f for k, f in E.queries().items() if k in load_all()}
SQL = {k: q for k, q in E.oracle_sql().items() if k in load_all()}


@pytest.fixture(scope="module")
def con(small_dir):
    return duck_conn(small_dir)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("key", sorted(SQL))
def test_query_matches_oracle(spark, small_dir, con, key):
    df = QUERIES[key](spark, small_dir)
    sc, sr = canon(df.columns, [tuple(r) for r in df.collect()])
    dcols, drows = rows_of_duck(con, SQL[key])
    dc, dr = canon(dcols, drows)
    assert sc == dc
    assert len(sr) == len(dr)
    assert sr == dr


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["source", "target_lang", "n_docs", "n_parts", "part_chars", "est_tokens"]
