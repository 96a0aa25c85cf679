"""Every registered query with an oracle matches DuckDB on the small tables."""

import pytest

import __spark_entry__ as E
from _compare import duck, rows_of
from mercato.plans import registry

ORACLE = {k: v for k, v in E.oracle_sql().items() if k in registry.queries()}
NAMES = sorted(ORACLE)


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("name", NAMES)
def test_matches_oracle(spark, sf_dir, con, name):
    df = E.queries()[name](spark, sf_dir)
    s_cols, s_rows = rows_of(df.columns, df.collect())
    res = con.execute(ORACLE[name])
    o_cols, o_rows = rows_of([d[0] for d in res.description], res.fetchall())
    assert s_cols == o_cols
    assert s_rows == o_rows


def test_every_query_registered_with_oracle_or_rows_only():
    assert set(ORACLE) | registry.ROWS_ONLY == set(registry.queries())
    assert set(registry.queries()) <= set(E.queries())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "gross_margin_pct" in df.columns
