"""Cases in which a row was once stored twice, lost or left out."""

import datetime as dt
import os
import subprocess
import sys
import uuid

import pytest
from pyspark.sql import functions as F

from mercato.operators import timeintel as T
from mercato.plans import questions as Q
from mercato.sources import files, tables

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _sales(spark, rows):
    return spark.createDataFrame([(dt.date(*d), float(x), "Event", 1) for d, x in rows],
                                 "sales_date date, revenue double, promo_name string, nb_orders long")


def as_of():
    return F.lit("2001-03-15").cast("date")


def test_a_month_sold_last_year_only_shows_as_lost(spark):
    sales = _sales(spark, [((2000, 1, 5), 4), ((2000, 2, 5), 6), ((2001, 1, 5), 5)])
    got = {(r.year, r.month_num): (r.year_month, r.revenue, r.revenue_ly, r.revenue_vs_ly)
           for r in T.vs_last_year_monthly(T.monthly_revenue(sales), as_of()).toLocalIterator()}
    assert got == {(2000, 1): ("2000-01", 4, None, None), (2000, 2): ("2000-02", 6, None, None),
                   (2001, 1): ("2001-01", 5, 4, 0.25), (2001, 2): ("2001-02", None, 6, -1.0)}  # not 2002-01, which is to come


def test_vanished_years_quarters_months_and_events_show(spark):
    sales = _sales(spark, [((1999, 5, 5), 8), ((2001, 1, 5), 5)])
    year = {r.year: (r.revenue, r.growth) for r in Q.q16_year_over_year(sales, as_of()).toLocalIterator()}
    assert year == {1999: (8, None), 2000: (None, -1.0), 2001: (5, None)}
    quarter = {(r.year, r.quarter): r.growth for r in Q.q16_quarter_over_quarter(sales, as_of()).toLocalIterator()}
    assert quarter == {(1999, 2): None, (2000, 2): -1.0, (2001, 1): None}
    month = {(r.year, r.month): r.growth for r in Q.q18_month_over_month(sales, as_of()).toLocalIterator()}
    assert month == {(1999, 5): None, (1999, 6): -1.0, (2001, 1): None, (2001, 2): -1.0}
    event = {r.year: (r.nb_orders, r.revenue_ly, r.growth) for r in Q.q19_promo_year_over_year(sales, as_of()).toLocalIterator()}
    assert event == {1999: (1, None, None), 2000: (None, 8, -1.0), 2001: (1, None, None)}


@pytest.fixture
def table(spark):
    name = f"moved_{uuid.uuid4().hex[:8]}"
    yield name
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def _append(spark, table, rows):
    tables.append_idempotent(spark.createDataFrame(rows, "id long, v long, region string"), table, ["id"], "region")
    return sorted((r.id, r.v, r.region) for r in spark.table(table).toLocalIterator())


def test_a_key_that_moves_is_stored_once(spark, table):
    _append(spark, table, [(1, 1, "ASIA"), (2, 1, "ASIA"), (3, 1, "AFRICA")])
    assert _append(spark, table, [(1, 2, "EUROPE")]) == [(1, 2, "EUROPE"), (2, 1, "ASIA"), (3, 1, "AFRICA")]
    # the only row of a partition moves away, to a null partition and back
    assert _append(spark, table, [(3, 2, None)]) == [(1, 2, "EUROPE"), (2, 1, "ASIA"), (3, 2, None)]
    assert _append(spark, table, [(3, 3, "it's")]) == [(1, 2, "EUROPE"), (2, 1, "ASIA"), (3, 3, "it's")]
    assert _append(spark, table, [(3, 4, "ASIA")]) == [(1, 2, "EUROPE"), (2, 1, "ASIA"), (3, 4, "ASIA")]
    assert not [t for t in spark.catalog.listTables() if t.name.startswith(f"{table}__")]


def test_lines_of_a_file_without_header_are_rejects(spark, tmp_path):
    (tmp_path / "a.csv").write_text("snapshot_month,product_id,our_price\n2024-01,1,10.0\n", encoding="utf-8")
    (tmp_path / "b.csv").write_text("2024-02,2,11.0\n\n2024-02,3,12.0\n", encoding="utf-8")
    out = files.read_competitor(spark, str(tmp_path))
    assert [r.product_id for r in out.rows.toLocalIterator()] == [1]
    assert sorted(r.line for r in out.rejects.toLocalIterator()) == ["2024-02,2,11.0", "2024-02,3,12.0"]


def test_a_header_that_repeats_a_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text("snapshot_month,product_id,our_price,our_price\n2024-01,1,10.0,99.0\n", encoding="utf-8")
    out = files.read_competitor(spark, str(tmp_path))
    assert [(r.product_id, r.our_price) for r in out.rows.toLocalIterator()] == [(1, 10.0)]


@pytest.mark.parametrize("library", ["zstandard", "public_tokenizers", "corpus_pipeline"])
def test_entry_without_an_optional_library(library):
    code = (f"import sys; sys.modules['{library}'] = None; import __spark_entry__ as E; "
            "q = E.queries(); assert 'sales_daily' in q and len(q) > 150 and 'pipeline' not in q; assert 'sales_daily' in E.oracle_sql()")
    done = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
