"""Physical-plan properties: no cartesian products, pushed filters, stored
gold read once, no driver collects in the library."""

import os
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from mercato.plans.registry import ROWS_ONLY, queries

BATCH = sorted(n for n in queries() if not n.startswith("stream_") and n not in ROWS_ONLY)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", BATCH)
def test_no_cartesian_product(spark, sf_dir, name):
    p = plan_of(E.queries()[name](spark, sf_dir))
    assert "CartesianProduct" not in p
    assert "BroadcastNestedLoopJoin" not in p


def test_promotion_join_is_equi_join(spark, sf_dir):
    p = plan_of(E.queries()["sales_daily"](spark, sf_dir))
    assert "BroadcastHashJoin" in p or "SortMergeJoin" in p
    assert "BroadcastNestedLoopJoin" not in p


def test_latest_snapshot_is_a_date_range_on_the_scan(spark, sf_dir):
    from mercato.sources.retail import load
    r = load(spark, sf_dir)
    s = plan_of(r.competitor_latest)
    pushed = [x for x in re.findall(r"PushedFilters: \[([^\]]*)\]", s) if "o_orderdate" in x]
    assert pushed and all("GreaterThanOrEqual(o_orderdate" in x and "LessThan(o_orderdate" in x for x in pushed)
    p = plan_of(r.products.where("is_active").select("product_id"))
    assert "ReadSchema: struct<p_partkey:bigint,p_size:int>" in p and "LessThan(p_size,49)" in p


def test_distinct_counts_do_not_expand_the_facts(spark, sf_dir):
    for name in ("sales_daily", "rfm_features"):
        assert "Expand" not in plan_of(E.queries()[name](spark, sf_dir))


def test_questions_on_stored_gold_read_each_fact_once(spark, sf_dir, tmp_path):
    from mercato.plans import questions as Q, reports as R
    from mercato.plans.gold import build_facts
    from mercato.sources.retail import load
    r = load(spark, sf_dir)
    g = build_facts(r, str(tmp_path))
    kpis = Q.q15_kpis(g.sales, g.inventory, g.forecast_vs_actual, g.competitor_prices, r.as_of)
    facts = {"gold_forecast_vs_actual", "gold_inventory_status", "gold_sales_daily", "silver_competitor_prices"}
    assert {re.search(r"/(\w+)/(\w+=[^/]*/)*part-", f)[1] for f in kpis.inputFiles()} == facts
    assert plan_of(kpis).split("== Initial Plan ==")[0].count("FileScan parquet") == len(facts)
    year = R.rpt02_top_stores(g.sales, year=2000)
    assert all("sales_year=2000" in f for f in year.inputFiles()) or "sales_year" in plan_of(year).split("PartitionFilters")[1][:80]


def test_a_failed_gold_write_leaves_the_old_table(spark, tmp_path):
    from mercato.plans.gold import Gold, write_table
    write_table(spark.range(3), str(tmp_path), "t")
    bad = spark.range(9).select((10 / (F.col("id") - 4)).alias("id"))  # divides by zero while writing
    with pytest.raises(Exception):
        write_table(bad, str(tmp_path), "t")
    assert Gold(spark, str(tmp_path)).table("t").count() == 3
    write_table(spark.range(5), str(tmp_path), "t")
    assert Gold(spark, str(tmp_path)).table("t").count() == 5


def test_column_pruning_on_scan(spark, sf_dir):
    df = E.queries()["dim_channel"](spark, sf_dir)
    s = plan_of(df)
    schemas = re.findall(r"ReadSchema: (struct<[^>]*>)", s)
    assert schemas and all("o_totalprice" not in x for x in schemas)


def test_library_has_no_driver_collect():
    root = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "mercato")
    offenders = []
    for d, _, files in os.walk(root):
        if os.path.basename(d) == "llm":  # has its own bounded samples and tests
            continue
        for f in files:
            if f.endswith(".py"):
                text = open(os.path.join(d, f)).read()
                for pat in (".collect()", ".toPandas()", "localCheckpoint"):
                    if pat in text:
                        offenders.append((f, pat))
    assert not offenders
