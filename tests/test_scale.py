"""Memory of a task: facts are dealt by the size of the lines, rows stay narrow."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from mercato.functions import exprs as X
from mercato.operators import distinct as D, forecast, measures as M, sales
from mercato.sources import retail
from mercato.sources.retail import load


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def shop(spark, tmp_path):
    """Three stores, two products, 40 orders of two lines; every order row comes twice."""
    day = dt.datetime(1995, 1, 30)
    put = lambda name, rows, schema: spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    put("region", [(0, "EUROPE")], "r_regionkey long, r_name string")
    put("nation", [(0, "FRANCE", 0)], "n_nationkey long, n_name string, n_regionkey long")
    put("supplier", [(i, f"S{i}", 0, 100.0) for i in range(3)], "s_suppkey long, s_name string, s_nationkey long, s_acctbal double")
    put("part", [(0, "a", "B1", "T", 3, 10.05), (1, "b", "B1", "T", 4, 0.99)],
        "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double")
    put("orders", [(i, i % 7, "F", day + dt.timedelta(days=i % 5), "2-HIGH") for i in range(40)] * 2,
        "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate timestamp, o_orderpriority string")
    put("lineitem", [(i, p, 0, 3.0, 5.0, 0.07) for i in range(40) for p in (0, 1)],
        "l_orderkey long, l_partkey long, l_suppkey long, l_quantity double, l_extendedprice double, l_discount double")
    return str(tmp_path)


def test_tasks_follow_the_size_of_the_lines(spark, shop, monkeypatch):
    few = load(spark, shop)
    want = {"sales": sales.gold_sales_daily(few), "lines": few.order_lines, "sold": D.sold(few)}
    assert all("REPARTITION_BY_NUM" not in plan_of(df) for df in want.values())
    monkeypatch.setattr(retail, "LINE_BYTES", 100)
    many = load(spark, shop)
    assert many.line_parts > 8
    got = {"sales": sales.gold_sales_daily(many), "lines": many.order_lines, "sold": D.sold(many)}
    for name, df in got.items():
        parts = set(map(int, re.findall(r"hashpartitioning\(order_id[^,]*, (\d+)\), REPARTITION_BY_NUM", plan_of(df))))
        assert parts and min(parts) >= many.line_parts, name
        assert sorted(map(str, df.toLocalIterator())) == sorted(map(str, want[name].toLocalIterator()))
    years = lambda r: M.true_order_count(r.order_lines.withColumn("y", F.year("order_date")), by=["y"]).first()
    assert years(many) == years(few) == (1995, 40)


def test_daily_sales_sum_integers(spark, shop):
    df = sales.gold_sales_daily(load(spark, shop))
    aggs = [x for x in plan_of(df).splitlines() if "HashAggregate" in x and "partial_sum" in x and "order_id" in x]
    assert aggs and not any("decimal(3" in x for x in aggs)
    want = sales.sales_lines(load(spark, shop)).groupBy(*sales.FACT_KEYS).agg(
        F.countDistinct("order_id").alias("n"), F.round(F.sum(X.revenue()), 2).cast("double").alias("rev"),
        F.round(F.sum(X.gross_margin()), 2).cast("double").alias("gm"), F.round(F.avg("discount_pct"), 2).cast("double").alias("disc"))
    rows = lambda x, *c: sorted(map(tuple, x.select("store_id", "sales_date", *c).toLocalIterator()))
    assert rows(df, "nb_orders", "revenue", "gross_margin", "avg_discount_pct") == rows(want, "n", "rev", "gm", "disc")


def test_bitmaps_of_few_ids_are_small(spark):
    ids = [*range(-130, 130), 10**15, None]
    stored = D.bitmaps(spark.createDataFrame([("orders", i) for i in ids] * 2, "id_kind string, id long"), "id", ["id_kind"])
    size = stored.agg(F.max(F.length("ids")), F.min(F.length("ids")), F.sum(F.bitmap_count("ids"))).first()
    assert tuple(size) == (8, 8, 261)
    assert D.distinct_counts(stored).first() == (261, 0)
    full = D.bitmaps(spark.createDataFrame([("orders", i) for i in range(64)], "id_kind string, id long"), "id", ["id_kind"])
    assert D.distinct_counts(D.appended(stored, full)).first() == (261, 0)
    assert "SortAggregate" not in plan_of(D.distinct_counts(stored))


def test_competitor_feed_is_cut_once_and_has_few_files(spark, shop, tmp_path):
    import __spark_entry__ as E
    from mercato.sources import files
    text = 'product_id,competitor,product_name,our_price,snapshot_month\r\n1,X,"a, ""b"" ", 2.0 ,2024-01\n\n2, Y ,c d,x,2024-01\n,Z,e,2.0,2024-01\n'
    (tmp_path / "feed").mkdir()
    (tmp_path / "feed" / "a.csv").write_text(text)
    out = files.read_competitor(spark, str(tmp_path / "feed"))
    assert [(r.product_id, r.competitor, r.product_name, r.our_price, r.is_cheaper) for r in out.rows.toLocalIterator()] == [(1, "X", 'a, "b" ', 2.0, None)]
    assert [(r.product_id, r.competitor, r.our_price) for r in out.rejects.toLocalIterator()] == [("2", "Y", "x")]
    cut = [x for x in plan_of(out.rows).splitlines() if "split(value" in x]
    assert cut and all("Generate explode" in x for x in cut)  # no filter or projection cuts the line again
    more = spark.createDataFrame([(1, 1, "F", dt.datetime(1995, 6, 1), "2-HIGH")], spark.read.parquet(f"{shop}/orders.parquet").schema)
    more.write.mode("append").parquet(f"{shop}/orders.parquet")
    df = E.queries()["ingest_competitor_roundtrip"](spark, shop)
    assert df.count() == 4 and len([f for f in df.inputFiles() if f.endswith(".csv")]) == 2  # two months of two products


def test_transfers_read_the_inventory_once(spark, sf_dir):
    import __spark_entry__ as E
    for name in ("q_28_regions_stockout_transfers", "transfer_proposals"):
        assert "lineitem.parquet" not in "".join(E.queries()[name](spark, sf_dir).inputFiles())


def test_baseline_forecast_reads_the_lines_once(spark, shop):
    r = load(spark, shop)
    r.as_of = F.lit(dt.date(1995, 2, 10))  # sales on Monday to Friday of the week before
    df = forecast.forecast_baseline(r, horizon=7)
    assert df._jdf.queryExecution().optimizedPlan().toString().count("Relation [l_orderkey") == 1
    day = lambda i: dt.date(1995, 2, 4) + dt.timedelta(days=i)
    want = [(p, day(i), *((0.0, 0.0, 0.0) if i < 2 else (6.0, 4.8, 7.2))) for p in (0, 1) for i in range(7)]
    assert sorted(map(tuple, df.collect())) == want
