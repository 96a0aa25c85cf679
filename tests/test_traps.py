"""Hand-computed cases for the semantics the survey marks as traps."""

import datetime as dt
import os

from pyspark.sql import functions as F

from mercato.functions import exprs as X
from mercato.operators import cross, measures as M, timeintel as T
from mercato.plans.joins import join_promotions
from mercato.operators.competitor import latest_snapshot
from mercato.operators.quality import promo_overlap

D = dt.date


def test_promo_overlap_fans_out_and_is_flagged(spark):
    promos = spark.createDataFrame(
        [("A", D(2024, 1, 1), D(2024, 1, 10), "toys"), ("B", D(2024, 1, 5), D(2024, 1, 6), "toys"),
         ("C", D(2024, 1, 5), D(2024, 1, 6), "food")],
        "promo_name string, start_date date, end_date date, category string")
    lines = spark.createDataFrame([(1, "toys", D(2024, 1, 5)), (2, "toys", D(2024, 1, 9)), (3, "tools", D(2024, 1, 5))],
                                  "order_id long, category string, order_date date")
    out = join_promotions(lines, promos).orderBy("order_id", "promo_name").collect()
    assert [(r.order_id, r.promo_name) for r in out] == [(1, "A"), (1, "B"), (2, "A"), (3, None)]
    ov = promo_overlap(promos).collect()
    assert sorted((r.category, str(r.promo_date), r.promo_names) for r in ov) == [
        ("toys", "2024-01-05", "A|B"), ("toys", "2024-01-06", "A|B")]


def test_dax_blank_semantics(spark):
    inv = spark.createDataFrame([("r1", "normal", 5, 10.0), ("r1", "low", 2, 3.0)],
                                "region string, stock_status string, quantity_on_hand long, coverage_days double")
    row = M.evaluate(inv, ["stockout_rate", "nb_stockout", "stockouts_display", "nb_critical"]).first()
    assert row.stockout_rate is None          # DIVIDE(BLANK, n) is BLANK, not 0
    assert row.nb_stockout == 0               # COALESCE(..., 0)
    assert row.stockouts_display is None      # 0 shown as BLANK
    assert row.nb_critical == 0
    fva = spark.createDataFrame([(0, 2.0), (0, 3.0)], "actual_qty long, forecast_qty double")
    r = M.evaluate(fva, ["forecast_accuracy", "forecast_vs_actual_pct", "mae_forecast"]).first()
    assert r.forecast_accuracy == 1.0         # 1 - BLANK = 1
    assert r.forecast_vs_actual_pct == -1.0   # 0/5 - 1
    assert abs(r.mae_forecast - 2.5) < 1e-12
    zero = spark.createDataFrame([(3, 0.0)], "actual_qty long, forecast_qty double")
    assert M.evaluate(zero, ["forecast_vs_actual_pct"]).first()[0] == -1.0  # DIVIDE by 0 -> BLANK, BLANK - 1


def test_uplift_blank_minus(spark):
    s = spark.createDataFrame([(D(2024, 1, 1), 0, 100.0), (D(2024, 1, 2), 0, 50.0)],
                              "sales_date date, is_promo_day int, revenue double")
    assert M.evaluate(s, ["revenue_uplift_promo"]).first()[0] == -75.0  # BLANK - 75


def test_same_period_last_year_feb_29(spark):
    series = spark.createDataFrame(
        [(D(2023, 2, 28), 10.0), (D(2024, 2, 28), 20.0), (D(2024, 2, 29), 30.0), (D(2024, 3, 1), 5.0)],
        "date date, revenue double").withColumn("revenue", F.col("revenue").cast("decimal(18,2)"))
    out = {str(r.date): (r.revenue_ly, r.revenue_vs_ly) for r in T.vs_last_year_daily(series).collect()}
    assert out["2024-02-29"] == (10.0, 2.0)   # 29 Feb compares with 28 Feb
    assert out["2024-02-28"] == (10.0, 1.0)
    assert out["2024-03-01"] == (None, None)  # no LY -> BLANK


def test_period_to_date_invariants(spark):
    rows = [(D(2024, 1, d), float(d)) for d in range(1, 32)] + [(D(2024, 2, d), 1.0) for d in range(1, 5)]
    series = (spark.createDataFrame(rows, "date date, revenue double")
              .withColumn("revenue", F.col("revenue").cast("decimal(18,2)"))
              .withColumn("year", F.year("date")).withColumn("month_num", F.month("date"))
              .withColumn("quarter", F.concat(F.lit("Q"), F.quarter("date"))))
    out = T.period_to_date(series).collect()
    for r in out:
        assert r.revenue_mtd <= r.revenue_qtd <= r.revenue_ytd
    feb2 = [r for r in out if r.date == D(2024, 2, 2)][0]
    assert feb2.revenue_mtd == 2.0 and feb2.revenue_ytd == 496.0 + 2.0
    assert feb2.revenue_30d_rolling == sum(range(4, 32)) + 2.0  # 4 Jan .. 2 Feb inclusive


def test_double_risk_keeps_every_cheaper_competitor(spark):
    products = spark.createDataFrame([(1, "p", "c", 10.0)], "product_id long, name string, category string, unit_price double")
    inv = spark.createDataFrame([(1, 7, "s", "r", "stockout", 0.0, 0)],
                                "product_id long, store_id long, store_name string, region string, stock_status string, coverage_days double, quantity_on_hand long")
    cp = spark.createDataFrame([("2024-01", 1, "X", True, 8.0, -20.0), ("2024-01", 1, "Y", True, 9.0, -10.0),
                                ("2024-01", 1, "Z", True, 7.0, -30.0), ("2023-12", 1, "W", True, 1.0, -90.0),
                                ("2024-01", 1, "V", False, 11.0, 10.0)],
                               "snapshot_month string, product_id long, competitor string, is_cheaper boolean, competitor_price double, price_gap_pct double")
    dr = cross.double_risk(products, inv, latest_snapshot(cp))
    assert sorted(r.cheapest_competitor for r in dr.collect()) == ["X", "Y", "Z"]  # latest month only
    best = cross.double_risk_cheapest(dr).collect()
    assert len(best) == 1 and best[0].cheapest_competitor == "Z" and best[0].n_cheaper == 3


def test_champion_alert_store_mismatch(spark):
    seg = spark.createDataFrame([(1, "Champions", 900.0, 3, 5)],
                                "customer_id long, segment_label string, monetary double, recency_days int, frequency long")
    lines = spark.createDataFrame([(1, 10, 100)], "customer_id long, product_id long, store_id long")
    products = spark.createDataFrame([(10, "p", "c")], "product_id long, name string, category string")
    stores = spark.createDataFrame([(100, "A", "r"), (200, "B", "r")], "store_id long, name string, region string")
    inv = spark.createDataFrame([(200, 10, "stockout", 0.0, 0)],
                                "store_id long, product_id long, stock_status string, coverage_days double, quantity_on_hand long")
    loose = cross.champion_stockout_alert(seg, lines, products, stores, inv).collect()
    strict = cross.champion_stockout_alert(seg, lines, products, stores, inv, same_store=True).collect()
    assert len(loose) == 1 and loose[0].store_name == "A"  # status comes from store B
    assert loose[0].n_stores == 1
    assert strict == []


def test_stock_status_thresholds(spark):
    df = spark.createDataFrame([(0, 2, 5), (2, 2, 5), (3, 2, 5), (5, 2, 5), (6, 2, 5)],
                               "quantity_on_hand int, safety_stock int, reorder_point int")
    assert [r[0] for r in df.select(X.stock_status()).collect()] == ["stockout", "critical", "low", "low", "normal"]


def test_rename_if_present_is_idempotent(spark):
    df = spark.createDataFrame([(1.0, 2.0)], "temp_max_c double, rainfall_mm double")
    m = {"temp_max_c": "max_temperature_c", "precipitation_mm": "rainfall_mm"}
    once = X.rename_if_present(df, m)
    assert once.columns == ["max_temperature_c", "rainfall_mm"]
    assert X.rename_if_present(once, m).columns == once.columns


def test_remap_keeps_unmatched(spark):
    df = spark.createDataFrame([("Soldes Hiver",), ("Black Friday",)], "promo_name string")
    assert [r[0] for r in df.select(X.remap("promo_name", X.PROMO_EN)).collect()] == ["Winter Sales", "Black Friday"]


def test_segment_rank_tie_breaks_on_segment_id(spark):
    from mercato.operators.segments import label_by_score
    seg = spark.createDataFrame(
        [(i, D(2024, 1, 1), 10, 2, 100.0, 50.0, 2, i % 5) for i in range(10)],
        "customer_id long, last_order_date date, recency_days int, frequency long, monetary double, avg_basket double, nb_distinct_products long, segment_id int")
    out = {r.segment_id: r.segment_label for r in label_by_score(seg).collect()}
    assert out == {0: "Champions", 1: "Loyal", 2: "Warm Prospects", 3: "At Risk", 4: "Inactive"}


def test_winsorise_matches_linear_quantile(spark):
    from mercato.operators.segments import winsorise
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate([1, 2, 3, 10])], "customer_id long, x double")
    out = sorted(r.x for r in winsorise(df, 0.99, ["x"]).collect())
    assert abs(out[-1] - 9.79) < 1e-9  # pandas quantile(0.99) of 1,2,3,10


def test_staged_overwrite_of_table_read_by_itself(spark):
    from mercato.sources.tables import overwrite_table
    spark.range(5).write.mode("overwrite").saveAsTable("t_self")
    overwrite_table(spark.table("t_self").withColumn("id", F.col("id") * 2), "t_self")
    assert sorted(r.id for r in spark.table("t_self").collect()) == [0, 2, 4, 6, 8]


def test_insert_overwrite_is_by_name_order(spark):
    from mercato.sources.tables import insert_overwrite
    spark.createDataFrame([(1, "a")], "k long, v string").write.mode("overwrite").saveAsTable("t_pos")
    insert_overwrite(spark.createDataFrame([("b", 2)], "v string, k long"), "t_pos")
    assert [tuple(r) for r in spark.table("t_pos").collect()] == [(2, "b")]


def test_append_rerun_is_idempotent(spark):
    from mercato.sources.tables import append_idempotent
    batch = spark.createDataFrame([(D(2024, 1, 1), "Paris", 1.0), (D(2024, 1, 2), "Lyon", 2.0)],
                                  "date date, city string, rainfall_mm double").withColumn("month", F.date_format("date", "yyyy-MM"))
    spark.sql("DROP TABLE IF EXISTS t_weather")
    append_idempotent(batch, "t_weather", ["date", "city"], "month")
    append_idempotent(batch, "t_weather", ["date", "city"], "month")
    assert spark.table("t_weather").count() == 2


def test_exact_quantile_matches_percentile(spark):
    from mercato.functions.quantile import exact_quantile
    cases = [spark.range(0, n).select((F.col("id") * 7919 % 10007 / 3.0).alias("v")) for n in (1, 2, 4, 10, 101, 20011)]
    cases.append(spark.range(0, 1000).select((F.col("id") % 3).cast("double").alias("v")))  # heavy ties
    cases.append(spark.createDataFrame([(float(v),) for v in (1, 2, 3, 10)], "v double"))
    for df in cases:
        for q in (0.0, 0.01, 0.5, 0.99):
            for acc in (10, 10000):
                got = exact_quantile(df, "v", q, accuracy=acc)
                want = df.select(F.percentile("v", q)).first()[0]
                assert abs(got - want) < 1e-9, (df.count(), q, acc, got, want)


def test_sql_over_registered_views(spark, sf_dir):
    from mercato.sources.retail import register_views
    names = register_views(spark, sf_dir)
    assert "gold_sales_daily" in names
    by_sql = spark.sql("""
        SELECT YEAR(sales_date) AS yr, ROUND(SUM(revenue) / 1e6, 1) AS rev_m
        FROM gold_sales_daily GROUP BY YEAR(sales_date)""").collect()
    from mercato.operators.sales import sales_by_year, gold_sales_daily
    from mercato.sources.retail import load
    by_df = {r.yr: r.rev_m for r in sales_by_year(gold_sales_daily(load(spark, sf_dir))).collect()}
    assert {r.yr: r.rev_m for r in by_sql} == by_df


def test_grouped_exact_quantile_matches_percentile(spark):
    from mercato.functions.quantile import grouped_exact_quantile
    df = spark.range(0, 5003).select((F.col("id") % 4).alias("g"), (F.col("id") * 7919 % 10007 / 7.0).alias("v"))
    df = df.unionByName(spark.createDataFrame([(9, 1.0), (9, 1.0), (9, 5.0)], "g long, v double"))
    for q in (0.0, 0.5, 0.99):
        for acc in (10, 10000):
            got = {r.g: r.m for r in grouped_exact_quantile(df, ["g"], "v", q, "m", acc).collect()}
            want = {r.g: r.m for r in df.groupBy("g").agg(F.percentile("v", q).alias("m")).collect()}
            assert got.keys() == want.keys()
            assert all(abs(got[k] - want[k]) < 1e-9 for k in want), (q, acc, got, want)


def test_relationships_refuse_forbidden_keys(spark):
    import pytest as _pytest
    from mercato.operators.entities import check_relationship, relate
    fact = spark.createDataFrame([(1, "toys")], "store_id long, category string")
    dim = spark.createDataFrame([(1, "A")], "store_id long, name string")
    assert relate(fact, dim, "store_id", "store_id", "sales", "stores").columns == ["store_id", "category", "name"]
    with _pytest.raises(ValueError):
        check_relationship("sales", "category", "products", "category")
    with _pytest.raises(ValueError):
        check_relationship("sales", "store_id", "promotions", "store_id")


def test_a_sixth_segment_has_no_label(spark):
    import pytest as _pytest
    from mercato.operators.segments import assert_all_labels, label_by_score
    seg = spark.createDataFrame(
        [(i, D(2024, 1, 1), 10, 2, 100.0, 50.0, 2, i % 4) for i in range(8)],
        "customer_id long, last_order_date date, recency_days int, frequency long, monetary double, avg_basket double, nb_distinct_products long, segment_id int")
    with _pytest.raises(ValueError):
        label_by_score(seg, 6)
    with _pytest.raises(ValueError):
        assert_all_labels(label_by_score(seg))  # four of five labels


def test_append_with_null_keys_and_duplicates(spark):
    from mercato.sources.tables import append_idempotent
    spark.sql("DROP TABLE IF EXISTS t_null_keys")
    schema = "k string, v int, part string"
    append_idempotent(spark.createDataFrame([(None, 1, "a"), ("x", 1, "a"), ("x", 3, "a"), ("y", 1, "b")], schema), "t_null_keys", ["k"], "part")
    append_idempotent(spark.createDataFrame([(None, 2, "a"), ("z", 9, "a")], schema), "t_null_keys", ["k"], "part", order_col="v")
    got = sorted(map(str, spark.table("t_null_keys").select("k", "v", "part").toLocalIterator()))
    assert got == sorted(map(str, spark.createDataFrame([(None, 2, "a"), ("x", 3, "a"), ("y", 1, "b"), ("z", 9, "a")], schema).toLocalIterator()))
    assert not [t.name for t in spark.catalog.listTables() if "__merge_" in t.name]


def test_overwrite_recovers_a_table_left_between_renames(spark):
    from mercato.sources.tables import overwrite_table, recover_table
    spark.range(3).write.mode("overwrite").saveAsTable("t_crash")
    spark.sql("ALTER TABLE t_crash RENAME TO t_crash__old")  # as a crash would leave it
    recover_table(spark, "t_crash")
    assert spark.table("t_crash").count() == 3
    overwrite_table(spark.range(5), "t_crash")
    assert spark.table("t_crash").count() == 5 and not spark.catalog.tableExists("t_crash__old")


def test_transfers_give_each_unit_once(spark):
    from mercato.operators.ops import transfer_proposals
    rows = [(1, 7, "N", "stockout", 0, 10), (2, 7, "N", "critical", 1, 10), (3, 7, "N", "normal", 22, 10),
            (4, 7, "S", "normal", 13, 10), (5, 7, "S", "critical", 2, 4), (6, 8, "N", "stockout", 0, 5)]
    inv = spark.createDataFrame([(*r, D(2024, 1, 1)) for r in rows],
                                "store_id long, product_id long, region string, stock_status string, quantity_on_hand int, reorder_point int, last_updated date")
    got = sorted((r.from_store_id, r.to_store_id, r.product_id, r.quantity) for r in
                 transfer_proposals(inv, F.lit(D(2024, 1, 5))).toLocalIterator())
    # store 3 can give 12: 10 to store 1, 2 of 9 to store 2; store 4 gives 2 of its 3 at home, then the last one
    assert got == [(3, 1, 7, 10), (3, 2, 7, 2), (4, 2, 7, 1), (4, 5, 7, 2)]


def test_no_donor_gives_more_than_its_excess(spark, sf_dir):
    import __spark_entry__ as E
    t = E.queries()["transfer_proposals"](spark, sf_dir)
    inv = E.queries()["inventory_status"](spark, sf_dir)
    gave = t.groupBy("from_store_id", "product_id").agg(F.sum("quantity").alias("gave"))
    over = gave.join(inv, (gave.from_store_id == inv.store_id) & (gave.product_id == inv.product_id)).where(
        "gave > quantity_on_hand - reorder_point")
    assert t.count() > 0 and over.count() == 0


def test_load_sees_appended_orders(spark, sf_dir):
    import shutil
    import tempfile
    from mercato.sources.retail import load
    d = tempfile.mkdtemp(prefix="mercato-append-")
    for t in ("orders", "supplier"):
        os.makedirs(f"{d}/{t}.parquet")
        shutil.copy(f"{sf_dir}/{t}.parquet", f"{d}/{t}.parquet/part-0.parquet")
    before = load(spark, d).params["hi"]
    late = spark.read.parquet(f"{d}/orders.parquet").limit(1).withColumn("o_orderdate", F.lit("2005-01-01").cast("timestamp_ntz"))
    late.write.mode("append").parquet(f"{d}/orders.parquet")
    assert before < D(2005, 1, 1) == load(spark, d).params["hi"]
