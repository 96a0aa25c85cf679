"""The business-question catalogue (Q-01..Q-29) as parameterised DataFrame
functions.  Store rows carry name and region, product rows name and
category; "top N" questions default to 10."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mercato.functions import exprs as X
from mercato.functions.dax import davg, div, dsum
from mercato.operators import measures as M
from mercato.operators import timeintel as T


def q01_stores_at_risk(inv: DataFrame, region: str | None = None, statuses=X.AT_RISK) -> DataFrame:
    """Q-01: stores (of a region) with products in critical/stockout status."""
    x = inv.where(F.col("stock_status").isin(*statuses))
    if region is not None:
        x = x.where(F.col("region") == region)
    return x.groupBy("store_id", "store_name", "region").agg(
        F.count(F.lit(1)).alias("n_products_at_risk"),
        F.count_if(F.col("stock_status") == "stockout").alias("n_stockout"))


def q02_margin_by_category_year(sales: DataFrame) -> DataFrame:
    """Q-02: gross margin % by category and year vs the prior year, with a
    declining flag."""
    g = sales.groupBy("category", F.year("sales_date").alias("year")).agg(
        M.measure("gross_margin_pct"), F.lit(True).alias("sold"))
    x = T.with_prior(g, "year", 1, "gross_margin_pct", "gross_margin_pct_ly", ["category"]).where(F.col("sold"))
    return x.select("category", "year", "gross_margin_pct", "gross_margin_pct_ly",
                    (F.col("gross_margin_pct") < F.col("gross_margin_pct_ly")).alias("declining"))


def q03_accuracy_and_price_pressure(fva: DataFrame, cp: DataFrame) -> DataFrame:
    """Q-03: categories ranked by worst forecast accuracy and by highest
    price pressure (most negative average gap); combined rank = sum."""
    acc = M.evaluate(fva, ["forecast_accuracy"], by=["category"])
    gap = M.evaluate(cp, ["avg_price_gap"], by=["category"])
    x = acc.join(gap, "category")
    # windows over one row per category (the aggregated result)
    w_acc = Window.orderBy(F.col("forecast_accuracy").asc_nulls_last())
    w_gap = Window.orderBy(F.col("avg_price_gap").asc_nulls_last())
    x = x.select("*", F.rank().over(w_acc).alias("accuracy_rank"), F.rank().over(w_gap).alias("pressure_rank"))
    return x.withColumn("combined_rank", F.col("accuracy_rank") + F.col("pressure_rank"))


def q04_stockout_and_cheaper(double_risk: DataFrame) -> DataFrame:
    """Q-04: stockout products cheaper at a competitor, by price gap."""
    return double_risk.where(F.col("stock_status") == "stockout").orderBy("price_gap_pct", "product_id",
                                                                           "store_id", "cheapest_competitor")


def q05_champions_at_risk(alert: DataFrame, status: str = "stockout") -> DataFrame:
    """Q-05: champion customers who bought products now in ``status``; one row
    per customer (deduplicated before any LTV sum), by lifetime value."""
    return (alert.where(F.col("stock_status") == status)
            .groupBy("customer_id", "lifetime_value", "recency_days", "frequency")
            .agg(F.count_distinct("product_id").alias("n_products"))
            .orderBy(F.desc("lifetime_value"), "customer_id"))  # contact priority


def q05_summary(per_customer: DataFrame) -> DataFrame:
    """Q-05: customer count and total LTV at risk (customers counted once)."""
    return per_customer.agg(F.count(F.lit(1)).alias("n_customers"),
                            dsum("lifetime_value").alias("ltv_at_risk"))


def q07_store_counts(stores: DataFrame) -> DataFrame:
    """Q-07: store counts by region, city and format."""
    return stores.groupBy("region", "city", "store_type").agg(F.count(F.lit(1)).alias("n_stores"))


def q08_promotions_active(promotions: DataFrame, as_of: Column) -> DataFrame:
    """Q-08: promotions running on the analysis date."""
    return promotions.where(X.promo_active(as_of))


def q09_category_products(products: DataFrame) -> DataFrame:
    """Q-09: active products and average selling price per category."""
    act = products.where("is_active")
    return act.groupBy("category").agg(F.count(F.lit(1)).alias("n_active_products"),
                                       davg("unit_price").alias("avg_unit_price"))


def q10_customers_in_segment(segments: DataFrame, label: str = "Champions") -> DataFrame:
    """Q-10: customers of one segment."""
    return segments.where(F.col("segment_label") == label).select(
        "customer_id", "segment_label", "monetary", "recency_days", "frequency")


def q11_cheaper_at(latest: DataFrame, competitor: str | None = "BonPrix",
                   min_undercut_pct: float | None = None) -> DataFrame:
    """Q-11: products cheaper at a competitor in the latest month; optionally
    only those undercut by more than ``min_undercut_pct`` %."""
    x = latest.where("is_cheaper")
    if competitor is not None:
        x = x.where(F.col("competitor") == competitor)
    if min_undercut_pct is not None:
        x = x.where(F.col("price_gap_pct") < -min_undercut_pct)
    return x.select("product_id", "product_name", "category", "competitor",
                    F.col("our_price").cast("double").alias("our_price"),
                    F.col("competitor_price").cast("double").alias("competitor_price"),
                    F.col("price_gap_pct").cast("double").alias("price_gap_pct"))


def q12_product_accuracy(fva: DataFrame) -> DataFrame:
    """MEA-20 per product."""
    return M.evaluate(fva, ["forecast_accuracy", "mae_forecast"], by=["product_id", "product_name", "category"])


def q12_low_accuracy(fva: DataFrame, threshold: float = 0.75) -> DataFrame:
    """Q-12: products whose accuracy is below the threshold."""
    return q12_product_accuracy(fva).where(F.col("forecast_accuracy") < threshold)


def q12_worst(fva: DataFrame, n: int = 10) -> DataFrame:
    """Q-12: the n products with the worst accuracy (ties by product id)."""
    return q12_product_accuracy(fva).orderBy("forecast_accuracy", "product_id").limit(n)


def q13_forecast_demand(forecast: DataFrame, start: Column, days: int = 30) -> DataFrame:
    """Q-13: forecast units per product over the next ``days`` days."""
    w = forecast.where(F.col("forecast_date").between(start, F.date_add(start, days - 1)))
    return w.groupBy("product_id").agg(dsum("forecast_qty").alias("forecast_units"),
                                       (dsum("forecast_qty") / days).alias("units_per_day"))


def q13_top(forecast: DataFrame, start: Column, n: int = 10, days: int = 30) -> DataFrame:
    return q13_forecast_demand(forecast, start, days).orderBy(F.desc("forecast_units"), "product_id").limit(n)


def q13_high_daily(forecast: DataFrame, start: Column, per_day: float = 50.0, days: int = 30) -> DataFrame:
    return q13_forecast_demand(forecast, start, days).where(F.col("units_per_day") > per_day)


def q14_stores_with_weather(stores: DataFrame, weather: DataFrame, on: Column,
                            condition: str = "pluie") -> DataFrame:
    """Q-14 (JOI-12 observed_at): stores whose city has ``condition`` that day."""
    w = weather.where((F.col("date") == on) & (F.col("weather_condition") == condition))
    return stores.join(w.select("city", "date", "rainfall_mm", "weather_condition"), "city") \
        .select("store_id", F.col("name").alias("store_name"), "region", "city", "date", "rainfall_mm",
                "weather_condition")


def q15_kpis(sales: DataFrame, inv: DataFrame, fva: DataFrame, cp: DataFrame, as_of: Column) -> DataFrame:
    """Q-15: KPI one-liners as one row.  Each fact is aggregated once (one
    row per fact, revenue YTD as a conditional sum next to the other sales
    KPIs); the one-row results are unioned in long form and pivoted on the
    known KPI names -- no joins and no repeated subqueries."""
    ytd = (F.year("sales_date") == F.year(as_of)) & (F.col("sales_date") <= as_of)
    parts = [
        sales.agg(M.measure("gross_margin_pct"), M.measure("avg_basket"),
                  dsum(F.when(ytd, F.col("revenue"))).alias("revenue_ytd")),
        fva.agg(M.measure("forecast_accuracy")),
        inv.agg(M.measure("nb_stockout"), M.measure("avg_coverage_days")),
        cp.agg(M.measure("pct_cheaper")),
    ]
    names = [c for p in parts for c in p.columns]
    long = None
    for p in parts:
        kv = F.explode(F.array(*[F.struct(F.lit(c).alias("kpi"), F.col(c).cast("double").alias("value"))
                                 for c in p.columns])).alias("kv")
        x = p.select(kv).select("kv.kpi", "kv.value")
        long = x if long is None else long.unionByName(x)
    wide = long.groupBy().pivot("kpi", names).agg(F.first("value"))
    return wide.select("gross_margin_pct", "avg_basket", "forecast_accuracy",
                       F.col("nb_stockout").cast("bigint").alias("nb_stockout"), "avg_coverage_days",
                       "pct_cheaper", "revenue_ytd")


def q16_year_over_year(sales: DataFrame, as_of: Column) -> DataFrame:
    """Q-16: revenue per year vs the previous year; a year without sales after one with some is listed."""
    y = sales.groupBy(F.year("sales_date").alias("year")).agg(dsum("revenue").alias("revenue"))
    x = T.with_prior(y, "year", 1, "revenue", "revenue_ly", last=F.year(as_of))
    return x.select("year", "revenue", "revenue_ly", T.growth("revenue", "revenue_ly").alias("growth"))


def q16_quarter_over_quarter(sales: DataFrame, as_of: Column) -> DataFrame:
    """Q-16: revenue per quarter vs the same quarter last year, vanished quarters too."""
    qi = lambda d: F.year(d) * 4 + F.quarter(d) - 1
    y = sales.groupBy(qi("sales_date").alias("qi")).agg(dsum("revenue").alias("revenue"))
    x = T.with_prior(y, "qi", 4, "revenue", "revenue_ly", last=qi(as_of))
    return x.select(F.expr("CAST(qi div 4 AS INT)").alias("year"), F.expr("CAST(qi % 4 + 1 AS INT)").alias("quarter"),
                    "revenue", "revenue_ly", T.growth("revenue", "revenue_ly").alias("growth"))


def q17_best_periods(sales: DataFrame) -> DataFrame:
    """Q-17: per year, the best month by revenue and the best quarter by
    gross margin % (ties to the earlier period)."""
    m = sales.groupBy(F.year("sales_date").alias("year"), F.month("sales_date").alias("month")) \
        .agg(dsum("revenue").alias("revenue"))
    bm = m.groupBy("year").agg(F.max(F.struct("revenue", -F.col("month"))).alias("b")).select(
        "year", (-F.col("b.col2")).alias("best_month"), F.col("b.revenue").alias("best_month_revenue"))
    q = sales.groupBy(F.year("sales_date").alias("year"), F.quarter("sales_date").alias("quarter")) \
        .agg(M.measure("gross_margin_pct"))
    bq = q.groupBy("year").agg(F.max(F.struct("gross_margin_pct", -F.col("quarter"))).alias("b")).select(
        "year", (-F.col("b.col2")).alias("best_margin_quarter"), F.col("b.gross_margin_pct").alias("best_quarter_margin_pct"))
    return bm.join(bq, "year")


def q18_month_over_month(sales: DataFrame, as_of: Column) -> DataFrame:
    """Q-18: revenue per month vs the previous month, the first month without sales too."""
    m = sales.groupBy(T.month_index("sales_date").alias("mi")).agg(dsum("revenue").alias("revenue"))
    x = T.with_prior(m, "mi", 1, "revenue", "revenue_prev_month", last=T.month_index(as_of))
    return x.select(F.expr("CAST(mi div 12 AS INT)").alias("year"), F.expr("CAST(mi % 12 + 1 AS INT)").alias("month"),
                    "revenue", "revenue_prev_month", T.growth("revenue", "revenue_prev_month").alias("growth"))


def q18_ytd_vs_ly(sales: DataFrame, as_of: Column) -> DataFrame:
    """Q-18: year-to-date revenue at ``as_of`` vs the same span last year."""
    d = F.col("sales_date")
    ly_end = F.add_months(as_of, -12)
    cur = (F.year(d) == F.year(as_of)) & (d <= as_of)
    prev = (F.year(d) == F.year(ly_end)) & (d <= ly_end)
    x = sales.where(cur | prev).agg(dsum(F.when(cur, F.col("revenue"))).alias("revenue_ytd"),
                                    dsum(F.when(prev, F.col("revenue"))).alias("revenue_ytd_ly"))
    return x.withColumn("growth", div(F.col("revenue_ytd") - F.col("revenue_ytd_ly"), F.col("revenue_ytd_ly")))


def q19_promo_year_over_year(sales: DataFrame, as_of: Column) -> DataFrame:
    """Q-19: revenue and orders of each promotion event per year vs last year,
    events that did not sell again too."""
    y = sales.where(F.col("promo_name").isNotNull()).groupBy("promo_name", F.year("sales_date").alias("year")) \
        .agg(dsum("revenue").alias("revenue"), F.sum("nb_orders").alias("nb_orders"))
    x = T.with_prior(y, "year", 1, "revenue", "revenue_ly", ["promo_name"], F.year(as_of))
    return x.select("promo_name", "year", "revenue", "nb_orders", "revenue_ly",
                    T.growth("revenue", "revenue_ly").alias("growth"))


def q21_top_stores(sales: DataFrame, n: int = 5) -> DataFrame:
    """Q-21: top n stores by revenue."""
    return (sales.groupBy("store_id", "store_name", "region").agg(M.measure("total_revenue"))
            .orderBy(F.desc("total_revenue"), "store_id").limit(n))


def _ranked(df: DataFrame, by: str, key: str, n: int | None) -> DataFrame:
    """Rows with their rank by ``by``, highest first, in that order (one row per region or category)."""
    x = df.withColumn("rank", F.row_number().over(Window.orderBy(F.desc_nulls_last(by), key)))
    return (x if n is None else x.where(F.col("rank") <= n)).orderBy("rank")


def q21_regions_by_stockout(inv: DataFrame, n: int | None = 3) -> DataFrame:
    """Q-21: the n regions with the highest stockout rate."""
    return _ranked(M.evaluate(inv, ["stockout_rate", "nb_stockout"], by=["region"]), "stockout_rate", "region", n)


def q21_categories_by_margin(sales: DataFrame, n: int | None = None) -> DataFrame:
    """Q-21: categories by gross margin %, best first."""
    return _ranked(M.evaluate(sales, ["gross_margin_pct", "total_margin"], by=["category"]), "gross_margin_pct", "category", n)


def q22_low_coverage_stores(inv: DataFrame, days: float = 7.0) -> DataFrame:
    """Q-22: stores whose average coverage is under ``days``."""
    return (inv.groupBy("store_id", "store_name", "region").agg(M.measure("avg_coverage_days"))
            .where(F.col("avg_coverage_days") < days))


def q23_segments_by_ltv(segments: DataFrame) -> DataFrame:
    """Q-23: segments by average lifetime value."""
    return segments.groupBy("segment_label").agg(davg("monetary").alias("avg_ltv"),
                                                 F.count(F.lit(1)).alias("n_customers"))


def q24_promo_uplift(sales: DataFrame, promotions: DataFrame) -> DataFrame:
    """Q-24: per promotion event, revenue/day and orders/day on its days vs
    days without promotion; the orders ratio compared to the planned
    traffic boost (below_expected when the ratio is lower)."""
    g = sales.groupBy("promo_name").agg(dsum("revenue").alias("revenue"), F.sum("nb_orders").alias("orders"),
                                        F.count_distinct("sales_date").alias("days"))
    # the days without promotion as columns of every row (one row per event goes through the window)
    plain = lambda c: F.max(F.when(F.col("promo_name").isNull(), c)).over(Window.partitionBy())
    g = g.withColumn("base_rev", plain(F.col("revenue") / F.col("days"))).withColumn(
        "base_ord", plain(F.col("orders") / F.col("days")))
    boost = promotions.groupBy("promo_name").agg(F.max(F.col("traffic_boost").cast("double")).alias("traffic_boost"))
    p = g.where(F.col("promo_name").isNotNull()).join(boost, "promo_name", "left")
    rev_day = F.col("revenue") / F.col("days")
    ratio = (F.col("orders") / F.col("days")) / F.col("base_ord")
    return p.select("promo_name", rev_day.alias("revenue_per_day"),
                    (rev_day - F.col("base_rev")).alias("revenue_uplift_per_day"),
                    ratio.alias("orders_ratio"), "traffic_boost",
                    (ratio < F.col("traffic_boost")).alias("below_expected"))


def q25_critical_undercut(double_risk: DataFrame, competitor: str | None = "BonPrix") -> DataFrame:
    """Q-25: critical-stock rows undercut by a competitor."""
    x = double_risk.where(F.col("stock_status") == "critical")
    return x.where(F.col("cheapest_competitor") == competitor) if competitor else x


def q28_regions_stockout_transfers(inv: DataFrame, transfers: DataFrame, stores: DataFrame) -> DataFrame:
    """Q-28: stockout rate per region next to pending transfers into it."""
    rate = M.evaluate(inv, ["stockout_rate"], by=["region"])
    t = (transfers.where(F.col("status") == "pending")
         .join(stores.select(F.col("store_id").alias("to_store_id"), "region"), "to_store_id")
         .groupBy("region").agg(F.count(F.lit(1)).alias("pending_transfers")))
    return rate.join(t, "region", "left").select(
        "region", "stockout_rate", F.coalesce("pending_transfers", F.lit(0)).alias("pending_transfers"))


def q29_urgent_stores(inv: DataFrame, coverage_days: float = 7.0, rate: float = 0.05) -> DataFrame:
    """Q-29: stores flagged by the business rules (PRJ-19): average
    coverage under 7 days or stockout rate above 5 %."""
    g = inv.groupBy("store_id", "store_name", "region").agg(
        M.measure("avg_coverage_days"), M.measure("stockout_rate"))
    g = g.withColumn("urgent_replenishment", X.urgent_replenishment("avg_coverage_days", coverage_days)) \
        .withColumn("critical_situation", F.coalesce(X.critical_stockout_rate("stockout_rate", rate), F.lit(False)))
    return g.where(F.col("urgent_replenishment") | F.col("critical_situation"))

