"""Report data sets (RPT-01..15).  Every function takes the gold facts and
the report slicers (year, region, channel; RPT-15) as optional filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mercato.functions.dax import davg, dsum
from mercato.operators import measures as M


def slice_sales(sales: DataFrame, year: int | None = None, region: str | None = None,
                channel: str | None = None) -> DataFrame:
    """RPT-15: the report slicers; a year is the partition of a stored gold
    table, else a range of dates that reaches the scan."""
    if year is not None:
        in_year = F.col("sales_date").between(F.make_date(F.lit(year), F.lit(1), F.lit(1)),
                                              F.make_date(F.lit(year), F.lit(12), F.lit(31)))
        sales = sales.where(F.col("sales_year") == year if "sales_year" in sales.columns else in_year)
    if region is not None:
        sales = sales.where(F.col("region") == region)
    if channel is not None:
        sales = sales.where(F.col("channel") == channel)
    return sales


def rpt02_top_stores(sales: DataFrame, n: int = 10, **slicers) -> DataFrame:
    """RPT-02: top n stores by revenue."""
    s = slice_sales(sales, **slicers)
    return (s.groupBy("store_id", "store_name", "region").agg(M.measure("total_revenue"))
            .orderBy(F.desc("total_revenue"), "store_id").limit(n))


def rpt03_region_map(sales: DataFrame, **slicers) -> DataFrame:
    """RPT-03: revenue and gross margin % per region."""
    return M.evaluate(slice_sales(sales, **slicers), ["total_revenue", "gross_margin_pct"], by=["region"])


def slice_inventory(inv: DataFrame, region: str | None = None, category: str | None = None) -> DataFrame:
    """RPT-15 on the snapshot: it has neither year nor channel."""
    inv = inv if region is None else inv.where(F.col("region") == region)
    return inv if category is None else inv.where(F.col("category") == category)


def rpt05_category_region_matrix(inv: DataFrame, **slicers) -> DataFrame:
    """RPT-05: stockouts (BLANK for 0) and average coverage per category x
    region, region not null (long form; pivot with ``pivot_wide``)."""
    return M.evaluate(slice_inventory(inv, **slicers).where(F.col("region").isNotNull()), ["stockouts_display", "avg_coverage_days"],
                      by=["category", "region"])


def pivot_wide(df: DataFrame, rows: list[str], col: str, value: str, values: list) -> DataFrame:
    """Matrix layout of a long result; the pivot values are passed in (a
    known dimension), so Spark does not collect the distinct values."""
    return df.groupBy(*rows).pivot(col, values).agg(F.first(value))


def rpt07_actual_vs_forecast(fva: DataFrame) -> DataFrame:
    """RPT-07: actual and forecast units with the band, per day."""
    return fva.groupBy("forecast_date").agg(
        F.sum("actual_qty").alias("actual_qty"), dsum("forecast_qty").alias("forecast_qty"),
        dsum("forecast_qty_lower").alias("forecast_qty_lower"),
        dsum("forecast_qty_upper").alias("forecast_qty_upper"))


def rpt09_weather_revenue(sales: DataFrame, stores: DataFrame, weather: DataFrame, **slicers) -> DataFrame:
    """RPT-09: revenue, orders and mean max temperature per weather
    condition; sales meet weather on (city, date) (the model's single-
    direction relationships would never filter sales by weather)."""
    s = slice_sales(sales, **slicers).join(stores.select("store_id", "city"), "store_id")
    x = s.join(weather.select("city", F.col("date").alias("sales_date"), "weather_condition", "max_temperature_c"),
               ["city", "sales_date"])
    return x.groupBy("weather_condition").agg(
        davg("max_temperature_c", 1).alias("avg_max_temperature_c"),
        M.measure("total_revenue"), M.measure("nb_orders"))


def rpt10_future_forecast(forecast: DataFrame, as_of: Column) -> DataFrame:
    """RPT-10: forecast totals and bounds per future day."""
    f = forecast.where(F.col("forecast_date") > as_of)
    return f.groupBy("forecast_date").agg(dsum("forecast_qty").alias("forecast_qty"),
                                          dsum("forecast_qty_lower").alias("forecast_qty_lower"),
                                          dsum("forecast_qty_upper").alias("forecast_qty_upper"))


def rpt11_segment_bubble(segments: DataFrame) -> DataFrame:
    """RPT-11: recency, lifetime value and size per segment."""
    return segments.groupBy("segment_label").agg(
        F.avg("recency_days").alias("avg_recency_days"), davg("monetary").alias("avg_ltv"),
        F.count_distinct("customer_id").alias("nb_clients"))


def rpt12_format_category_stockout(inv: DataFrame, stores: DataFrame, **slicers) -> DataFrame:
    """RPT-12: stockout rate per store format x category."""
    x = slice_inventory(inv, **slicers).join(stores.select("store_id", "store_type"), "store_id")
    return M.evaluate(x, ["stockout_rate"], by=["store_type", "category"])


def rpt13_gap_category_competitor(cp: DataFrame) -> DataFrame:
    """RPT-13: average price gap per category x competitor."""
    return M.evaluate(cp, ["avg_price_gap"], by=["category", "competitor"])


def rpt14_store_category(sales: DataFrame, store_id=None, **slicers) -> DataFrame:
    """RPT-14: revenue by category for one store (all stores when None)."""
    s = slice_sales(sales, **slicers)
    s = s if store_id is None else s.where(F.col("store_id") == store_id)
    return M.evaluate(s, ["total_revenue", "gross_margin_pct"], by=["store_id", "category"])


def rpt14_store_monthly(sales: DataFrame, store_id=None, **slicers) -> DataFrame:
    """RPT-14: monthly revenue trend per store."""
    s = slice_sales(sales, **slicers)
    s = s if store_id is None else s.where(F.col("store_id") == store_id)
    s = s.withColumn("year_month_sort", F.year("sales_date") * 100 + F.month("sales_date"))
    return M.evaluate(s, ["total_revenue"], by=["store_id", "year_month_sort"])


def rpt14_top_products(lines: DataFrame, products: DataFrame, n: int = 20, store_id=None) -> DataFrame:
    """RPT-14: top n products per store by revenue (order items are needed,
    gold_sales_daily has no product).  Aggregated to store x product first;
    the window then ranks within a store."""
    x = lines if store_id is None else lines.where(F.col("store_id") == store_id)
    rev = F.col("quantity") * F.col("unit_price") * (F.lit(1) - F.col("discount_pct") / 100)
    g = x.groupBy("store_id", "product_id").agg(F.round(F.sum(rev), 2).cast("double").alias("revenue"),
                                                F.sum("quantity").alias("units_sold"))
    w = Window.partitionBy("store_id").orderBy(F.desc("revenue"), "product_id")
    top = g.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)
    return top.join(products.select("product_id", F.col("name").alias("product_name"), "category"), "product_id")


def rpt14_store_kpis(sales: DataFrame, inv: DataFrame, store_id=None, **slicers) -> DataFrame:
    """RPT-14: the five KPI cards of a store (of every store when None)."""
    s = slice_sales(sales, **slicers)
    if store_id is not None:
        s, inv = s.where(F.col("store_id") == store_id), inv.where(F.col("store_id") == store_id)
    a = M.evaluate(s, ["total_revenue", "gross_margin_pct", "nb_orders"], by=["store_id"])
    return a.join(M.evaluate(inv, ["nb_stockout", "avg_coverage_days"], by=["store_id"]), "store_id", "left")


def rpt08_worst_first(fva: DataFrame) -> DataFrame:
    """RPT-08: forecast accuracy by category, worst first (rank 1)."""
    g = M.evaluate(fva, ["forecast_accuracy"], by=["category"])
    rank = F.row_number().over(Window.orderBy("forecast_accuracy", "category"))  # one row per category
    return g.withColumn("rank", rank).orderBy("rank")
