"""Sales facts: gold_sales_daily (AGG-01) and its summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.functions import exprs as X
from mercato.plans.joins import join_promotions
from mercato.sources.retail import LONGEST_PROMO_DAYS, Retail, dec

FACT_KEYS = ["store_id", "sales_date", "channel", "category", "subcategory", "promo_name"]
SALES_COLUMNS = ["store_id", "store_name", "region", "surface_m2", "store_type", "sales_date", "channel", "category",
                 "subcategory", "nb_orders", "units_sold", "revenue", "gross_margin", "avg_discount_pct",
                 "is_promo_day", "promo_name"]


def sales_lines(r: Retail) -> DataFrame:
    """Order lines with product and promotion attributes (JOI-01, 03, 04)."""
    lines = r.with_orders(r.priced_lines, r.orders).withColumnRenamed("order_date", "sales_date")
    return join_promotions(lines, r.promotions, "sales_date", LONGEST_PROMO_DAYS)


def gold_sales_daily(r: Retail) -> DataFrame:
    """AGG-01: store x date x channel x category x subcategory x promotion.

    Lines are first summed per order and key, so distinct orders are a plain
    count afterwards (no expansion of the fact rows); the store attributes
    (JOI-02) join the daily rows, not the lines.  Money is summed in
    millionths and discounts in hundredths of a percent, as integers."""
    per_order = sales_lines(r).groupBy(*FACT_KEYS, "order_id").agg(
        F.sum("quantity").alias("units"), F.sum(X.revenue_micros()).alias("rev"), F.sum(X.gross_margin_micros()).alias("gm"),
        F.sum(X.hundredths("discount_pct")).alias("disc"), F.count(F.lit(1)).alias("lines"))
    money = lambda c: F.round(F.sum(c).cast("decimal(19,0)") * dec("0.000001", 7, 6), 2)
    g = per_order.groupBy(*FACT_KEYS).agg(
        F.count(F.lit(1)).alias("nb_orders"), F.sum("units").alias("units_sold"),
        money("rev").alias("revenue"), money("gm").alias("gross_margin"),
        F.round(F.sum("disc").cast("decimal(19,0)") * dec("0.01", 3, 2) / F.sum("lines"), 2).alias("avg_discount_pct"))
    stores = r.stores.select("store_id", F.col("name").alias("store_name"), "region", "surface_m2", "store_type")
    g = g.join(stores, "store_id").withColumn("is_promo_day", X.promo_flag())
    return X.decimals_to_double(g.select(*SALES_COLUMNS))


def sales_by_year(sales: DataFrame) -> DataFrame:
    """AGG-02: revenue in millions and mean row margin % per year."""
    return (sales.groupBy(F.year("sales_date").alias("yr"))
            .agg(F.round(F.sum("revenue") / 1e6, 1).alias("rev_m"),
                 F.round(F.avg(F.try_divide("gross_margin", F.nullif(F.col("revenue"), F.lit(0)))) * 100, 1)
                 .alias("margin_pct")))


def line_totals(r: Retail) -> DataFrame:
    """PRJ-07 recomputed from the raw lines next to the stored value."""
    li = r.raw("lineitem")
    price = r.raw("part").select("p_partkey", F.col("p_retailprice").cast("decimal(10,2)").alias("price"))
    x = li.join(price, li.l_partkey == price.p_partkey)
    return (x.groupBy(F.col("l_returnflag").alias("returnflag"))
            .agg(F.count(F.lit(1)).alias("n_lines"),
                 F.sum(X.line_total(F.col("l_quantity").cast("int"), "price",
                                    F.col("l_discount").cast("decimal(4,2)"))).cast("double")
                 .alias("sum_line_total")))
