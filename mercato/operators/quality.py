"""Data-quality checks and audits (DQ-*, SRC-12/13, SET-01)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.plans.joins import overlaps
from mercato.sources.retail import Retail

# Allowed domain values (DQ-01).
DOMAINS = {
    "store_type": ("hypermarket", "supermarket", "convenience"),
    "channel": ("in_store", "click_and_collect", "home_delivery", "drive"),
    "stock_status": ("stockout", "critical", "low", "normal"),
    "order_status": ("F", "O", "P"),
    "event_type": ("click", "purchase", "signup", "view"),
    "segment_label": ("Champions", "Loyal", "Warm Prospects", "At Risk", "Inactive"),
}


def promo_overlap_stretches(promotions: DataFrame, lead_days: int = 0, longest_days: int | None = None) -> DataFrame:
    """DQ-06: stretches of days on which a category has more than one
    promotion, by a sweep over starts and ends; with ``lead_days`` a promotion
    counts from its announcement that many days before."""
    announced = promotions.withColumn("start_date", F.date_sub("start_date", lead_days))
    longest = None if longest_days is None else longest_days + lead_days
    return overlaps(announced, "promo_name", "start_date", "end_date", ["category"], longest).select(
        "category", "from_date", "to_date", F.col("n").alias("n_promos"), F.array_join("names", "|").alias("promo_names"))


def promo_overlap(promotions: DataFrame, lead_days: int = 0, longest_days: int | None = None) -> DataFrame:
    """DQ-06 per day: the rows the promotion join would fan out.  Only the
    stretches that overlap are listed day by day."""
    x = promo_overlap_stretches(promotions, lead_days, longest_days)
    return x.select("category", F.explode(F.sequence("from_date", "to_date")).alias("promo_date"), "n_promos", "promo_names")


def distributions(r: Retail) -> DataFrame:
    """AGG-21: value distributions as (dimension, value, cnt)."""
    parts = [r.stores.groupBy(F.lit("store_type").alias("dimension"), F.col("store_type").alias("value")),
             r.orders.groupBy(F.lit("channel").alias("dimension"), F.col("channel").alias("value")),
             r.orders.groupBy(F.lit("order_status").alias("dimension"), F.col("order_status").alias("value"))]
    return reduce(DataFrame.unionAll, [g.agg(F.count(F.lit(1)).alias("cnt")) for g in parts])


def row_counts(r: Retail) -> DataFrame:
    """SET-01: UNION ALL of per-table row counts."""
    tables = {"stores": r.stores, "products": r.products, "orders": r.orders,
              "order_items": r.order_items, "promotions": r.promotions,
              "competitor_prices": r.competitor_prices, "inventory": r.inventory}
    return reduce(DataFrame.unionAll, [df.agg(F.lit(n).alias("tbl"), F.count(F.lit(1)).alias("rows"))
                                       for n, df in tables.items()])


def key_checks(r: Retail) -> DataFrame:
    """DQ-02: duplicate primary keys and dangling foreign keys, as counts."""
    dup_orders = r.orders.groupBy("order_id").count().where("count > 1")
    dup_products = r.products.groupBy("product_id").count().where("count > 1")
    no_lines = r.orders.join(r.order_items, "order_id", "left_anti")
    bad_store = r.orders.join(r.stores, "store_id", "left_anti")
    bad_product = r.order_items.join(r.products, "product_id", "left_anti")
    checks = {"duplicate_order_id": dup_orders, "duplicate_product_id": dup_products,
              "orders_without_lines": no_lines, "orders_unknown_store": bad_store,
              "items_unknown_product": bad_product}
    return reduce(DataFrame.unionAll, [df.agg(F.lit(n).alias("check"), F.count(F.lit(1)).alias("n"))
                                       for n, df in checks.items()])


def domain_violations(df: DataFrame, column: str, allowed=None) -> DataFrame:
    """DQ-01: rows whose value is outside the allowed set (left_anti on a
    tiny literal set, broadcast)."""
    allowed = allowed or DOMAINS[column]
    spark = SparkSession.getActiveSession()
    ok = spark.createDataFrame([(v,) for v in allowed], [column])
    return df.join(F.broadcast(ok), column, "left_anti")


def table_audit(spark: SparkSession, names, fallback_dir: str | None = None) -> DataFrame:
    """SRC-12: presence and row count of required catalog tables; a missing
    table is reported (exists=false), not fatal.  With ``fallback_dir`` a
    missing catalog table is looked up as <dir>/<name>.parquet (SRC-08)."""
    from mercato.sources.tables import read_table
    rows = []
    for n in names:
        df = read_table(spark, n, fallback_dir)
        rows.append((n, df is not None, df.count() if df is not None else None))
    return spark.createDataFrame(rows, "tbl string, exists boolean, rows long")
