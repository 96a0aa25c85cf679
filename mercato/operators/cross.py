"""Cross-entity gold tables: double risk (AGG-08) and champion alert (AGG-09)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.functions.exprs import AT_RISK


def double_risk(products: DataFrame, inv: DataFrame, latest: DataFrame,
                statuses=AT_RISK) -> DataFrame:
    """AGG-08: at-risk stock rows whose product is cheaper at a competitor in
    the latest snapshot (``latest``).  Every cheaper competitor gives a row (as the
    source does); the fan-out per product is bounded by the competitor count."""
    risky = inv.where(F.col("stock_status").isin(*statuses)).select(
        "product_id", "store_id", "store_name", "region", "stock_status", "coverage_days",
        "quantity_on_hand")
    cheaper = latest.where("is_cheaper").select(
        "product_id", F.col("competitor").alias("cheapest_competitor"),
        F.col("competitor_price").cast("double").alias("competitor_price"),
        F.round("price_gap_pct", 2).cast("double").alias("price_gap_pct"))
    p = products.select("product_id", F.col("name").alias("product_name"), "category",
                        F.col("unit_price").cast("double").alias("our_price"))
    return (p.join(risky, "product_id").join(cheaper, "product_id")
            .select("product_id", "product_name", "category", "our_price", "store_id", "store_name",
                    "region", "stock_status", "coverage_days", "quantity_on_hand",
                    "cheapest_competitor", "competitor_price", "price_gap_pct")
            .distinct())


def double_risk_cheapest(dr: DataFrame) -> DataFrame:
    """One row per product x store: the cheapest competitor (ties by name)."""
    keys = ["product_id", "product_name", "category", "our_price", "store_id", "store_name", "region",
            "stock_status", "coverage_days", "quantity_on_hand"]
    best = F.min(F.struct("competitor_price", "cheapest_competitor", "price_gap_pct")).alias("b")
    return dr.groupBy(*keys).agg(best, F.count(F.lit(1)).alias("n_cheaper")).select(
        *keys, F.col("b.cheapest_competitor").alias("cheapest_competitor"),
        F.col("b.competitor_price").alias("competitor_price"),
        F.col("b.price_gap_pct").alias("price_gap_pct"), "n_cheaper")


def champion_stockout_alert(segments: DataFrame, lines: DataFrame, products: DataFrame,
                            stores: DataFrame, inv: DataFrame, segment: str = "Champions",
                            statuses=AT_RISK, recent_days: int | None = None, as_of=None,
                            same_store: bool = False) -> DataFrame:
    """AGG-09: customers of a segment who bought products now at risk.

    By default the status is that of the product in any store (as in the
    source) and there is no date window: a purchase meets one row per status
    of its product, with the number of stores in it and the lowest coverage
    and quantity.  ``same_store`` joins on (store, product); ``recent_days``
    keeps purchases in the last N days before ``as_of``.  Purchases are
    reduced to distinct (customer, product, store) first."""
    seg = segments.where(F.col("segment_label") == segment).select(
        "customer_id", F.col("segment_label").alias("customer_segment"),
        F.col("monetary").cast("double").alias("lifetime_value"), "recency_days", "frequency")
    buys = lines
    if recent_days is not None:
        buys = buys.where(F.col("order_date") > F.date_sub(as_of, recent_days))
    # the segment is a small part of the customers: keep its lines before they are reduced
    buys = (buys.join(seg.select("customer_id"), "customer_id", "left_semi")
            .select("customer_id", "product_id", "store_id").distinct())
    risky = inv.where(F.col("stock_status").isin(*statuses)).select(
        F.col("store_id").alias("inv_store_id"), "product_id", "stock_status",
        F.round("coverage_days", 1).alias("coverage_days"), "quantity_on_hand")
    x = seg.join(buys, "customer_id")
    if same_store:
        rk = risky.withColumnRenamed("product_id", "inv_product_id")
        x = x.join(rk, (x.product_id == rk.inv_product_id) & (x.store_id == rk.inv_store_id)) \
            .drop("inv_product_id")
    else:
        # one row per product and status: how many stores, and the scarcest of them
        states = risky.groupBy("product_id", "stock_status").agg(
            F.min("coverage_days").alias("coverage_days"), F.min("quantity_on_hand").alias("quantity_on_hand"),
            F.count(F.lit(1)).alias("n_stores"))
        x = x.join(states, "product_id")
    p = products.select("product_id", F.col("name").alias("product_name"), "category")
    s = stores.select("store_id", F.col("name").alias("store_name"), "region")
    return (x.join(p, "product_id").join(s, "store_id")
            .select("customer_id", "customer_segment", "lifetime_value", "recency_days", "frequency",
                    "product_id", "product_name", "category", "store_id", "store_name", "region",
                    "stock_status", "coverage_days", "quantity_on_hand", *([] if same_store else ["n_stores"])))
