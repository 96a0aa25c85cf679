"""Inventory: velocity (AGG-03), stock policy (PRJ-15), gold_inventory_status (AGG-04)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mercato.functions import exprs as X
from mercato.sources.retail import Retail


def velocity(r: Retail) -> DataFrame:
    """AGG-03: units per selling day per store x product."""
    return r.store_product_sales.select(
        "store_id", "product_id",
        (F.col("sold").cast("double") / F.col("days")).alias("avg_daily_sales"))


def stock_policy(pairs: DataFrame, sales: DataFrame, stores: DataFrame, cover_days: int = 14,
                 min_velocity: float = 0.1, default_velocity: float = 1.0) -> DataFrame:
    """PRJ-15 + JOI-08: thresholds per candidate (store_id, product_id) pair;
    a pair without sales has the default velocity."""
    velocity_ = F.col("sold").cast("double") / F.col("days")
    adp = F.greatest(F.lit(min_velocity), F.coalesce(velocity_, F.lit(default_velocity)))
    safety, reorder = X.stock_thresholds(min_velocity=str(min_velocity), default_velocity=str(default_velocity))
    x = (pairs.join(sales, ["store_id", "product_id"], "left")
         .join(stores.select("store_id", "surface_m2"), "store_id").withColumn("adp", adp))
    return x.select(
        "store_id", "product_id", "adp", safety.alias("safety_stock"), reorder.alias("reorder_point"),
        F.greatest(F.lit(5), F.floor(cover_days * F.col("adp") * F.log(F.col("surface_m2") / 400 + 1))
                   .cast("int")).alias("base_stock"))


def gold_inventory_status(r: Retail) -> DataFrame:
    """AGG-04: stock on hand per store x active product with status and coverage."""
    stores = r.stores.select("store_id", F.col("name").alias("store_name"), "region")
    products = (r.products.where("is_active")
                .select("product_id", F.col("name").alias("product_name"), "category"))
    inv = (r.inventory
           .join(stores, "store_id").join(products, "product_id"))
    return inv.select("store_id", "store_name", "region", "product_id", "product_name", "category",
                      "quantity_on_hand", "safety_stock", "reorder_point",
                      X.stock_status().alias("stock_status"), "coverage_days", "last_updated")


def status_mix(inv: DataFrame) -> DataFrame:
    """AGG-05 / WIN-01: count, share of total and mean coverage per status."""
    g = inv.groupBy("stock_status").agg(F.count(F.lit(1)).alias("cnt"),
                                        F.round(F.avg("coverage_days"), 1).alias("avg_coverage"))
    # share of total over the 4 aggregated rows only
    return g.select("stock_status", "cnt",
                    F.round(F.col("cnt") * 100.0 / F.sum("cnt").over(Window.partitionBy()), 1).alias("pct"),
                    "avg_coverage")
