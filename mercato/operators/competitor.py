"""Competitor prices: gaps, re-pricing, latest snapshot, summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercato.functions.sketches import sketched_quantiles, sketches
from mercato.sources.retail import dec


def latest_snapshot(cp: DataFrame) -> DataFrame:
    """PRJ-24 on a snapshot table whose months aren't known beforehand: rows of
    the latest snapshot_month ('yyyy-MM' strings sort chronologically).
    ``Retail.competitor_latest`` reads that month alone."""
    latest = cp.select(F.max("snapshot_month")).scalar()
    return cp.where(F.col("snapshot_month") == latest)


def price_gap(cp: DataFrame, floor: str = "0.50") -> DataFrame:
    """PRJ-12: clamp the competitor price at a floor, then gap % and flag
    from the clamped price."""
    clamped = F.greatest(dec(floor, 12, 2), F.col("competitor_price"))
    gap = F.round((clamped - F.col("our_price")) / F.col("our_price") * 100, 2)
    return cp.select("snapshot_month", "product_id", "competitor", clamped.alias("competitor_price"),
                     gap.cast("double").alias("gap_from_price_pct")) \
        .withColumn("is_cheaper_from_price", F.col("gap_from_price_pct") < 0)


def reprice(cp: DataFrame, floor: str = "0.50") -> DataFrame:
    """PRJ-13: competitor price re-derived from the stored gap:
    our * (1 + gap/100), rounded to cents, floored; flag from the unclamped gap."""
    price = F.greatest(dec(floor, 12, 2),
                       F.round(F.col("our_price") * (F.lit(1) + F.col("price_gap_pct") / 100), 2))
    return cp.select("snapshot_month", "product_id", "competitor", "our_price", "price_gap_pct",
                     price.cast("double").alias("competitor_price"),
                     (F.col("price_gap_pct") < 0).alias("is_cheaper"))


def summary(cp: DataFrame) -> DataFrame:
    """AGG-14: average gap and number of cheaper rows per competitor."""
    return cp.groupBy("competitor").agg(
        F.round(F.avg("price_gap_pct"), 2).cast("double").alias("avg_gap"),
        F.sum(F.when(F.col("is_cheaper"), 1).otherwise(0)).alias("cheaper_count"))


PRICE_KEYS = ["snapshot_month", "category"]
PRICES = {"our_price": "median_our_price", "competitor_price": "median_competitor_price"}


def price_sketches(cp: DataFrame) -> DataFrame:
    """Quantile sketches of our and competitor prices per month and category."""
    return sketches(cp, PRICE_KEYS, list(PRICES))


def median_prices(cp: DataFrame, stored: DataFrame, by=("category",), where: Column | None = None) -> DataFrame:
    """AGG-22 / RPT-06: exact medians of our and competitor prices per category
    (or ``by``), for any months and categories, from stored sketches and one
    scan of the selected snapshots."""
    return sketched_quantiles(cp, stored, list(by), PRICES, 0.5, where)
