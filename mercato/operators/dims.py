"""Dimensions: dim_calendar (AGG-10) and distinct-value dims (AGG-11)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercato.sources.retail import Retail


def calendar(start: Column, end: Column, anchor: DataFrame) -> DataFrame:
    """Calendar rows for [start, end]; ``anchor`` is any one-row DataFrame."""
    d = F.col("date")
    days = anchor.select(F.explode(F.sequence(start, end)).alias("date"))
    return days.select(
        d, F.date_format(d, "yyyy-MM-dd").alias("date_key"), F.year(d).alias("year"),
        F.month(d).alias("month_num"), F.date_format(d, "MMMM").alias("month_name"),
        F.concat(F.lit("Q"), F.quarter(d)).alias("quarter"),
        F.concat(F.year(d), F.lit("-"), F.lpad(F.month(d).cast("string"), 2, "0")).alias("year_month"),
        (F.year(d) * 100 + F.month(d)).alias("year_month_sort"),
        F.weekofyear(d).alias("week_num"),
        F.dayofweek(d).isin(1, 7).alias("is_weekend"))


def dim_calendar(r: Retail) -> DataFrame:
    """Whole calendar years spanning the sales history."""
    o = r.raw("orders").select(F.min("o_orderdate").alias("lo"), F.max("o_orderdate").alias("hi"))
    return calendar(F.make_date(F.year("lo"), F.lit(1), F.lit(1)),
                    F.make_date(F.year("hi"), F.lit(12), F.lit(31)), o)


def dim_category(r: Retail) -> DataFrame:
    return r.products.select("category").distinct()


def dim_region(r: Retail) -> DataFrame:
    return r.stores.select("region").distinct()


def dim_channel(r: Retail) -> DataFrame:
    return r.orders.select("channel").distinct()
