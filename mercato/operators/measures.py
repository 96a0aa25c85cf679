"""Semantic-model measures (MEA-01..35) as aggregate Column builders.

A measure is evaluated in a filter context: ``evaluate(df, names, by,
where)`` = filter, then ``groupBy(by).agg(...)``.  DAX semantics: BLANK is
NULL, DIVIDE gives BLANK on a zero/BLANK denominator, BLANK counts as 0 in
+/- (see ``mercato.functions.dax``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercato.functions.dax import blank_sub, count_rows_if, davg, div, dsum


def _sales() -> dict[str, Callable[[], Column]]:
    def promo():
        return F.col("is_promo_day") == 1

    def normal():
        return F.col("is_promo_day") == 0
    return {
        "total_revenue": lambda: dsum("revenue"),                                   # MEA-01
        "total_margin": lambda: dsum("gross_margin"),                               # MEA-02
        "gross_margin_pct": lambda: div(dsum("gross_margin"), dsum("revenue")),     # MEA-03
        "nb_orders": lambda: F.sum("nb_orders"),                                    # MEA-04
        "units_sold": lambda: F.sum("units_sold"),                                  # MEA-05
        "avg_basket": lambda: div(dsum("revenue"), F.sum("nb_orders")),             # MEA-06
        "avg_discount_pct": lambda: davg("avg_discount_pct"),                       # MEA-07
        "revenue_uplift_promo": lambda: blank_sub(                                  # MEA-13
            div(dsum(F.when(promo(), F.col("revenue"))), F.count_distinct(F.when(promo(), F.col("sales_date")))),
            div(dsum(F.when(normal(), F.col("revenue"))), F.count_distinct(F.when(normal(), F.col("sales_date"))))),
    }


def _inventory() -> dict[str, Callable[[], Column]]:
    def st():
        return F.col("stock_status")
    return {
        "stockout_rate": lambda: div(count_rows_if(st() == "stockout"), F.count(F.lit(1))),  # MEA-14
        "nb_stockout": lambda: F.count_if(st() == "stockout"),                                # MEA-15
        "stockouts_display": lambda: count_rows_if(st() == "stockout"),                       # MEA-16
        "nb_critical": lambda: F.count_if(st().isin("stockout", "critical")),                 # MEA-17
        "avg_stock": lambda: F.avg("quantity_on_hand"),                                     # MEA-18
        "avg_coverage_days": lambda: davg("coverage_days", 1),                              # MEA-19
    }


def _fva() -> dict[str, Callable[[], Column]]:
    def err():
        return F.abs(F.col("actual_qty") - F.col("forecast_qty"))
    return {
        "forecast_accuracy": lambda: F.lit(1) - F.coalesce(div(dsum(err()), F.sum("actual_qty")), F.lit(0)),  # MEA-20
        "mae_forecast": lambda: davg(err()),                                                                  # MEA-21
        "forecast_vs_actual_pct": lambda: F.coalesce(div(F.sum("actual_qty"), dsum("forecast_qty")),        # MEA-22
                                                     F.lit(0)) - 1,
    }


def _customers() -> dict[str, Callable[[], Column]]:
    def lab():
        return F.col("segment_label")
    return {
        "nb_clients": lambda: F.count_distinct("customer_id"),                              # MEA-25
        "nb_champions": lambda: count_rows_if(lab() == "Champions"),                          # MEA-26
        "pct_champions": lambda: div(count_rows_if(lab() == "Champions"),                     # MEA-27
                                     F.count_distinct("customer_id")),
        "avg_monetary_champions": lambda: davg(F.when(lab() == "Champions", F.col("monetary"))),  # MEA-28
        "avg_recency_days": lambda: F.avg("recency_days"),                                  # MEA-29
        "nb_at_risk": lambda: count_rows_if(lab() == "At Risk"),                              # MEA-30
        "nb_inactive": lambda: count_rows_if(lab() == "Inactive"),                            # MEA-31
    }


def _competitor() -> dict[str, Callable[[], Column]]:
    def ch():
        return F.col("is_cheaper")
    return {
        "avg_price_gap": lambda: davg("price_gap_pct"),                                     # MEA-32
        "pct_cheaper": lambda: div(count_rows_if(ch()), F.count(F.lit(1))),                   # MEA-33
        "nb_cheaper": lambda: count_rows_if(ch()),                                            # MEA-34
        "max_gap": lambda: F.max(F.col("price_gap_pct").cast("double")),                    # MEA-35
    }


MEASURES: dict[str, dict[str, Callable[[], Column]]] = {
    "sales": _sales(), "inventory": _inventory(), "fva": _fva(),
    "customers": _customers(), "competitor": _competitor(),
}


def measure(name: str) -> Column:
    for group in MEASURES.values():
        if name in group:
            return group[name]().alias(name)
    raise KeyError(name)


def evaluate(df: DataFrame, names, by=(), where: Column | None = None) -> DataFrame:
    """Evaluate measures over ``df`` in the filter context (by, where)."""
    if where is not None:
        df = df.where(where)
    aggs = [measure(n) for n in names]
    return df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)


def forecast_window(forecast: DataFrame, as_of: Column, days=(30, 90), by=()) -> DataFrame:
    """MEA-23/24: forecast units over [as_of, as_of + d - 1] for each d, in
    one aggregate pass."""
    d = F.col("forecast_date")
    aggs = [dsum(F.when(d.between(as_of, F.date_add(as_of, n - 1)), F.col("forecast_qty")))
            .alias(f"forecast_{n}d") for n in days]
    return forecast.groupBy(*by).agg(*aggs) if by else forecast.agg(*aggs)


def true_order_count(lines: DataFrame, by=()) -> DataFrame:
    """MEA-04 variant: distinct orders from the order grain (an order over
    two categories counts once)."""
    agg = F.count_distinct("order_id").alias("nb_orders_distinct")
    return lines.groupBy(*by).agg(agg) if by else lines.agg(agg)
