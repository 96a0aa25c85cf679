"""Column expressions shared by the operators (all JVM-side, codegen'd)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

# Inventory status labels, in severity order.
STATUSES = ("stockout", "critical", "low", "normal")
AT_RISK = ("stockout", "critical")

# Customer segment labels by score rank 1..5.
SEGMENT_LABELS = ("Champions", "Loyal", "Warm Prospects", "At Risk", "Inactive")

# Weather condition labels and their English names.
WEATHER_EN = {"ensoleillé": "sunny", "nuageux": "cloudy", "pluie": "rain", "couvert": "overcast"}

# French promotion names of the source feed -> English.
PROMO_EN = {"Soldes Hiver": "Winter Sales", "Soldes Été": "Summer Sales",
            "Rentrée scolaire": "Back to School", "Saint-Valentin": "Valentine's Day",
            "Fêtes de fin d'année": "Christmas"}


def c(name: str | Column) -> Column:
    return F.col(name) if isinstance(name, str) else name


def discount_factor(discount_pct: str | Column = "discount_pct") -> Column:
    """1 - discount/100 in exact decimal arithmetic."""
    return F.lit(1) - c(discount_pct) / 100


def revenue(qty="quantity", price="unit_price", disc="discount_pct") -> Column:
    """PRJ-05: qty * price * (1 - disc/100)."""
    return c(qty) * c(price) * discount_factor(disc)


def gross_margin(qty="quantity", price="unit_price", cost="unit_cost", disc="discount_pct") -> Column:
    """PRJ-06: qty * (price - cost) * (1 - disc/100); the discount scales the cost too."""
    return c(qty) * (c(price) - c(cost)) * discount_factor(disc)


def hundredths(x: str | Column) -> Column:
    """A value of two decimals as an integer of hundredths (cents, hundredths of a percent)."""
    return (c(x) * 100).cast("bigint")


def revenue_micros(qty="quantity", price="unit_price", disc="discount_pct") -> Column:
    """PRJ-05 in millionths, as an integer."""
    return c(qty) * hundredths(price) * (F.lit(10_000).cast("bigint") - hundredths(disc))


def gross_margin_micros(qty="quantity", price="unit_price", cost="unit_cost", disc="discount_pct") -> Column:
    """PRJ-06 in millionths, as an integer."""
    return c(qty) * (hundredths(price) - hundredths(cost)) * (F.lit(10_000).cast("bigint") - hundredths(disc))


def line_total(qty="quantity", price="unit_price", disc_frac="discount") -> Column:
    """PRJ-07: qty * price * (1 - disc) rounded to cents."""
    return F.round(c(qty) * c(price) * (F.lit(1) - c(disc_frac)), 2)


def promo_flag(promo_name="promo_name") -> Column:
    """PRJ-08: 1 on a promotion row, else 0."""
    return c(promo_name).isNotNull().cast("int")


def promo_active(as_of: Column, start="start_date", end="end_date") -> Column:
    """PRJ-09: start <= as_of <= end."""
    return as_of.between(c(start), c(end))


def stock_thresholds(sold="sold", days="days", safety_days: int = 3, reorder_days: int = 7,
                     min_velocity: str = "0.1", default_velocity: str = "1.0") -> tuple[Column, Column]:
    """PRJ-15: (safety stock, reorder point) from the units per selling day,
    in exact arithmetic; pairs never sold get the default velocity."""
    v = F.greatest(F.lit(min_velocity).cast("decimal(4,1)"), F.lit(default_velocity).cast("decimal(4,1)"))

    def floor_of(n: int) -> Column:
        by_sales = F.greatest(F.floor(F.lit(n) * F.lit(min_velocity).cast("decimal(4,1)")).cast("bigint"),
                              F.expr(f"div({n} * {sold}, {days})"))
        return F.coalesce(by_sales, F.floor(F.lit(n) * v).cast("bigint"))

    return (F.greatest(F.lit(1), floor_of(safety_days)).cast("int"),
            F.greatest(F.lit(2), floor_of(reorder_days)).cast("int"))


def stock_status(qty="quantity_on_hand", safety="safety_stock", reorder="reorder_point") -> Column:
    """PRJ-16: threshold rule for the stock status."""
    return (F.when(c(qty) == 0, "stockout").when(c(qty) <= c(safety), "critical")
            .when(c(qty) <= c(reorder), "low").otherwise("normal"))


def severity_rank(sev="severity") -> Column:
    """SRT-02: CASE-based severity order."""
    return (F.when(c(sev) == "critical", 1).when(c(sev) == "high", 2)
            .when(c(sev) == "medium", 3).otherwise(4))


def coverage_band(cov="coverage_days") -> Column:
    """PRJ-20: coverage colour bands of the inventory matrix."""
    return (F.when(c(cov) < 7, "red").when(c(cov) < 14, "orange").when(c(cov) < 20, "yellow")
            .when(c(cov) <= 25, "light_green").otherwise("green"))


def remap(col: str | Column, mapping: dict) -> Column:
    """PRJ-03 / PRJ-22: value remap that keeps unmatched values."""
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return F.coalesce(m[c(col)], c(col))


def decimals_to_double(df: DataFrame) -> DataFrame:
    """PRJ-04: cast every DecimalType column to double, schema-driven."""
    return df.select([F.col(f.name).cast("double").alias(f.name)
                      if isinstance(f.dataType, DecimalType) else F.col(f.name)
                      for f in df.schema.fields])


def rename_if_present(df: DataFrame, mapping: dict) -> DataFrame:
    """PRJ-01: idempotent rename (only when old is present and new absent)."""
    cols = set(df.columns)
    return df.withColumnsRenamed({o: n for o, n in mapping.items() if o in cols and n not in cols})


# Business rules (PRJ-19).
def urgent_replenishment(cov="coverage_days", days: float = 7) -> Column:
    return c(cov) < days


def overstock(cov="coverage_days") -> Column:
    return c(cov) > 30


def retrain_needed(acc="forecast_accuracy") -> Column:
    return c(acc) < 0.75


def high_confidence(acc="forecast_accuracy") -> Column:
    return c(acc) > 0.90


def undercut(gap="price_gap_pct") -> Column:
    return c(gap) < 0


def critical_stockout_rate(rate="stockout_rate", limit: float = 0.05) -> Column:
    return c(rate) > limit


def retention_priority(label="segment_label", recency="recency_days") -> Column:
    return (c(label) == "At Risk") & (c(recency) > 90)


def win_back(label="segment_label", ltv="monetary") -> Column:
    return (c(label) == "Inactive") & (c(ltv) > 500)
