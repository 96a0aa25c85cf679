"""Entity views (PRJ-21), model relationships (JOI-10/11) and entity
relationships (JOI-12) as renamed projections and named key joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.functions.exprs import WEATHER_EN, remap

# Physical column -> business property name per entity
# (columns not listed keep their physical name).
ENTITY_PROPERTIES = {
    "Store": {"store_type": "Store_Format", "surface_m2": "Store_Size_m2"},
    "Product": {"category": "Product_Category", "subcategory": "Product_Subcategory",
                "unit_price": "Selling_Price", "unit_cost": "Cost_Price"},
    "InventoryStatus": {"quantity_on_hand": "Stock_On_Hand", "safety_stock": "Safety_Stock_Threshold",
                        "reorder_point": "Reorder_Point", "stock_status": "Stock_Health_Status",
                        "coverage_days": "Coverage_Days"},
    "ForecastVsActual": {"forecast_date": "Forecast_Date", "actual_qty": "Actual_Quantity",
                         "forecast_qty": "Forecasted_Quantity", "forecast_qty_lower": "Forecast_Lower_Bound",
                         "forecast_qty_upper": "Forecast_Upper_Bound", "forecast_error_pct": "Forecast_Error_Pct",
                         "forecast_accuracy": "Forecast_Accuracy"},
    "DemandForecast": {"forecast_date": "Forecast_Date", "forecast_qty": "Forecasted_Quantity",
                       "forecast_qty_lower": "Forecast_Lower_Bound", "forecast_qty_upper": "Forecast_Upper_Bound"},
    "CustomerSegment": {"segment_label": "Customer_Segment", "recency_days": "Days_Since_Last_Purchase",
                        "frequency": "Purchase_Frequency", "monetary": "Lifetime_Value",
                        "avg_basket": "Average_Basket_Size", "nb_distinct_products": "Distinct_Products_Bought"},
    "CompetitorPrice": {"competitor": "Competitor_Name", "price_gap_pct": "Price_Gap_Pct",
                        "is_cheaper": "Competitor_Is_Cheaper"},
    "WeatherObservation": {"max_temperature_c": "Max_Temperature_C", "min_temperature_c": "Min_Temperature_C",
                           "rainfall_mm": "Rainfall_mm", "wind_speed_kmh": "Wind_Speed_kmh",
                           "weather_condition": "Weather_Condition"},
    "Promotion": {"start_date": "Start_Date", "end_date": "End_Date", "category": "Product_Category",
                  "discount_pct": "Discount_Pct", "traffic_boost": "Traffic_Boost_Factor",
                  "budget_eur": "Budget_EUR", "is_active": "Is_Active"},
}

# Entity relationships (name: source entity, source column,
# target entity, target column).
RELATIONSHIPS = {
    "holds_inventory": ("InventoryStatus", "store_id", "Store", "store_id"),
    "located_in": ("InventoryStatus", "store_id", "Store", "store_id"),
    "tracked_in_inventory": ("InventoryStatus", "product_id", "Product", "product_id"),
    "has_product": ("InventoryStatus", "product_id", "Product", "product_id"),
    "is_forecasted_for": ("ForecastVsActual", "product_id", "Product", "product_id"),
    "benchmarked_against": ("CompetitorPrice", "product_id", "Product", "product_id"),
    "in_demand_forecast": ("DemandForecast", "product_id", "Product", "product_id"),
    "observed_at": ("Store", "city", "WeatherObservation", "city"),
    "occurs_on": ("ForecastVsActual", "forecast_date", "Calendar", "date"),
    "starts_on": ("Promotion", "start_date", "Calendar", "date"),
    "at_location": ("WeatherObservation", "city", "Store", "city"),
}

# Semantic-model relationships (fact column -> dimension column).
MODEL_RELATIONSHIPS = [
    ("sales", "sales_date", "calendar", "date"), ("sales", "store_id", "stores", "store_id"),
    ("forecast_vs_actual", "forecast_date", "calendar", "date"),
    ("forecast_vs_actual", "product_id", "products", "product_id"),
    ("inventory", "store_id", "stores", "store_id"), ("inventory", "product_id", "products", "product_id"),
    ("demand_forecast", "product_id", "products", "product_id"),
    ("competitor_prices", "product_id", "products", "product_id"),
    ("weather", "city", "stores", "city"),
]
# JOI-11: keys and tables no relationship may use.
FORBIDDEN_KEYS = {"category", "region", "channel"}
FORBIDDEN_TABLES = {"promotions", "segments"}


def entity_view(df: DataFrame, entity: str) -> DataFrame:
    """PRJ-21: the physical table under business property names."""
    m = ENTITY_PROPERTIES[entity]
    return df.select(*[F.col(c).alias(m.get(c, c)) for c in df.columns])


def weather_in_english(df: DataFrame, col: str = "weather_condition") -> DataFrame:
    """PRJ-22: weather condition labels translated to English."""
    return df.withColumn(col, remap(col, WEATHER_EN))


def check_relationship(src_table: str, src_col: str, dst_table: str, dst_col: str) -> None:
    """JOI-11: refuse a relationship on a forbidden key or table."""
    if {src_col, dst_col} & FORBIDDEN_KEYS:
        raise ValueError(f"no relationship on {sorted({src_col, dst_col} & FORBIDDEN_KEYS)}")
    if {src_table, dst_table} & FORBIDDEN_TABLES:
        raise ValueError(f"{sorted({src_table, dst_table} & FORBIDDEN_TABLES)} is a standalone table")


def relate(fact: DataFrame, dim: DataFrame, fact_col: str, dim_col: str, fact_table: str = "fact",
           dim_table: str = "dim") -> DataFrame:
    """JOI-10: fact -> dimension left join along a model relationship.
    The weather -> stores relationship is declared many-to-one but a city
    has many stores; callers relate weather to sales on (city, date)."""
    check_relationship(fact_table, fact_col, dim_table, dim_col)
    d = dim.withColumnRenamed(dim_col, fact_col) if dim_col != fact_col else dim
    extra = [c for c in d.columns if c in fact.columns and c != fact_col]
    return fact.join(d.drop(*extra), fact_col, "left")


def traverse(src: DataFrame, relationship: str, dst: DataFrame) -> DataFrame:
    """JOI-12: follow a named entity relationship: source rows with the
    target's attributes (target columns prefixed by the target entity)."""
    s_ent, s_col, d_ent, d_col = RELATIONSHIPS[relationship]
    pref = d_ent.lower() + "_"
    d = dst.select(*[F.col(c).alias(c if c == d_col else pref + c) for c in dst.columns])
    return src.join(d, src[s_col] == d[d_col]).drop(d[d_col]) if s_col != d_col else src.join(d, s_col)
