"""Silver -> gold build (the main batch path) and the reader of its tables.

Each gold table is one DataFrame plan written once as Parquet; row counts
and the table's expectations (``expectations``) come from ``observe`` metrics
of the write itself (no second pass), and a
table that later plans read is read back from its written files, which
cuts the lineage (an executor lost later recomputes from the table, not
from the sources).  A table is written to a staging folder and renamed into
place when complete and as expected; a failed write or a breached
expectation leaves the old table as it was.

usage: python -m mercato.plans.gold <sf_dir> <out_dir>
"""

from __future__ import annotations

import sys
from datetime import date
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.operators import competitor, cross, dims, distinct, forecast, inventory, sales, segments
from mercato.operators import expectations as E
from mercato.operators.expectations import RowRule, TableRule
from mercato.operators.quality import DOMAINS
from mercato.sources.retail import COMPETITORS, Retail, load

EPOCH = date(1970, 1, 1)

# partition columns of the larger gold tables (partition pruning on the
# usual date / month filters)
PARTITION_BY = {"gold_sales_daily": ["sales_year"], "silver_competitor_prices": ["snapshot_month"],
                "gold_price_sketches": ["snapshot_month"]}


def expectations(r: Retail) -> dict[str, list]:
    """DQ-01/DQ-03: what each gold table must hold, from the calendar facts of
    the sales history and the domains; no table is scanned for it."""
    known = lambda c: f"{c} IN ({', '.join(repr(v) for v in DOMAINS[c])})"
    first, last = r.params["lo"], r.params["hi"]
    days = (date(last.year, 12, 31) - date(first.year, 1, 1)).days + 1
    some = TableRule("rows", E.rows, low=1)
    return {
        "silver_competitor_prices": [RowRule("competitor_known", f"competitor IN ({', '.join(repr(c) for c in COMPETITORS)})"),
                                     RowRule("prices_positive", "competitor_price > 0 AND our_price > 0"), some,
                                     TableRule("cheaper_share", E.share("is_cheaper"), 0.05, 0.95, "warn")],
        "gold_sales_daily": [RowRule("keys_known", "store_id IS NOT NULL AND region IS NOT NULL AND category IS NOT NULL"),
                             RowRule("channel_known", known("channel")),
                             RowRule("units_positive", "units_sold > 0 AND nb_orders > 0", "fail"), some,
                             TableRule("first_day", E.smallest("unix_date(sales_date)"), (first - EPOCH).days, (last - EPOCH).days),
                             TableRule("last_day", E.largest("unix_date(sales_date)"), (first - EPOCH).days, (last - EPOCH).days)],
        "gold_inventory_status": [RowRule("status_known", known("stock_status"), "fail"),
                                  RowRule("stock_not_negative", "quantity_on_hand >= 0"), some,
                                  TableRule("stockout_share", E.share("stock_status = 'stockout'"), high=0.25, action="warn")],
        "gold_forecast_vs_actual": [RowRule("forecast_not_negative", "forecast_qty >= 0"), some,
                                    TableRule("rows_beyond_whole_horizons", lambda good: F.count_if(good) % 90, 0, 0)],
        "silver_customer_segments": [RowRule("label_known", known("segment_label"), "fail"), some],
        "gold_price_sketches": [RowRule("sketch_of_values", "n > 0 AND kll_sketch_get_n_double(sketch) = n", "fail"), some],
        "gold_slicer_bitmaps": [RowRule("no_empty_set", "bitmap_count(ids) > 0", "fail"), some],
        "dim_calendar": [TableRule("rows", E.rows, days, days)],
        "dim_channel": [RowRule("channel_known", known("channel"), "fail"), TableRule("rows", E.rows, 1, len(DOMAINS["channel"]))],
    }


def write_table(df: DataFrame, out_dir: str, name: str, rules=()) -> int:
    """Write ``df`` to <out_dir>/<name> through a staging folder, under the
    rules of ``mercato.operators.expectations``; returns its row count (observed)."""
    if name == "gold_sales_daily":
        df = df.withColumn("sales_year", F.year("sales_date"))
    return E.checked_write(df, out_dir, name, rules, PARTITION_BY.get(name, ()))


class Gold:
    """The stored gold tables under a folder, as DataFrames."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{name}")

    @cached_property
    def sales(self) -> DataFrame:
        return self.table("gold_sales_daily")

    @cached_property
    def inventory(self) -> DataFrame:
        return self.table("gold_inventory_status")

    @cached_property
    def forecast_vs_actual(self) -> DataFrame:
        return self.table("gold_forecast_vs_actual")

    @cached_property
    def competitor_prices(self) -> DataFrame:
        return self.table("silver_competitor_prices")

    @cached_property
    def price_sketches(self) -> DataFrame:
        return self.table("gold_price_sketches")

    @cached_property
    def slicer_bitmaps(self) -> DataFrame:
        return self.table("gold_slicer_bitmaps")

    @cached_property
    def segments(self) -> DataFrame:
        return self.table("silver_customer_segments")


def build_facts(r: Retail, out_dir: str) -> Gold:
    """The facts that the KPI questions and the reports read, with the
    baseline forecast (exact in SQL, so queries over it can be checked)."""
    rules = expectations(r)
    for name, df in (("silver_competitor_prices", r.competitor_prices), ("gold_sales_daily", sales.gold_sales_daily(r)),
                     ("gold_inventory_status", inventory.gold_inventory_status(r)),
                     ("gold_forecast_vs_actual", forecast.forecast_vs_actual(r, forecast.forecast_baseline(r)))):
        write_table(df, out_dir, name, rules[name])
    return Gold(r.spark, out_dir)


def build(spark: SparkSession, sf_dir: str, out_dir: str) -> dict[str, int]:
    """Build every gold table; returns {table: rows}."""
    r: Retail = load(spark, sf_dir)
    rules, counts = expectations(r), {}

    def put(name: str, df: DataFrame) -> DataFrame:
        counts[name] = write_table(df, out_dir, name, rules.get(name, ()))
        return Gold(spark, out_dir).table(name)

    prices = put("silver_competitor_prices", r.competitor_prices)
    put("gold_price_sketches", competitor.price_sketches(prices))
    put("gold_sales_daily", sales.gold_sales_daily(r))
    inv = put("gold_inventory_status", inventory.gold_inventory_status(r))
    # ML-06 on the history up to 90 days before the analysis date, scored against those days
    fc = put("silver_demand_forecast", forecast.demand_forecast(r, cutoff=forecast.cutoff_of(r)))
    put("gold_forecast_vs_actual", forecast.forecast_vs_actual(r, fc.where("status = 'ok'").drop("status")))
    # ML-02..05, with all labels present
    seg = segments.assert_all_labels(put("silver_customer_segments", segments.kmeans_segments(r)))
    put("gold_double_risk_products", cross.double_risk(r.products, inv, r.competitor_latest))
    put("gold_champion_stockout_alert",
        cross.champion_stockout_alert(seg, r.order_lines, r.products, r.stores, inv))
    put("gold_slicer_bitmaps", distinct.slicer_bitmaps(r))
    put("dim_calendar", dims.dim_calendar(r))
    put("dim_category", dims.dim_category(r))
    put("dim_region", dims.dim_region(r))
    put("dim_channel", dims.dim_channel(r))
    return counts


if __name__ == "__main__":
    # on a cluster: spark-submit -m mercato.plans.gold <sf_dir> <out_dir>; the
    # master and sizing come from the submission, only semantics are pinned
    from mercato.session import apply_semantics, ensure_checkpoint_dir
    s = apply_semantics(SparkSession.builder.appName("mercato-gold").getOrCreate())
    ensure_checkpoint_dir(s)
    print(build(s, sys.argv[1], sys.argv[2]))
