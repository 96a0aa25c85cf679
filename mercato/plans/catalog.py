"""The query catalogue: one registered entry per operator group."""

from __future__ import annotations

from mercato.operators import dims, inventory, sales
from mercato.plans.registry import register
from mercato.sources.retail import LONGEST_PROMO_DAYS, Retail


# ---- sales ---------------------------------------------------------------
@register("sales_daily")
def q_sales_daily(r: Retail):
    """AGG-01 gold_sales_daily."""
    return sales.gold_sales_daily(r)


@register("sales_by_year")
def q_sales_by_year(r: Retail):
    """AGG-02 yearly revenue and mean row margin %."""
    return sales.sales_by_year(sales.gold_sales_daily(r))


@register("line_total")
def q_line_total(r: Retail):
    """PRJ-07 line totals recomputed from raw lines."""
    return sales.line_totals(r)


# ---- inventory -----------------------------------------------------------
@register("velocity")
def q_velocity(r: Retail):
    """AGG-03 sales velocity per store x product."""
    return inventory.velocity(r)


@register("inventory_status")
def q_inventory_status(r: Retail):
    """AGG-04 gold_inventory_status."""
    return inventory.gold_inventory_status(r)


@register("status_mix")
def q_status_mix(r: Retail):
    """AGG-05 status distribution with share of total."""
    return inventory.status_mix(inventory.gold_inventory_status(r))


# ---- dimensions ----------------------------------------------------------
@register("dim_calendar")
def q_dim_calendar(r: Retail):
    return dims.dim_calendar(r)


@register("dim_category")
def q_dim_category(r: Retail):
    return dims.dim_category(r)


@register("dim_region")
def q_dim_region(r: Retail):
    return dims.dim_region(r)


@register("dim_channel")
def q_dim_channel(r: Retail):
    return dims.dim_channel(r)


# ---- promotions / stores / audits ----------------------------------------
from pyspark.sql import functions as F  # noqa: E402

from mercato.functions import exprs as X  # noqa: E402
from mercato.operators import competitor, cross, forecast, quality, segments  # noqa: E402


def _sale_day(r: Retail):
    """28 November before the analysis date: a day inside a promotion."""
    return F.make_date(F.year(r.as_of) - 1, F.lit(11), F.lit(28))


@register("promo_active")
def q_promo_active(r: Retail):
    """PRJ-09: promotion calendar with is_active on the last Black Friday."""
    return r.promotions.select("*", X.promo_active(_sale_day(r)).alias("is_active"))


@register("promo_overlap")
def q_promo_overlap(r: Retail):
    """DQ-06: category-days covered by more than one promotion, announced a week ahead."""
    return quality.promo_overlap(r.promotions, lead_days=7, longest_days=LONGEST_PROMO_DAYS)


@register("store_format")
def q_store_format(r: Retail):
    """PRJ-10: stores with their format from the surface."""
    return r.stores


@register("distributions")
def q_distributions(r: Retail):
    """AGG-21: store-type, channel and order-status distributions."""
    return quality.distributions(r)


@register("union_audit")
def q_union_audit(r: Retail):
    """SET-01 / SRC-13: UNION ALL of row counts of the source tables."""
    return quality.row_counts(r)


@register("order_date_range")
def q_order_date_range(r: Retail):
    """SRC-13: min / max order date and order count."""
    return r.orders.agg(F.min("order_date").alias("min_date"), F.max("order_date").alias("max_date"),
                        F.count(F.lit(1)).alias("n_orders"))


@register("distinct_lists")
def q_distinct_lists(r: Retail):
    """AGG-17: distinct promotion names."""
    return r.promotions.select("promo_name").distinct()


@register("orphan_items")
def q_orphan_items(r: Retail):
    """DQ-02 / JOI-13: orders without lines (left_anti) and duplicate keys."""
    return quality.key_checks(r)


# ---- competitor ----------------------------------------------------------
@register("competitor_summary")
def q_competitor_summary(r: Retail):
    """AGG-14: average gap and cheaper count per competitor."""
    return competitor.summary(r.competitor_prices)


@register("competitor_latest")
def q_competitor_latest(r: Retail):
    """PRJ-24: latest snapshot month rows."""
    return X.decimals_to_double(r.competitor_latest)


@register("price_gap")
def q_price_gap(r: Retail):
    """PRJ-12: gap % recomputed from the floored competitor price."""
    return X.decimals_to_double(competitor.price_gap(r.competitor_prices))


@register("competitor_reprice")
def q_competitor_reprice(r: Retail):
    """PRJ-13: competitor price re-derived from the gap."""
    return X.decimals_to_double(competitor.reprice(r.competitor_prices))


@register("median_prices")
def q_median_prices(r: Retail):
    """AGG-22 / RPT-06: median our vs competitor price per category (latest month)."""
    from mercato.plans.gold import Gold, write_table
    # the month is written once; its sketches and the refining scan read it back
    out = _scratch(r, "gold")
    write_table(r.competitor_latest, out, "silver_competitor_prices")
    g = Gold(r.spark, out)
    write_table(competitor.price_sketches(g.competitor_prices), out, "gold_price_sketches")
    return competitor.median_prices(g.competitor_prices, g.price_sketches)


@register("median_prices_last_quarter")
def q_median_prices_last_quarter(r: Retail):
    """AGG-22 over the last three closed months: their sketches merge, and
    their snapshots alone are scanned."""
    from mercato.plans.gold import Gold, write_table
    out = _scratch(r, "gold")
    this = r.params["hi"].replace(day=1)
    months = [m for m in r.params["months"] if m < this][-3:]
    write_table(r.competitor_prices, out, "silver_competitor_prices")
    g = Gold(r.spark, out)
    write_table(competitor.price_sketches(g.competitor_prices), out, "gold_price_sketches")
    where = F.col("snapshot_month").isin(*[m.strftime("%Y-%m") for m in months])
    return competitor.median_prices(g.competitor_prices, g.price_sketches, where=where)


# ---- customers -----------------------------------------------------------
@register("rfm_features")
def q_rfm_features(r: Retail):
    """AGG-12: RFM features per customer."""
    return segments.rfm_features(r)


@register("rfm_winsorised")
def q_rfm_winsorised(r: Retail):
    """ML-01: features with NULL->0 and p99 clip."""
    return segments.winsorise(segments.rfm_features(r))


@register("segments_rule")
def q_segments_rule(r: Retail):
    """Score-labelled segments (SQL-checkable stand-in of ML-05)."""
    return segments.rule_segments(r)


@register("segment_counts")
def q_segment_counts(r: Retail):
    """AGG-16: customers per segment."""
    return segments.segment_counts(segments.rule_segments(r))


@register("customer_segments", rows_only=True)
def q_customer_segments(r: Retail):
    """ML-02..05: K-Means segments (iterative; rows-only check)."""
    return segments.kmeans_segments(r)


# ---- forecast ------------------------------------------------------------
@register("daily_actuals")
def q_daily_actuals(r: Retail):
    """AGG-06: units per product and day."""
    return forecast.daily_actuals(r)


@register("top_skus")
def q_top_skus(r: Retail):
    """AGG-13 / SRT-04: top 200 products by volume."""
    return forecast.top_skus(r)


@register("forecast_baseline")
def q_forecast_baseline(r: Retail):
    """ML-07: weekday-mean baseline for the 90 held-out days."""
    return forecast.forecast_baseline(r)


@register("forecast_vs_actual")
def q_forecast_vs_actual(r: Retail):
    """AGG-07: gold_forecast_vs_actual over the baseline forecast."""
    return forecast.forecast_vs_actual(r, forecast.forecast_baseline(r))


@register("demand_forecast", rows_only=True)
def q_demand_forecast(r: Retail):
    """ML-06: per-SKU seasonal model for the top 200 SKUs (applyInPandas)."""
    return forecast.demand_forecast(r, cutoff=forecast.cutoff_of(r))


# ---- cross-entity --------------------------------------------------------
def _double_risk(r: Retail):
    from mercato.operators.inventory import gold_inventory_status
    return cross.double_risk(r.products, gold_inventory_status(r), r.competitor_latest)


@register("double_risk")
def q_double_risk(r: Retail):
    """AGG-08: gold_double_risk_products."""
    return _double_risk(r)


@register("double_risk_cheapest")
def q_double_risk_cheapest(r: Retail):
    """AGG-08 variant: cheapest competitor per product x store."""
    return cross.double_risk_cheapest(_double_risk(r))


def _champions(r: Retail, same_store: bool):
    from mercato.operators.inventory import gold_inventory_status
    return cross.champion_stockout_alert(segments.rule_segments(r), r.order_lines, r.products, r.stores,
                                         gold_inventory_status(r), same_store=same_store)


@register("champion_stockout_alert")
def q_champion_stockout_alert(r: Retail):
    """AGG-09: gold_champion_stockout_alert (source semantics)."""
    return _champions(r, False)


@register("champion_alert_same_store")
def q_champion_alert_same_store(r: Retail):
    """AGG-09 with the inventory joined on (store, product)."""
    return _champions(r, True)


# ---- measures (MEA-*) and time intelligence (WIN-03..05) ----------------
from mercato.operators import measures as M  # noqa: E402
from mercato.operators import timeintel as T  # noqa: E402
from mercato.operators.inventory import gold_inventory_status  # noqa: E402

SALES_MEASURES = ["total_revenue", "total_margin", "gross_margin_pct", "nb_orders", "units_sold",
                  "avg_basket", "avg_discount_pct"]


@register("mea_sales_by_year")
def q_mea_sales_by_year(r: Retail):
    """MEA-01..07 per year."""
    s = sales.gold_sales_daily(r).withColumn("year", F.year("sales_date"))
    return M.evaluate(s, SALES_MEASURES, by=["year"])


@register("mea_sales_by_region_channel")
def q_mea_sales_by_region_channel(r: Retail):
    """MEA-01..07 per region x channel (RPT-15 slicers as group keys)."""
    return M.evaluate(sales.gold_sales_daily(r), SALES_MEASURES, by=["region", "channel"])


@register("mea_promo_uplift")
def q_mea_promo_uplift(r: Retail):
    """MEA-13 per category."""
    return M.evaluate(sales.gold_sales_daily(r), ["revenue_uplift_promo"], by=["category"])


@register("mea_order_count")
def q_mea_order_count(r: Retail):
    """MEA-04 and its true distinct-order variant per year."""
    s = sales.gold_sales_daily(r).withColumn("year", F.year("sales_date"))
    a = M.evaluate(s, ["nb_orders"], by=["year"])
    b = M.true_order_count(r.order_lines.withColumn("year", F.year("order_date")), by=["year"])
    return a.join(b, "year")


@register("mea_inventory_by_region")
def q_mea_inventory_by_region(r: Retail):
    """MEA-14..19 per region."""
    return M.evaluate(gold_inventory_status(r), list(M.MEASURES["inventory"]), by=["region"])


@register("mea_inventory_total")
def q_mea_inventory_total(r: Retail):
    """MEA-14..19 without filter (KPI cards)."""
    return M.evaluate(gold_inventory_status(r), list(M.MEASURES["inventory"]))


@register("mea_forecast_by_category")
def q_mea_forecast_by_category(r: Retail):
    """MEA-20..22 per category."""
    fva = forecast.forecast_vs_actual(r, forecast.forecast_baseline(r))
    return M.evaluate(fva, list(M.MEASURES["fva"]), by=["category"])


@register("mea_forecast_horizon")
def q_mea_forecast_horizon(r: Retail):
    """MEA-23/24: forecast units in the 30 and 90 days from the first forecast day."""
    fc = forecast.forecast_baseline(r)
    start = F.date_add(forecast.cutoff_of(r), 1)
    return M.forecast_window(fc, start, (30, 90))


@register("mea_customers")
def q_mea_customers(r: Retail):
    """MEA-25..31 over the segment table."""
    return M.evaluate(segments.rule_segments(r), list(M.MEASURES["customers"]))


@register("mea_competitor_by_category")
def q_mea_competitor_by_category(r: Retail):
    """MEA-32..35 per category (all snapshot months)."""
    return M.evaluate(r.competitor_prices, list(M.MEASURES["competitor"]), by=["category"])


def _series(r: Retail):
    return T.daily_revenue(sales.gold_sales_daily(r), dims.dim_calendar(r), r.as_of)


@register("mea_time_intel_daily")
def q_mea_time_intel_daily(r: Retail):
    """MEA-08/09/10/12: MTD, QTD, YTD and 30-day rolling revenue per day."""
    return T.period_to_date(_series(r))


@register("mea_vs_ly_daily")
def q_mea_vs_ly_daily(r: Retail):
    """MEA-11 at day grain."""
    return T.vs_last_year_daily(_series(r))


@register("mea_vs_ly_monthly")
def q_mea_vs_ly_monthly(r: Retail):
    """MEA-11 at month grain (RPT-01 line chart data)."""
    return T.vs_last_year_monthly(T.monthly_revenue(sales.gold_sales_daily(r)), r.as_of)


@register("mea_time_intel_region")
def q_mea_time_intel_region(r: Retail):
    """WIN-03/04 per region, every calendar day."""
    since = F.make_date(F.year(r.first_day), F.lit(1), F.lit(1))
    s = T.daily_revenue(sales.gold_sales_daily(r), dims.dim_calendar(r), r.as_of, by=["region"], since=since)
    return T.period_to_date(s, by=["region"])


# ---- question catalogue (Q-*) --------------------------------------------
from mercato.operators import ops  # noqa: E402
from mercato.plans import questions as Q  # noqa: E402
from mercato.plans import reports as R  # noqa: E402


def _sales(r: Retail):
    return sales.gold_sales_daily(r)


def _inv(r: Retail):
    return gold_inventory_status(r)


def _fva(r: Retail):
    return forecast.forecast_vs_actual(r, forecast.forecast_baseline(r))


@register("q_01_stores_at_risk")
def q_01(r: Retail):
    """Q-01: stores with critical/stockout products (all regions)."""
    return Q.q01_stores_at_risk(_inv(r))


@register("q_01_stores_at_risk_europe")
def q_01b(r: Retail):
    """Q-01 with a region filter."""
    return Q.q01_stores_at_risk(_inv(r), region="EUROPE")


@register("q_02_margin_by_category_year")
def q_02(r: Retail):
    """Q-02 (flagship): gross margin % by category, year vs prior year."""
    return Q.q02_margin_by_category_year(_sales(r))


@register("q_03_accuracy_price_pressure")
def q_03(r: Retail):
    """Q-03: worst accuracy and highest price pressure by category."""
    return Q.q03_accuracy_and_price_pressure(_fva(r), r.competitor_prices)


@register("q_04_stockout_and_cheaper")
def q_04(r: Retail):
    """Q-04: products out of stock and cheaper elsewhere."""
    return Q.q04_stockout_and_cheaper(_double_risk(r))


@register("q_05_champions_at_risk")
def q_05(r: Retail):
    """Q-05: champions who bought products now in stockout, per customer."""
    return Q.q05_champions_at_risk(_champions(r, False))


@register("q_05_summary")
def q_05s(r: Retail):
    """Q-05: count and LTV at risk, customers deduplicated."""
    return Q.q05_summary(Q.q05_champions_at_risk(_champions(r, False)))


@register("q_07_store_counts")
def q_07(r: Retail):
    return Q.q07_store_counts(r.stores)


@register("q_08_promotions_active")
def q_08(r: Retail):
    """Q-08: promotions running on a given day."""
    return Q.q08_promotions_active(r.promotions, _sale_day(r))


@register("q_09_category_products")
def q_09(r: Retail):
    return Q.q09_category_products(r.products)


@register("q_10_champion_customers")
def q_10(r: Retail):
    return Q.q10_customers_in_segment(segments.rule_segments(r))


@register("q_11_cheaper_at_bonprix")
def q_11(r: Retail):
    return Q.q11_cheaper_at(r.competitor_latest, "BonPrix")


@register("q_11_undercut_beyond_10pct")
def q_11b(r: Retail):
    return Q.q11_cheaper_at(r.competitor_latest, None, min_undercut_pct=10.0)


@register("q_12_low_accuracy")
def q_12(r: Retail):
    return Q.q12_low_accuracy(_fva(r))


@register("q_12_worst10")
def q_12b(r: Retail):
    return Q.q12_worst(_fva(r))


@register("q_13_top_forecast")
def q_13(r: Retail):
    return Q.q13_top(forecast.forecast_baseline(r), F.date_add(forecast.cutoff_of(r), 1))


@register("q_13_high_daily_demand")
def q_13b(r: Retail):
    return Q.q13_high_daily(forecast.forecast_baseline(r), F.date_add(forecast.cutoff_of(r), 1), per_day=1.0)


@register("q_14_stores_rain")
def q_14(r: Retail):
    return Q.q14_stores_with_weather(r.stores, r.weather, r.as_of)


@register("q_15_kpis")
def q_15(r: Retail):
    return Q.q15_kpis(_sales(r), _inv(r), _fva(r), r.competitor_prices, r.as_of)


@register("q_16_year_over_year")
def q_16(r: Retail):
    return Q.q16_year_over_year(_sales(r), r.as_of)


@register("q_16_quarter_over_quarter")
def q_16b(r: Retail):
    return Q.q16_quarter_over_quarter(_sales(r), r.as_of)


@register("q_17_best_periods")
def q_17(r: Retail):
    return Q.q17_best_periods(_sales(r))


@register("q_18_month_over_month")
def q_18(r: Retail):
    return Q.q18_month_over_month(_sales(r), r.as_of)


@register("q_18_ytd_vs_ly")
def q_18b(r: Retail):
    return Q.q18_ytd_vs_ly(_sales(r), r.as_of)


@register("q_19_promo_yoy")
def q_19(r: Retail):
    return Q.q19_promo_year_over_year(_sales(r), r.as_of)


@register("q_21_top_stores")
def q_21(r: Retail):
    return Q.q21_top_stores(_sales(r))


@register("q_21_regions_by_stockout")
def q_21b(r: Retail):
    return Q.q21_regions_by_stockout(_inv(r))


@register("q_21_categories_by_margin")
def q_21c(r: Retail):
    return Q.q21_categories_by_margin(_sales(r))


@register("q_22_low_coverage_stores")
def q_22(r: Retail):
    return Q.q22_low_coverage_stores(_inv(r), days=60.0)


@register("q_23_segments_by_ltv")
def q_23(r: Retail):
    return Q.q23_segments_by_ltv(segments.rule_segments(r))


@register("q_24_promo_uplift")
def q_24(r: Retail):
    return Q.q24_promo_uplift(_sales(r), r.promotions)


@register("q_25_critical_undercut")
def q_25(r: Retail):
    return Q.q25_critical_undercut(_double_risk(r), None)


@register("q_29_urgent_stores")
def q_29(r: Retail):
    return Q.q29_urgent_stores(_inv(r), rate=0.006)


# ---- operational tables (STR-04..08, AGG-18..20, Q-06/26/27/28) -----------
def _transfers(r: Retail, inv=None):
    """Proposals over the inventory, stored once for its four readers."""
    return ops.transfer_proposals(_stored_inv(r) if inv is None else inv, r.as_of)


def _stored_inv(r: Retail):
    from mercato.sources import folders
    return folders.stored(_inv(r), "inventory")


def _offers(r: Retail):
    return ops.retention_offers(segments.rule_segments(r), r.order_lines, r.products, r.as_of)


@register("stock_alerts")
def q_stock_alerts(r: Retail):
    return ops.stock_alerts(_inv(r))


@register("transfer_proposals")
def q_transfer_proposals(r: Retail):
    return _transfers(r)


@register("retention_offers")
def q_retention_offers(r: Retail):
    return X.decimals_to_double(_offers(r))


@register("incidents")
def q_incidents(r: Retail):
    return ops.incidents(r)


@register("sales_spike")
def q_sales_spike(r: Retail):
    return ops.sales_spikes(ops.pos_events(r))


@register("pos_silence")
def q_pos_silence(r: Retail):
    return ops.pos_silences(ops.pos_events(r))


@register("transfers_by_status")
def q_transfers_by_status(r: Retail):
    """AGG-18 / Q-06."""
    return ops.transfers_by_status(_transfers(r))


@register("q_06_transfers_this_week")
def q_06(r: Retail):
    """Q-06: transfers proposed in the last seven days, by status."""
    return ops.transfers_by_status(_transfers(r), r.as_of.cast("timestamp_ntz"), 7)


@register("alerts_by_severity")
def q_alerts_by_severity(r: Retail):
    """AGG-19 / Q-26."""
    return ops.alerts_by_severity(ops.active_alerts(r, _inv(r)))


@register("q_26_stores_most_alerts")
def q_26(r: Retail):
    """Q-26: stores by number of active alerts (top 10)."""
    a = ops.active_alerts(r, _inv(r)).where(F.col("status") == "active")
    return (a.groupBy("store_id").agg(F.count(F.lit(1)).alias("n_alerts"))
            .join(r.stores.select("store_id", F.col("name").alias("store_name"), "region"), "store_id")
            .orderBy(F.desc("n_alerts"), "store_id").limit(10))


@register("q_26_open_incidents")
def q_26b(r: Retail):
    """Q-26: open incidents per store."""
    return ops.incidents(r).where(F.col("status") == "open").groupBy("store_id") \
        .agg(F.count(F.lit(1)).alias("open_incidents"))


@register("offers_this_week")
def q_offers_this_week(r: Retail):
    """AGG-20 / Q-27."""
    return ops.offers_this_week(_offers(r), r.as_of.cast("timestamp_ntz"))


@register("q_28_regions_stockout_transfers")
def q_28(r: Retail):
    inv = _stored_inv(r)
    return Q.q28_regions_stockout_transfers(inv, _transfers(r, inv), r.stores)


# ---- report data sets (RPT-*) --------------------------------------------
@register("rpt_02_top_stores")
def rpt_02(r: Retail):
    return R.rpt02_top_stores(_sales(r))


@register("rpt_02_top_stores_sliced")
def rpt_02b(r: Retail):
    """RPT-02 with the year / channel slicers (RPT-15)."""
    return R.rpt02_top_stores(_sales(r), year=2000, channel="in_store")


@register("rpt_03_region_map")
def rpt_03(r: Retail):
    return R.rpt03_region_map(_sales(r))


@register("rpt_05_category_region")
def rpt_05(r: Retail):
    return R.rpt05_category_region_matrix(_inv(r))


@register("rpt_07_actual_vs_forecast")
def rpt_07(r: Retail):
    return R.rpt07_actual_vs_forecast(_fva(r))


@register("rpt_09_weather_revenue")
def rpt_09(r: Retail):
    return R.rpt09_weather_revenue(_sales(r), r.stores, r.weather)


@register("rpt_10_future_forecast")
def rpt_10(r: Retail):
    return R.rpt10_future_forecast(forecast.forecast_baseline(r), forecast.cutoff_of(r))


@register("rpt_11_segment_bubble")
def rpt_11(r: Retail):
    return R.rpt11_segment_bubble(segments.rule_segments(r))


@register("rpt_12_format_category_stockout")
def rpt_12(r: Retail):
    return R.rpt12_format_category_stockout(_inv(r), r.stores)


@register("rpt_13_gap_category_competitor")
def rpt_13(r: Retail):
    return R.rpt13_gap_category_competitor(r.competitor_prices)


@register("rpt_14_store_category")
def rpt_14(r: Retail):
    return R.rpt14_store_category(_sales(r))


@register("rpt_14_store_monthly")
def rpt_14b(r: Retail):
    return R.rpt14_store_monthly(_sales(r))


@register("rpt_14_top_products")
def rpt_14c(r: Retail):
    return R.rpt14_top_products(r.order_lines, r.products)


@register("weather")
def q_weather(r: Retail):
    """SRC-01 stand-in: daily weather per city over the sales range."""
    return r.weather


# ---- streaming (STR-01..05) ------------------------------------------------
from mercato.streaming import jobs as S  # noqa: E402


def _scratch(r: Retail, name: str) -> str:
    """A new folder under the shared checkpoint folder."""
    import uuid

    from mercato.session import scratch_path
    return scratch_path(r.spark, f"{name}-{uuid.uuid4().hex[:12]}")


def _events_stream(r: Retail):
    return S.event_stream(r.spark, r.sf_dir)


@register("stream_sales_tumbling")
def q_stream_sales_tumbling(r: Retail):
    """STR-03: daily tumbling windows per event type, watermark, closed windows only."""
    path = S.run_available(S.windowed_totals(_events_stream(r), "1 hour", "1 day"), None, name="tumbling")
    return r.spark.read.parquet(path)


@register("stream_sales_sliding")
def q_stream_sales_sliding(r: Retail):
    """STR-03: 1-day windows sliding every 6 hours."""
    path = S.run_available(S.windowed_totals(_events_stream(r), "1 hour", "1 day", "6 hours"), None, name="sliding")
    return r.spark.read.parquet(path)


@register("stream_pos_sessions")
def q_stream_pos_sessions(r: Retail):
    """STR-05: POS activity sessions per store (45-minute gap)."""
    path = S.run_available(S.pos_sessions(_events_stream(r), r.n_stores, "1 hour"), None, name="sessions")
    return r.spark.read.parquet(path)


@register("cdc_state")
def q_cdc_state(r: Retail):
    """STR-01 batch semantics: latest change per key, deletes dropped."""
    e = r.raw("events")
    return S.cdc_state(S.change_feed(e))


@register("stream_cdc_apply")
def q_stream_cdc_apply(r: Retail):
    """STR-01: the change feed applied by a foreachBatch stream in several
    batches that arrive out of order: the feed is dealt to six files by
    user and sequence, so deletes are followed by older changes."""
    feed, target = _scratch(r, "cdc-feed"), _scratch(r, "cdc-users")
    e = r.raw("events").select("event_id", "ts", "user_id", "event_type", "value", "props")
    part = F.pmod(F.col("event_id") * 7 + F.col("user_id"), F.lit(6))
    e.repartitionByRange(6, part, "event_id").withColumn("part", part).write.partitionBy("part").parquet(feed)
    files = r.spark.readStream.schema(S.EVENTS_SCHEMA).option("maxFilesPerTrigger", 1).parquet(feed)
    S.cdc_apply_stream(S.change_feed(files.withColumn("ts", F.col("ts").cast("timestamp"))), target)
    return S.cdc_current(r.spark, target)


@register("stream_sales_spike")
def q_stream_sales_spike(r: Retail):
    """STR-04: spike alerts computed per micro-batch over closed daily windows."""
    path = S.spike_alerts_stream(_events_stream(r), r.n_stores, _scratch(r, "spikes"), "1 hour")
    return r.spark.read.parquet(path).drop("batch_id")


@register("stream_sales_totals_merged")
def q_stream_sales_totals_merged(r: Retail):
    """STR-03 with every row counted, however late: partial totals per batch, summed."""
    return S.totals_merged(_events_stream(r), _scratch(r, "totals"))


# ---- entity model (PRJ-21/22, JOI-10..12) -----------------------------------
from mercato.operators import entities as EN  # noqa: E402


@register("ents_store")
def q_ents_store(r: Retail):
    return EN.entity_view(r.stores, "Store")


@register("ents_product")
def q_ents_product(r: Retail):
    return X.decimals_to_double(EN.entity_view(r.products, "Product"))


@register("ents_inventory")
def q_ents_inventory(r: Retail):
    return EN.entity_view(_inv(r), "InventoryStatus")


@register("ents_forecast_vs_actual")
def q_ents_fva(r: Retail):
    return EN.entity_view(_fva(r), "ForecastVsActual")


@register("ents_demand_forecast")
def q_ents_demand_forecast(r: Retail):
    return EN.entity_view(forecast.forecast_baseline(r), "DemandForecast")


@register("ents_customer_segment")
def q_ents_customer_segment(r: Retail):
    return EN.entity_view(segments.rule_segments(r), "CustomerSegment")


@register("ents_competitor_latest")
def q_ents_competitor_latest(r: Retail):
    return X.decimals_to_double(EN.entity_view(r.competitor_latest, "CompetitorPrice"))


@register("ents_weather_en")
def q_ents_weather_en(r: Retail):
    """PRJ-21 + PRJ-22: weather observations, English condition names."""
    return EN.entity_view(EN.weather_in_english(r.weather), "WeatherObservation")


@register("ents_promotion")
def q_ents_promotion(r: Retail):
    p = r.promotions.select("*", X.promo_active(_sale_day(r)).alias("is_active"))
    return X.decimals_to_double(EN.entity_view(p, "Promotion"))


@register("ents_tracked_in_inventory")
def q_ents_tracked_in_inventory(r: Retail):
    """JOI-12: at-risk inventory rows -> their Product."""
    src = _inv(r).where(F.col("stock_status").isin(*X.AT_RISK)).select("store_id", "product_id", "stock_status")
    return X.decimals_to_double(EN.traverse(src, "tracked_in_inventory", r.products))


@register("ents_observed_at")
def q_ents_observed_at(r: Retail):
    """JOI-12: Store -> WeatherObservation of its city on the analysis date."""
    w = r.weather.where(F.col("date") == r.as_of).select("city", "date", "weather_condition", "rainfall_mm")
    return EN.traverse(r.stores.select("store_id", "city"), "observed_at", w)


@register("model_sales_weekend")
def q_model_sales_weekend(r: Retail):
    """JOI-10: sales related to the calendar; revenue by weekend flag."""
    s = EN.relate(_sales(r), dims.dim_calendar(r), "sales_date", "date", "sales", "calendar")
    return M.evaluate(s, ["total_revenue", "nb_orders"], by=["is_weekend"])


# ---- remaining operators ------------------------------------------------------
@register("stock_policy")
def q_stock_policy(r: Retail):
    """PRJ-15 + JOI-08: thresholds for every listed store x product pair."""
    return inventory.stock_policy(r.listed_pairs, r.store_product_sales, r.stores)


@register("inventory_flags")
def q_inventory_flags(r: Retail):
    """PRJ-19 / PRJ-20: coverage rules and colour band per inventory row."""
    return _inv(r).select("store_id", "product_id", "coverage_days",
                          X.urgent_replenishment().alias("urgent_replenishment"),
                          X.overstock().alias("potential_overstock"),
                          X.coverage_band().alias("coverage_band"))


@register("top_stores_per_region")
def q_top_stores_per_region(r: Retail):
    """WIN-06: top 3 stores of each region by revenue, with their share of
    the region (ranked after aggregation, window per region)."""
    from pyspark.sql import Window
    g = M.evaluate(_sales(r), ["total_revenue"], by=["region", "store_id", "store_name"])
    w = Window.partitionBy("region").orderBy(F.desc("total_revenue"), "store_id")
    x = g.select("*", F.dense_rank().over(w).alias("rank"),
                 (F.col("total_revenue") / F.sum("total_revenue").over(Window.partitionBy("region"))).alias("share"))
    return x.where(F.col("rank") <= 3)


@register("domain_checks")
def q_domain_checks(r: Retail):
    """DQ-01: values outside the allowed domains, counted per check."""
    from functools import reduce

    from pyspark.sql import DataFrame as _DF
    inv = _inv(r)
    parts = {"store_type": quality.domain_violations(r.stores, "store_type"),
             "channel": quality.domain_violations(r.orders, "channel"),
             "stock_status": quality.domain_violations(inv, "stock_status"),
             "order_status": quality.domain_violations(r.orders, "order_status"),
             "event_type": quality.domain_violations(r.raw("events"), "event_type"),
             "segment_label": quality.domain_violations(segments.rule_segments(r), "segment_label")}
    return reduce(_DF.unionAll, [df.agg(F.lit(k).alias("domain"), F.count(F.lit(1)).alias("violations"))
                                 for k, df in parts.items()])


@register("coverage_sanity")
def q_coverage_sanity(r: Retail):
    """DQ-05: coverage distribution (no runaway ~2000-day values)."""
    return _inv(r).agg(F.max("coverage_days").alias("max_coverage"),
                       F.percentile("coverage_days", 0.99).alias("p99_coverage"),
                       F.count_if(F.col("coverage_days") > 365).alias("n_over_a_year"))


@register("ingest_competitor_roundtrip")
def q_ingest_competitor_roundtrip(r: Retail):
    """SRC-04..06: competitor snapshots written as monthly CSV files, then
    read back through the feed reader (header echo / blank-key cleaning,
    typing with rejects)."""
    import uuid

    from mercato.session import scratch_path
    from mercato.sources import files as FL
    out = scratch_path(r.spark, f"competitor-csv-{uuid.uuid4().hex[:6]}")
    rows = X.decimals_to_double(r.competitor_prices).withColumn("source", F.lit("web_scraping"))
    # a month's files follow its share of the lines, not the number of tasks
    files = -(-r.line_parts // max(1, len(r.params["months"])))
    rows.repartition(max(r.line_parts, 8), "snapshot_month", F.pmod(F.xxhash64("product_id"), F.lit(files))) \
        .write.option("header", True).partitionBy("snapshot_month").csv(out)
    return FL.read_competitor(r.spark, out).rows


@register("q_20_stockout_rate_6_months")
def q_20(r: Retail):
    """Q-20: stockout rate per month-end snapshot over the last six months."""
    snaps = r.inventory_snapshots(6).withColumn("stock_status", X.stock_status())
    return M.evaluate(snaps, ["stockout_rate", "nb_stockout"], by=["snapshot_ym"])


@register("stream_stock_alerts")
def q_stream_stock_alerts(r: Retail):
    """STR-06 on a feed: the inventory status published as files, alerts
    produced by a stream over them."""
    import uuid

    from mercato.session import scratch_path
    feed = scratch_path(r.spark, f"inventory-feed-{uuid.uuid4().hex[:6]}")
    inv = _inv(r)
    inv.write.parquet(feed)
    out = S.run_available(S.stock_alert_stream(r.spark, feed, inv.schema), None, name="stock-alerts")
    return r.spark.read.parquet(out)


@register("stream_competitor_ingest")
def q_stream_competitor_ingest(r: Retail):
    """STR-02: competitor snapshots dropped as CSV files (the latest month
    delivered twice, months in any order) and ingested once each."""
    from mercato.sources.files import COMPETITOR_TYPES
    feed = _scratch(r, "competitor-feed")
    as_feed = lambda df: X.decimals_to_double(df).withColumn("source", F.lit("web_scraping")).select(
        *COMPETITOR_TYPES)  # the feed's column layout
    as_feed(r.competitor_prices).write.option("header", True).csv(feed)
    as_feed(r.competitor_latest).write.mode("append").option("header", True).csv(feed)  # re-delivered month
    return S.ingest_feed(S.competitor_feed_stream(r.spark, feed, max_files_per_trigger=4), _scratch(r, "competitor"))


@register("ingest_weather_roundtrip")
def q_ingest_weather_roundtrip(r: Retail):
    """SRC-01/02/06 + PRJ-02: daily weather published as JSON-array files
    under the raw field names, read back through the feed reader."""
    import uuid

    from mercato.session import scratch_path
    from mercato.sources import files as FL
    feed = scratch_path(r.spark, f"weather-feed-{uuid.uuid4().hex[:6]}")
    FL.write_weather_feed(r.weather, feed)
    return FL.read_weather(r.spark, feed, suffix="part-*").rows


@register("ingest_promotions_roundtrip")
def q_ingest_promotions_roundtrip(r: Retail):
    """SRC-03 + PRJ-09: the promotion calendar published as a UTF-8 CSV with
    header (carrying a stale is_active column), read back with is_active
    recomputed for the analysis date."""
    import uuid

    from mercato.session import scratch_path
    from mercato.sources import files as FL
    feed = scratch_path(r.spark, f"promo-feed-{uuid.uuid4().hex[:6]}")
    r.promotions.withColumn("is_active", F.lit(False)).write.option("header", True).csv(feed)
    return FL.read_promotions(r.spark, feed, _sale_day(r)).rows


# ---- matrices, cards, orders, flags, relationships, catalog ------------------
REGIONS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]


@register("rpt_05_matrix")
def q_rpt_05_matrix(r: Retail):
    """RPT-05 as a matrix: average coverage, categories down, regions across."""
    return R.pivot_wide(R.rpt05_category_region_matrix(_inv(r)), ["category"], "region", "avg_coverage_days", REGIONS)


@register("rpt_12_matrix")
def q_rpt_12_matrix(r: Retail):
    """RPT-12 as a matrix: stockout rate, categories down, store formats across."""
    return R.pivot_wide(R.rpt12_format_category_stockout(_inv(r), r.stores), ["category"], "store_type", "stockout_rate",
                        list(quality.DOMAINS["store_type"]))


@register("rpt_13_matrix")
def q_rpt_13_matrix(r: Retail):
    """RPT-13 as a matrix: average gap, categories down, competitors across."""
    from mercato.sources.retail import COMPETITORS
    return R.pivot_wide(R.rpt13_gap_category_competitor(r.competitor_prices), ["category"], "competitor", "avg_price_gap",
                        COMPETITORS)


@register("rpt_14_store_kpis")
def q_rpt_14_store_kpis(r: Retail):
    """RPT-14: KPI cards of every store, sliced to one year."""
    return R.rpt14_store_kpis(_sales(r), _inv(r), year=2000)


@register("rpt_08_worst_first")
def q_rpt_08(r: Retail):
    return R.rpt08_worst_first(_fva(r))


@register("srt_03_months_in_order")
def q_srt_03(r: Retail):
    """SRT-03: month labels with their place by the numeric key."""
    from pyspark.sql import Window
    months = _sales(r).select("sales_date").distinct().join(
        dims.dim_calendar(r).select(F.col("date").alias("sales_date"), "month_name", "year", "year_month_sort"), "sales_date")
    g = months.groupBy("year_month_sort", "month_name", "year").agg(F.count(F.lit(1)).alias("days_with_sales"))
    return g.withColumn("place", F.row_number().over(Window.orderBy("year_month_sort"))).orderBy("year_month_sort")


@register("alerts_in_severity_order")
def q_alerts_in_order(r: Retail):
    """SRT-02: alert groups, most severe first, with their place."""
    from pyspark.sql import Window
    g = ops.alerts_by_severity(ops.active_alerts(r, _inv(r)))
    place = F.row_number().over(Window.orderBy("severity_rank", F.desc("cnt"), "alert_type"))
    return g.withColumn("place", place).orderBy("place")


@register("product_flags")
def q_product_flags(r: Retail):
    """PRJ-19: retrain and high-confidence flags of every forecast product."""
    return Q.q12_product_accuracy(_fva(r)).select(
        "product_id", "forecast_accuracy", X.retrain_needed().alias("retrain_needed"), X.high_confidence().alias("high_confidence"))


@register("customer_flags")
def q_customer_flags(r: Retail):
    """PRJ-19: retention priority and win-back flags of every customer."""
    return segments.rule_segments(r).select(
        "customer_id", "segment_label", X.retention_priority().alias("retention_priority"), X.win_back().alias("win_back"))


@register("undercut_flags")
def q_undercut_flags(r: Retail):
    """PRJ-19: products undercut by a competitor in the latest month."""
    return r.competitor_latest.select("product_id", "competitor", X.undercut().alias("undercut"))


@register("q_13_demand_by_product")
def q_13c(r: Retail):
    """Q-13 with the product's name and category."""
    top = Q.q13_top(forecast.forecast_baseline(r), F.date_add(forecast.cutoff_of(r), 1))
    return top.join(r.products.select("product_id", F.col("name").alias("product_name"), "category"), "product_id")


@register("q_25_critical_undercut_bonprix")
def q_25b(r: Retail):
    """Q-25 for one competitor."""
    return Q.q25_critical_undercut(_double_risk(r), "BonPrix")


@register("q_21_top_stores_year")
def q_21d(r: Retail):
    """Q-21 for one year."""
    return Q.q21_top_stores(R.slice_sales(_sales(r), year=2000))


def _model_tables(r: Retail) -> dict:
    return {"sales": _sales(r), "forecast_vs_actual": _fva(r), "inventory": _inv(r), "stores": r.stores, "products": r.products,
            "calendar": dims.dim_calendar(r), "demand_forecast": forecast.forecast_baseline(r),
            "competitor_prices": r.competitor_prices, "weather": r.weather}


@register("model_relationships")
def q_model_relationships(r: Retail):
    """JOI-10: every relationship of the model followed: fact rows and those that found their dimension row."""
    from functools import reduce

    from pyspark.sql import DataFrame as _DF
    t, out = _model_tables(r), []
    for fact, fact_col, dim, dim_col in EN.MODEL_RELATIONSHIPS:
        keys = t[dim].select(F.col(dim_col)).distinct().withColumn("found", F.lit(1))  # a city has several stores
        x = EN.relate(t[fact].select(fact_col), keys, fact_col, dim_col, fact, dim)
        out.append(x.agg(F.lit(f"{fact}.{fact_col}").alias("fact"), F.lit(f"{dim}.{dim_col}").alias("dimension"),
                         F.count(F.lit(1)).alias("n_rows"), F.count("found").alias("n_found")))
    return reduce(_DF.unionAll, out)


@register("entity_relationships")
def q_entity_relationships(r: Retail):
    """JOI-12: every entity relationship traversed: the pairs it connects."""
    from functools import reduce

    from pyspark.sql import DataFrame as _DF
    day = F.col("date") == r.as_of
    t = {"InventoryStatus": _inv(r), "Store": r.stores, "Product": r.products, "ForecastVsActual": _fva(r),
         "CompetitorPrice": r.competitor_latest, "DemandForecast": forecast.forecast_baseline(r),
         "WeatherObservation": r.weather.where(day), "Calendar": dims.dim_calendar(r), "Promotion": r.promotions}
    out = []
    for name, (src, src_col, dst, dst_col) in EN.RELATIONSHIPS.items():
        x = EN.traverse(t[src].select(src_col), name, t[dst].select(dst_col))
        out.append(x.agg(F.lit(name).alias("relationship"), F.count(F.lit(1)).alias("n_pairs")))
    return reduce(_DF.unionAll, out)


@register("refused_relationships", rows_only=True)
def q_refused_relationships(r: Retail):
    """JOI-11: relationships on shared column names that the model refuses, over the columns of its tables."""
    t, rows = _model_tables(r) | {"promotions": r.promotions}, []
    names = sorted(t)
    for i, a in enumerate(names):
        for b in names[i + 1:]:
            for c in sorted(set(t[a].columns) & set(t[b].columns)):
                try:
                    EN.check_relationship(a, c, b, c)
                except ValueError as e:
                    rows.append((a, b, c, "standalone" if "standalone" in str(e) else "key"))
    refused = r.spark.createDataFrame(rows, "a string, b string, col string, reason string")
    return refused.groupBy("col", "reason").agg(F.count(F.lit(1)).alias("n_refused"))


@register("catalog_tables")
def q_catalog_tables(r: Retail):
    """SRC-07..12: a day's stores appended twice, replaced by a reading of
    themselves, and overwritten by position; the rows after each step, a
    fallback read, and the audit of a table that is there and one that isn't."""
    import uuid
    from functools import reduce

    from pyspark.sql import DataFrame as _DF

    from mercato.sources import tables as TB
    name, spark = f"mercato_{uuid.uuid4().hex[:12]}", r.spark
    rows = r.stores.select("store_id", "name", "region")
    steps = []

    def note(step: str, df) -> None:
        # counted now, as the next step changes the table
        steps.append(spark.createDataFrame([(step, df.count())], "step string, n_rows long"))

    for _ in range(2):
        TB.append_idempotent(rows, name, ["store_id"], "region")
    note("append twice", TB.read_table(spark, name))
    TB.overwrite_table(TB.read_table(spark, name).where(F.col("region") != "ASIA"), name)
    note("overwrite from itself", TB.read_table(spark, name))
    TB.insert_overwrite(rows.where(F.col("region") == "ASIA").select("region", "name", "store_id"), name)
    note("overwrite contents", spark.table(name).where(F.col("region") == "ASIA"))
    note("fallback", TB.read_table(spark, "mercato_no_such_table", None) or TB.read_table(spark, "nation", r.sf_dir))
    audit = quality.table_audit(spark, [name, "mercato_no_such_table"])
    steps.append(audit.select(F.when(F.col("exists"), "audit: there").otherwise("audit: missing").alias("step"), F.col("rows").alias("n_rows")))
    spark.sql(f"DROP TABLE {name}")
    return reduce(_DF.unionAll, steps)


@register("views_in_sql")
def q_views_in_sql(r: Retail):
    """SRC-16: retail and gold tables as temporary views, read by spark.sql."""
    from mercato.sources.retail import register_views
    register_views(r.spark, r.sf_dir)
    return r.spark.sql("""
        SELECT s.region, count(*) AS n_rows, CAST(sum(i.quantity_on_hand) AS BIGINT) AS units
        FROM gold_inventory_status i JOIN stores s USING (store_id) GROUP BY s.region""")


@register("gold_kpis")
def q_gold_kpis(r: Retail):
    """Q-15 from stored gold: the facts are built once, the KPIs read them."""
    from mercato.plans.gold import build_facts
    g = build_facts(r, _scratch(r, "gold"))
    return Q.q15_kpis(g.sales, g.inventory, g.forecast_vs_actual, g.competitor_prices, r.as_of)


@register("gold_top_stores_2000")
def q_gold_top_stores(r: Retail):
    """RPT-02 with slicers from stored gold: the year is a partition."""
    from mercato.plans.gold import Gold, write_table
    out = _scratch(r, "gold")
    write_table(sales.gold_sales_daily(r), out, "gold_sales_daily")
    return R.rpt02_top_stores(Gold(r.spark, out).sales, year=2000, channel="in_store")


@register("segment_check")
def q_segment_check(r: Retail):
    """ML-02..05 checked: every customer labelled once, five labels, and the
    labels in the order of the segments' scores."""
    from pyspark.sql import Window
    seg = segments.assert_all_labels(segments.kmeans_segments(r))
    prof = seg.groupBy("segment_label").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("customer_id").alias("d"),
        *[F.avg(c).alias(c) for c in ("recency_days", "frequency", "monetary")])
    every = Window.partitionBy()
    top = lambda c: F.max(c).over(every)
    s = segments.score(F.col("recency_days"), F.col("frequency"), F.col("monetary"), top("recency_days"), top("frequency"), top("monetary"))
    rank = F.row_number().over(Window.orderBy(F.desc("score")))
    named = F.element_at(F.array(*[F.lit(x) for x in X.SEGMENT_LABELS]), F.col("rank"))
    return (prof.withColumn("score", s).withColumn("rank", rank)
            .agg(F.sum("n").alias("n_customers"), F.sum("d").alias("n_distinct"), F.count(F.lit(1)).alias("n_labels"),
                 F.count_if(named == F.col("segment_label")).alias("n_in_order")))


@register("forecast_check")
def q_forecast_check(r: Retail):
    """ML-06 checked: 90 days for every product of enough history among the
    top 200, no negative value, bounds around the forecast."""
    fc = forecast.demand_forecast(r, cutoff=forecast.cutoff_of(r))
    per = fc.where("status = 'ok'").groupBy("product_id").agg(
        F.count(F.lit(1)).alias("days"),
        F.count_if((F.col("forecast_qty") < 0) | (F.col("forecast_qty_lower") > F.col("forecast_qty"))
                   | (F.col("forecast_qty") > F.col("forecast_qty_upper"))).alias("out_of_order"))
    return per.agg(F.count(F.lit(1)).alias("n_products"), F.count_if(F.col("days") != 90).alias("n_other_length"),
                   F.coalesce(F.sum("out_of_order"), F.lit(0)).alias("n_out_of_order"))


# ---- expectations of the gold writes --------------------------------------------
@register("gold_checks")
def q_gold_checks(r: Retail):
    """DQ-01/DQ-03: the facts written under their expectations; what each rule
    observed in the write, and whether it held."""
    from mercato.operators import expectations as E
    from mercato.plans.gold import build_facts
    out = _scratch(r, "gold")
    build_facts(r, out)
    return E.checks(r.spark, out).select("tbl", "rule", "action", F.round("observed", 6).alias("observed"), "passed")


@register("quarantined_events")
def q_quarantined_events(r: Retail):
    """DQ-01: the event feed stored under its domain rule; rows with another
    type are set apart by the same write."""
    from mercato.operators import expectations as E
    events, out = r.raw("events"), _scratch(r, "silver")
    rules = [E.RowRule("event_type_known", f"event_type IN ({', '.join(repr(v) for v in quality.DOMAINS['event_type'])})"),
             E.RowRule("value_known", "value IS NOT NULL"), E.TableRule("rows", E.rows, low=1)]
    E.checked_write(events, out, "silver_events", rules)
    stored = r.spark.read.parquet(f"{out}/silver_events").select("event_type", F.lit("stored").alias("place"))
    apart = E.quarantined(r.spark, out, "silver_events", events.schema).select("event_type", F.col("_failed").alias("place"))
    return stored.unionAll(apart).groupBy("place", "event_type").agg(F.count(F.lit(1)).alias("n"))


# ---- exact distinct counts by any slicer -----------------------------------------
def _stored_bitmaps(r: Retail):
    from mercato.operators.distinct import slicer_bitmaps
    from mercato.plans.gold import Gold, write_table
    out = _scratch(r, "gold")
    write_table(slicer_bitmaps(r), out, "gold_slicer_bitmaps")
    return Gold(r.spark, out).slicer_bitmaps


@register("mea_distinct_by_year")
def q_mea_distinct_by_year(r: Retail):
    """MEA-04 (true orders) and MEA-25 per year, from stored bitmaps."""
    from mercato.operators.distinct import distinct_counts
    return distinct_counts(_stored_bitmaps(r).withColumn("year", F.year("sales_month")), ["year"])


@register("mea_distinct_by_region_channel")
def q_mea_distinct_by_region_channel(r: Retail):
    """MEA-04 and MEA-25 per region and channel."""
    from mercato.operators.distinct import distinct_counts
    return distinct_counts(_stored_bitmaps(r), ["region", "channel"])


@register("mea_distinct_by_category_sliced")
def q_mea_distinct_by_category_sliced(r: Retail):
    """MEA-04 and MEA-25 per category under three slicers: last full year, supermarkets, in store."""
    from mercato.operators.distinct import distinct_counts
    where = ((F.year("sales_month") == F.year(r.as_of) - 1) & (F.col("store_type") == "supermarket") & (F.col("channel") == "in_store"))
    return distinct_counts(_stored_bitmaps(r), ["category"], where)


@register("mea_distinct_total")
def q_mea_distinct_total(r: Retail):
    """MEA-04 and MEA-25 without filter (cards)."""
    from mercato.operators.distinct import distinct_counts
    return distinct_counts(_stored_bitmaps(r))


# ---- held-out quality of the forecasts --------------------------------------------
@register("forecast_scores", rows_only=True)
def q_forecast_scores(r: Retail):
    """ML-06 next to ML-07 on the 90 held-out days: error and interval coverage of both."""
    return forecast.scores(forecast.both_models(r), ["model"])


@register("forecast_quality")
def q_forecast_quality(r: Retail):
    """ML-07's held-out error and coverage on the products of ML-06, and
    whether ML-06 errs no more and covers its 80 % at least."""
    s = forecast.scores(forecast.both_models(r), ["model"])
    of = lambda model, c: F.max(F.when(F.col("model") == model, F.col(c)))
    return s.agg(of("ML-07", "n_days").alias("n_days"), of("ML-07", "mae").alias("baseline_mae"),
                 of("ML-07", "coverage").alias("baseline_coverage"),
                 (of("ML-06", "n_days") == of("ML-07", "n_days")).alias("same_days"),
                 (of("ML-06", "mae") <= of("ML-07", "mae")).alias("model_errs_no_more"),
                 (of("ML-06", "coverage") >= 0.8).alias("model_covers"))


@register("segment_fixed_point")
def q_segment_fixed_point(r: Retail):
    """ML-02, ML-03: the best restart is a fixed point: every customer is
    nearest to its own centre, every centre is the mean of its customers,
    and the features it was fitted to have mean 0 and deviation 1."""
    fitted, model = segments.fitted_segments(r)
    point = segments.fixed_point(fitted, model).agg(
        F.sum("n_customers").alias("n_customers"), F.count(F.lit(1)).alias("n_segments"),
        F.sum("n_nearer_elsewhere").alias("n_nearer_elsewhere"), F.count_if(F.col("centre_off") > 1e-9).alias("n_centres_off"))
    # the scale in which distances were taken is that of the features themselves
    close = lambda a, b: F.abs(a - F.lit(b)) <= 1e-9 * F.abs(F.lit(b))
    scaled = [close(F.avg(f), model.mean[f]) & close(F.stddev_pop(f), model.std[f]) for f in segments.FEATURES]
    in_scale = fitted.agg(F.array_min(F.array(*scaled))).first()[0]
    return point.withColumn("standardised", F.lit(in_scale)) \
        .withColumn("best_of_restarts", F.lit(len(model.costs) == 10 and model.converged and model.cost <= min(model.costs) + 1e-6))


# ---- POS silence by slices and timers -----------------------------------------
@register("pos_sessions")
def q_pos_sessions(r: Retail):
    """STR-05: sessions of sales per store, stitched from time slices."""
    from mercato.streaming import silence
    return silence.sessions(silence.store_sales(r.raw("events"), r.n_stores))


@register("stream_silence_alarms")
def q_stream_silence_alarms(r: Retail):
    """STR-05: alarms raised by timers 45 minutes after a store's last sale,
    for every silence that the clock of the feed (an hour behind its last event) has passed."""
    from mercato.streaming import jobs as S
    from mercato.streaming import silence
    alarms = silence.silence_alarms(S.event_stream(r.spark, r.sf_dir), r.n_stores, "1 hour")
    path = silence.with_rocksdb(r.spark, lambda: S.run_available(alarms, ""))
    return r.spark.read.parquet(path).withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("session_start", "last_sale", "alarm_at")})


@register("promo_overlap_stretches")
def q_promo_overlap_stretches(r: Retail):
    """DQ-06: stretches of overlapping promotions, announced thirty days ahead."""
    return quality.promo_overlap_stretches(r.promotions, lead_days=30, longest_days=LONGEST_PROMO_DAYS)
