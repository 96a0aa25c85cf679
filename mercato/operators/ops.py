"""Operational tables derived from the gold facts and the event stream:
stock alerts (STR-06), transfer proposals (STR-07), retention offers
(STR-08), incidents, sales-spike (STR-04) and POS-silence (STR-05) alerts,
and the operational summaries (AGG-18..20)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mercato.functions import exprs as X
from mercato.sources import folders
from mercato.sources.retail import Retail, dec

ALERT_COLS = ["store_id", "product_id", "alert_type", "severity", "message", "created_at", "status"]


def _ts(d: Column | str) -> Column:
    return (F.col(d) if isinstance(d, str) else d).cast("timestamp_ntz")


def stock_alerts(inv: DataFrame) -> DataFrame:
    """STR-06: stockout -> (stockout, critical); critical -> (critical_stock,
    high); raised on the day of the sale that brought the stock there."""
    x = inv.where(F.col("stock_status").isin(*X.AT_RISK))
    so = F.col("stock_status") == "stockout"
    pid, sid = F.col("product_id").cast("string"), F.col("store_id").cast("string")
    # Alert message formats of the operational store.
    msg = F.when(so, F.concat(F.lit("Product "), pid, F.lit(" out of stock at store "), sid)) \
        .otherwise(F.concat(F.lit("Product "), pid, F.lit(" below safety stock at store "), sid))
    return x.select("store_id", "product_id",
                    F.when(so, "stockout").otherwise("critical_stock").alias("alert_type"),
                    F.when(so, "critical").otherwise("high").alias("severity"),
                    msg.alias("message"), _ts(F.col("last_updated")).alias("created_at"), F.lit("active").alias("status"))


def _allocate(short: DataFrame, donors: DataFrame, by: list[str]) -> DataFrame:
    """Hand the donors' excess to the short stores of the same ``by`` values.

    Needs (most urgent first) and excesses (largest first) are laid end to
    end on two lines of units; where a stretch of need lies over a stretch
    of excess, that many units move.  The stretches come from one window
    over the starts of both kinds, so a group of n short and m surplus
    stores makes at most n + m rows, never n x m, and no unit is given
    twice."""
    upto = (Window.unboundedPreceding, -1)
    urgent = Window.partitionBy(*by).orderBy(F.col("stock_status") != "stockout", F.desc("need"), "to_store_id")
    largest = Window.partitionBy(*by).orderBy(F.desc("excess"), "from_store_id")
    start = lambda c, w: F.coalesce(F.sum(c).over(w.rowsBetween(*upto)), F.lit(0)).alias("at")
    needs = short.select(*by, start("need", urgent), F.col("need").alias("n"), F.lit(0).alias("e"),
                         "to_store_id", "stock_status", "created_at", F.lit(None).cast("bigint").alias("from_store_id"))
    gifts = donors.select(*by, start("excess", largest), F.lit(0).alias("n"), F.col("excess").alias("e"),
                          F.lit(None).cast("bigint").alias("to_store_id"), F.lit(None).cast("string").alias("stock_status"),
                          F.lit(None).cast("timestamp_ntz").alias("created_at"), "from_store_id")
    group = Window.partitionBy(*by)
    # peers of one start see each other, so either may come first
    line = group.orderBy("at").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    cover = F.least(F.sum("n").over(group), F.sum("e").over(group))
    last = lambda c: F.last(c, ignorenulls=True).over(line).alias(c)
    x = needs.unionByName(gifts).select(
        *by, "at", F.least(F.coalesce(F.lead("at").over(group.orderBy("at", F.col("to_store_id").isNull())), cover), cover).alias("to"),
        last("to_store_id"), last("stock_status"), last("created_at"), last("from_store_id"))
    return x.withColumn("quantity", (F.col("to") - F.col("at")).cast("int")).where("quantity > 0").drop("at", "to")


def transfer_proposals(inv: DataFrame, as_of: Column, pending_days: int = 7, transit_days: int = 30) -> DataFrame:
    """STR-07: stock for stockout and critical rows from stores above their
    reorder point -- of the same region as far as their excess goes, the rest
    from anywhere.  No donor gives more than its excess.  A proposal dates
    from the sale that caused the shortage; it is pending for
    ``pending_days``, in transit up to ``transit_days``, then completed."""
    short = inv.where(F.col("stock_status").isin(*X.AT_RISK)).select(
        F.col("store_id").alias("to_store_id"), "product_id", "region", "stock_status",
        F.greatest(F.col("reorder_point") - F.col("quantity_on_hand"), F.lit(1)).alias("need"),
        _ts(F.col("last_updated")).alias("created_at"))
    donors = inv.where(F.col("quantity_on_hand") > F.col("reorder_point")).select(
        F.col("store_id").alias("from_store_id"), "product_id", "region",
        (F.col("quantity_on_hand") - F.col("reorder_point")).alias("excess"))
    near = folders.stored(_allocate(short, donors, ["product_id", "region"]), "transfers")  # read three times
    got = near.groupBy("product_id", "to_store_id").agg(F.sum("quantity").alias("got"))
    gave = near.groupBy("product_id", "from_store_id").agg(F.sum("quantity").alias("gave"))
    rest = (short.join(got, ["product_id", "to_store_id"], "left")
            .withColumn("need", F.col("need") - F.coalesce("got", F.lit(0))).where("need > 0"))
    spare = (donors.join(gave, ["product_id", "from_store_id"], "left")
             .withColumn("excess", F.col("excess") - F.coalesce("gave", F.lit(0))).where("excess > 0"))
    far = _allocate(rest, spare, ["product_id"])
    age = F.datediff(as_of, F.col("created_at"))
    return near.drop("region").unionByName(far).select(
        "from_store_id", "to_store_id", "product_id", "quantity",
        F.when(F.col("stock_status") == "stockout", "stockout_reflex").otherwise("critical_stock_reflex").alias("reason"),
        "created_at",
        F.when(age <= pending_days, "pending").when(age <= transit_days, "in_transit").otherwise("completed").alias("status"))


def favourite_category(lines: DataFrame, products: DataFrame) -> DataFrame:
    """Per customer, the category with the highest spend (ties: larger name)."""
    spend = (lines.join(products.select("product_id", "category"), "product_id")
             .groupBy("customer_id", "category").agg(F.sum("line_total").alias("spend")))
    return spend.groupBy("customer_id").agg(F.max(F.struct("spend", "category")).alias("b")) \
        .select("customer_id", F.col("b.category").alias("category"))


def retention_offers(segments: DataFrame, lines: DataFrame, products: DataFrame, as_of: Column,
                     recency_days: int = 90, min_ltv: float = 500.0, valid_days: int = 30) -> DataFrame:
    """STR-08: At Risk with recency > 90 -> loyalty_discount 15 %; Inactive
    with lifetime value > 500 -> win_back 20 %; offered on the customer's
    favourite category."""
    loyal = (F.col("segment_label") == "At Risk") & (F.col("recency_days") > recency_days)
    back = (F.col("segment_label") == "Inactive") & (F.col("monetary") > min_ltv)
    s = segments.where(loyal | back).select(
        "customer_id", F.when(loyal, "loyalty_discount").otherwise("win_back").alias("offer_type"),
        F.when(loyal, dec("15.00", 5, 2)).otherwise(dec("20.00", 5, 2)).alias("discount_pct"),
        # generated on the day the customer had been away for more than recency_days
        F.least(F.date_add("last_order_date", recency_days + 1), as_of).alias("due"))
    fav = favourite_category(lines.join(s.select("customer_id"), "customer_id", "left_semi"), products)
    return s.join(fav, "customer_id", "left").select(
        "customer_id", "offer_type", "discount_pct", "category",
        F.date_add(as_of, valid_days).alias("valid_until"), _ts("due").alias("generated_at"))


def pos_events(r: Retail) -> DataFrame:
    """Purchase events as POS transactions of a store (store = user mod store count)."""
    e = r.raw("events")
    return e.where(F.col("event_type") == "purchase").select(
        "event_id", F.col("ts").cast("timestamp_ntz").alias("ts"),
        (F.col("user_id") % r.n_stores).alias("store_id"), "value")


def incidents(r: Retail, open_hours: int = 48) -> DataFrame:
    """Incidents from error events; open when within ``open_hours`` of the
    last event, else resolved."""
    e = r.raw("events")
    last = e.select(F.max("ts")).scalar()
    x = e.where(F.col("event_type") == "error")
    is_open = F.col("ts") >= last - F.expr(f"INTERVAL {open_hours} HOURS")
    return x.select((F.col("user_id") % r.n_stores).alias("store_id"), F.lit("pos_error").alias("incident_type"),
                    F.concat(F.lit("Error event "), F.col("event_id").cast("string")).alias("description"),
                    F.col("ts").cast("timestamp_ntz").alias("created_at"),
                    F.when(is_open, "open").otherwise("resolved").alias("status"))


def daily_counts(pos: DataFrame) -> DataFrame:
    """Purchases per store and day."""
    return pos.groupBy("store_id", F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).alias("n"))


def sales_spikes(pos: DataFrame, k: float = 3.0, trailing_days: int = 7) -> DataFrame:
    """STR-04 (batch): a store-day whose purchase count exceeds k times the
    mean of the previous ``trailing_days`` days (missing days count 0)."""
    return spikes_from_counts(daily_counts(pos), k, trailing_days)


def spikes_from_counts(day: DataFrame, k: float = 3.0, trailing_days: int = 7) -> DataFrame:
    """Spike rule over (store_id, day, n); pre-aggregated, so the window runs
    over one row per store-day."""
    w = Window.partitionBy("store_id").orderBy(F.unix_date("day")).rangeBetween(-trailing_days, -1)
    x = day.select("*", F.sum("n").over(w).alias("prev"))
    x = x.where(F.col("prev").isNotNull() & (F.col("n") * trailing_days > k * F.col("prev")))
    return x.select("store_id", F.lit(None).cast("bigint").alias("product_id"), F.lit("sales_spike").alias("alert_type"),
                    F.lit("medium").alias("severity"),
                    F.concat(F.lit("Unusual sales spike at store "), F.col("store_id").cast("string")).alias("message"),
                    F.date_add("day", 1).cast("timestamp_ntz").alias("created_at"), F.lit("active").alias("status"))


def pos_silences(pos: DataFrame, gap_minutes: int = 45) -> DataFrame:
    """STR-05 (batch): a gap of more than ``gap_minutes`` between consecutive
    transactions of a store.  Skew-safe: gaps inside a store-day use a window
    partitioned by (store, day); gaps across days compare each day's first
    event with the previous active day's last one (one row per store-day)."""
    x = pos.select("store_id", "ts", F.to_date("ts").alias("day"))
    w = Window.partitionBy("store_id", "day").orderBy("ts")
    inner = x.select("store_id", F.lag("ts").over(w).alias("prev_ts"), "ts")
    days = x.groupBy("store_id", "day").agg(F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))
    wd = Window.partitionBy("store_id").orderBy("day")
    cross_day = days.select("store_id", F.lag("last_ts").over(wd).alias("prev_ts"), F.col("first_ts").alias("ts"))
    gaps = inner.unionByName(cross_day).where(F.col("prev_ts").isNotNull())
    limit = F.expr(f"INTERVAL {gap_minutes} MINUTES")
    g = gaps.where(F.col("ts") > F.col("prev_ts") + limit)
    return g.select("store_id", F.lit(None).cast("bigint").alias("product_id"), F.lit("pos_silence").alias("alert_type"),
                    F.lit("high").alias("severity"),
                    F.lit(f"No POS transactions for {gap_minutes} minutes").alias("message"),
                    (F.col("prev_ts") + limit).alias("created_at"), F.lit("active").alias("status"))


def active_alerts(r: Retail, inv: DataFrame) -> DataFrame:
    """All alert sources in the active_alerts schema."""
    pos = pos_events(r)
    parts = [stock_alerts(inv), sales_spikes(pos), pos_silences(pos)]
    return reduce(DataFrame.unionByName, [p.select(*ALERT_COLS) for p in parts])


def transfers_by_status(transfers: DataFrame, now: Column | None = None, days: int | None = None) -> DataFrame:
    """AGG-18 / Q-06: transfer orders and units per status, of all time or of
    the ``days`` days up to ``now``."""
    if days is not None:
        transfers = transfers.where(F.col("created_at") >= now - F.expr(f"INTERVAL {days} DAYS"))
    return transfers.groupBy("status").agg(F.count(F.lit(1)).alias("cnt"), F.sum("quantity").alias("total_units"))


def alerts_by_severity(alerts: DataFrame) -> DataFrame:
    """AGG-19: active alerts per type and severity, with the severity order."""
    return (alerts.where(F.col("status") == "active").groupBy("alert_type", "severity")
            .agg(F.count(F.lit(1)).alias("cnt")).withColumn("severity_rank", X.severity_rank()))


def offers_this_week(offers: DataFrame, now: Column, days: int = 7) -> DataFrame:
    """AGG-20: offers generated in the last ``days`` days per type."""
    x = offers.where(F.col("generated_at") >= (now - F.expr(f"INTERVAL {days} DAYS")))
    return x.groupBy("offer_type").agg(F.count(F.lit(1)).alias("cnt"),
                                       F.round(F.avg("discount_pct"), 1).cast("double").alias("avg_discount"))
