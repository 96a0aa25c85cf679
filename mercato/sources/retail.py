"""Retail source tables derived from the warehouse Parquet tables.

The engine's contract (stores, products, orders, order_items, promotions,
competitor prices, inventory, weather) is laid over the star-schema Parquet
tables with column expressions only, so every view scales with its input
and Catalyst prunes and pushes filters through it to the scan.  The mapping
is documented in FIXTURES.md; the oracle SQL in ``mercato.plans.oracle``
states the same mapping independently for DuckDB.
"""

from __future__ import annotations

import os
from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.sources import folders

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")

# The seven promotion events of the source system
# (name, start month, start day, end month, end day, discount %, traffic boost).
PROMO_EVENTS = [
    ("Winter Sales", 1, 10, 2, 7, 30, "1.40"),
    ("Valentine's Day", 2, 10, 2, 14, 10, "1.15"),
    ("Summer Sales", 6, 28, 7, 26, 30, "1.35"),
    ("Back to School", 8, 15, 9, 10, 10, "1.20"),
    ("Black Friday", 11, 28, 11, 28, 25, "2.80"),
    ("Cyber Monday", 12, 1, 12, 1, 20, "1.80"),
    ("Christmas", 12, 20, 12, 24, 15, "2.20"),
]

# The longest of them, in days (as a bound: months counted as 31 days).
LONGEST_PROMO_DAYS = max(31 * (em - sm) + ed - sd + 1 for _, sm, sd, em, ed, _, _ in PROMO_EVENTS)

# The five tracked competitors.
COMPETITORS = ["MaxiMarché", "PrimoShop", "BonPrix", "NeoShop", "TendancePlus"]

# Stores replenish a product by whole cases of this many packs of its size.
CASE_PACKS = 12

# Bytes of the stored order lines that one task joins and sums (a few hundred thousand lines).
LINE_BYTES = 4 << 20

# Order priority -> sales channel.
CHANNEL_OF_PRIORITY = {"1-URGENT": "drive", "2-HIGH": "click_and_collect",
                       "5-LOW": "home_delivery"}
DEFAULT_CHANNEL = "in_store"


def dec(x: str | int | float, p: int, s: int) -> Column:
    return F.lit(str(x)).cast(f"decimal({p},{s})")


def store_type(surface: Column) -> Column:
    """PRJ-10: store format from the sales surface."""
    return (F.when(surface > 3000, "hypermarket")
            .when(surface > 1000, "supermarket").otherwise("convenience"))


@dataclass
class Retail:
    """Lazily built retail DataFrames over one warehouse folder."""

    spark: SparkSession
    sf_dir: str
    _cache: dict = field(default_factory=dict, repr=False)

    def raw(self, name: str) -> DataFrame:
        if name not in self._cache:
            self._cache[name] = self.spark.read.parquet(os.path.join(self.sf_dir, f"{name}.parquet"))
        return self._cache[name]

    @cached_property
    def line_parts(self) -> int:
        """Shuffle partitions for plans that keep every order line, by the size of the stored lines."""
        return -(-folders.size(self.spark, os.path.join(self.sf_dir, "lineitem.parquet")) // LINE_BYTES)

    def dealt(self, df: DataFrame, *keys: str) -> DataFrame:
        """``df`` shuffled by ``keys`` so that a task's share of the lines, and so
        its memory, stays the same however many lines there are.  Few lines
        are left to adaptive execution, which may broadcast one side."""
        return df.repartition(self.line_parts, *keys) if self.line_parts > 8 else df

    def with_orders(self, lines: DataFrame, orders: DataFrame) -> DataFrame:
        """Lines joined to their order (JOI-01)."""
        return self.dealt(lines, "order_id").join(self.dealt(orders, "order_id"), "order_id")

    # -- source system tables -------------------------------------------------
    @cached_property
    def stores(self) -> DataFrame:
        s, n, r = self.raw("supplier"), self.raw("nation"), self.raw("region")
        # surface from the account balance, the only measure of a store's size here
        surface = (F.lit(400) + F.floor(F.abs(F.col("s_acctbal")) / 2)).cast("int")
        return (s.join(n, s.s_nationkey == n.n_nationkey)
                .join(r, n.n_regionkey == r.r_regionkey)
                .select(F.col("s_suppkey").alias("store_id"), F.col("s_name").alias("name"),
                        F.col("n_name").alias("city"), F.col("r_name").alias("region"),
                        surface.alias("surface_m2"))
                .withColumn("store_type", store_type(F.col("surface_m2"))))

    @cached_property
    def products(self) -> DataFrame:
        p = self.raw("part")
        price = F.col("p_retailprice").cast("decimal(10,2)")
        cost_pct = (F.lit(40) + F.col("p_size")).cast("decimal(4,0)")  # larger sizes leave less margin
        return p.select(
            F.col("p_partkey").alias("product_id"), F.col("p_name").alias("name"),
            F.col("p_type").alias("category"), F.col("p_brand").alias("subcategory"),
            price.alias("unit_price"),
            (price * cost_pct * dec("0.01", 3, 2)).cast("decimal(10,2)").alias("unit_cost"),
            F.col("p_size").alias("pack_size"), (F.col("p_size") < 49).alias("is_active"))

    @cached_property
    def params(self) -> dict:
        """Calendar facts of the sales history and the store count, computed
        once per load (two single-row aggregates) and used as literals, so
        filters on them fold into constants and reach the Parquet scan.  A
        new load reads them anew, so appended data moves the analysis date."""
        d = F.col("o_orderdate").cast("date")
        row = self.raw("orders").agg(
            F.min(d).alias("lo"), F.max(d).alias("hi"),
            F.sort_array(F.collect_set(F.year(d))).alias("years"),
            F.sort_array(F.collect_set(F.trunc(d, "MM"))).alias("months")).first()
        n = self.raw("supplier").count()
        return {"lo": row["lo"], "hi": row["hi"], "years": list(row["years"]),
                "months": list(row["months"]), "n_stores": n}

    @cached_property
    def n_stores(self) -> Column:
        """Store count (the store key space)."""
        return F.lit(self.params["n_stores"]).cast("bigint")

    @cached_property
    def orders(self) -> DataFrame:
        o = self.raw("orders")
        channel = F.coalesce(F.create_map(*[x for kv in CHANNEL_OF_PRIORITY.items()
                                            for x in map(F.lit, kv)])[F.col("o_orderpriority")],
                             F.lit(DEFAULT_CHANNEL))
        return o.select(F.col("o_orderkey").alias("order_id"),
                        (F.col("o_orderkey") % self.n_stores).alias("store_id"),
                        F.col("o_orderdate").cast("date").alias("order_date"),
                        F.col("o_custkey").alias("customer_id"),
                        channel.alias("channel"),
                        F.col("o_orderstatus").alias("order_status"))

    @cached_property
    def priced_lines(self) -> DataFrame:
        """Order lines joined once to their product: the order_items columns
        (priced at the product list price, as the source does) plus the
        product attributes the facts group by."""
        li = self.raw("lineitem")
        prod = self.products
        qty = F.col("l_quantity").cast("int")
        line_total = F.round(qty * F.col("unit_price")
                             * (F.lit(1) - F.col("l_discount").cast("decimal(4,2)")), 2)
        return (li.join(prod, li.l_partkey == prod.product_id)
                .select(F.col("l_orderkey").alias("order_id"), "product_id",
                        qty.alias("quantity"), "unit_price",
                        (F.col("l_discount") * 100).cast("decimal(5,2)").alias("discount_pct"),
                        line_total.cast("decimal(12,2)").alias("line_total"),
                        "category", "subcategory", "unit_cost"))

    @cached_property
    def order_items(self) -> DataFrame:
        """order_items contract columns."""
        return self.priced_lines.select("order_id", "product_id", "quantity", "unit_price",
                                        "discount_pct", "line_total")

    @cached_property
    def order_lines(self) -> DataFrame:
        """order_items joined to their order (JOI-01), the grain of most facts."""
        return self.with_orders(self.order_items, self.orders)

    # -- calendars derived from the sales history -----------------------------
    @cached_property
    def years(self) -> Column:
        """Array of the distinct sales years (bounded by the calendar)."""
        return F.array(*[F.lit(y) for y in self.params["years"]])

    @cached_property
    def as_of(self) -> Column:
        """Analysis date: the last sales date."""
        return F.lit(self.params["hi"])

    @cached_property
    def first_day(self) -> Column:
        return F.lit(self.params["lo"])

    @cached_property
    def promotions(self) -> DataFrame:
        """Promotion calendar: each event per sales year and category."""
        events = F.array(*[F.struct(F.lit(n).alias("promo_name"), F.lit(sm).alias("sm"),
                                    F.lit(sd).alias("sd"), F.lit(em).alias("em"),
                                    F.lit(ed).alias("ed"), F.lit(dp).alias("discount_pct"),
                                    dec(tb, 3, 2).alias("traffic_boost"))
                           for n, sm, sd, em, ed, dp, tb in PROMO_EVENTS])
        cats = self.raw("part").select(F.col("p_type").alias("category")).distinct()
        e = F.col("e")
        return (cats.withColumn("y", F.explode(self.years)).withColumn("e", F.explode(events))
                .select(e.promo_name.alias("promo_name"),
                        F.make_date("y", e.sm, e.sd).alias("start_date"),
                        F.make_date("y", e.em, e.ed).alias("end_date"),
                        "category", e.discount_pct.alias("discount_pct"),
                        e.traffic_boost.alias("traffic_boost")))

    def observed_prices(self, since=None, before=None) -> DataFrame:
        """Competitor snapshots from the prices that lines were sold at.

        The suppliers of a region stand for one competitor; its price of a
        product in a month is what its lines of the month earned per unit
        (extended price less discount), to the cent and at least 0.50.  All
        arithmetic is on integers (cents, hundredths of a percent)."""
        d = F.col("o_orderdate").cast("date")
        o = self.raw("orders").select("o_orderkey", d.alias("day"))
        whole = since is None
        o = o if since is None else o.where(F.col("day") >= F.lit(since))
        o = o if before is None else o.where(F.col("day") < F.lit(before))
        shop = (self.raw("supplier").join(self.raw("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
                .select("s_suppkey", (F.col("n_regionkey") % len(COMPETITORS)).alias("rival")))
        paid = (F.round(F.col("l_extendedprice") * 100).cast("bigint")
                * (F.lit(100) - F.round(F.col("l_discount") * 100).cast("bigint")))
        o = o.select("o_orderkey", F.date_format("day", "yyyy-MM").alias("snapshot_month"))
        li = self.raw("lineitem")
        if whole:
            li, o = self.dealt(li, "l_orderkey"), self.dealt(o, "o_orderkey")
        sums = (li.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
                .join(shop, F.col("l_suppkey") == F.col("s_suppkey"))
                .groupBy("snapshot_month", F.col("l_partkey").alias("product_id"), "rival")
                .agg(F.sum(paid).alias("paid"), F.sum(F.col("l_quantity").cast("bigint")).alias("units")))
        our = F.col("p_retailprice").cast("decimal(10,2)")
        x = sums.join(self.raw("part"), F.col("product_id") == F.col("p_partkey")).withColumn(
            "cents", F.expr("greatest(50, div(2 * paid + 100 * units, 200 * units))")).withColumn(
            "ours", (our * 100).cast("bigint"))
        gap = F.expr("sign(cents - ours) * div(2 * abs(cents - ours) * 10000 + ours, 2 * ours)")
        names = F.array(*[F.lit(n) for n in COMPETITORS])
        return x.select(
            "snapshot_month", "product_id", F.col("p_name").alias("product_name"), F.col("p_type").alias("category"),
            F.element_at(names, (F.col("rival") + 1).cast("int")).alias("competitor"), our.alias("our_price"),
            (gap.cast("decimal(12,0)") * dec("0.01", 3, 2)).cast("decimal(10,2)").alias("price_gap_pct"),
            (F.col("cents") < F.col("ours")).alias("is_cheaper"),
            (F.col("cents").cast("decimal(12,0)") * dec("0.01", 3, 2)).cast("decimal(12,2)").alias("competitor_price"))

    @cached_property
    def competitor_prices(self) -> DataFrame:
        """Snapshots of the closed months: those before the month of the analysis date."""
        return self.observed_prices(before=self.params["hi"].replace(day=1))

    @cached_property
    def competitor_latest(self) -> DataFrame:
        """PRJ-24: the latest closed month, as a date range that reaches the orders scan."""
        this = self.params["hi"].replace(day=1)
        closed = [m for m in self.params["months"] if m < this]
        return self.observed_prices(closed[-1] if closed else this, this)

    @cached_property
    def store_product_sales(self) -> DataFrame:
        """Units sold, selling days and last sale per store x product (input of AGG-03)."""
        lines = self.order_lines.select("store_id", "product_id", "order_date", "quantity")
        # one shuffle serves both sums
        daily = (self.dealt(lines, "store_id", "product_id").groupBy("store_id", "product_id", "order_date")
                 .agg(F.sum("quantity").alias("sold")))
        return (daily.groupBy("store_id", "product_id")
                .agg(F.sum("sold").alias("sold"), F.count("order_date").alias("days"), F.max("order_date").alias("last_sale")))

    @cached_property
    def listed_pairs(self) -> DataFrame:
        """Store x product pairs that a store has on its list: it sells the product or supplies it."""
        supplied = self.raw("lineitem").select(F.col("l_suppkey").alias("store_id"), F.col("l_partkey").alias("product_id"))
        return supplied.union(self.store_product_sales.select("store_id", "product_id")).distinct()

    def on_hand(self, sales: DataFrame) -> DataFrame:
        """Stock left of the opened case: a store refills a product by cases
        of CASE_PACKS packs and has what its sales to date left of the last
        one; thresholds by the stock policy (PRJ-15)."""
        from mercato.functions.exprs import stock_thresholds
        safety, reorder = stock_thresholds()
        case = F.col("pack_size") * CASE_PACKS
        x = sales.join(self.products.select("product_id", "pack_size"), "product_id")
        return x.withColumn("quantity_on_hand", F.pmod(-F.col("sold"), case.cast("bigint"))).withColumn(
            "safety_stock", safety).withColumn("reorder_point", reorder).drop("pack_size")

    @cached_property
    def inventory(self) -> DataFrame:
        """Stock on hand per sold store x product pair at the analysis date."""
        cov = F.round(F.col("quantity_on_hand").cast("decimal(12,0)") * F.col("days") / F.col("sold"), 1)
        return self.on_hand(self.store_product_sales).select(
            "store_id", "product_id", "quantity_on_hand", "safety_stock", "reorder_point", "sold", "days",
            cov.cast("double").alias("coverage_days"), F.col("last_sale").alias("last_updated"))

    def inventory_snapshots(self, months: int = 6) -> DataFrame:
        """Month-end stock of the ``months`` closed months before the analysis
        date, by the same rule on the sales up to each month end.  Sales are
        summed per month first, those before the first snapshot as one month,
        so a row meets at most ``months`` snapshots and no line is read twice."""
        this = self.params["hi"].replace(day=1)
        snaps = [m.year * 100 + m.month for m in self.params["months"] if m < this][-months:]
        ym = F.year("order_date") * 100 + F.month("order_date")
        first = F.greatest(ym, F.lit(snaps[0] if snaps else 0))
        monthly = (self.order_lines.groupBy("store_id", "product_id", "order_date").agg(F.sum("quantity").alias("sold"))
                   .groupBy("store_id", "product_id", first.alias("ym"))
                   .agg(F.sum("sold").alias("sold"), F.count(F.lit(1)).alias("days")))
        targets = F.array(*[F.lit(x) for x in snaps]).cast("array<int>")
        sums = (monthly.withColumn("snapshot_ym", F.explode(F.filter(targets, lambda t: t >= F.col("ym"))))
                .groupBy("store_id", "product_id", "snapshot_ym")
                .agg(F.sum("sold").alias("sold"), F.sum("days").alias("days")))
        return self.on_hand(sums).select("snapshot_ym", "store_id", "product_id", "quantity_on_hand",
                                         "safety_stock", "reorder_point")

    @cached_property
    def weather(self) -> DataFrame:
        """Daily readings per city from the event feed: an event is a sensor
        reading in the nation of its user; the days are moved so that the
        last day of the feed is the analysis date.  Temperatures are tenths of
        the reading, rain is what the error readings add up to, wind the
        number of readings."""
        e = self.raw("events").select("user_id", "event_type", F.col("value").cast("decimal(12,2)").alias("value"),
                                      F.to_date("ts").alias("day"))
        last = e.select(F.max("day")).scalar()
        place = (self.raw("customer").join(self.raw("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
                 .join(self.raw("region"), F.col("n_regionkey") == F.col("r_regionkey"))
                 .select("c_custkey", F.col("n_name").alias("city"), F.col("r_name").alias("region")))
        tenth = lambda c: c.cast("double") / 10
        w = (e.join(place, F.col("user_id") == F.col("c_custkey"))
             .withColumn("date", F.date_sub(self.as_of, F.datediff(last, F.col("day"))))
             .groupBy("date", "city", "region")
             .agg(tenth(F.max("value")).alias("max_temperature_c"), tenth(F.min("value")).alias("min_temperature_c"),
                  tenth(F.sum(F.when(F.col("event_type") == "error", F.col("value")).otherwise(0))).alias("rainfall_mm"),
                  F.count(F.lit(1)).cast("double").alias("wind_speed_kmh")))
        rain, tmax = F.col("rainfall_mm"), F.col("max_temperature_c")
        return w.select("*", ((rain == 0) & (tmax > 18)).alias("is_sunny"),
                        weather_condition(rain, tmax).alias("weather_condition"))


def weather_condition(rain: Column, tmax: Column) -> Column:
    """PRJ-11: condition label from rainfall and maximum temperature."""
    # Condition labels of the weather feed.
    return (F.when(rain > 5, "pluie").when(rain > 0, "nuageux")
            .when(tmax > 20, "ensoleillé").otherwise("couvert"))


def load(spark: SparkSession, sf_dir: str) -> Retail:
    """The retail views over ``sf_dir`` as the tables stand now."""
    return Retail(spark, sf_dir)


def register_views(spark: SparkSession, sf_dir: str, gold: bool = True) -> list[str]:
    """SRC-16: register the retail tables (and the gold tables) as temporary
    views so they can be queried with ``spark.sql``; returns the names."""
    from mercato.operators import dims, inventory, sales
    r = load(spark, sf_dir)
    views = {"stores": r.stores, "products": r.products, "orders": r.orders,
             "order_items": r.order_items, "promotions": r.promotions,
             "competitor_prices": r.competitor_prices, "inventory": r.inventory, "weather": r.weather}
    if gold:
        views.update({"gold_sales_daily": sales.gold_sales_daily(r),
                      "gold_inventory_status": inventory.gold_inventory_status(r),
                      "dim_calendar": dims.dim_calendar(r)})
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return list(views)
