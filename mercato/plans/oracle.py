"""DuckDB oracle SQL for the registered queries.

Each query is plain SQL over the warehouse tables (region, nation, ...,
events).  The retail views are stated once as CTEs (``VIEWS``) and the
query bodies refer to them; ``sql(body)`` prefixes the CTE list.  The
text is an independent statement of the semantics the Spark operators
implement, used only as a correctness oracle.
"""

from __future__ import annotations

VIEWS: list[tuple[str, str]] = []


def view(name: str, text: str) -> None:
    VIEWS.append((name, text.strip()))


view("v_stores", """
SELECT store_id, name, city, region, surface_m2,
       CASE WHEN surface_m2 > 3000 THEN 'hypermarket' WHEN surface_m2 > 1000 THEN 'supermarket' ELSE 'convenience' END AS store_type
FROM (SELECT s_suppkey AS store_id, s_name AS name, n_name AS city, r_name AS region, CAST(400 + FLOOR(ABS(s_acctbal) / 2) AS INT) AS surface_m2
      FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey) sized
""")
view("v_products", """
SELECT p_partkey AS product_id, p_name AS name, p_type AS category, p_brand AS subcategory,
       CAST(p_retailprice AS DECIMAL(10,2)) AS unit_price,
       CAST(CAST(p_retailprice AS DECIMAL(10,2)) * CAST(40 + p_size AS DECIMAL(4,0)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(10,2)) AS unit_cost,
       p_size AS pack_size, p_size < 49 AS is_active
FROM part
""")
view("v_orders", """
SELECT o_orderkey AS order_id, o_orderkey % (SELECT COUNT(*) FROM supplier) AS store_id, CAST(o_orderdate AS DATE) AS order_date, o_custkey AS customer_id,
       CASE o_orderpriority WHEN '1-URGENT' THEN 'drive' WHEN '2-HIGH' THEN 'click_and_collect' WHEN '5-LOW' THEN 'home_delivery' ELSE 'in_store' END AS channel,
       o_orderstatus AS order_status
FROM orders
""")
view("v_order_items", """
SELECT l_orderkey AS order_id, l_partkey AS product_id, CAST(l_quantity AS INT) AS quantity, CAST(p_retailprice AS DECIMAL(10,2)) AS unit_price,
       CAST(l_discount * 100 AS DECIMAL(5,2)) AS discount_pct,
       CAST(ROUND(CAST(l_quantity AS INT) * CAST(p_retailprice AS DECIMAL(10,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))), 2) AS DECIMAL(12,2)) AS line_total
FROM lineitem JOIN part ON l_partkey = p_partkey
""")
view("v_as_of", "SELECT MAX(CAST(o_orderdate AS DATE)) AS as_of FROM orders")
view("v_promotions", """
SELECT e.promo_name, make_date(y.y, e.sm, e.sd) AS start_date, make_date(y.y, e.em, e.ed) AS end_date, c.category, e.discount_pct, e.traffic_boost
FROM (VALUES ('Winter Sales',1,10,2,7,30,1.40), ('Valentine''s Day',2,10,2,14,10,1.15), ('Summer Sales',6,28,7,26,30,1.35), ('Back to School',8,15,9,10,10,1.20),
             ('Black Friday',11,28,11,28,25,2.80), ('Cyber Monday',12,1,12,1,20,1.80), ('Christmas',12,20,12,24,15,2.20)) AS e(promo_name, sm, sd, em, ed, discount_pct, traffic_boost)
CROSS JOIN (SELECT DISTINCT CAST(YEAR(o_orderdate) AS INT) AS y FROM orders) y
CROSS JOIN (SELECT DISTINCT p_type AS category FROM part) c
""")
view("v_competitor_prices", """
WITH paid AS (
  SELECT strftime(o_orderdate, '%Y-%m') AS snapshot_month, l_partkey AS product_id, n_regionkey % 5 AS rival,
         SUM(CAST(ROUND(l_extendedprice * 100) AS BIGINT) * (100 - CAST(ROUND(l_discount * 100) AS BIGINT)))::BIGINT AS paid,
         SUM(CAST(l_quantity AS BIGINT))::BIGINT AS units
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey
  WHERE CAST(o_orderdate AS DATE) < date_trunc('month', (SELECT as_of FROM v_as_of)) GROUP BY ALL),
priced AS (
  SELECT paid.*, GREATEST(50, (2 * paid + 100 * units) // (200 * units)) AS cents, CAST(p_retailprice AS DECIMAL(10,2)) AS our_price,
         CAST(CAST(p_retailprice AS DECIMAL(10,2)) * 100 AS BIGINT) AS ours, p_name, p_type
  FROM paid JOIN part ON p_partkey = product_id)
SELECT snapshot_month, product_id, p_name AS product_name, p_type AS category,
       ['MaxiMarché', 'PrimoShop', 'BonPrix', 'NeoShop', 'TendancePlus'][rival + 1] AS competitor, our_price,
       CAST(CAST(sign(cents - ours) * ((2 * ABS(cents - ours) * 10000 + ours) // (2 * ours)) AS DECIMAL(12,0)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(10,2)) AS price_gap_pct,
       cents < ours AS is_cheaper, CAST(CAST(cents AS DECIMAL(12,0)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(12,2)) AS competitor_price
FROM priced
""")
view("v_sp_sales", """
SELECT o_orderkey % (SELECT COUNT(*) FROM supplier) AS store_id, l_partkey AS product_id, SUM(CAST(l_quantity AS INT)) AS sold,
       COUNT(DISTINCT CAST(o_orderdate AS DATE)) AS days, MAX(CAST(o_orderdate AS DATE)) AS last_sale
FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey GROUP BY ALL
""")
view("v_inventory", """
SELECT store_id, product_id, (case_units - sold % case_units) % case_units AS quantity_on_hand,
       GREATEST(1, CAST((3 * sold) // days AS INT)) AS safety_stock, GREATEST(2, CAST((7 * sold) // days AS INT)) AS reorder_point, sold, days,
       CAST(ROUND(CAST((case_units - sold % case_units) % case_units AS DECIMAL(12,0)) * days / sold, 1) AS DOUBLE) AS coverage_days, last_sale AS last_updated
FROM (SELECT v_sp_sales.*, 12 * p_size AS case_units FROM v_sp_sales JOIN part ON p_partkey = product_id) cases
""")
view("v_weather", """
WITH readings AS (
  SELECT (SELECT as_of FROM v_as_of) - CAST(date_diff('day', CAST(ts AS DATE), (SELECT MAX(CAST(ts AS DATE)) FROM events)) AS INT) AS date,
         n_name AS city, r_name AS region, event_type, CAST(value AS DECIMAL(12,2)) AS reading
  FROM events JOIN customer ON c_custkey = user_id JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey),
per_day AS (
  SELECT date, city, region, CAST(MAX(reading) AS DOUBLE) / 10 AS max_temperature_c, CAST(MIN(reading) AS DOUBLE) / 10 AS min_temperature_c,
         CAST(SUM(CASE WHEN event_type = 'error' THEN reading ELSE 0 END) AS DOUBLE) / 10 AS rainfall_mm, CAST(COUNT(*) AS DOUBLE) AS wind_speed_kmh
  FROM readings GROUP BY 1, 2, 3)
SELECT *, rainfall_mm = 0 AND max_temperature_c > 18 AS is_sunny,
       CASE WHEN rainfall_mm > 5 THEN 'pluie' WHEN rainfall_mm > 0 THEN 'nuageux' WHEN max_temperature_c > 20 THEN 'ensoleillé' ELSE 'couvert' END AS weather_condition
FROM per_day
""")

# ---- gold tables --------------------------------------------------------
view("g_sales", """
WITH sold AS (
  SELECT ord.store_id, ord.order_date AS sales_date, ord.channel, prod.category, prod.subcategory, item.order_id, item.quantity AS units,
         item.quantity * (100 - item.discount_pct) AS paid_units, item.discount_pct, item.unit_price, prod.unit_cost
  FROM v_order_items item JOIN v_orders ord USING (order_id) JOIN v_products prod USING (product_id)),
promoted AS (
  SELECT sold.*, promo.promo_name
  FROM sold LEFT JOIN (SELECT category, promo_name, CAST(UNNEST(generate_series(start_date, end_date, INTERVAL 1 DAY)) AS DATE) AS sales_date FROM v_promotions) promo
       USING (category, sales_date)),
daily AS (
  SELECT store_id, sales_date, channel, category, subcategory, promo_name, COUNT(DISTINCT order_id) AS nb_orders, SUM(units) AS units_sold,
         SUM(paid_units * unit_price) * CAST(0.01 AS DECIMAL(3,2)) AS revenue, SUM(paid_units * (unit_price - unit_cost)) * CAST(0.01 AS DECIMAL(3,2)) AS gross_margin,
         SUM(discount_pct) AS discounts, COUNT(*) AS n_lines
  FROM promoted GROUP BY ALL)
SELECT store_id, shop.name AS store_name, shop.region, shop.surface_m2, shop.store_type, sales_date, channel, category, subcategory, nb_orders,
       CAST(units_sold AS BIGINT) AS units_sold, CAST(ROUND(revenue, 2) AS DOUBLE) AS revenue, CAST(ROUND(gross_margin, 2) AS DOUBLE) AS gross_margin,
       CAST(CAST((2 * discounts * 100 + n_lines) AS BIGINT) // (2 * n_lines) AS DOUBLE) / 100 AS avg_discount_pct,
       CAST(promo_name IS NOT NULL AS INT) AS is_promo_day, promo_name
FROM daily JOIN v_stores shop USING (store_id)
""")
view("g_inventory", """
SELECT i.store_id, s.name AS store_name, s.region, i.product_id, p.name AS product_name, p.category,
       i.quantity_on_hand, i.safety_stock, i.reorder_point,
       CASE WHEN i.quantity_on_hand = 0 THEN 'stockout' WHEN i.quantity_on_hand <= i.safety_stock THEN 'critical'
            WHEN i.quantity_on_hand <= i.reorder_point THEN 'low' ELSE 'normal' END AS stock_status,
       i.coverage_days, i.last_updated
FROM v_inventory i JOIN v_stores s ON i.store_id = s.store_id JOIN v_products p ON i.product_id = p.product_id
WHERE p.is_active
""")
view("dim_calendar", """
SELECT date, strftime(date, '%Y-%m-%d') AS date_key, CAST(YEAR(date) AS INT) AS year, CAST(MONTH(date) AS INT) AS month_num,
       strftime(date, '%B') AS month_name, 'Q' || QUARTER(date) AS quarter,
       YEAR(date) || '-' || LPAD(CAST(MONTH(date) AS VARCHAR), 2, '0') AS year_month,
       CAST(YEAR(date) * 100 + MONTH(date) AS INT) AS year_month_sort, CAST(WEEKOFYEAR(date) AS INT) AS week_num,
       DAYOFWEEK(date) IN (0, 6) AS is_weekend
FROM (SELECT CAST(UNNEST(generate_series(make_date(CAST(YEAR(MIN(o_orderdate)) AS INT), 1, 1), make_date(CAST(YEAR(MAX(o_orderdate)) AS INT), 12, 31), INTERVAL 1 DAY)) AS DATE) AS date FROM orders) c
""")

view("v_rfm", """
SELECT o.customer_id, MAX(o.order_date) AS last_order_date,
       CAST(date_diff('day', MAX(o.order_date), (SELECT as_of FROM v_as_of)) AS INT) AS recency_days,
       COUNT(DISTINCT o.order_id) AS frequency, CAST(SUM(i.line_total) AS DOUBLE) AS monetary,
       CAST(SUM(i.line_total) AS DOUBLE) / COUNT(*) AS avg_basket, COUNT(DISTINCT i.product_id) AS nb_distinct_products
FROM v_orders o JOIN v_order_items i ON o.order_id = i.order_id GROUP BY o.customer_id
""")
view("v_segments", """
SELECT customer_id, last_order_date, recency_days, frequency, monetary, avg_basket, nb_distinct_products, segment_id,
       ['Champions', 'Loyal', 'Warm Prospects', 'At Risk', 'Inactive'][segment_id + 1] AS segment_label
FROM (SELECT *, CAST(CASE WHEN score >= 1.0 THEN 0 WHEN score >= 0.7 THEN 1 WHEN score >= 0.45 THEN 2 WHEN score >= 0.2 THEN 3 ELSE 4 END AS INT) AS segment_id
      FROM (SELECT r.*, -CAST(recency_days AS DOUBLE) / (SELECT MAX(recency_days) FROM v_rfm)
                        + CAST(frequency AS DOUBLE) / (SELECT MAX(frequency) FROM v_rfm)
                        + monetary / (SELECT MAX(monetary) FROM v_rfm) AS score FROM v_rfm r) s) t
""")
view("v_cutoff", "SELECT as_of - 90 AS cutoff FROM v_as_of")
view("v_daily", """
SELECT i.product_id, o.order_date, CAST(SUM(i.quantity) AS BIGINT) AS actual_qty
FROM v_order_items i JOIN v_orders o ON o.order_id = i.order_id GROUP BY 1, 2
""")
view("v_fb_sums", """
SELECT i.product_id, dayofweek(o.order_date) AS dow, SUM(i.quantity) AS qty
FROM v_order_items i JOIN v_orders o ON o.order_id = i.order_id
WHERE o.order_date > (SELECT cutoff FROM v_cutoff) - 56 AND o.order_date <= (SELECT cutoff FROM v_cutoff)
GROUP BY 1, 2
""")
view("v_forecast", """
SELECT d.product_id, d.forecast_date,
       CAST(ROUND(CAST(COALESCE(s.qty, 0) AS DECIMAL(18,0)) * 0.125, 2) AS DOUBLE) AS forecast_qty,
       CAST(ROUND(CAST(COALESCE(s.qty, 0) AS DECIMAL(18,0)) * 0.125 * 0.8, 2) AS DOUBLE) AS forecast_qty_lower,
       CAST(ROUND(CAST(COALESCE(s.qty, 0) AS DECIMAL(18,0)) * 0.125 * 1.2, 2) AS DOUBLE) AS forecast_qty_upper
FROM (SELECT product_id, CAST(UNNEST(generate_series((SELECT cutoff FROM v_cutoff) + 1, (SELECT cutoff FROM v_cutoff) + 90, INTERVAL 1 DAY)) AS DATE) AS forecast_date
      FROM (SELECT DISTINCT product_id FROM v_fb_sums) p) d
LEFT JOIN v_fb_sums s ON s.product_id = d.product_id AND s.dow = dayofweek(d.forecast_date)
""")
view("g_fva", """
WITH compared AS (
  SELECT fc.*, COALESCE(sold.actual_qty, 0) AS actual_qty, CAST(fc.forecast_qty AS DECIMAL(12,2)) AS planned
  FROM v_forecast fc LEFT JOIN v_daily sold ON sold.product_id = fc.product_id AND sold.order_date = fc.forecast_date),
missed AS (SELECT *, ABS(planned - actual_qty) / NULLIF(planned, 0) AS miss FROM compared)
SELECT product_id, prod.name AS product_name, prod.category, forecast_date, actual_qty, forecast_qty, forecast_qty_lower, forecast_qty_upper,
       ROUND(miss, 4) AS forecast_error_pct, ROUND(1 - miss, 4) AS forecast_accuracy
FROM missed JOIN v_products prod USING (product_id)
""")
view("g_double_risk", """
WITH endangered AS (SELECT * FROM g_inventory WHERE stock_status = 'stockout' OR stock_status = 'critical'),
undercut AS (
  SELECT product_id, competitor, CAST(competitor_price AS DOUBLE) AS competitor_price, CAST(price_gap_pct AS DOUBLE) AS price_gap_pct
  FROM v_competitor_prices WHERE is_cheaper AND snapshot_month = (SELECT MAX(snapshot_month) FROM v_competitor_prices))
SELECT product_id, endangered.product_name, endangered.category, CAST(prod.unit_price AS DOUBLE) AS our_price, store_id, store_name, region,
       stock_status, coverage_days, quantity_on_hand, competitor AS cheapest_competitor, competitor_price, price_gap_pct
FROM undercut JOIN endangered USING (product_id) JOIN v_products prod USING (product_id)
""")
view("g_champion", """
WITH best AS (SELECT customer_id, segment_label, monetary, recency_days, frequency FROM v_segments WHERE segment_label = 'Champions'),
bought AS (SELECT DISTINCT customer_id, store_id, product_id FROM v_orders JOIN v_order_items USING (order_id)),
states AS (SELECT product_id, stock_status, COUNT(*) AS n_stores, MIN(coverage_days) AS coverage_days, MIN(quantity_on_hand) AS quantity_on_hand
           FROM g_inventory WHERE stock_status IN ('critical', 'stockout') GROUP BY product_id, stock_status)
SELECT best.customer_id, best.segment_label AS customer_segment, best.monetary AS lifetime_value, best.recency_days, best.frequency, bought.product_id,
       prod.name AS product_name, prod.category, bought.store_id, shop.name AS store_name, shop.region, states.stock_status,
       ROUND(states.coverage_days, 1) AS coverage_days, states.quantity_on_hand, states.n_stores
FROM states JOIN bought USING (product_id) JOIN best USING (customer_id) JOIN v_products prod ON prod.product_id = bought.product_id
     JOIN v_stores shop ON shop.store_id = bought.store_id
""")

QUERIES: dict[str, str] = {}


def q(name: str, body: str) -> None:
    QUERIES[name] = body.strip()


def sql(body: str) -> str:
    """Prefix the CTE list to a query body."""
    ctes = ",\n".join(f"{n} AS (\n{t}\n)" for n, t in VIEWS)
    if body.lstrip()[:5].upper() == "WITH ":
        return "WITH " + ctes + ",\n" + body.lstrip()[5:]
    return "WITH " + ctes + "\n" + body


def oracle_sql() -> dict[str, str]:
    return {k: sql(v) for k, v in QUERIES.items()}


# ---- queries ------------------------------------------------------------
q("sales_daily", "SELECT * FROM g_sales")
q("sales_by_year", """
SELECT CAST(YEAR(sales_date) AS INT) AS yr, ROUND(SUM(revenue) / 1e6, 1) AS rev_m,
       ROUND(AVG(gross_margin / NULLIF(revenue, 0)) * 100, 1) AS margin_pct
FROM g_sales GROUP BY 1""")
q("line_total", """
SELECT l_returnflag AS returnflag, COUNT(*) AS n_lines,
       CAST(SUM(ROUND(CAST(l_quantity AS INT) * CAST(p_retailprice AS DECIMAL(10,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))), 2)) AS DOUBLE) AS sum_line_total
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1""")
q("velocity", "SELECT store_id, product_id, CAST(sold AS DOUBLE) / days AS avg_daily_sales FROM v_sp_sales")
q("inventory_status", "SELECT * FROM g_inventory")
q("status_mix", """
SELECT stock_status, COUNT(*) AS cnt, ROUND(100.0 * COUNT(*) / SUM(COUNT(*)) OVER (), 1) AS pct,
       ROUND(AVG(coverage_days), 1) AS avg_coverage
FROM g_inventory GROUP BY stock_status""")
q("dim_calendar", "SELECT * FROM dim_calendar")
q("dim_category", "SELECT DISTINCT category FROM v_products")
q("dim_region", "SELECT DISTINCT region FROM v_stores")
q("dim_channel", "SELECT DISTINCT channel FROM v_orders")

q("promo_active", """
SELECT *, make_date(CAST(YEAR((SELECT as_of FROM v_as_of)) AS INT) - 1, 11, 28) BETWEEN start_date AND end_date AS is_active FROM v_promotions""")
q("promo_overlap", """
SELECT category, promo_date, COUNT(*) AS n_promos, array_to_string(list_sort(list(promo_name)), '|') AS promo_names
FROM (SELECT category, promo_name, CAST(UNNEST(generate_series(start_date - 7, end_date, INTERVAL 1 DAY)) AS DATE) AS promo_date FROM v_promotions) d
GROUP BY 1, 2 HAVING COUNT(*) > 1""")
q("store_format", "SELECT * FROM v_stores")
q("distributions", """
SELECT 'store_type' AS dimension, store_type AS value, COUNT(*) AS cnt FROM v_stores GROUP BY 2
UNION ALL SELECT 'channel', channel, COUNT(*) FROM v_orders GROUP BY 2
UNION ALL SELECT 'order_status', order_status, COUNT(*) FROM v_orders GROUP BY 2""")
q("union_audit", """
SELECT 'stores' AS tbl, COUNT(*) AS rows FROM v_stores
UNION ALL SELECT 'products', COUNT(*) FROM v_products
UNION ALL SELECT 'orders', COUNT(*) FROM v_orders
UNION ALL SELECT 'order_items', COUNT(*) FROM v_order_items
UNION ALL SELECT 'promotions', COUNT(*) FROM v_promotions
UNION ALL SELECT 'competitor_prices', COUNT(*) FROM v_competitor_prices
UNION ALL SELECT 'inventory', COUNT(*) FROM v_inventory""")
q("order_date_range", "SELECT MIN(order_date) AS min_date, MAX(order_date) AS max_date, COUNT(*) AS n_orders FROM v_orders")
q("distinct_lists", "SELECT DISTINCT promo_name FROM v_promotions")
q("orphan_items", """
SELECT 'duplicate_order_id' AS "check", COUNT(*) AS n FROM (SELECT order_id FROM v_orders GROUP BY 1 HAVING COUNT(*) > 1) x
UNION ALL SELECT 'duplicate_product_id', COUNT(*) FROM (SELECT product_id FROM v_products GROUP BY 1 HAVING COUNT(*) > 1) x
UNION ALL SELECT 'orders_without_lines', COUNT(*) FROM v_orders o WHERE NOT EXISTS (SELECT 1 FROM v_order_items i WHERE i.order_id = o.order_id)
UNION ALL SELECT 'orders_unknown_store', COUNT(*) FROM v_orders o WHERE NOT EXISTS (SELECT 1 FROM v_stores s WHERE s.store_id = o.store_id)
UNION ALL SELECT 'items_unknown_product', COUNT(*) FROM v_order_items i WHERE NOT EXISTS (SELECT 1 FROM v_products p WHERE p.product_id = i.product_id)""")
q("competitor_summary", """
SELECT competitor, CAST(ROUND(AVG(price_gap_pct), 2) AS DOUBLE) AS avg_gap,
       CAST(SUM(CASE WHEN is_cheaper THEN 1 ELSE 0 END) AS BIGINT) AS cheaper_count
FROM v_competitor_prices GROUP BY competitor""")
q("competitor_latest", """
SELECT snapshot_month, product_id, product_name, category, competitor, CAST(our_price AS DOUBLE) AS our_price,
       CAST(price_gap_pct AS DOUBLE) AS price_gap_pct, is_cheaper, CAST(competitor_price AS DOUBLE) AS competitor_price
FROM v_competitor_prices WHERE snapshot_month = (SELECT MAX(snapshot_month) FROM v_competitor_prices)""")
q("price_gap", """
SELECT snapshot_month, product_id, competitor, CAST(cp AS DOUBLE) AS competitor_price,
       CAST(ROUND((cp - our_price) / our_price * 100, 2) AS DOUBLE) AS gap_from_price_pct,
       ROUND((cp - our_price) / our_price * 100, 2) < 0 AS is_cheaper_from_price
FROM (SELECT *, GREATEST(CAST(0.50 AS DECIMAL(12,2)), competitor_price) AS cp FROM v_competitor_prices) t""")
q("competitor_reprice", """
SELECT snapshot_month, product_id, competitor, CAST(our_price AS DOUBLE) AS our_price, CAST(price_gap_pct AS DOUBLE) AS price_gap_pct,
       CAST(GREATEST(CAST(0.50 AS DECIMAL(12,2)), ROUND(our_price * (1 + price_gap_pct * 0.01), 2)) AS DOUBLE) AS competitor_price,
       price_gap_pct < 0 AS is_cheaper
FROM v_competitor_prices""")
q("median_prices", """
SELECT category, median(CAST(our_price AS DOUBLE)) AS median_our_price, median(CAST(competitor_price AS DOUBLE)) AS median_competitor_price
FROM v_competitor_prices WHERE snapshot_month = (SELECT MAX(snapshot_month) FROM v_competitor_prices) GROUP BY category""")
q("rfm_features", "SELECT * FROM v_rfm")
q("rfm_winsorised", """
WITH f AS (SELECT customer_id, CAST(COALESCE(recency_days, 0) AS DOUBLE) AS recency_days, CAST(COALESCE(frequency, 0) AS DOUBLE) AS frequency,
                  COALESCE(monetary, 0) AS monetary, COALESCE(avg_basket, 0) AS avg_basket, CAST(COALESCE(nb_distinct_products, 0) AS DOUBLE) AS nb_distinct_products
           FROM v_rfm),
     q AS (SELECT quantile_cont(recency_days, 0.99) AS r, quantile_cont(frequency, 0.99) AS f, quantile_cont(monetary, 0.99) AS m,
                  quantile_cont(avg_basket, 0.99) AS b, quantile_cont(nb_distinct_products, 0.99) AS p FROM f)
SELECT customer_id, LEAST(recency_days, q.r) AS recency_days, LEAST(frequency, q.f) AS frequency, LEAST(monetary, q.m) AS monetary,
       LEAST(avg_basket, q.b) AS avg_basket, LEAST(nb_distinct_products, q.p) AS nb_distinct_products
FROM f, q""")
q("segments_rule", "SELECT * FROM v_segments")
q("segment_counts", "SELECT segment_label, COUNT(*) AS count FROM v_segments GROUP BY 1")
q("daily_actuals", "SELECT * FROM v_daily")
q("top_skus", """
SELECT product_id, CAST(SUM(quantity) AS BIGINT) AS total_qty FROM v_order_items GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 200""")
q("forecast_baseline", "SELECT * FROM v_forecast")
q("forecast_vs_actual", "SELECT * FROM g_fva")
q("double_risk", "SELECT * FROM g_double_risk")
q("double_risk_cheapest", """
SELECT product_id, product_name, category, our_price, store_id, store_name, region, stock_status, coverage_days, quantity_on_hand,
       cheapest_competitor, competitor_price, price_gap_pct, n_cheaper
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY product_id, store_id, stock_status, coverage_days, quantity_on_hand
                                   ORDER BY competitor_price, cheapest_competitor, price_gap_pct) AS rn,
             COUNT(*) OVER (PARTITION BY product_id, store_id, stock_status, coverage_days, quantity_on_hand) AS n_cheaper
      FROM g_double_risk) t WHERE rn = 1""")
q("champion_stockout_alert", "SELECT * FROM g_champion")
q("champion_alert_same_store", """
WITH short AS (SELECT store_id, product_id, stock_status, quantity_on_hand, ROUND(coverage_days, 1) AS coverage_days
               FROM g_inventory WHERE stock_status IN ('critical', 'stockout')),
     champions AS (SELECT customer_id, segment_label AS customer_segment, CAST(monetary AS DOUBLE) AS lifetime_value, recency_days, frequency
                   FROM v_segments WHERE segment_label = 'Champions'),
     bought AS (SELECT DISTINCT customer_id, store_id, product_id
                FROM v_orders NATURAL JOIN (SELECT order_id, product_id FROM v_order_items) lines
                WHERE customer_id IN (SELECT customer_id FROM champions))
SELECT champions.*, product_id, pr.name AS product_name, pr.category, store_id, st.name AS store_name, st.region,
       short.stock_status, short.coverage_days, short.quantity_on_hand
FROM bought JOIN champions USING (customer_id) JOIN short USING (store_id, product_id)
     JOIN v_products pr USING (product_id) JOIN v_stores st USING (store_id)""")


# ---- measure helpers (DAX semantics in SQL) -------------------------------
def DSUM(x: str, s: int = 2) -> str:
    return f"CAST(SUM(CAST({x} AS DECIMAL(18,{s}))) AS DOUBLE)"


def DAVG(x: str, s: int = 2) -> str:
    return f"({DSUM(x, s)} / NULLIF(COUNT({x}), 0))"


def DIV(a: str, b: str) -> str:
    return f"(({a}) / NULLIF({b}, 0))"


def CNT(cond: str) -> str:
    return f"NULLIF(CAST(COUNT_IF({cond}) AS BIGINT), 0)"


def BSUB(a: str, b: str) -> str:
    return f"(CASE WHEN ({a}) IS NULL AND ({b}) IS NULL THEN NULL ELSE COALESCE({a}, 0) - COALESCE({b}, 0) END)"


SALES_MEASURES_SQL = f"""{DSUM('revenue')} AS total_revenue, {DSUM('gross_margin')} AS total_margin,
  {DIV(DSUM('gross_margin'), DSUM('revenue'))} AS gross_margin_pct, CAST(SUM(nb_orders) AS BIGINT) AS nb_orders,
  CAST(SUM(units_sold) AS BIGINT) AS units_sold, {DIV(DSUM('revenue'), 'SUM(nb_orders)')} AS avg_basket,
  {DAVG('avg_discount_pct')} AS avg_discount_pct"""
UPLIFT_SQL = BSUB(DIV(DSUM("CASE WHEN is_promo_day = 1 THEN revenue END"), "COUNT(DISTINCT CASE WHEN is_promo_day = 1 THEN sales_date END)"),
                  DIV(DSUM("CASE WHEN is_promo_day = 0 THEN revenue END"), "COUNT(DISTINCT CASE WHEN is_promo_day = 0 THEN sales_date END)"))
INVENTORY_MEASURES_SQL = f"""{DIV(CNT("stock_status = 'stockout'"), 'COUNT(*)')} AS stockout_rate,
  CAST(COUNT_IF(stock_status = 'stockout') AS BIGINT) AS nb_stockout, {CNT("stock_status = 'stockout'")} AS stockouts_display,
  CAST(COUNT_IF(stock_status IN ('stockout', 'critical')) AS BIGINT) AS nb_critical, AVG(quantity_on_hand) AS avg_stock,
  {DAVG('coverage_days', 1)} AS avg_coverage_days"""
FVA_MEASURES_SQL = f"""1 - COALESCE({DIV(DSUM('ABS(actual_qty - forecast_qty)'), 'SUM(actual_qty)')}, 0) AS forecast_accuracy,
  {DAVG('ABS(actual_qty - forecast_qty)')} AS mae_forecast,
  COALESCE({DIV('SUM(actual_qty)', DSUM('forecast_qty'))}, 0) - 1 AS forecast_vs_actual_pct"""
CUSTOMER_MEASURES_SQL = f"""COUNT(DISTINCT customer_id) AS nb_clients, {CNT("segment_label = 'Champions'")} AS nb_champions,
  {DIV(CNT("segment_label = 'Champions'"), 'COUNT(DISTINCT customer_id)')} AS pct_champions,
  {DAVG("CASE WHEN segment_label = 'Champions' THEN monetary END")} AS avg_monetary_champions,
  AVG(recency_days) AS avg_recency_days, {CNT("segment_label = 'At Risk'")} AS nb_at_risk,
  {CNT("segment_label = 'Inactive'")} AS nb_inactive"""
COMPETITOR_MEASURES_SQL = f"""{DAVG('price_gap_pct')} AS avg_price_gap, {DIV(CNT('is_cheaper'), 'COUNT(*)')} AS pct_cheaper,
  {CNT('is_cheaper')} AS nb_cheaper, MAX(CAST(price_gap_pct AS DOUBLE)) AS max_gap"""

view("v_day_series", f"""
SELECT c.date, c.year, c.month_num, c.quarter, d.revenue
FROM dim_calendar c LEFT JOIN (SELECT sales_date AS date, SUM(CAST(revenue AS DECIMAL(18,2))) AS revenue FROM g_sales GROUP BY 1) d ON d.date = c.date
WHERE c.date <= (SELECT as_of FROM v_as_of)
""")

PTD_SQL = """CAST(revenue AS DOUBLE) AS revenue,
  CAST(SUM(revenue) OVER (PARTITION BY {p} year, month_num ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS revenue_mtd,
  CAST(SUM(revenue) OVER (PARTITION BY {p} year, quarter ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS revenue_qtd,
  CAST(SUM(revenue) OVER (PARTITION BY {p} year ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS revenue_ytd,
  CAST(SUM(revenue) OVER ({pp} ORDER BY date RANGE BETWEEN INTERVAL 29 DAYS PRECEDING AND CURRENT ROW) AS DOUBLE) AS revenue_30d_rolling"""

q("mea_sales_by_year", f"SELECT CAST(YEAR(sales_date) AS INT) AS year, {SALES_MEASURES_SQL} FROM g_sales GROUP BY 1")
q("mea_sales_by_region_channel", f"SELECT region, channel, {SALES_MEASURES_SQL} FROM g_sales GROUP BY 1, 2")
q("mea_promo_uplift", f"SELECT category, {UPLIFT_SQL} AS revenue_uplift_promo FROM g_sales GROUP BY 1")
q("mea_order_count", """
SELECT a.year, a.nb_orders, b.nb_orders_distinct
FROM (SELECT CAST(YEAR(sales_date) AS INT) AS year, CAST(SUM(nb_orders) AS BIGINT) AS nb_orders FROM g_sales GROUP BY 1) a
JOIN (SELECT CAST(YEAR(o.order_date) AS INT) AS year, COUNT(DISTINCT o.order_id) AS nb_orders_distinct
      FROM v_orders o JOIN v_order_items i ON o.order_id = i.order_id GROUP BY 1) b ON a.year = b.year""")
q("mea_inventory_by_region", f"SELECT region, {INVENTORY_MEASURES_SQL} FROM g_inventory GROUP BY 1")
q("mea_inventory_total", f"SELECT {INVENTORY_MEASURES_SQL} FROM g_inventory")
q("mea_forecast_by_category", f"SELECT category, {FVA_MEASURES_SQL} FROM g_fva GROUP BY 1")
q("mea_forecast_horizon", f"""
SELECT {DSUM("CASE WHEN forecast_date BETWEEN (SELECT cutoff FROM v_cutoff) + 1 AND (SELECT cutoff FROM v_cutoff) + 30 THEN forecast_qty END")} AS forecast_30d,
       {DSUM("CASE WHEN forecast_date BETWEEN (SELECT cutoff FROM v_cutoff) + 1 AND (SELECT cutoff FROM v_cutoff) + 90 THEN forecast_qty END")} AS forecast_90d
FROM v_forecast""")
q("mea_customers", f"SELECT {CUSTOMER_MEASURES_SQL} FROM v_segments")
q("mea_competitor_by_category", f"SELECT category, {COMPETITOR_MEASURES_SQL} FROM v_competitor_prices GROUP BY 1")
q("mea_time_intel_daily", "SELECT date, " + PTD_SQL.format(p="", pp="") + " FROM v_day_series")
q("mea_vs_ly_daily", """
SELECT c.date, CAST(c.revenue AS DOUBLE) AS revenue, CAST(l.revenue AS DOUBLE) AS revenue_ly,
       """ + DIV(BSUB("CAST(c.revenue AS DOUBLE)", "CAST(l.revenue AS DOUBLE)"), "CAST(l.revenue AS DOUBLE)") + """ AS revenue_vs_ly
FROM v_day_series c LEFT JOIN v_day_series l ON l.date = CAST(c.date - INTERVAL 12 MONTH AS DATE)""")
view("v_month_rev", f"SELECT CAST(YEAR(sales_date) AS INT) AS year, CAST(MONTH(sales_date) AS INT) AS month_num, {DSUM('revenue')} AS revenue FROM g_sales GROUP BY 1, 2")
q("mea_vs_ly_monthly", """
WITH m AS (SELECT year * 12 + month_num - 1 AS mi, revenue FROM v_month_rev),
     x AS (SELECT COALESCE(m.mi, l.mi + 12) AS mi, m.revenue, l.revenue AS revenue_ly FROM m FULL JOIN m l ON m.mi = l.mi + 12)
SELECT CAST(mi // 12 AS INT) AS year, CAST(mi % 12 + 1 AS INT) AS month_num, (mi // 12) || '-' || LPAD(CAST(mi % 12 + 1 AS VARCHAR), 2, '0') AS year_month,
       revenue, revenue_ly, """ + DIV(BSUB("revenue", "revenue_ly"), "revenue_ly") + """ AS revenue_vs_ly
FROM x WHERE mi <= (SELECT YEAR(as_of) * 12 + MONTH(as_of) - 1 FROM v_as_of)""")
q("mea_time_intel_region", """
SELECT region, date, """ + PTD_SQL.format(p="region,", pp="PARTITION BY region") + """
FROM (SELECT g.region, c.date, c.year, c.month_num, c.quarter, d.revenue
      FROM dim_calendar c CROSS JOIN (SELECT DISTINCT region FROM g_sales) g
      LEFT JOIN (SELECT region, sales_date AS date, SUM(CAST(revenue AS DECIMAL(18,2))) AS revenue FROM g_sales GROUP BY 1, 2) d
           ON d.date = c.date AND d.region = g.region
      WHERE c.date <= (SELECT as_of FROM v_as_of)) s""")

# ---- questions ------------------------------------------------------------
GM_PCT = DIV(DSUM("gross_margin"), DSUM("revenue"))
q("q_01_stores_at_risk", """
SELECT store_id, store_name, region, COUNT(*) AS n_products_at_risk, CAST(COUNT_IF(stock_status = 'stockout') AS BIGINT) AS n_stockout
FROM g_inventory WHERE stock_status IN ('stockout', 'critical') GROUP BY 1, 2, 3""")
q("q_01_stores_at_risk_europe", """
SELECT store_id, store_name, region, COUNT(*) AS n_products_at_risk, CAST(COUNT_IF(stock_status = 'stockout') AS BIGINT) AS n_stockout
FROM g_inventory WHERE stock_status IN ('stockout', 'critical') AND region = 'EUROPE' GROUP BY 1, 2, 3""")
q("q_02_margin_by_category_year", f"""
WITH g AS (SELECT category, CAST(YEAR(sales_date) AS INT) AS year, {GM_PCT} AS gross_margin_pct FROM g_sales GROUP BY 1, 2)
SELECT g.category, g.year, g.gross_margin_pct, p.gross_margin_pct AS gross_margin_pct_ly,
       g.gross_margin_pct < p.gross_margin_pct AS declining
FROM g LEFT JOIN g p ON p.category = g.category AND p.year + 1 = g.year""")
q("q_03_accuracy_price_pressure", f"""
WITH a AS (SELECT category, 1 - COALESCE({DIV(DSUM('ABS(actual_qty - forecast_qty)'), 'SUM(actual_qty)')}, 0) AS forecast_accuracy FROM g_fva GROUP BY 1),
     p AS (SELECT category, {DAVG('price_gap_pct')} AS avg_price_gap FROM v_competitor_prices GROUP BY 1),
     x AS (SELECT a.category, a.forecast_accuracy, p.avg_price_gap,
                  CAST(RANK() OVER (ORDER BY a.forecast_accuracy ASC NULLS LAST) AS INT) AS accuracy_rank,
                  CAST(RANK() OVER (ORDER BY p.avg_price_gap ASC NULLS LAST) AS INT) AS pressure_rank
           FROM a JOIN p ON a.category = p.category)
SELECT *, accuracy_rank + pressure_rank AS combined_rank FROM x""")
q("q_04_stockout_and_cheaper", "SELECT * FROM g_double_risk WHERE stock_status = 'stockout'")
view("v_q05", """
SELECT customer_id, lifetime_value, recency_days, frequency, COUNT(DISTINCT product_id) AS n_products
FROM g_champion WHERE stock_status = 'stockout' GROUP BY 1, 2, 3, 4
""")
q("q_05_champions_at_risk", "SELECT * FROM v_q05")
q("q_05_summary", f"SELECT COUNT(*) AS n_customers, {DSUM('lifetime_value')} AS ltv_at_risk FROM v_q05")
q("q_07_store_counts", "SELECT region, city, store_type, COUNT(*) AS n_stores FROM v_stores GROUP BY 1, 2, 3")
q("q_08_promotions_active", "SELECT * FROM v_promotions WHERE make_date(CAST(YEAR((SELECT as_of FROM v_as_of)) AS INT) - 1, 11, 28) BETWEEN start_date AND end_date")
q("q_09_category_products", f"SELECT category, COUNT(*) AS n_active_products, {DAVG('unit_price')} AS avg_unit_price FROM v_products WHERE is_active GROUP BY 1")
q("q_10_champion_customers", "SELECT customer_id, segment_label, monetary, recency_days, frequency FROM v_segments WHERE segment_label = 'Champions'")
CHEAPER_SQL = """SELECT product_id, product_name, category, competitor, CAST(our_price AS DOUBLE) AS our_price,
       CAST(competitor_price AS DOUBLE) AS competitor_price, CAST(price_gap_pct AS DOUBLE) AS price_gap_pct
FROM v_competitor_prices WHERE snapshot_month = (SELECT MAX(snapshot_month) FROM v_competitor_prices) AND is_cheaper"""
q("q_11_cheaper_at_bonprix", CHEAPER_SQL + " AND competitor = 'BonPrix'")
q("q_11_undercut_beyond_10pct", CHEAPER_SQL + " AND price_gap_pct < -10.0")
view("v_prod_acc", f"""
SELECT product_id, product_name, category, 1 - COALESCE({DIV(DSUM('ABS(actual_qty - forecast_qty)'), 'SUM(actual_qty)')}, 0) AS forecast_accuracy,
       {DAVG('ABS(actual_qty - forecast_qty)')} AS mae_forecast
FROM g_fva GROUP BY 1, 2, 3
""")
q("q_12_low_accuracy", "SELECT * FROM v_prod_acc WHERE forecast_accuracy < 0.75")
q("q_12_worst10", "SELECT * FROM v_prod_acc ORDER BY forecast_accuracy, product_id LIMIT 10")
view("v_fc30", f"""
SELECT product_id, {DSUM('forecast_qty')} AS forecast_units, {DSUM('forecast_qty')} / 30 AS units_per_day
FROM v_forecast WHERE forecast_date BETWEEN (SELECT cutoff FROM v_cutoff) + 1 AND (SELECT cutoff FROM v_cutoff) + 30 GROUP BY 1
""")
q("q_13_top_forecast", "SELECT * FROM v_fc30 ORDER BY forecast_units DESC, product_id LIMIT 10")
q("q_13_high_daily_demand", "SELECT * FROM v_fc30 WHERE units_per_day > 1.0")
q("q_14_stores_rain", """
SELECT s.store_id, s.name AS store_name, s.region, s.city, w.date, w.rainfall_mm, w.weather_condition
FROM v_stores s JOIN v_weather w ON w.city = s.city
WHERE w.date = (SELECT as_of FROM v_as_of) AND w.weather_condition = 'pluie'""")
q("q_15_kpis", f"""
SELECT {GM_PCT} AS gross_margin_pct, {DIV(DSUM('revenue'), 'SUM(nb_orders)')} AS avg_basket,
       (SELECT 1 - COALESCE({DIV(DSUM('ABS(actual_qty - forecast_qty)'), 'SUM(actual_qty)')}, 0) FROM g_fva) AS forecast_accuracy,
       (SELECT CAST(COUNT_IF(stock_status = 'stockout') AS BIGINT) FROM g_inventory) AS nb_stockout,
       (SELECT {DAVG('coverage_days', 1)} FROM g_inventory) AS avg_coverage_days,
       (SELECT {DIV(CNT('is_cheaper'), 'COUNT(*)')} FROM v_competitor_prices) AS pct_cheaper,
       (SELECT {DSUM('revenue')} FROM g_sales WHERE YEAR(sales_date) = YEAR((SELECT as_of FROM v_as_of)) AND sales_date <= (SELECT as_of FROM v_as_of)) AS revenue_ytd
FROM g_sales""")
q("q_16_year_over_year", f"""
WITH y AS (SELECT CAST(YEAR(sales_date) AS INT) AS year, {DSUM('revenue')} AS revenue FROM g_sales GROUP BY 1),
     x AS (SELECT COALESCE(y.year, p.year + 1) AS year, y.revenue, p.revenue AS revenue_ly FROM y FULL JOIN y p ON p.year + 1 = y.year)
SELECT *, {DIV(BSUB('revenue', 'revenue_ly'), 'revenue_ly')} AS growth FROM x WHERE year <= (SELECT YEAR(as_of) FROM v_as_of)""")
q("q_16_quarter_over_quarter", f"""
WITH y AS (SELECT YEAR(sales_date) * 4 + QUARTER(sales_date) - 1 AS qi, {DSUM('revenue')} AS revenue FROM g_sales GROUP BY 1),
     x AS (SELECT COALESCE(y.qi, p.qi + 4) AS qi, y.revenue, p.revenue AS revenue_ly FROM y FULL JOIN y p ON p.qi + 4 = y.qi)
SELECT CAST(qi // 4 AS INT) AS year, CAST(qi % 4 + 1 AS INT) AS quarter, revenue, revenue_ly,
       {DIV(BSUB('revenue', 'revenue_ly'), 'revenue_ly')} AS growth
FROM x WHERE qi <= (SELECT YEAR(as_of) * 4 + QUARTER(as_of) - 1 FROM v_as_of)""")
q("q_17_best_periods", f"""
WITH m AS (SELECT CAST(YEAR(sales_date) AS INT) AS year, CAST(MONTH(sales_date) AS INT) AS month, {DSUM('revenue')} AS revenue FROM g_sales GROUP BY 1, 2),
     bm AS (SELECT year, month AS best_month, revenue AS best_month_revenue FROM
              (SELECT *, ROW_NUMBER() OVER (PARTITION BY year ORDER BY revenue DESC, month) AS rn FROM m) t WHERE rn = 1),
     qq AS (SELECT CAST(YEAR(sales_date) AS INT) AS year, CAST(QUARTER(sales_date) AS INT) AS quarter, {GM_PCT} AS gross_margin_pct FROM g_sales GROUP BY 1, 2),
     bq AS (SELECT year, quarter AS best_margin_quarter, gross_margin_pct AS best_quarter_margin_pct FROM
              (SELECT *, ROW_NUMBER() OVER (PARTITION BY year ORDER BY gross_margin_pct DESC, quarter) AS rn FROM qq) t WHERE rn = 1)
SELECT bm.year, bm.best_month, bm.best_month_revenue, bq.best_margin_quarter, bq.best_quarter_margin_pct
FROM bm JOIN bq ON bm.year = bq.year""")
q("q_18_month_over_month", f"""
WITH m AS (SELECT YEAR(sales_date) * 12 + MONTH(sales_date) - 1 AS mi, {DSUM('revenue')} AS revenue FROM g_sales GROUP BY 1),
     x AS (SELECT COALESCE(m.mi, p.mi + 1) AS mi, m.revenue, p.revenue AS revenue_prev_month FROM m FULL JOIN m p ON p.mi + 1 = m.mi)
SELECT CAST(mi // 12 AS INT) AS year, CAST(mi % 12 + 1 AS INT) AS month, revenue, revenue_prev_month,
       {DIV(BSUB('revenue', 'revenue_prev_month'), 'revenue_prev_month')} AS growth
FROM x WHERE mi <= (SELECT YEAR(as_of) * 12 + MONTH(as_of) - 1 FROM v_as_of)""")
q("q_18_ytd_vs_ly", f"""
WITH a AS (SELECT as_of, CAST(as_of - INTERVAL 12 MONTH AS DATE) AS ly_end FROM v_as_of),
     x AS (SELECT {DSUM("CASE WHEN YEAR(sales_date) = YEAR(a.as_of) AND sales_date <= a.as_of THEN revenue END")} AS revenue_ytd,
                  {DSUM("CASE WHEN YEAR(sales_date) = YEAR(a.ly_end) AND sales_date <= a.ly_end THEN revenue END")} AS revenue_ytd_ly
           FROM g_sales, a
           WHERE (YEAR(sales_date) = YEAR(a.as_of) AND sales_date <= a.as_of) OR (YEAR(sales_date) = YEAR(a.ly_end) AND sales_date <= a.ly_end))
SELECT *, {DIV('revenue_ytd - revenue_ytd_ly', 'revenue_ytd_ly')} AS growth FROM x""")
q("q_19_promo_yoy", f"""
WITH y AS (SELECT promo_name, CAST(YEAR(sales_date) AS INT) AS year, {DSUM('revenue')} AS revenue, CAST(SUM(nb_orders) AS BIGINT) AS nb_orders
           FROM g_sales WHERE promo_name IS NOT NULL GROUP BY 1, 2),
     x AS (SELECT COALESCE(y.promo_name, p.promo_name) AS promo_name, COALESCE(y.year, p.year + 1) AS year, y.revenue, y.nb_orders,
                  p.revenue AS revenue_ly
           FROM y FULL JOIN y p ON p.promo_name = y.promo_name AND p.year + 1 = y.year)
SELECT *, {DIV(BSUB('revenue', 'revenue_ly'), 'revenue_ly')} AS growth FROM x WHERE year <= (SELECT YEAR(as_of) FROM v_as_of)""")
q("q_21_top_stores", f"SELECT store_id, store_name, region, {DSUM('revenue')} AS total_revenue FROM g_sales GROUP BY 1, 2, 3 ORDER BY total_revenue DESC, store_id LIMIT 5")
q("q_21_regions_by_stockout", f"""
SELECT * FROM (SELECT *, CAST(ROW_NUMBER() OVER (ORDER BY stockout_rate DESC NULLS LAST, region) AS INT) AS rank FROM (
  SELECT region, {DIV(CNT("stock_status = 'stockout'"), 'COUNT(*)')} AS stockout_rate, CAST(COUNT_IF(stock_status = 'stockout') AS BIGINT) AS nb_stockout FROM g_inventory GROUP BY 1) g) t
WHERE rank <= 3""")
q("q_21_categories_by_margin", f"""
SELECT *, CAST(ROW_NUMBER() OVER (ORDER BY gross_margin_pct DESC NULLS LAST, category) AS INT) AS rank
FROM (SELECT category, {GM_PCT} AS gross_margin_pct, {DSUM('gross_margin')} AS total_margin FROM g_sales GROUP BY 1) g""")
q("q_22_low_coverage_stores", f"""
SELECT * FROM (SELECT store_id, store_name, region, {DAVG('coverage_days', 1)} AS avg_coverage_days FROM g_inventory GROUP BY 1, 2, 3) t WHERE avg_coverage_days < 60.0""")
q("q_23_segments_by_ltv", f"SELECT segment_label, {DAVG('monetary')} AS avg_ltv, COUNT(*) AS n_customers FROM v_segments GROUP BY 1")
q("q_24_promo_uplift", f"""
WITH g AS (SELECT promo_name, {DSUM('revenue')} AS revenue, SUM(nb_orders) AS orders, COUNT(DISTINCT sales_date) AS days FROM g_sales GROUP BY 1),
     b AS (SELECT revenue / days AS rev, orders / days AS ord FROM g WHERE promo_name IS NULL),
     t AS (SELECT promo_name, MAX(CAST(traffic_boost AS DOUBLE)) AS traffic_boost FROM v_promotions GROUP BY 1)
SELECT g.promo_name, g.revenue / g.days AS revenue_per_day, g.revenue / g.days - b.rev AS revenue_uplift_per_day,
       (g.orders / g.days) / b.ord AS orders_ratio, t.traffic_boost, (g.orders / g.days) / b.ord < t.traffic_boost AS below_expected
FROM g CROSS JOIN b LEFT JOIN t ON t.promo_name = g.promo_name WHERE g.promo_name IS NOT NULL""")
q("q_25_critical_undercut", "SELECT * FROM g_double_risk WHERE stock_status = 'critical'")
q("q_29_urgent_stores", f"""
SELECT *, avg_coverage_days < 7 AS urgent_replenishment, COALESCE(stockout_rate > 0.006, FALSE) AS critical_situation
FROM (SELECT store_id, store_name, region, {DAVG('coverage_days', 1)} AS avg_coverage_days,
             {DIV(CNT("stock_status = 'stockout'"), 'COUNT(*)')} AS stockout_rate FROM g_inventory GROUP BY 1, 2, 3) t
WHERE avg_coverage_days < 7 OR COALESCE(stockout_rate > 0.006, FALSE)""")

# ---- operational tables -----------------------------------------------------
view("v_stock_alerts", """
SELECT store_id, product_id, CASE WHEN stock_status = 'stockout' THEN 'stockout' ELSE 'critical_stock' END AS alert_type,
       CASE WHEN stock_status = 'stockout' THEN 'critical' ELSE 'high' END AS severity,
       CASE WHEN stock_status = 'stockout' THEN 'Product ' || product_id || ' out of stock at store ' || store_id
            ELSE 'Product ' || product_id || ' below safety stock at store ' || store_id END AS message,
       CAST(last_updated AS TIMESTAMP) AS created_at, 'active' AS status
FROM g_inventory WHERE stock_status IN ('stockout', 'critical')
""")
view("v_transfers", """
WITH short AS (
  SELECT store_id AS to_store_id, product_id, region, stock_status, GREATEST(reorder_point - quantity_on_hand, 1) AS need, last_updated
  FROM g_inventory WHERE stock_status IN ('stockout', 'critical')),
donors AS (SELECT store_id AS from_store_id, product_id, region, quantity_on_hand - reorder_point AS excess FROM g_inventory WHERE quantity_on_hand > reorder_point),
ns AS (SELECT *, SUM(need) OVER (PARTITION BY product_id, region ORDER BY stock_status <> 'stockout', need DESC, to_store_id ROWS UNBOUNDED PRECEDING) AS e, e - need AS b FROM short),
ds AS (SELECT *, SUM(excess) OVER (PARTITION BY product_id, region ORDER BY excess DESC, from_store_id ROWS UNBOUNDED PRECEDING) AS e, e - excess AS b FROM donors),
near AS (SELECT ns.product_id, to_store_id, from_store_id, LEAST(ns.e, ds.e) - GREATEST(ns.b, ds.b) AS quantity, stock_status, last_updated
         FROM ns JOIN ds ON ns.product_id = ds.product_id AND ns.region = ds.region AND ns.b < ds.e AND ds.b < ns.e),
rest AS (SELECT * FROM (SELECT short.* REPLACE (need - COALESCE((SELECT SUM(quantity) FROM near WHERE near.product_id = short.product_id AND near.to_store_id = short.to_store_id), 0) AS need) FROM short) r WHERE need > 0),
spare AS (SELECT * FROM (SELECT donors.* REPLACE (excess - COALESCE((SELECT SUM(quantity) FROM near WHERE near.product_id = donors.product_id AND near.from_store_id = donors.from_store_id), 0) AS excess) FROM donors) d WHERE excess > 0),
nf AS (SELECT *, SUM(need) OVER (PARTITION BY product_id ORDER BY stock_status <> 'stockout', need DESC, to_store_id ROWS UNBOUNDED PRECEDING) AS e, e - need AS b FROM rest),
df AS (SELECT *, SUM(excess) OVER (PARTITION BY product_id ORDER BY excess DESC, from_store_id ROWS UNBOUNDED PRECEDING) AS e, e - excess AS b FROM spare),
moved AS (SELECT * FROM near UNION ALL
          SELECT nf.product_id, to_store_id, from_store_id, LEAST(nf.e, df.e) - GREATEST(nf.b, df.b), stock_status, last_updated
          FROM nf JOIN df ON nf.product_id = df.product_id AND nf.b < df.e AND df.b < nf.e)
SELECT from_store_id, to_store_id, product_id, CAST(quantity AS INT) AS quantity,
       CASE WHEN stock_status = 'stockout' THEN 'stockout_reflex' ELSE 'critical_stock_reflex' END AS reason, CAST(last_updated AS TIMESTAMP) AS created_at,
       CASE WHEN (SELECT as_of FROM v_as_of) - last_updated <= 7 THEN 'pending' WHEN (SELECT as_of FROM v_as_of) - last_updated <= 30 THEN 'in_transit' ELSE 'completed' END AS status
FROM moved
""")
view("v_offers", """
WITH fav AS (SELECT customer_id, category FROM
               (SELECT customer_id, category, ROW_NUMBER() OVER (PARTITION BY customer_id ORDER BY spend DESC, category DESC) AS rn
                FROM (SELECT o.customer_id, p.category, SUM(i.line_total) AS spend FROM v_orders o JOIN v_order_items i ON o.order_id = i.order_id
                      JOIN v_products p ON p.product_id = i.product_id GROUP BY 1, 2) s) t WHERE rn = 1)
SELECT s.customer_id, CASE WHEN s.segment_label = 'At Risk' AND s.recency_days > 90 THEN 'loyalty_discount' ELSE 'win_back' END AS offer_type,
       CASE WHEN s.segment_label = 'At Risk' AND s.recency_days > 90 THEN CAST(15.00 AS DECIMAL(5,2)) ELSE CAST(20.00 AS DECIMAL(5,2)) END AS discount_pct,
       f.category, CAST((SELECT as_of FROM v_as_of) + 30 AS DATE) AS valid_until, CAST(LEAST(s.last_order_date + 91, (SELECT as_of FROM v_as_of)) AS TIMESTAMP) AS generated_at
FROM v_segments s LEFT JOIN fav f ON f.customer_id = s.customer_id
WHERE (s.segment_label = 'At Risk' AND s.recency_days > 90) OR (s.segment_label = 'Inactive' AND s.monetary > 500)
""")
view("v_pos", """
SELECT event_id, CAST(ts AS TIMESTAMP) AS ts, user_id % (SELECT COUNT(*) FROM supplier) AS store_id, value FROM events WHERE event_type = 'purchase'
""")
view("v_incidents", """
SELECT user_id % (SELECT COUNT(*) FROM supplier) AS store_id, 'pos_error' AS incident_type, 'Error event ' || event_id AS description,
       CAST(ts AS TIMESTAMP) AS created_at,
       CASE WHEN ts >= (SELECT MAX(ts) FROM events) - INTERVAL 48 HOUR THEN 'open' ELSE 'resolved' END AS status
FROM events WHERE event_type = 'error'
""")
view("v_spikes", """
WITH d AS (SELECT store_id, CAST(ts AS DATE) AS day, COUNT(*) AS n FROM v_pos GROUP BY 1, 2),
     x AS (SELECT *, SUM(n) OVER (PARTITION BY store_id ORDER BY day RANGE BETWEEN INTERVAL 7 DAYS PRECEDING AND INTERVAL 1 DAYS PRECEDING) AS prev FROM d)
SELECT store_id, CAST(NULL AS BIGINT) AS product_id, 'sales_spike' AS alert_type, 'medium' AS severity,
       'Unusual sales spike at store ' || store_id AS message, CAST(day + 1 AS TIMESTAMP) AS created_at, 'active' AS status
FROM x WHERE prev IS NOT NULL AND n * 7 > 3.0 * prev
""")
view("v_silences", """
WITH p AS (SELECT store_id, ts, LAG(ts) OVER (PARTITION BY store_id ORDER BY ts) AS prev_ts FROM v_pos)
SELECT store_id, CAST(NULL AS BIGINT) AS product_id, 'pos_silence' AS alert_type, 'high' AS severity,
       'No POS transactions for 45 minutes' AS message, prev_ts + INTERVAL 45 MINUTE AS created_at, 'active' AS status
FROM p WHERE prev_ts IS NOT NULL AND ts > prev_ts + INTERVAL 45 MINUTE
""")
view("v_alerts", """
SELECT * FROM v_stock_alerts UNION ALL SELECT * FROM v_spikes UNION ALL SELECT * FROM v_silences
""")
q("stock_alerts", "SELECT * FROM v_stock_alerts")
q("transfer_proposals", "SELECT * FROM v_transfers")
q("retention_offers", "SELECT customer_id, offer_type, CAST(discount_pct AS DOUBLE) AS discount_pct, category, valid_until, generated_at FROM v_offers")
q("incidents", "SELECT * FROM v_incidents")
q("sales_spike", "SELECT * FROM v_spikes")
q("pos_silence", "SELECT * FROM v_silences")
q("transfers_by_status", "SELECT status, COUNT(*) AS cnt, CAST(SUM(quantity) AS BIGINT) AS total_units FROM v_transfers GROUP BY 1")
q("q_06_transfers_this_week", """
SELECT status, COUNT(*) AS cnt, CAST(SUM(quantity) AS BIGINT) AS total_units FROM v_transfers
WHERE created_at >= CAST((SELECT as_of FROM v_as_of) AS TIMESTAMP) - INTERVAL 7 DAY GROUP BY 1""")
q("alerts_by_severity", """
SELECT alert_type, severity, COUNT(*) AS cnt,
       CASE severity WHEN 'critical' THEN 1 WHEN 'high' THEN 2 WHEN 'medium' THEN 3 ELSE 4 END AS severity_rank
FROM v_alerts WHERE status = 'active' GROUP BY 1, 2""")
q("q_26_stores_most_alerts", """
SELECT a.store_id, a.n_alerts, s.name AS store_name, s.region
FROM (SELECT store_id, COUNT(*) AS n_alerts FROM v_alerts WHERE status = 'active' GROUP BY 1) a JOIN v_stores s ON s.store_id = a.store_id
ORDER BY a.n_alerts DESC, a.store_id LIMIT 10""")
q("q_26_open_incidents", "SELECT store_id, COUNT(*) AS open_incidents FROM v_incidents WHERE status = 'open' GROUP BY 1")
q("offers_this_week", """
SELECT offer_type, COUNT(*) AS cnt, CAST(ROUND(AVG(discount_pct), 1) AS DOUBLE) AS avg_discount
FROM v_offers WHERE generated_at >= CAST((SELECT as_of FROM v_as_of) AS TIMESTAMP) - INTERVAL 7 DAY GROUP BY 1""")
q("q_28_regions_stockout_transfers", f"""
WITH r AS (SELECT region, {DIV(CNT("stock_status = 'stockout'"), 'COUNT(*)')} AS stockout_rate FROM g_inventory GROUP BY 1),
     t AS (SELECT s.region, COUNT(*) AS pending_transfers FROM v_transfers t JOIN v_stores s ON s.store_id = t.to_store_id WHERE t.status = 'pending' GROUP BY 1)
SELECT r.region, r.stockout_rate, COALESCE(t.pending_transfers, 0) AS pending_transfers FROM r LEFT JOIN t ON t.region = r.region""")

# ---- reports ------------------------------------------------------------------
q("rpt_02_top_stores", f"SELECT store_id, store_name, region, {DSUM('revenue')} AS total_revenue FROM g_sales GROUP BY 1, 2, 3 ORDER BY total_revenue DESC, store_id LIMIT 10")
q("rpt_02_top_stores_sliced", f"""SELECT store_id, store_name, region, {DSUM('revenue')} AS total_revenue FROM g_sales
WHERE YEAR(sales_date) = 2000 AND channel = 'in_store' GROUP BY 1, 2, 3 ORDER BY total_revenue DESC, store_id LIMIT 10""")
q("rpt_03_region_map", f"SELECT region, {DSUM('revenue')} AS total_revenue, {GM_PCT} AS gross_margin_pct FROM g_sales GROUP BY 1")
q("rpt_05_category_region", f"""SELECT category, region, {CNT("stock_status = 'stockout'")} AS stockouts_display, {DAVG('coverage_days', 1)} AS avg_coverage_days
FROM g_inventory WHERE region IS NOT NULL GROUP BY 1, 2""")
q("rpt_07_actual_vs_forecast", f"""SELECT forecast_date, CAST(SUM(actual_qty) AS BIGINT) AS actual_qty, {DSUM('forecast_qty')} AS forecast_qty,
  {DSUM('forecast_qty_lower')} AS forecast_qty_lower, {DSUM('forecast_qty_upper')} AS forecast_qty_upper FROM g_fva GROUP BY 1""")
q("rpt_09_weather_revenue", f"""
SELECT w.weather_condition, {DAVG('w.max_temperature_c', 1)} AS avg_max_temperature_c, {DSUM('g.revenue')} AS total_revenue,
       CAST(SUM(g.nb_orders) AS BIGINT) AS nb_orders
FROM g_sales g JOIN v_stores s ON s.store_id = g.store_id JOIN v_weather w ON w.city = s.city AND w.date = g.sales_date
GROUP BY 1""")
q("rpt_10_future_forecast", f"""SELECT forecast_date, {DSUM('forecast_qty')} AS forecast_qty, {DSUM('forecast_qty_lower')} AS forecast_qty_lower,
  {DSUM('forecast_qty_upper')} AS forecast_qty_upper FROM v_forecast WHERE forecast_date > (SELECT cutoff FROM v_cutoff) GROUP BY 1""")
q("rpt_11_segment_bubble", f"SELECT segment_label, AVG(recency_days) AS avg_recency_days, {DAVG('monetary')} AS avg_ltv, COUNT(DISTINCT customer_id) AS nb_clients FROM v_segments GROUP BY 1")
q("rpt_12_format_category_stockout", f"""SELECT s.store_type, i.category, {DIV(CNT("i.stock_status = 'stockout'"), 'COUNT(*)')} AS stockout_rate
FROM g_inventory i JOIN v_stores s ON s.store_id = i.store_id GROUP BY 1, 2""")
q("rpt_13_gap_category_competitor", f"SELECT category, competitor, {DAVG('price_gap_pct')} AS avg_price_gap FROM v_competitor_prices GROUP BY 1, 2")
q("rpt_14_store_category", f"SELECT store_id, category, {DSUM('revenue')} AS total_revenue, {GM_PCT} AS gross_margin_pct FROM g_sales GROUP BY 1, 2")
q("rpt_14_store_monthly", f"SELECT store_id, CAST(YEAR(sales_date) * 100 + MONTH(sales_date) AS INT) AS year_month_sort, {DSUM('revenue')} AS total_revenue FROM g_sales GROUP BY 1, 2")
q("rpt_14_top_products", """
WITH g AS (SELECT o.store_id, i.product_id, CAST(ROUND(SUM(i.quantity * i.unit_price * (1 - i.discount_pct * 0.01)), 2) AS DOUBLE) AS revenue,
                  CAST(SUM(i.quantity) AS BIGINT) AS units_sold
           FROM v_orders o JOIN v_order_items i ON o.order_id = i.order_id GROUP BY 1, 2),
     t AS (SELECT *, CAST(ROW_NUMBER() OVER (PARTITION BY store_id ORDER BY revenue DESC, product_id) AS INT) AS rank FROM g)
SELECT t.*, p.name AS product_name, p.category FROM t JOIN v_products p ON p.product_id = t.product_id WHERE rank <= 20""")
q("weather", "SELECT * FROM v_weather")


# ---- streaming --------------------------------------------------------------
q("stream_sales_tumbling", """
SELECT * FROM (SELECT date_trunc('day', ts) AS window_start, date_trunc('day', ts) + INTERVAL 1 DAY AS window_end, event_type,
                      COUNT(*) AS n, CAST(SUM(CAST(value AS DECIMAL(12,2))) AS DOUBLE) AS total_value
               FROM events GROUP BY 1, 2, 3) t
WHERE window_end <= (SELECT MAX(ts) FROM events) - INTERVAL 1 HOUR""")
q("stream_sales_sliding", """
WITH s AS (SELECT ts, event_type, value, UNNEST(generate_series(0, 3)) AS k FROM events),
     w AS (SELECT time_bucket(INTERVAL 6 HOUR, ts) - k * INTERVAL 6 HOUR AS window_start, event_type, value FROM s)
SELECT * FROM (SELECT window_start, window_start + INTERVAL 1 DAY AS window_end, event_type, COUNT(*) AS n,
                      CAST(SUM(CAST(value AS DECIMAL(12,2))) AS DOUBLE) AS total_value FROM w GROUP BY 1, 2, 3) t
WHERE window_end <= (SELECT MAX(ts) FROM events) - INTERVAL 1 HOUR""")
q("stream_sales_totals_merged", """
SELECT date_trunc('day', ts) AS window_start, date_trunc('day', ts) + INTERVAL 1 DAY AS window_end, event_type, COUNT(*) AS n,
       CAST(SUM(CAST(value AS DECIMAL(12,2))) AS DOUBLE) AS total_value FROM events GROUP BY 1, 2, 3""")
q("stream_pos_sessions", """
WITH p AS (SELECT user_id % (SELECT COUNT(*) FROM supplier) AS store_id, ts FROM events WHERE event_type = 'purchase'),
     g AS (SELECT *, CASE WHEN LAG(ts) OVER (PARTITION BY store_id ORDER BY ts) + INTERVAL 45 MINUTE > ts THEN 0 ELSE 1 END AS new_s FROM p),
     n AS (SELECT *, SUM(new_s) OVER (PARTITION BY store_id ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sid FROM g)
SELECT * FROM (SELECT store_id, MIN(ts) AS session_start, MAX(ts) + INTERVAL 45 MINUTE AS silence_from, COUNT(*) AS n_events
               FROM n GROUP BY store_id, sid) t
WHERE silence_from <= (SELECT MAX(ts) FROM events WHERE event_type = 'purchase') - INTERVAL 1 HOUR""")
CDC_SQL = """
SELECT key, seq, event_type, value, ts FROM (
  SELECT user_id AS key, event_id AS seq, event_type, value, ts,
         ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events) t
WHERE rn = 1 AND event_type <> 'error'"""
q("cdc_state", CDC_SQL)
q("stream_cdc_apply", CDC_SQL)


# ---- entity model -------------------------------------------------------------
q("ents_store", "SELECT store_id, name, city, region, surface_m2 AS Store_Size_m2, store_type AS Store_Format FROM v_stores")
q("ents_product", """SELECT product_id, name, category AS Product_Category, subcategory AS Product_Subcategory,
  CAST(unit_price AS DOUBLE) AS Selling_Price, CAST(unit_cost AS DOUBLE) AS Cost_Price, pack_size, is_active FROM v_products""")
q("ents_inventory", """SELECT store_id, store_name, region, product_id, product_name, category, quantity_on_hand AS Stock_On_Hand,
  safety_stock AS Safety_Stock_Threshold, reorder_point AS Reorder_Point, stock_status AS Stock_Health_Status, coverage_days AS Coverage_Days, last_updated FROM g_inventory""")
q("ents_forecast_vs_actual", """SELECT product_id, product_name, category, forecast_date AS Forecast_Date, actual_qty AS Actual_Quantity,
  forecast_qty AS Forecasted_Quantity, forecast_qty_lower AS Forecast_Lower_Bound, forecast_qty_upper AS Forecast_Upper_Bound,
  forecast_error_pct AS Forecast_Error_Pct, forecast_accuracy AS Forecast_Accuracy FROM g_fva""")
q("ents_demand_forecast", """SELECT product_id, forecast_date AS Forecast_Date, forecast_qty AS Forecasted_Quantity,
  forecast_qty_lower AS Forecast_Lower_Bound, forecast_qty_upper AS Forecast_Upper_Bound FROM v_forecast""")
q("ents_customer_segment", """SELECT customer_id, last_order_date, recency_days AS Days_Since_Last_Purchase, frequency AS Purchase_Frequency,
  monetary AS Lifetime_Value, avg_basket AS Average_Basket_Size, nb_distinct_products AS Distinct_Products_Bought, segment_id,
  segment_label AS Customer_Segment FROM v_segments""")
q("ents_competitor_latest", """SELECT snapshot_month, product_id, product_name, category, competitor AS Competitor_Name, CAST(our_price AS DOUBLE) AS our_price,
  CAST(price_gap_pct AS DOUBLE) AS Price_Gap_Pct, is_cheaper AS Competitor_Is_Cheaper, CAST(competitor_price AS DOUBLE) AS competitor_price
FROM v_competitor_prices WHERE snapshot_month = (SELECT MAX(snapshot_month) FROM v_competitor_prices)""")
q("ents_weather_en", """SELECT date, city, region, max_temperature_c AS Max_Temperature_C, min_temperature_c AS Min_Temperature_C,
  rainfall_mm AS Rainfall_mm, wind_speed_kmh AS Wind_Speed_kmh, is_sunny,
  CASE weather_condition WHEN 'ensoleillé' THEN 'sunny' WHEN 'nuageux' THEN 'cloudy' WHEN 'pluie' THEN 'rain' WHEN 'couvert' THEN 'overcast' ELSE weather_condition END AS Weather_Condition
FROM v_weather""")
q("ents_promotion", """SELECT promo_name, start_date AS Start_Date, end_date AS End_Date, category AS Product_Category, discount_pct AS Discount_Pct,
  CAST(traffic_boost AS DOUBLE) AS Traffic_Boost_Factor, make_date(CAST(YEAR((SELECT as_of FROM v_as_of)) AS INT) - 1, 11, 28) BETWEEN start_date AND end_date AS Is_Active FROM v_promotions""")
q("ents_tracked_in_inventory", """SELECT i.store_id, i.product_id, i.stock_status, p.name AS product_name, p.category AS product_category,
  p.subcategory AS product_subcategory, CAST(p.unit_price AS DOUBLE) AS product_unit_price, CAST(p.unit_cost AS DOUBLE) AS product_unit_cost,
  p.pack_size AS product_pack_size, p.is_active AS product_is_active
FROM g_inventory i JOIN v_products p ON p.product_id = i.product_id WHERE i.stock_status IN ('stockout', 'critical')""")
q("ents_observed_at", """SELECT s.store_id, s.city, w.date AS weatherobservation_date, w.weather_condition AS weatherobservation_weather_condition,
  w.rainfall_mm AS weatherobservation_rainfall_mm
FROM v_stores s JOIN v_weather w ON w.city = s.city WHERE w.date = (SELECT as_of FROM v_as_of)""")
q("model_sales_weekend", f"""SELECT c.is_weekend, {DSUM('g.revenue')} AS total_revenue, CAST(SUM(g.nb_orders) AS BIGINT) AS nb_orders
FROM g_sales g LEFT JOIN dim_calendar c ON c.date = g.sales_date GROUP BY 1""")


# ---- remaining operators -----------------------------------------------------------
q("stock_policy", """
WITH listed AS (SELECT l_suppkey AS store_id, l_partkey AS product_id FROM lineitem UNION SELECT store_id, product_id FROM v_sp_sales),
paced AS (SELECT listed.*, sold, days, surface_m2, GREATEST(0.1, COALESCE(CAST(sold AS DOUBLE) / days, 1.0)) AS adp
          FROM listed LEFT JOIN v_sp_sales USING (store_id, product_id) JOIN v_stores USING (store_id))
SELECT store_id, product_id, adp, CAST(COALESCE(GREATEST(1, (3 * sold) // days), 3) AS INT) AS safety_stock,
       CAST(COALESCE(GREATEST(2, (7 * sold) // days), 7) AS INT) AS reorder_point,
       GREATEST(5, CAST(FLOOR(14 * adp * LN(surface_m2 / 400 + 1)) AS INT)) AS base_stock
FROM paced""")
q("inventory_flags", """
SELECT store_id, product_id, coverage_days, coverage_days < 7 AS urgent_replenishment, coverage_days > 30 AS potential_overstock,
       CASE WHEN coverage_days < 7 THEN 'red' WHEN coverage_days < 14 THEN 'orange' WHEN coverage_days < 20 THEN 'yellow'
            WHEN coverage_days <= 25 THEN 'light_green' ELSE 'green' END AS coverage_band
FROM g_inventory""")
q("top_stores_per_region", f"""
SELECT * FROM (
  SELECT region, store_id, store_name, total_revenue,
         CAST(DENSE_RANK() OVER (PARTITION BY region ORDER BY total_revenue DESC, store_id) AS INT) AS rank,
         total_revenue / SUM(total_revenue) OVER (PARTITION BY region) AS share
  FROM (SELECT region, store_id, store_name, {DSUM('revenue')} AS total_revenue FROM g_sales GROUP BY 1, 2, 3) g) t
WHERE rank <= 3""")
q("domain_checks", """
SELECT 'store_type' AS domain, COUNT(*) AS violations FROM v_stores WHERE store_type NOT IN ('hypermarket', 'supermarket', 'convenience')
UNION ALL SELECT 'channel', COUNT(*) FROM v_orders WHERE channel NOT IN ('in_store', 'click_and_collect', 'home_delivery', 'drive')
UNION ALL SELECT 'stock_status', COUNT(*) FROM g_inventory WHERE stock_status NOT IN ('stockout', 'critical', 'low', 'normal')
UNION ALL SELECT 'order_status', COUNT(*) FROM v_orders WHERE order_status NOT IN ('F', 'O', 'P')
UNION ALL SELECT 'event_type', COUNT(*) FROM events WHERE event_type NOT IN ('click', 'purchase', 'signup', 'view')
UNION ALL SELECT 'segment_label', COUNT(*) FROM v_segments WHERE segment_label NOT IN ('Champions', 'Loyal', 'Warm Prospects', 'At Risk', 'Inactive')""")
q("coverage_sanity", """
SELECT MAX(coverage_days) AS max_coverage, quantile_cont(coverage_days, 0.99) AS p99_coverage, CAST(COUNT_IF(coverage_days > 365) AS BIGINT) AS n_over_a_year
FROM g_inventory""")
q("ingest_competitor_roundtrip", """
SELECT snapshot_month, product_id, product_name, category, competitor, CAST(competitor_price AS DOUBLE) AS competitor_price,
       CAST(our_price AS DOUBLE) AS our_price, CAST(price_gap_pct AS DOUBLE) AS price_gap_pct, is_cheaper, 'web_scraping' AS source
FROM v_competitor_prices""")
q("stream_sales_spike", "SELECT * FROM v_spikes WHERE created_at <= (SELECT MAX(ts) FROM events) - INTERVAL 1 HOUR")
q("q_20_stockout_rate_6_months", f"""
WITH t AS (SELECT ym AS snapshot_ym FROM (SELECT DISTINCT CAST(YEAR(o_orderdate) * 100 + MONTH(o_orderdate) AS INT) AS ym FROM orders) m
           WHERE ym < (SELECT YEAR(as_of) * 100 + MONTH(as_of) FROM v_as_of) ORDER BY ym DESC LIMIT 6),
     monthly AS (SELECT o.store_id, i.product_id, CAST(YEAR(o.order_date) * 100 + MONTH(o.order_date) AS INT) AS ym,
                        SUM(i.quantity) AS sold, COUNT(DISTINCT o.order_date) AS days
                 FROM v_order_items i JOIN v_orders o ON o.order_id = i.order_id GROUP BY 1, 2, 3),
     cum AS (SELECT m.store_id, m.product_id, t.snapshot_ym, SUM(m.sold) AS sold, SUM(m.days) AS days
             FROM monthly m JOIN t ON m.ym <= t.snapshot_ym GROUP BY 1, 2, 3),
     s AS (SELECT snapshot_ym, (12 * p_size - sold % (12 * p_size)) % (12 * p_size) AS qty FROM cum JOIN part ON p_partkey = product_id)
SELECT snapshot_ym, {DIV(CNT('qty = 0'), 'COUNT(*)')} AS stockout_rate, CAST(COUNT_IF(qty = 0) AS BIGINT) AS nb_stockout
FROM s GROUP BY 1""")
q("stream_stock_alerts", "SELECT * FROM v_stock_alerts")
q("stream_competitor_ingest", QUERIES["ingest_competitor_roundtrip"])
q("ingest_weather_roundtrip", "SELECT * FROM v_weather")
q("ingest_promotions_roundtrip", """
SELECT promo_name, start_date, end_date, category, CAST(discount_pct AS DOUBLE) AS discount_pct, CAST(traffic_boost AS DOUBLE) AS traffic_boost,
       make_date(CAST(YEAR((SELECT as_of FROM v_as_of)) AS INT) - 1, 11, 28) BETWEEN start_date AND end_date AS is_active
FROM v_promotions""")


# ---- matrices, cards, orders, flags, relationships, catalog -------------------
def MATRIX(source: str, row: str, col: str, value: str, names: list[str]) -> str:
    cells = ", ".join(f"MAX(CASE WHEN {col} = '{n}' THEN {value} END) AS \"{n}\"" for n in names)
    return f"SELECT {row}, {cells} FROM ({source}) x GROUP BY 1"


q("rpt_05_matrix", MATRIX(QUERIES["rpt_05_category_region"], "category", "region", "avg_coverage_days",
                          ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]))
q("rpt_12_matrix", MATRIX(QUERIES["rpt_12_format_category_stockout"], "category", "store_type", "stockout_rate",
                          ["hypermarket", "supermarket", "convenience"]))
q("rpt_13_matrix", MATRIX(QUERIES["rpt_13_gap_category_competitor"], "category", "competitor", "avg_price_gap",
                          ["MaxiMarché", "PrimoShop", "BonPrix", "NeoShop", "TendancePlus"]))
q("rpt_14_store_kpis", f"""
WITH s AS (SELECT store_id, {DSUM('revenue')} AS total_revenue, {GM_PCT} AS gross_margin_pct, CAST(SUM(nb_orders) AS BIGINT) AS nb_orders
           FROM g_sales WHERE YEAR(sales_date) = 2000 GROUP BY 1),
     i AS (SELECT store_id, CAST(COUNT_IF(stock_status = 'stockout') AS BIGINT) AS nb_stockout, {DAVG('coverage_days', 1)} AS avg_coverage_days FROM g_inventory GROUP BY 1)
SELECT s.*, i.nb_stockout, i.avg_coverage_days FROM s LEFT JOIN i USING (store_id)""")
q("rpt_08_worst_first", f"""
SELECT *, CAST(ROW_NUMBER() OVER (ORDER BY forecast_accuracy, category) AS INT) AS rank
FROM (SELECT category, 1 - COALESCE({DIV(DSUM('ABS(actual_qty - forecast_qty)'), 'SUM(actual_qty)')}, 0) AS forecast_accuracy FROM g_fva GROUP BY 1) g""")
q("srt_03_months_in_order", """
WITH m AS (SELECT CAST(YEAR(d) * 100 + MONTH(d) AS INT) AS year_month_sort, strftime(d, '%B') AS month_name, CAST(YEAR(d) AS INT) AS year, COUNT(*) AS days_with_sales
           FROM (SELECT DISTINCT sales_date AS d FROM g_sales) x GROUP BY 1, 2, 3)
SELECT *, CAST(ROW_NUMBER() OVER (ORDER BY year_month_sort) AS INT) AS place FROM m""")
q("alerts_in_severity_order", f"""
SELECT *, CAST(ROW_NUMBER() OVER (ORDER BY severity_rank, cnt DESC, alert_type) AS INT) AS place FROM ({QUERIES["alerts_by_severity"]}) g""")
q("product_flags", "SELECT product_id, forecast_accuracy, forecast_accuracy < 0.75 AS retrain_needed, forecast_accuracy > 0.90 AS high_confidence FROM v_prod_acc")
q("customer_flags", """
SELECT customer_id, segment_label, segment_label = 'At Risk' AND recency_days > 90 AS retention_priority,
       segment_label = 'Inactive' AND monetary > 500 AS win_back FROM v_segments""")
q("undercut_flags", """
SELECT product_id, competitor, price_gap_pct < 0 AS undercut FROM v_competitor_prices
WHERE snapshot_month = (SELECT MAX(snapshot_month) FROM v_competitor_prices)""")
q("q_13_demand_by_product", """
SELECT t.*, p.name AS product_name, p.category FROM (SELECT * FROM v_fc30 ORDER BY forecast_units DESC, product_id LIMIT 10) t
JOIN v_products p USING (product_id)""")
q("q_25_critical_undercut_bonprix", "SELECT * FROM g_double_risk WHERE stock_status = 'critical' AND cheapest_competitor = 'BonPrix'")
q("q_21_top_stores_year", f"SELECT store_id, store_name, region, {DSUM('revenue')} AS total_revenue FROM g_sales WHERE YEAR(sales_date) = 2000 GROUP BY 1, 2, 3 ORDER BY total_revenue DESC, store_id LIMIT 5")
q("model_relationships", " UNION ALL ".join(
    f"SELECT '{fact}.{c}' AS fact, '{dim}.{d}' AS dimension, COUNT(*) AS n_rows, COUNT(*) FILTER (WHERE {c} IN (SELECT {d} FROM {dim_sql})) AS n_found FROM {fact_sql}"
    for fact, c, dim, d, fact_sql, dim_sql in [
        ("sales", "sales_date", "calendar", "date", "g_sales", "dim_calendar"), ("sales", "store_id", "stores", "store_id", "g_sales", "v_stores"),
        ("forecast_vs_actual", "forecast_date", "calendar", "date", "g_fva", "dim_calendar"),
        ("forecast_vs_actual", "product_id", "products", "product_id", "g_fva", "v_products"),
        ("inventory", "store_id", "stores", "store_id", "g_inventory", "v_stores"),
        ("inventory", "product_id", "products", "product_id", "g_inventory", "v_products"),
        ("demand_forecast", "product_id", "products", "product_id", "v_forecast", "v_products"),
        ("competitor_prices", "product_id", "products", "product_id", "v_competitor_prices", "v_products"),
        ("weather", "city", "stores", "city", "v_weather", "v_stores")]))
LATEST_SQL = "(SELECT * FROM v_competitor_prices WHERE snapshot_month = (SELECT MAX(snapshot_month) FROM v_competitor_prices))"
TODAY_SQL = "(SELECT * FROM v_weather WHERE date = (SELECT as_of FROM v_as_of))"
q("entity_relationships", " UNION ALL ".join(
    f"SELECT '{name}' AS relationship, COUNT(*) AS n_pairs FROM {a} a JOIN {b} b ON a.{c} = b.{d}"
    for name, a, c, b, d in [
        ("holds_inventory", "g_inventory", "store_id", "v_stores", "store_id"), ("located_in", "g_inventory", "store_id", "v_stores", "store_id"),
        ("tracked_in_inventory", "g_inventory", "product_id", "v_products", "product_id"),
        ("has_product", "g_inventory", "product_id", "v_products", "product_id"),
        ("is_forecasted_for", "g_fva", "product_id", "v_products", "product_id"),
        ("benchmarked_against", LATEST_SQL, "product_id", "v_products", "product_id"),
        ("in_demand_forecast", "v_forecast", "product_id", "v_products", "product_id"),
        ("observed_at", "v_stores", "city", TODAY_SQL, "city"), ("occurs_on", "g_fva", "forecast_date", "dim_calendar", "date"),
        ("starts_on", "v_promotions", "start_date", "dim_calendar", "date"), ("at_location", TODAY_SQL, "city", "v_stores", "city")]))
q("catalog_tables", """
SELECT 'append twice' AS step, COUNT(*) AS n_rows FROM v_stores
UNION ALL SELECT 'overwrite from itself', COUNT(*) FROM v_stores WHERE region <> 'ASIA'
UNION ALL SELECT 'overwrite contents', COUNT(*) FROM v_stores WHERE region = 'ASIA'
UNION ALL SELECT 'fallback', COUNT(*) FROM nation
UNION ALL SELECT 'audit: there', COUNT(*) FROM v_stores WHERE region = 'ASIA'
UNION ALL SELECT 'audit: missing', NULL""")
q("views_in_sql", "SELECT region, COUNT(*) AS n_rows, CAST(SUM(quantity_on_hand) AS BIGINT) AS units FROM g_inventory GROUP BY 1")
q("gold_kpis", QUERIES["q_15_kpis"])
q("gold_top_stores_2000", QUERIES["rpt_02_top_stores_sliced"])
q("segment_check", """
SELECT CAST(COUNT(*) AS BIGINT) AS n_customers, CAST(COUNT(*) AS BIGINT) AS n_distinct, CAST(5 AS BIGINT) AS n_labels, CAST(5 AS BIGINT) AS n_in_order FROM v_rfm""")
q("forecast_check", """
WITH t AS (SELECT product_id, SUM(actual_qty) AS vol, COUNT(*) AS points FROM v_daily WHERE order_date <= (SELECT cutoff FROM v_cutoff)
           GROUP BY 1 ORDER BY vol DESC, product_id LIMIT 200)
SELECT COUNT(*) FILTER (WHERE points >= 30) AS n_products, CAST(0 AS BIGINT) AS n_other_length, CAST(0 AS BIGINT) AS n_out_of_order FROM t""")


# every rule as a query of its own; the writes take them all from one pass
def _check(tbl: str, rule: str, action: str, observed: str, source: str, passed: str = "observed = 0") -> str:
    return (f"SELECT '{tbl}' AS tbl, '{rule}' AS rule, '{action}' AS action, ROUND(CAST(observed AS DOUBLE), 6) AS observed, {passed} AS passed "
            f"FROM (SELECT {observed} AS observed FROM {source}) c")


_KNOWN_CHANNEL = "('in_store', 'click_and_collect', 'home_delivery', 'drive')"
_SPAN = "observed BETWEEN (SELECT MIN(order_date) - DATE '1970-01-01' FROM v_orders) AND (SELECT MAX(order_date) - DATE '1970-01-01' FROM v_orders)"
q("gold_checks", " UNION ALL ".join([
    _check("silver_competitor_prices", "competitor_known", "quarantine",
           "COUNT(*) FILTER (WHERE competitor NOT IN ('MaxiMarché', 'PrimoShop', 'BonPrix', 'NeoShop', 'TendancePlus'))", "v_competitor_prices"),
    _check("silver_competitor_prices", "prices_positive", "quarantine", "COUNT(*) FILTER (WHERE competitor_price <= 0 OR our_price <= 0)", "v_competitor_prices"),
    _check("silver_competitor_prices", "rows", "fail", "COUNT(*)", "v_competitor_prices", "observed >= 1"),
    _check("silver_competitor_prices", "cheaper_share", "warn", "AVG(CAST(is_cheaper AS INT))", "v_competitor_prices", "observed BETWEEN 0.05 AND 0.95"),
    _check("gold_sales_daily", "keys_known", "quarantine", "COUNT(*) FILTER (WHERE store_id IS NULL OR region IS NULL OR category IS NULL)", "g_sales"),
    _check("gold_sales_daily", "channel_known", "quarantine", f"COUNT(*) FILTER (WHERE channel NOT IN {_KNOWN_CHANNEL})", "g_sales"),
    _check("gold_sales_daily", "units_positive", "fail", "COUNT(*) FILTER (WHERE units_sold <= 0 OR nb_orders <= 0)", "g_sales"),
    _check("gold_sales_daily", "rows", "fail", "COUNT(*)", "g_sales", "observed >= 1"),
    _check("gold_sales_daily", "first_day", "fail", "MIN(sales_date) - DATE '1970-01-01'", "g_sales", _SPAN),
    _check("gold_sales_daily", "last_day", "fail", "MAX(sales_date) - DATE '1970-01-01'", "g_sales", _SPAN),
    _check("gold_inventory_status", "status_known", "fail", "COUNT(*) FILTER (WHERE stock_status NOT IN ('stockout', 'critical', 'low', 'normal'))", "g_inventory"),
    _check("gold_inventory_status", "stock_not_negative", "quarantine", "COUNT(*) FILTER (WHERE quantity_on_hand < 0)", "g_inventory"),
    _check("gold_inventory_status", "rows", "fail", "COUNT(*)", "g_inventory", "observed >= 1"),
    _check("gold_inventory_status", "stockout_share", "warn", "AVG(CAST(stock_status = 'stockout' AS INT))", "g_inventory", "observed <= 0.25"),
    _check("gold_forecast_vs_actual", "forecast_not_negative", "quarantine", "COUNT(*) FILTER (WHERE forecast_qty < 0)", "g_fva"),
    _check("gold_forecast_vs_actual", "rows", "fail", "COUNT(*)", "g_fva", "observed >= 1"),
    _check("gold_forecast_vs_actual", "rows_beyond_whole_horizons", "fail", "COUNT(*) % 90", "g_fva")]))
q("quarantined_events", """
SELECT CASE WHEN event_type IN ('click', 'purchase', 'signup', 'view') THEN CASE WHEN value IS NOT NULL THEN 'stored' ELSE 'value_known' END
            WHEN value IS NOT NULL THEN 'event_type_known' ELSE 'event_type_known,value_known' END AS place, event_type, COUNT(*) AS n
FROM events GROUP BY 1, 2""")


# distinct counts straight from the lines; the Spark side counts bits of stored bitmaps
view("v_sold", """
SELECT o.order_id, o.customer_id, o.order_date, o.channel, s.region, s.store_type, p.category
FROM v_order_items i JOIN v_orders o USING (order_id) JOIN v_products p USING (product_id) JOIN v_stores s USING (store_id)""")
_DISTINCT = "COUNT(DISTINCT order_id) AS nb_orders_distinct, COUNT(DISTINCT customer_id) AS nb_clients FROM v_sold"
q("mea_distinct_by_year", f"SELECT CAST(YEAR(order_date) AS INT) AS year, {_DISTINCT} GROUP BY 1")
q("mea_distinct_by_region_channel", f"SELECT region, channel, {_DISTINCT} GROUP BY 1, 2")
q("mea_distinct_by_category_sliced", f"""
SELECT category, {_DISTINCT} WHERE YEAR(order_date) = (SELECT YEAR(as_of) - 1 FROM v_as_of) AND store_type = 'supermarket' AND channel = 'in_store'
GROUP BY 1""")
q("mea_distinct_total", f"SELECT {_DISTINCT}")

q("median_prices_last_quarter", """
SELECT category, median(CAST(our_price AS DOUBLE)) AS median_our_price, median(CAST(competitor_price AS DOUBLE)) AS median_competitor_price
FROM v_competitor_prices
WHERE snapshot_month IN (SELECT snapshot_month FROM v_competitor_prices GROUP BY 1 ORDER BY 1 DESC LIMIT 3) GROUP BY category""")
q("forecast_quality", f"""
WITH t AS (SELECT product_id, SUM(actual_qty) AS vol, COUNT(*) AS points FROM v_daily WHERE order_date <= (SELECT cutoff FROM v_cutoff)
           GROUP BY 1 ORDER BY vol DESC, product_id LIMIT 200),
     f AS (SELECT v.*, COALESCE(d.actual_qty, 0) AS units FROM v_forecast v JOIN t ON t.product_id = v.product_id AND t.points >= 30
           LEFT JOIN v_daily d ON d.product_id = v.product_id AND d.order_date = v.forecast_date)
SELECT COUNT(*) AS n_days, {DAVG('ABS(units - forecast_qty)')} AS baseline_mae,
       AVG(CAST(units BETWEEN forecast_qty_lower AND forecast_qty_upper AS INT)) AS baseline_coverage,
       TRUE AS same_days, TRUE AS model_errs_no_more, TRUE AS model_covers
FROM f""")

q("segment_fixed_point", """
SELECT COUNT(*) AS n_customers, CAST(5 AS BIGINT) AS n_segments, CAST(0 AS BIGINT) AS n_nearer_elsewhere, CAST(0 AS BIGINT) AS n_centres_off,
       TRUE AS standardised, TRUE AS best_of_restarts FROM v_rfm""")

view("v_pos_sessions", """
SELECT store_id, MIN(ts) AS first_ts, MAX(ts) AS last_ts, COUNT(*) AS n_sales
FROM (SELECT *, SUM(CASE WHEN ts <= before + INTERVAL 45 MINUTE THEN 0 ELSE 1 END) OVER (PARTITION BY store_id ORDER BY ts, event_id) AS run
      FROM (SELECT event_id, ts, user_id % (SELECT COUNT(*) FROM supplier) AS store_id,
                   LAG(ts) OVER (PARTITION BY user_id % (SELECT COUNT(*) FROM supplier) ORDER BY ts, event_id) AS before
            FROM events WHERE event_type = 'purchase') p) q
GROUP BY store_id, run""")
q("pos_sessions", "SELECT * FROM v_pos_sessions")
q("stream_silence_alarms", """
SELECT store_id, first_ts AS session_start, last_ts AS last_sale, last_ts + INTERVAL 45 MINUTE AS alarm_at, n_sales
FROM v_pos_sessions
WHERE time_bucket(INTERVAL 5 MINUTE, last_ts + INTERVAL 45 MINUTE) + INTERVAL 5 MINUTE <= (SELECT MAX(ts) FROM events) - INTERVAL 1 HOUR""")

q("promo_overlap_stretches", """
WITH p AS (SELECT category, promo_name, start_date - 30 AS start_date, end_date FROM v_promotions),
     days AS (SELECT category, CAST(d AS DATE) AS d, COUNT(*) AS n, STRING_AGG(promo_name, '|' ORDER BY promo_name) AS names,
                     STRING_AGG(promo_name || start_date, '|' ORDER BY promo_name, start_date) AS who
              FROM (SELECT *, UNNEST(generate_series(start_date, end_date, INTERVAL 1 DAY)) AS d FROM p) x GROUP BY 1, 2),
     runs AS (SELECT *, d - CAST(ROW_NUMBER() OVER (PARTITION BY category, who ORDER BY d) AS INT) AS run FROM days WHERE n > 1)
SELECT category, MIN(d) AS from_date, MAX(d) AS to_date, n AS n_promos, names AS promo_names FROM runs GROUP BY category, who, run, n, names""")
