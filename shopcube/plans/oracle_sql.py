"""Independent DuckDB SQL for every registered query (the correctness oracle).

Written directly against the driver tables, not generated from the Spark
code.  Shared building blocks are CTEs below; each query string is
``WITH <blocks> SELECT ...``.  Money follows the same exact-decimal rules as
the engine; ratios are double(sum) / double(count) so both engines round
identically; integer sums are cast to BIGINT.
"""

from __future__ import annotations

# -- building blocks -------------------------------------------------------

ITEMS = """
items0 AS (
  SELECT l_orderkey AS order_key, l_partkey AS product_key, l_suppkey AS supplier_key,
         l_linenumber AS line_number, CAST(l_quantity AS INTEGER) AS quantity,
         CAST(l_extendedprice AS DECIMAL(12,2)) AS gross,
         CAST(l_discount AS DECIMAL(5,2)) AS rate, CAST(l_tax AS DECIMAL(5,2)) AS tax_rate,
         l_returnflag = 'R' AS is_returned, l_linestatus, CAST(l_shipdate AS DATE) AS ship_date
  FROM lineitem),
items1 AS (
  SELECT *, CAST(gross * rate AS DECIMAL(12,2)) AS discount FROM items0),
items AS (
  SELECT *, CAST(gross - discount AS DECIMAL(12,2)) AS net,
         CAST(CAST(gross - discount AS DECIMAL(12,2)) * tax_rate AS DECIMAL(10,2)) AS tax,
         CASE WHEN rate > 0 THEN CAST(rate * 100 AS INTEGER) END AS voucher_key,
         CASE WHEN line_number % 2 = 1 THEN 'seller' ELSE 'platform' END AS voucher_side,
         CAST(CAST((CAST(gross * 100 AS BIGINT) * 2 + quantity) // (2 * quantity) AS DECIMAL(18,0))
              * 0.01 AS DECIMAL(10,2)) AS unit_price,
         CASE WHEN is_returned THEN CASE l_linestatus WHEN 'F' THEN 'Damaged item'
                                     WHEN 'O' THEN 'Not as described' END END AS return_reason
  FROM items1)"""

ORDERS = """
ords AS (
  SELECT o_orderkey AS order_key, o_custkey AS customer_key, o_orderdate AS order_ts,
         CAST(o_orderdate AS DATE) AS order_date,
         CAST(year(o_orderdate) * 10000 + month(o_orderdate) * 100 + day(o_orderdate) AS INTEGER)
           AS time_key,
         o_orderstatus = 'P' AS is_cancelled, o_orderpriority AS order_priority,
         CAST(o_orderkey % 2 + 1 AS INTEGER) AS platform_key,
         CASE WHEN o_orderpriority = '1-URGENT' THEN CAST(45.00 AS DECIMAL(10,2)) END AS shipping_fee,
         CASE WHEN o_orderstatus = 'P' THEN CASE o_orderpriority
              WHEN '1-URGENT' THEN 'Delivery too slow' WHEN '2-HIGH' THEN 'Found cheaper elsewhere'
              WHEN '3-MEDIUM' THEN 'Changed mind' WHEN '4-NOT SPECIFIED' THEN 'Ordered by mistake'
              WHEN '5-LOW' THEN 'Payment failed' END END AS cancellation_reason
  FROM orders)"""

FIRST = """
first_orders AS (
  SELECT order_key FROM (
    SELECT order_key, row_number() OVER (PARTITION BY customer_key ORDER BY order_ts, order_key) AS rn
    FROM ords) WHERE rn = 1)"""

PRICED = """
order_roll AS (
  SELECT order_key, CAST(SUM(gross) AS DECIMAL(10,2)) AS order_total_price,
         CAST(SUM(CASE WHEN voucher_side = 'seller' THEN discount END) AS DECIMAL(10,2)) AS voucher_seller,
         CAST(SUM(CASE WHEN voucher_side = 'platform' THEN discount END) AS DECIMAL(10,2)) AS voucher_platform,
         CAST(SUM(quantity) AS INTEGER) AS items_count, bool_or(is_returned) AS has_return,
         COUNT(*) AS line_count
  FROM items GROUP BY order_key),
priced0 AS (
  SELECT o.*, CAST(COALESCE(r.order_total_price, 0) AS DECIMAL(10,2)) AS order_total_price,
         r.voucher_seller, r.voucher_platform, CAST(COALESCE(r.items_count, 0) AS INTEGER) AS items_count,
         COALESCE(r.has_return, FALSE) AS has_return, COALESCE(r.line_count, 0) AS line_count,
         CAST(COALESCE(r.voucher_seller, 0) + COALESCE(r.voucher_platform, 0) AS DECIMAL(10,2))
           AS voucher_total
  FROM ords o LEFT JOIN order_roll r ON o.order_key = r.order_key),
priced AS (
  SELECT *, CAST(order_total_price - voucher_total + COALESCE(shipping_fee, 0) AS DECIMAL(10,2))
              AS buyer_paid_price,
         order_key IN (SELECT order_key FROM first_orders) AS is_first_order
  FROM priced0)"""

CUSTOMERS = """
as_of AS (SELECT MAX(CAST(o_orderdate AS DATE)) AS d FROM orders),
cust_roll AS (
  SELECT customer_key, COUNT(*) AS n, SUM(buyer_paid_price) AS spent,
         MIN(order_date) AS first_order_date, MAX(order_date) AS last_order_date
  FROM priced GROUP BY customer_key),
dim_customers0 AS (
  SELECT c.c_custkey AS customer_key, CAST(c.c_custkey AS VARCHAR) AS customer_id,
         split_part(c.c_name, '#', 1) AS first_name, split_part(c.c_name, '#', 2) AS last_name,
         n.n_name AS city, r.r_name AS region, n.n_name AS country,
         CAST(COALESCE(cr.n, 0) AS INTEGER) AS total_orders,
         CAST(COALESCE(cr.spent, 0) AS DECIMAL(20,2)) AS total_spent,
         CAST(COALESCE((CAST(cr.spent * 100 AS BIGINT) * 2 + cr.n) // (2 * cr.n), 0) AS DECIMAL(18,0))
           * 0.01 AS aov,
         cr.first_order_date, cr.last_order_date,
         date_diff('day', cr.last_order_date, (SELECT d FROM as_of)) AS recency_days,
         c.c_acctbal > 0 AS is_active
  FROM customer c
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
  LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
  LEFT JOIN cust_roll cr ON c.c_custkey = cr.customer_key),
dim_customers AS (
  SELECT customer_key, customer_id, first_name, last_name,
         concat_ws(' ', first_name, last_name) AS full_name, city, region, country,
         total_orders, total_spent, CAST(aov AS DECIMAL(10,2)) AS average_order_value,
         first_order_date, last_order_date,
         CASE WHEN recency_days > 365 THEN 'Inactive' WHEN total_orders <= 1 THEN 'New'
              WHEN total_spent >= 3000000 THEN 'VIP' ELSE 'Regular' END AS customer_segment,
         total_spent AS customer_lifetime_value,
         CASE WHEN total_orders <= 1 THEN 'New Buyer' ELSE 'Returning Buyer' END AS buyer_segment,
         CASE WHEN total_spent >= 2300000 THEN 'Gold' WHEN total_spent >= 1650000 THEN 'Silver'
              ELSE 'Bronze' END AS ltv_tier,
         CAST(recency_days AS INTEGER) AS recency_days,
         sha256('shopcube' || customer_id) AS platform_buyer_id,
         CASE WHEN region IS NULL THEN NULL WHEN region = 'ASIA' THEN 'Metro' ELSE 'Provincial' END
           AS region_class,
         is_active
  FROM dim_customers0)"""

USAGE = """
usage AS (
  SELECT CAST(i.order_key * 2147483648 + i.voucher_key AS BIGINT) AS usage_key, i.voucher_key, i.order_key,
         o.customer_key, o.time_key, 'SAVE' || lpad(CAST(i.voucher_key AS VARCHAR), 2, '0') AS voucher_code,
         CAST(SUM(i.discount) AS DECIMAL(10,2)) AS discount_amount,
         CAST(SUM(i.gross) AS DECIMAL(10,2)) AS order_value_before_discount,
         CAST(SUM(i.net) AS DECIMAL(10,2)) AS order_value_after_discount,
         o.order_ts AS usage_date,
         i.order_key IN (SELECT order_key FROM first_orders) AS first_time_customer
  FROM items i JOIN ords o ON i.order_key = o.order_key
  WHERE i.voucher_key IS NOT NULL
  GROUP BY i.voucher_key, i.order_key, o.customer_key, o.time_key, o.order_ts)"""

VOUCHERS = """
vouchers AS (
  SELECT v AS voucher_key, 'SAVE' || lpad(CAST(v AS VARCHAR), 2, '0') AS voucher_code,
         CASE WHEN v % 2 = 1 THEN 'PHP ' || CAST(v * 100 AS VARCHAR) || ' off'
              ELSE CAST(v AS VARCHAR) || '% off' END AS voucher_name,
         CASE WHEN v % 2 = 1 THEN 'fixed_amount' ELSE 'percentage' END AS voucher_type,
         CASE WHEN v % 2 = 1 THEN CAST(v * 100 AS DECIMAL(10,2)) END AS discount_value,
         CASE WHEN v % 2 = 0 THEN CAST(v AS DECIMAL(5,2)) END AS discount_percentage,
         CAST(v * 10000 AS DECIMAL(10,2)) AS minimum_spend,
         CAST(v * 500 AS DECIMAL(10,2)) AS maximum_discount,
         CAST(v * 300 AS INTEGER) AS usage_limit, 3 AS usage_limit_per_customer,
         make_timestamp(CAST(1994 + (v - 1) // 2 AS BIGINT), 1, 1, 0, 0, 0) AS start_date,
         make_timestamp(CAST(1994 + (v - 1) // 2 + 2 AS BIGINT), 12, 31, 23, 59, 59) AS end_date,
         CASE WHEN v % 3 = 0 THEN '["PROMO", "STANDARD"]' WHEN v % 3 = 1 THEN '[]'
              ELSE '["ECONOMY", "LARGE", "MEDIUM", "SMALL"]' END AS applicable_categories
  FROM (SELECT unnest(range(1, (SELECT MAX(voucher_key) FROM items) + 2)) AS v))"""


def with_(*blocks: str) -> str:
    return "WITH " + ",\n".join(b.strip() for b in blocks) + "\n"


BASE = (ITEMS, ORDERS)
FULL = (ITEMS, ORDERS, FIRST, PRICED)


def kpi_aggs(group_cols: str) -> str:
    """Daily/period KPI aggregates over ``priced`` (the values the export writes)."""
    return f"""
  SELECT CASE platform_key WHEN 1 THEN 'Lazada' ELSE 'Shopee' END AS platform, {group_cols},
         COALESCE(SUM(buyer_paid_price) FILTER (WHERE NOT is_cancelled), 0) AS rev,
         COUNT(DISTINCT customer_key) AS visitors,
         COUNT(DISTINCT customer_key) FILTER (WHERE NOT is_cancelled) AS buyers,
         COUNT(*) FILTER (WHERE NOT is_cancelled) AS orders,
         SUM(line_count) AS pageviews,
         COALESCE(SUM(items_count) FILTER (WHERE NOT is_cancelled), 0) AS units,
         COUNT(DISTINCT customer_key) FILTER (WHERE voucher_total > 0) AS atc_users,
         SUM(items_count) AS atc_units,
         NULLIF(COUNT(*) FILTER (WHERE has_return), 0) AS wishlists,
         NULLIF(COUNT(DISTINCT customer_key) FILTER (WHERE has_return), 0) AS wishlist_users,
         COALESCE(SUM(order_total_price) FILTER (WHERE is_cancelled), 0) AS cancelled,
         COALESCE(SUM(buyer_paid_price) FILTER (WHERE NOT is_cancelled AND has_return), 0) AS refunds
  FROM priced"""


def half_up(num_cents: str, den: str, out_scale_factor: str = "0.01") -> str:
    """round-half-up(num_cents / den) as an exact decimal, NULL when den = 0."""
    return (f"CAST(CAST(({num_cents} * 2 + {den}) // (2 * NULLIF({den}, 0)) AS DECIMAL(18,0))"
            f" * {out_scale_factor} AS DOUBLE)")


KPI_MEASURES = f"""
       CAST(rev AS DOUBLE) AS total_sales_value, CAST(visitors AS BIGINT) AS visitors,
       CAST(buyers AS BIGINT) AS buyers, CAST(orders AS BIGINT) AS total_orders,
       CAST(pageviews AS BIGINT) AS pageviews, CAST(units AS BIGINT) AS units_sold,
       {half_up('CAST(buyers AS BIGINT) * 10000', 'visitors', '0.0001')} AS conversion_rate,
       {half_up('CAST(rev * 100 AS BIGINT)', 'buyers')} AS revenue_per_buyer,
       {half_up('CAST(rev * 100 AS BIGINT)', 'visitors')} AS visitor_value,
       CAST(atc_users AS BIGINT) AS add_to_cart_users, CAST(atc_units AS BIGINT) AS add_to_cart_units,
       CAST(wishlists AS BIGINT) AS wishlists, CAST(wishlist_users AS BIGINT) AS wishlist_users,
       {half_up('CAST(rev * 100 AS BIGINT)', 'orders')} AS average_order_value,
       {half_up('CAST(units AS BIGINT) * 100', 'orders')} AS average_basket_size,
       CAST(cancelled AS DOUBLE) AS cancelled_amount, CAST(refunds AS DOUBLE) AS return_refund_amount"""

TX = """
top_line AS (
  SELECT order_key, product_key FROM (
    SELECT order_key, product_key,
           row_number() OVER (PARTITION BY order_key ORDER BY gross DESC, product_key) AS rn
    FROM items) WHERE rn = 1),
tx AS (
  SELECT CAST(p.order_key AS VARCHAR) AS transaction_id, pt.p_name AS product_name,
         p.items_count AS quantity, p.buyer_paid_price AS paid, p.order_total_price AS list,
         c.c_name AS customer_name, p.order_ts AS transaction_date,
         CASE p.platform_key WHEN 1 THEN 'Lazada' ELSE 'Shopee' END AS source, p.platform_key
  FROM priced p LEFT JOIN top_line t ON p.order_key = t.order_key
  LEFT JOIN part pt ON t.product_key = pt.p_partkey
  LEFT JOIN customer c ON p.customer_key = c.c_custkey),
combined AS (
  SELECT transaction_id, product_name, quantity, paid AS price,
         CASE WHEN platform_key = 1 THEN customer_name END AS customer_name,
         transaction_date, source
  FROM tx),
target AS (
  SELECT transaction_id, product_name, quantity, list AS price, customer_name, transaction_date, source
  FROM tx WHERE transaction_date < TIMESTAMP '2000-01-01'),
batch AS (SELECT * FROM combined WHERE transaction_date >= TIMESTAMP '1999-01-01')"""

HISTORY = """
hist0 AS (
  SELECT customer_key, order_date, COUNT(*) AS n, SUM(buyer_paid_price) AS s
  FROM priced GROUP BY customer_key, order_date),
hist AS (
  SELECT customer_key, order_date AS valid_from,
         SUM(n) OVER w AS orders_to_date, CAST(SUM(s) OVER w AS DECIMAL(20,2)) AS spent_to_date,
         MAX(order_date) OVER (PARTITION BY customer_key ORDER BY order_date
                               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS previous_order_date
  FROM hist0
  WINDOW w AS (PARTITION BY customer_key ORDER BY order_date
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
hist2 AS (
  SELECT *, CASE WHEN orders_to_date <= 1 THEN 'New' WHEN spent_to_date >= 3000000 THEN 'VIP'
                 ELSE 'Regular' END AS segment
  FROM hist)"""

EVENTS = """
ev AS (
  SELECT event_id, ts, user_id AS customer_key, event_type, value,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS product_key,
         CAST(user_id % 2 + 1 AS INTEGER) AS platform_key,
         CAST(year(ts) * 10000 + month(ts) * 100 + day(ts) AS INTEGER) AS time_key
  FROM events),
ev1 AS (SELECT *, lag(ts) OVER (PARTITION BY customer_key ORDER BY ts, event_id) AS prev FROM ev),
ev2 AS (SELECT *, CASE WHEN prev IS NULL OR ts >= prev + INTERVAL 30 MINUTE THEN ts END AS st FROM ev1),
sess AS (
  SELECT *, MAX(st) OVER (PARTITION BY customer_key ORDER BY ts, event_id
                          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS session_start
  FROM ev2),
traffic AS (
  SELECT time_key, product_key, customer_key, platform_key,
         COUNT(*) FILTER (WHERE event_type = 'view') AS page_views,
         COUNT(DISTINCT session_start) AS visits,
         NULLIF(COUNT(*) FILTER (WHERE event_type = 'click'), 0) AS add_to_cart_count,
         NULLIF(COUNT(*) FILTER (WHERE event_type = 'wishlist'), 0) AS wishlist_add_count
  FROM sess GROUP BY time_key, product_key, customer_key, platform_key),
activity AS (
  SELECT event_id AS activity_event_key, time_key, customer_key, platform_key,
         CASE event_type WHEN 'signup' THEN 'SHOP_FOLLOWED' WHEN 'error' THEN 'CHAT_SENT'
              WHEN 'purchase' THEN 'COUPON_CLAIMED' END AS activity_type,
         CASE WHEN event_type = 'error' THEN CAST(floor(value) AS INTEGER) END AS chat_response_time_seconds,
         CASE WHEN event_type = 'signup' THEN 1 END AS follower_count_change
  FROM ev WHERE event_type IN ('signup', 'error', 'purchase'))"""

FACT_ORDERS = """
fact_orders AS (
  SELECT i.order_key, i.line_number, o.time_key, i.product_key, o.customer_key, o.platform_key,
         i.net AS paid_price, i.quantity AS item_quantity, o.cancellation_reason, i.return_reason,
         CAST(i.net * 0.05 AS DECIMAL(12,2)) AS commission,
         CAST(CASE WHEN i.voucher_side = 'platform' THEN i.discount END AS DECIMAL(12,2)) AS subsidy
  FROM items i JOIN ords o ON i.order_key = o.order_key)"""

FACT = """
fact AS (
  SELECT o.time_key, o.customer_key, i.product_key, i.order_key, i.voucher_key, o.platform_key,
         i.quantity, i.gross, i.discount, i.net, i.unit_price, o.is_cancelled, i.is_returned,
         o.order_ts, o.order_date
  FROM items i JOIN ords o ON i.order_key = o.order_key)"""
