"""Registered queries: name -> (spark, sf_dir) -> DataFrame, with DuckDB oracles.

Every query reads the whole driver tables (or frames Spark derives from
them); none runs on fixed input alone.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopcube.plans import oracle_sql as O
from shopcube.plans.model import Model
from shopcube.sources import incoming

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


def _m(spark, d) -> Model:
    return Model(spark, d)


# ---------------------------------------------------------------------------
# Phase 1: star schema core and the four views
# ---------------------------------------------------------------------------

@query("product_performance", O.with_(*O.BASE) + """
SELECT p.p_name AS product_name, p.p_brand || '-' || CAST(p.p_partkey AS VARCHAR) AS product_sku,
       p.p_type AS category,
       COUNT(DISTINCT f.order_key) AS orders_count,
       CAST(SUM(f.quantity) AS BIGINT) AS total_quantity_sold,
       CAST(SUM(f.gross) AS DOUBLE) AS gross_sales,
       CAST(SUM(f.discount) AS DOUBLE) AS total_discounts,
       CAST(SUM(f.net) AS DOUBLE) AS net_sales,
       CAST(SUM(f.unit_price) AS DOUBLE) / NULLIF(CAST(COUNT(f.unit_price) AS DOUBLE), 0)
         AS avg_selling_price,
       CAST(SUM(f.net) AS DOUBLE) / NULLIF(CAST(SUM(f.quantity) AS DOUBLE), 0) AS revenue_per_unit
FROM items f JOIN ords o ON f.order_key = o.order_key
JOIN part p ON f.product_key = p.p_partkey
WHERE o.is_cancelled = FALSE
GROUP BY p.p_partkey, p.p_name, p.p_brand, p.p_type
""")
def q_product_performance(spark, d):
    from shopcube.operators.views import product_performance
    m = _m(spark, d)
    return product_performance(m.fact, m.products)


@query("order_pricing", O.with_(*O.FULL) + """
SELECT order_key, customer_key, platform_key, order_date,
       CAST(order_total_price AS DOUBLE) AS order_total_price,
       CAST(voucher_seller AS DOUBLE) AS voucher_seller,
       CAST(voucher_platform AS DOUBLE) AS voucher_platform,
       CAST(voucher_total AS DOUBLE) AS voucher_total,
       CAST(shipping_fee AS DOUBLE) AS shipping_fee,
       CAST(buyer_paid_price AS DOUBLE) AS buyer_paid_price,
       items_count, has_return, is_cancelled
FROM priced
""")
def q_order_pricing(spark, d):
    m = _m(spark, d)
    money = ["order_total_price", "voucher_seller", "voucher_platform", "voucher_total",
             "shipping_fee", "buyer_paid_price"]
    return m.priced_orders.select("order_key", "customer_key", "platform_key", "order_date",
                                  *[F.col(c).cast("double").alias(c) for c in money],
                                  "items_count", "has_return", "is_cancelled")


@query("fact_sales", O.with_(*O.BASE) + """
SELECT o.time_key, o.customer_key, i.product_key, i.order_key, i.voucher_key, o.platform_key,
       i.quantity AS quantity_sold, CAST(i.gross AS DOUBLE) AS gross_sales_amount,
       CAST(i.discount AS DOUBLE) AS discount_amount, CAST(i.net AS DOUBLE) AS net_sales_amount,
       CAST(i.tax AS DOUBLE) AS tax_amount, CAST(i.unit_price AS DOUBLE) AS unit_price,
       CAST(c.cost AS DOUBLE) AS unit_cost,
       CAST(i.net - c.cost * i.quantity AS DOUBLE) AS profit_amount,
       o.is_cancelled, i.is_returned, i.voucher_key IS NOT NULL AS is_voucher_used
FROM items i JOIN ords o ON i.order_key = o.order_key
LEFT JOIN (SELECT p_partkey,
                  CASE WHEN p_size <= 45 THEN CAST(CAST(p_retailprice AS DECIMAL(10,2)) * 0.6 AS DECIMAL(10,2)) END AS cost
           FROM part) c ON i.product_key = c.p_partkey
""")
def q_fact_sales(spark, d):
    from shopcube.operators.facts import fact_sales
    m = _m(spark, d)
    f = fact_sales(m.items, m.orders, m.products)
    money = ["gross_sales_amount", "discount_amount", "net_sales_amount", "tax_amount",
             "unit_price", "unit_cost", "profit_amount"]
    return f.select("time_key", "customer_key", "product_key", "order_key", "voucher_key",
                    "platform_key", "quantity_sold",
                    *[F.col(c).cast("double").alias(c) for c in money],
                    "is_cancelled", "is_returned", "is_voucher_used")


# Members that arrive after the facts (remainders of their keys), and the last day of the first calendar.
LATE_CUSTOMER, LATE_PRODUCT, LATE_VOUCHER, CALENDAR_END = (11, 3), (7, 2), (4, 3), "1999-12-31"

STAR_SQL = (*O.FULL, O.HISTORY, O.VOUCHERS, f"""
cust_known AS (SELECT c_custkey AS customer_key FROM customer WHERE c_custkey % {LATE_CUSTOMER[0]} <> {LATE_CUSTOMER[1]}),
cust_versions AS (
  SELECT customer_key, CAST(NULL AS DATE) AS valid_from, 'New' AS segment FROM cust_known
  UNION ALL SELECT customer_key, valid_from, segment FROM hist2 WHERE customer_key IN (SELECT customer_key FROM cust_known)),
dim_c0 AS (SELECT row_number() OVER (ORDER BY customer_key, valid_from NULLS FIRST) AS sk, customer_key, valid_from,
                  FALSE AS is_inferred, segment FROM cust_versions),
dim_c AS (
  SELECT * FROM dim_c0 UNION ALL
  SELECT (SELECT MAX(sk) FROM dim_c0) + row_number() OVER (ORDER BY customer_key), customer_key, NULL, TRUE, NULL
  FROM (SELECT DISTINCT customer_key FROM ords WHERE customer_key NOT IN (SELECT customer_key FROM cust_known))),
prod_all AS (SELECT p_partkey AS product_key, p_name AS product_name, p_type AS category FROM part),
dim_p0 AS (SELECT row_number() OVER (ORDER BY product_key) AS sk, product_key, FALSE AS is_inferred, product_name, category
           FROM prod_all WHERE product_key % {LATE_PRODUCT[0]} <> {LATE_PRODUCT[1]}),
dim_p AS (
  SELECT * FROM dim_p0 UNION ALL
  SELECT (SELECT MAX(sk) FROM dim_p0) + row_number() OVER (ORDER BY product_key), product_key, TRUE, NULL, NULL
  FROM (SELECT DISTINCT product_key FROM items WHERE product_key NOT IN (SELECT product_key FROM dim_p0))),
dim_v0 AS (SELECT row_number() OVER (ORDER BY voucher_key) AS sk, voucher_key, FALSE AS is_inferred
           FROM vouchers WHERE voucher_key % {LATE_VOUCHER[0]} <> {LATE_VOUCHER[1]}),
dim_v AS (
  SELECT * FROM dim_v0 UNION ALL
  SELECT (SELECT MAX(sk) FROM dim_v0) + row_number() OVER (ORDER BY voucher_key), voucher_key, TRUE
  FROM (SELECT DISTINCT voucher_key FROM items WHERE voucher_key IS NOT NULL
        AND voucher_key NOT IN (SELECT voucher_key FROM dim_v0))),
days AS (SELECT DISTINCT order_date AS date, time_key FROM ords),
dim_t0 AS (SELECT row_number() OVER (ORDER BY time_key) AS sk, time_key, FALSE AS is_inferred
           FROM days WHERE date <= DATE '{CALENDAR_END}'),
dim_t AS (
  SELECT * FROM dim_t0 UNION ALL
  SELECT (SELECT COALESCE(MAX(sk), 0) FROM dim_t0) + row_number() OVER (ORDER BY time_key), time_key, TRUE
  FROM days WHERE date > DATE '{CALENDAR_END}'),
cust_sk AS (
  SELECT o.order_key, arg_max(d.sk, COALESCE(d.valid_from, DATE '0001-01-01')) AS customer_sk
  FROM ords o JOIN dim_c d ON o.customer_key = d.customer_key AND (d.valid_from IS NULL OR d.valid_from < o.order_date)
  GROUP BY o.order_key)""")


def _star(spark, d):
    """Line facts with looked-up keys, and the dimensions with inferred members; some members are late by a fixed rule."""
    from shopcube.operators.history import customer_states
    from shopcube.operators.star import Lookup, new_dimension, new_versions, star_join
    m = _m(spark, d)
    known = lambda c, rule: F.col(c) % rule[0] != rule[1]
    customers = m.customers.select("customer_key").where(known("customer_key", LATE_CUSTOMER))
    states = customer_states(m.priced_orders).select("customer_key", "valid_from", "segment")
    versions = (customers.select("customer_key", F.lit(None).cast("date").alias("valid_from"), F.lit("New").alias("segment"))
                .unionByName(states.join(customers, "customer_key", "left_semi")))
    products = m.products.select("product_key", "product_name", "category")
    vouchers = m.vouchers.select(F.col("voucher_key").cast("int"))
    days = m.orders.select("time_key", "order_date").distinct()
    # customer and day are looked up once for each order, product and voucher for each line
    orders, dims = star_join(m.orders.select("order_key", "customer_key", "time_key", "platform_key", "order_date"), [
        (Lookup("customer", "customer_key", "customer_sk", at="order_date"), new_versions(versions, "customer_key"), "customer_key"),
        (Lookup("time", "time_key", "time_sk"),
         new_dimension(days.where(F.col("order_date") <= F.lit(CALENDAR_END).cast("date")).select("time_key"), "time_key"), "time_key")])
    lines, more = star_join(m.items.select("order_key", "line_number", "product_key", "voucher_key", "paid_price"), [
        (Lookup("product", "product_key", "product_sk"),
         new_dimension(products.where(known("product_key", LATE_PRODUCT)), "product_key"), "product_key"),
        (Lookup("voucher", "voucher_key", "voucher_sk"),
         new_dimension(vouchers.where(known("voucher_key", LATE_VOUCHER)), "voucher_key"), "voucher_key")])
    return m, lines.join(orders.drop("order_date"), "order_key"), {**dims, **more}


@query("star_join", O.with_(*STAR_SQL) + """
SELECT i.order_key, i.line_number, o.time_key, t.sk AS time_sk, o.customer_key, c.customer_sk,
       i.product_key, p.sk AS product_sk, i.voucher_key, v.sk AS voucher_sk, o.platform_key,
       CAST(i.net AS DOUBLE) AS net_sales_amount
FROM items i JOIN ords o ON i.order_key = o.order_key JOIN cust_sk c ON i.order_key = c.order_key
JOIN dim_t t ON o.time_key = t.time_key JOIN dim_p p ON i.product_key = p.product_key
LEFT JOIN dim_v v ON i.voucher_key = v.voucher_key
""")
def q_star_join(spark, d):
    """Every line with the keys of all its dimensions; the customer's version as of the order."""
    _, facts, _ = _star(spark, d)
    return facts.select("order_key", "line_number", "time_key", "time_sk", "customer_key", "customer_sk", "product_key",
                        "product_sk", "voucher_key", "voucher_sk", "platform_key",
                        F.col("paid_price").cast("double").alias("net_sales_amount"))


@query("star_inferred_members", O.with_(*STAR_SQL) + """
SELECT 'customer' AS dimension, customer_key AS business_key, sk FROM dim_c WHERE is_inferred
UNION ALL SELECT 'product', product_key, sk FROM dim_p WHERE is_inferred
UNION ALL SELECT 'voucher', voucher_key, sk FROM dim_v WHERE is_inferred
UNION ALL SELECT 'time', time_key, sk FROM dim_t WHERE is_inferred
""")
def q_star_inferred_members(spark, d):
    """The rows that stand for members which the facts name before they arrive."""
    _, _, dims = _star(spark, d)
    out = None
    for name, key in (("customer", "customer_key"), ("product", "product_key"), ("voucher", "voucher_key"), ("time", "time_key")):
        rows = dims[name].where("is_inferred").select(F.lit(name).alias("dimension"), F.col(key).cast("bigint").alias("business_key"), "sk")
        out = rows if out is None else out.unionByName(rows)
    return out


@query("star_completed_products", O.with_(*STAR_SQL) + """,
done AS (
  SELECT d.sk, d.product_key, d.is_inferred AND a.product_key IS NULL AS is_inferred,
         CASE WHEN d.is_inferred THEN a.product_name ELSE d.product_name END AS product_name,
         CASE WHEN d.is_inferred THEN a.category ELSE d.category END AS category
  FROM dim_p d LEFT JOIN prod_all a ON d.product_key = a.product_key)
SELECT * FROM done UNION ALL
SELECT (SELECT MAX(sk) FROM done) + row_number() OVER (ORDER BY product_key), product_key, FALSE, product_name, category
FROM prod_all WHERE product_key NOT IN (SELECT product_key FROM done)
""")
def q_star_completed_products(spark, d):
    """The product dimension after the late members came in: inferred rows completed in place, keys unchanged."""
    from shopcube.operators.star import complete_members
    m, _, dims = _star(spark, d)
    arrived = m.products.select("product_key", "product_name", "category")
    return complete_members(dims["product"], arrived, "product_key").select("sk", "product_key", "is_inferred", "product_name", "category")


@query("shipping_by_line", O.with_(*O.BASE) + """,
run AS (
  SELECT i.order_key, i.line_number, i.product_key, i.supplier_key,
         CAST(COALESCE(o.shipping_fee, 0) * 100 AS HUGEINT) AS fee, CAST(i.gross * 100 AS HUGEINT) AS g,
         SUM(CAST(i.gross * 100 AS HUGEINT)) OVER (PARTITION BY i.order_key
             ORDER BY i.line_number, i.product_key, i.supplier_key ROWS UNBOUNDED PRECEDING) AS upto,
         SUM(CAST(i.gross * 100 AS HUGEINT)) OVER (PARTITION BY i.order_key) AS total
  FROM items i JOIN ords o ON i.order_key = o.order_key)
SELECT order_key, line_number, product_key, supplier_key, CAST(CAST(fee * upto // total - fee * (upto - g) // total AS DECIMAL(18,0)) * 0.01 AS DOUBLE) AS shipping_revenue
FROM run
""")
def q_shipping_by_line(spark, d):
    """the order's shipping fee on its lines, exact to the cent."""
    from shopcube.operators.facts import allocate_shipping
    m = _m(spark, d)
    return doubles(allocate_shipping(m.items, m.orders))


_KEY_LOADS = """
SELECT {cols}, {sk}_rank AS {sk}, first_load FROM (
  SELECT *, CASE WHEN first_load THEN row_number() OVER (PARTITION BY first_load ORDER BY {cols})
                 ELSE (SELECT COUNT(*) FROM k WHERE first_load) + row_number() OVER (PARTITION BY first_load ORDER BY {cols}) END
         AS {sk}_rank FROM k)
"""


@query("fact_sales_keys", O.with_(*O.BASE) + ", k AS (SELECT DISTINCT i.order_key, i.line_number, i.product_key, i.supplier_key, o.order_date < DATE '1998-01-01' AS first_load "
       "FROM items i JOIN ords o ON i.order_key = o.order_key)" + _KEY_LOADS.format(cols="order_key, line_number, product_key, supplier_key", sk="sales_key"))
def q_fact_sales_keys(spark, d):
    """stored line keys over two loads, the second one run twice; orders before 1998 are the first load."""
    from shopcube.operators.dims import stored
    from shopcube.operators.facts import LINE
    m = _m(spark, d)
    lines = stored(m.items.select(*LINE).join(m.orders.select("order_key", "order_date"), "order_key"))    # read by every load
    early = F.col("order_date") < F.lit("1998-01-01").cast("date")
    return _stored_keys(spark, lines, early, LINE, "sales_key").distinct()


@query("fact_traffic_keys", O.with_(O.EVENTS) + ", k AS (SELECT time_key, product_key, customer_key, platform_key, "
       "time_key % 2 = 0 AS first_load FROM traffic WHERE product_key IS NOT NULL)"
       + _KEY_LOADS.format(cols="time_key, product_key, customer_key, platform_key", sk="traffic_event_key"))
def q_fact_traffic_keys(spark, d):
    """stored traffic keys over two loads; even days come first."""
    from shopcube.operators.traffic import fact_traffic
    keys = ["time_key", "product_key", "customer_key", "platform_key"]
    rows = fact_traffic(_m(spark, d).t.events).select(*keys).dropna()
    return _stored_keys(spark, rows, F.col("time_key") % 2 == 0, keys, "traffic_event_key")


def _stored_keys(spark, rows, early, keys, sk):
    from shopcube.operators.keymap import extend_map, with_keys
    from shopcube.session import scratch_path
    path = scratch_path(spark, "key-map")
    extend_map(rows.where(early), keys, path, "1")
    for _ in range(2):                                    # a load that runs again changes nothing
        key_map = extend_map(rows, keys, path, "2")
    return with_keys(rows.withColumn("first_load", early), key_map, keys, sk).select(*keys, sk, "first_load")


@query("dim_time", O.with_(O.ORDERS) + """
SELECT CAST(year(d) * 10000 + month(d) * 100 + day(d) AS INTEGER) AS time_key, CAST(d AS DATE) AS date,
       year(d) AS year, quarter(d) AS quarter, month(d) AS month, monthname(d) AS month_name,
       weekofyear(d) AS week, day(d) AS day_of_month, isodow(d) AS day_of_week,
       dayname(d) AS day_name, isodow(d) >= 6 AS is_weekend,
       (month(d) * 100 + day(d)) IN (101, 612, 1225, 1230) AS is_holiday,
       month(d) = day(d) AS is_mega_sale_day, year(d) AS fiscal_year, quarter(d) AS fiscal_quarter,
       CASE WHEN month(d) IN (12, 1, 2) THEN 'Winter' WHEN month(d) IN (3, 4, 5) THEN 'Spring'
            WHEN month(d) IN (6, 7, 8) THEN 'Summer' ELSE 'Fall' END AS season
FROM (SELECT unnest(generate_series(
        CAST(date_trunc('year', (SELECT MIN(order_date) FROM ords)) AS DATE),
        CAST(date_trunc('year', (SELECT MAX(order_date) FROM ords)) + INTERVAL 1 YEAR - INTERVAL 1 DAY AS DATE),
        INTERVAL 1 DAY)) AS d)
""")
def q_dim_time(spark, d):
    return _m(spark, d).dim_time


SUMMARY_SQL = O.with_(*O.FULL) + """
SELECT time_key, order_date AS date, platform_key,
       CASE platform_key WHEN 1 THEN 'Lazada' WHEN 2 THEN 'Shopee' END AS platform,
       COUNT(*) AS total_orders,
       COUNT(*) FILTER (WHERE NOT is_cancelled AND NOT has_return) AS successful_orders,
       COUNT(*) FILTER (WHERE is_cancelled) AS cancelled_orders,
       COUNT(*) FILTER (WHERE NOT is_cancelled AND has_return) AS returned_orders,
       COALESCE(CAST(SUM(items_count) FILTER (WHERE NOT is_cancelled) AS BIGINT), 0) AS total_items_sold,
       COALESCE(CAST(SUM(order_total_price) FILTER (WHERE NOT is_cancelled) AS DOUBLE), 0) AS gross_revenue,
       COALESCE(CAST(SUM(voucher_total) FILTER (WHERE NOT is_cancelled) AS DOUBLE), 0) AS total_discounts,
       COALESCE(CAST(SUM(buyer_paid_price) FILTER (WHERE NOT is_cancelled) AS DOUBLE), 0) AS net_revenue,
       COALESCE(CAST(SUM(COALESCE(shipping_fee, 0)) FILTER (WHERE NOT is_cancelled) AS DOUBLE), 0)
         AS shipping_revenue,
       COALESCE(CAST(SUM(buyer_paid_price) FILTER (WHERE NOT is_cancelled) AS DOUBLE)
         / NULLIF(CAST(COUNT(*) FILTER (WHERE NOT is_cancelled) AS DOUBLE), 0), 0) AS average_order_value,
       COUNT(DISTINCT customer_key) AS unique_customers,
       COUNT(*) FILTER (WHERE is_first_order) AS new_customers,
       COUNT(DISTINCT customer_key) - COUNT(*) FILTER (WHERE is_first_order) AS returning_customers,
       COUNT(*) FILTER (WHERE voucher_total > 0) AS vouchers_used,
       COALESCE(CAST(SUM(voucher_total) FILTER (WHERE voucher_total > 0) AS DOUBLE), 0)
         AS voucher_discount_total,
       CAST(COUNT(*) FILTER (WHERE voucher_total > 0) * 100 AS DOUBLE)
         / NULLIF(CAST(COUNT(*) AS DOUBLE), 0) AS voucher_adoption_rate
FROM priced
GROUP BY time_key, order_date, platform_key
"""


@query("sales_summary", SUMMARY_SQL)
def q_sales_summary(spark, d):
    return _m(spark, d).summary


@query("sales_trends", "WITH summary AS (" + SUMMARY_SQL + """)
SELECT year(s.date) AS year, quarter(s.date) AS quarter, monthname(s.date) AS month_name,
       weekofyear(s.date) AS week, dayname(s.date) AS day_name, isodow(s.date) >= 6 AS is_weekend,
       s.total_orders, s.net_revenue, s.average_order_value, s.unique_customers,
       s.voucher_adoption_rate
FROM summary s ORDER BY s.time_key, s.platform
""")
def q_sales_trends(spark, d):
    from shopcube.operators.views import sales_trends
    m = _m(spark, d)
    return sales_trends(m.dim_time, m.summary)


@query("net_revenue", O.with_(*O.FULL) + """
SELECT platform_key, CAST(SUM(buyer_paid_price) AS DOUBLE) AS net_revenue, COUNT(*) AS orders
FROM priced WHERE is_cancelled = FALSE GROUP BY platform_key
""")
def q_net_revenue(spark, d):
    from shopcube.operators.views import net_revenue
    return net_revenue(_m(spark, d).priced_orders)


@query("voucher_effectiveness", O.with_(*O.BASE, O.FIRST, O.USAGE, O.VOUCHERS) + """
SELECT v.voucher_code, v.voucher_name, v.voucher_type, v.start_date, v.end_date,
       COUNT(u.usage_key) AS total_usage, COUNT(DISTINCT u.customer_key) AS unique_customers,
       CAST(SUM(u.discount_amount) AS DOUBLE) AS total_discount_given,
       CAST(SUM(u.discount_amount) AS DOUBLE) / NULLIF(CAST(COUNT(u.discount_amount) AS DOUBLE), 0)
         AS avg_discount_per_use,
       CAST(SUM(u.order_value_after_discount) AS DOUBLE) AS total_order_value_generated,
       COUNT(CASE WHEN u.first_time_customer THEN 1 END) AS new_customer_acquisitions,
       CAST(SUM(u.order_value_after_discount) - SUM(u.discount_amount) AS DOUBLE)
         AS net_revenue_generated
FROM vouchers v LEFT JOIN usage u ON v.voucher_key = u.voucher_key
GROUP BY v.voucher_key, v.voucher_code, v.voucher_name, v.voucher_type, v.start_date, v.end_date
""")
def q_voucher_effectiveness(spark, d):
    from shopcube.operators.views import voucher_effectiveness
    m = _m(spark, d)
    return voucher_effectiveness(m.vouchers, m.usage)


@query("voucher_roi", O.with_(*O.BASE, O.FIRST, O.USAGE, O.VOUCHERS) + """
SELECT v.voucher_key, v.voucher_code,
       CAST(SUM(u.order_value_after_discount) AS DOUBLE) AS total_order_value_generated,
       CAST(SUM(u.discount_amount) AS DOUBLE) AS total_discount_given,
       CAST(SUM(u.order_value_after_discount) - SUM(u.discount_amount) AS DOUBLE)
         / NULLIF(CAST(SUM(u.discount_amount) AS DOUBLE), 0) AS effectiveness
FROM vouchers v LEFT JOIN usage u ON v.voucher_key = u.voucher_key
GROUP BY v.voucher_key, v.voucher_code
""")
def q_voucher_roi(spark, d):
    from shopcube.operators.views import voucher_roi
    m = _m(spark, d)
    return voucher_roi(m.vouchers, m.usage)


@query("customer_segments", O.with_(*O.FULL, O.CUSTOMERS) + """
SELECT customer_segment, COUNT(*) AS customer_count,
       CAST(SUM(total_orders) AS DOUBLE) / NULLIF(CAST(COUNT(total_orders) AS DOUBLE), 0)
         AS avg_orders_per_customer,
       CAST(SUM(average_order_value) AS DOUBLE) / NULLIF(CAST(COUNT(average_order_value) AS DOUBLE), 0)
         AS avg_order_value,
       CAST(SUM(total_spent) AS DOUBLE) / NULLIF(CAST(COUNT(total_spent) AS DOUBLE), 0)
         AS avg_customer_lifetime_value,
       CAST(SUM(total_spent) AS DOUBLE) AS segment_total_revenue,
       CAST(SUM(date_diff('day', first_order_date, last_order_date)) AS DOUBLE)
         / NULLIF(CAST(COUNT(date_diff('day', first_order_date, last_order_date)) AS DOUBLE), 0)
         AS avg_customer_lifespan_days
FROM dim_customers WHERE is_active = TRUE GROUP BY customer_segment
""")
def q_customer_segments(spark, d):
    from shopcube.operators.views import customer_segments
    return customer_segments(_m(spark, d).dim_customers)


@query("dim_customers", O.with_(*O.FULL, O.CUSTOMERS) + """
SELECT customer_key, customer_id, first_name, last_name, full_name, city, region, country,
       total_orders, CAST(total_spent AS DOUBLE) AS total_spent,
       CAST(average_order_value AS DOUBLE) AS average_order_value,
       first_order_date, last_order_date, customer_segment,
       CAST(customer_lifetime_value AS DOUBLE) AS customer_lifetime_value, buyer_segment, ltv_tier,
       recency_days, platform_buyer_id, region_class, is_active
FROM dim_customers
""")
def q_dim_customers(spark, d):
    c = _m(spark, d).dim_customers
    money = {"total_spent", "average_order_value", "customer_lifetime_value"}
    return c.select(*[F.col(x).cast("double").alias(x) if x in money else F.col(x)
                      for x in c.columns])


# ---------------------------------------------------------------------------
# Phase 2: daily-KPI feed
# ---------------------------------------------------------------------------

def doubles(df: DataFrame) -> DataFrame:
    """Report decimals as double (exact sums/ratios, engine-neutral type)."""
    from pyspark.sql.types import DecimalType
    return df.select(*[F.col(f.name).cast("double").alias(f.name)
                       if isinstance(f.dataType, DecimalType) else F.col(f.name)
                       for f in df.schema.fields])


KPI_DAILY = "kd AS (" + O.kpi_aggs("order_date AS date") + " GROUP BY platform_key, order_date)"
KPI_PERIOD = ("kp AS (" + O.kpi_aggs("CAST(date_trunc('month', order_date) AS DATE) AS period_start")
              + " GROUP BY platform_key, date_trunc('month', order_date))")
KPI_MEASURE_NAMES = ["total_sales_value", "visitors", "buyers", "total_orders", "pageviews",
                     "units_sold", "conversion_rate", "revenue_per_buyer", "visitor_value",
                     "add_to_cart_users", "add_to_cart_units", "wishlists", "wishlist_users",
                     "average_order_value", "average_basket_size", "cancelled_amount",
                     "return_refund_amount"]


@query("kpi_daily", O.with_(*O.FULL, KPI_DAILY) + "SELECT platform, date," + O.KPI_MEASURES
       + " FROM kd")
def q_kpi_daily(spark, d):
    k = _m(spark, d).kpi.daily
    return doubles(k.select("platform", "date", *KPI_MEASURE_NAMES))


@query("kpi_period", O.with_(*O.FULL, KPI_PERIOD)
       + "SELECT platform, period_start, last_day(period_start) AS period_end," + O.KPI_MEASURES
       + " FROM kp")
def q_kpi_period(spark, d):
    k = _m(spark, d).kpi.period
    return doubles(k.select("platform", "period_start", "period_end", *KPI_MEASURE_NAMES))


@query("kpi_ratios", O.with_(*O.FULL, KPI_DAILY) + "SELECT platform, date, conversion_rate, revenue_per_buyer,"
       " visitor_value, average_order_value, average_basket_size FROM (SELECT platform, date,"
       + O.KPI_MEASURES + " FROM kd)")
def q_kpi_ratios(spark, d):
    """The five ratios computed anew from the counts and amounts of the cleaned rows."""
    from shopcube.operators.kpi import RATIOS, kpi_ratios
    return doubles(kpi_ratios(_m(spark, d).kpi.daily).select("platform", "date", *RATIOS))


@query("kpi_rollup", O.with_(*O.FULL, KPI_DAILY) + f"""
SELECT platform, CAST(date_trunc('month', date) AS DATE) AS period_start, MAX(date) AS last_day,
       COUNT(*) AS days, CAST(SUM(rev) AS DOUBLE) AS total_sales_value,
       CAST(SUM(orders) AS BIGINT) AS total_orders, CAST(SUM(pageviews) AS BIGINT) AS pageviews,
       CAST(SUM(units) AS BIGINT) AS units_sold, CAST(SUM(atc_units) AS BIGINT) AS add_to_cart_units,
       CAST(SUM(wishlists) AS BIGINT) AS wishlists, CAST(SUM(cancelled) AS DOUBLE) AS cancelled_amount,
       CAST(SUM(refunds) AS DOUBLE) AS return_refund_amount,
       {O.half_up('CAST(SUM(rev) * 100 AS BIGINT)', 'SUM(orders)')} AS average_order_value,
       {O.half_up('CAST(SUM(units) AS BIGINT) * 100', 'SUM(orders)')} AS average_basket_size
FROM kd GROUP BY platform, date_trunc('month', date)
""")
def q_kpi_rollup(spark, d):
    from shopcube.operators.kpi import rollup_kpis
    return doubles(rollup_kpis(_m(spark, d).kpi.daily))


_RECON = [("total_sales_value", "rev", "DOUBLE"), ("total_orders", "orders", "BIGINT"),
          ("pageviews", "pageviews", "BIGINT"), ("units_sold", "units", "BIGINT"),
          ("add_to_cart_units", "atc_units", "BIGINT"), ("wishlists", "wishlists", "BIGINT"),
          ("cancelled_amount", "cancelled", "DOUBLE"), ("return_refund_amount", "refunds", "DOUBLE")]


@query("kpi_reconcile", O.with_(*O.FULL, KPI_DAILY, KPI_PERIOD) + """
SELECT p.platform, lower(p.platform) || '-' || strftime(p.period_start, '%Y-%m') AS source_file,
       p.period_start, last_day(p.period_start) AS period_end, COUNT(d.date) AS days, """
       + ", ".join(f"CAST(p.{s} - COALESCE(SUM(d.{s}), 0) AS {t}) AS diff_{c}" for c, s, t in _RECON)
       + ", " + " AND ".join(f"COALESCE(p.{s} = COALESCE(SUM(d.{s}), 0), TRUE)" for c, s, t in _RECON)
       + """ AS reconciled
FROM kp p LEFT JOIN kd d ON p.platform = d.platform
  AND d.date BETWEEN p.period_start AND last_day(p.period_start)
GROUP BY p.platform, p.period_start, """ + ", ".join(f"p.{s}" for _, s, _ in _RECON))
def q_kpi_reconcile(spark, d):
    from shopcube.operators.kpi import reconcile_kpis
    k = _m(spark, d).kpi
    return doubles(reconcile_kpis(k.daily, k.period))


@query("kpi_quarantine", O.with_(*O.FULL) + """,
files AS (SELECT DISTINCT CASE platform_key WHEN 1 THEN 'Lazada' ELSE 'Shopee' END AS platform,
                 date_trunc('month', order_date) AS m FROM priced),
bad AS (
  SELECT platform, 'malformed_row' AS reason FROM files
  UNION ALL SELECT platform, 'bad_number' FROM files WHERE month(m) % 3 = 1
  UNION ALL SELECT platform, 'bad_date' FROM files WHERE month(m) % 3 = 2
  UNION ALL SELECT platform, 'bad_period' FROM files WHERE month(m) % 3 = 0 
  UNION ALL SELECT platform, 'out_of_period' FROM files WHERE month(m) = 12)
SELECT platform, reason, COUNT(*) AS rows FROM bad GROUP BY platform, reason
""")
def q_kpi_quarantine(spark, d):
    """Rows the cleaning rejected, by reason (the export is damaged by a fixed rule)."""
    q = _m(spark, d).kpi.quarantine
    return q.groupBy("platform", "reason").agg(F.count(F.lit(1)).alias("rows"))


# ---------------------------------------------------------------------------
# Phase 3: loading, keys, quality
# ---------------------------------------------------------------------------

TX_OUT = ["transaction_id", "product_name", "quantity", "CAST(price AS DOUBLE) AS price",
          "customer_name", "transaction_date", "source"]
INITIAL_CUTOFF = "2000-01-01"     # orders before this date form the initial load
BATCH_FROM = "1999-01-01"         # the incremental batch re-extracts from this date


def _feeds(m: Model, tx: DataFrame | None = None):
    from shopcube.operators.load import combine_feeds
    from shopcube.sources.canonical import marketplace_feeds
    if tx is None:
        from shopcube.operators.dims import checkpointed
        tx = checkpointed(m.transactions("buyer_paid_price"))   # staged once, read per feed
    a, b = marketplace_feeds(tx)
    return combine_feeds(a, b)


def _upsert_inputs(m: Model):
    """Initial load: list prices of orders before the cutoff; batch: the
    marketplace feeds (paid prices) re-extracted from an earlier date.  Both
    come from one staged transactions frame, so its joins run once."""
    from shopcube.operators.dims import checkpointed
    from shopcube.sources.canonical import TRANSACTION_COLUMNS
    # L01 staging: the extracted transactions are written once (as the
    # loader stages a batch before merging) and every branch reads the stage
    tx = checkpointed(m.transactions("buyer_paid_price"))
    target = (tx.filter(F.col("transaction_date") < F.lit(INITIAL_CUTOFF).cast("timestamp_ntz"))
              .withColumn("price", F.col("list_price"))
              .select(*TRANSACTION_COLUMNS))
    batch = _feeds(m, tx).filter(
        F.col("transaction_date") >= F.lit(BATCH_FROM).cast("timestamp_ntz"))
    return target, batch


@query("combined_transactions", O.with_(*O.FULL, O.TX) + "SELECT " + ", ".join(TX_OUT)
       + " FROM combined")
def q_combined_transactions(spark, d):
    return doubles(_feeds(_m(spark, d)))


@query("upsert_transactions", O.with_(*O.FULL, O.TX) + "SELECT " + ", ".join(TX_OUT) + """
FROM (SELECT * FROM target WHERE transaction_id NOT IN (SELECT transaction_id FROM batch)
      UNION ALL SELECT * FROM batch)
""")
def q_upsert_transactions(spark, d):
    from shopcube.operators.load import upsert
    target, batch = _upsert_inputs(_m(spark, d))
    return doubles(upsert(target, batch, "transaction_id").merged)


@query("upsert_report", O.with_(*O.FULL, O.TX) + """
SELECT COUNT(*) FILTER (WHERE b.transaction_id IS NOT NULL AND t.transaction_id IS NULL) AS inserted,
       COUNT(*) FILTER (WHERE b.transaction_id IS NOT NULL AND t.transaction_id IS NOT NULL) AS updated,
       COUNT(*) FILTER (WHERE b.transaction_id IS NULL) AS unchanged,
       COUNT(*) AS total_after
FROM target t FULL JOIN batch b ON t.transaction_id = b.transaction_id
""")
def q_upsert_report(spark, d):
    from shopcube.operators.load import upsert_counts
    target, batch = _upsert_inputs(_m(spark, d))
    return upsert_counts(target, batch, "transaction_id")


@query("surrogate_keys", """
WITH first_load AS (
  SELECT customer_id, row_number() OVER (ORDER BY customer_id) AS sk
  FROM (SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS customer_id FROM orders
        WHERE o_orderdate < TIMESTAMP '1996-01-01')),
second AS (
  SELECT customer_id, (SELECT COUNT(*) FROM first_load) + row_number() OVER (ORDER BY customer_id) AS sk
  FROM (SELECT CAST(c_custkey AS VARCHAR) AS customer_id FROM customer)
  WHERE customer_id NOT IN (SELECT customer_id FROM first_load))
SELECT customer_id, CAST(sk AS BIGINT) AS sk FROM first_load UNION ALL SELECT customer_id, sk FROM second
""")
def q_surrogate_keys(spark, d):
    """Dense keys for customers seen in an early load, then the rest keep
    counting from there -- existing keys never change."""
    from shopcube.operators.dims import assign_surrogate_keys
    m = _m(spark, d)
    early = (m.t.orders.filter(F.col("o_orderdate") < F.lit("1996-01-01").cast("timestamp_ntz"))
             .select(F.col("o_custkey").cast("string").alias("customer_id")))
    first = assign_surrogate_keys(early, "customer_id")
    return assign_surrogate_keys(m.customers.select("customer_id"), "customer_id", existing=first)


SEGMENTS = ["New", "Regular", "VIP", "Inactive"]
TIERS = ["Gold", "Silver", "Bronze"]
STATUSES = ["completed", "open", "cancelled"]


@query("quality_report", O.with_(incoming.ORACLE) + """
SELECT 'orders' AS table_name, 'unique' AS rule, 'order_key' AS column_name,
       (SELECT COUNT(*) FROM (SELECT order_key FROM in_orders GROUP BY 1 HAVING COUNT(*) > 1)) AS failures
UNION ALL SELECT 'orders', 'not_null', 'order_date', COUNT(*) FILTER (WHERE order_date IS NULL) FROM in_orders
UNION ALL SELECT 'orders', 'not_null', 'customer_key', COUNT(*) FILTER (WHERE customer_key IS NULL) FROM in_orders
UNION ALL SELECT 'orders', 'allowed_values', 'status_code',
       COUNT(*) FILTER (WHERE status_code NOT IN ('F', 'O', 'P')) FROM in_orders
UNION ALL SELECT 'orders', 'not_negative', 'total', COUNT(*) FILTER (WHERE total < 0) FROM in_orders
UNION ALL SELECT 'orders', 'foreign_key', 'customer_key', COUNT(*) FROM in_orders
       WHERE customer_key IS NOT NULL AND customer_key NOT IN (SELECT c_custkey FROM customer)
UNION ALL SELECT 'order_items', 'unique', 'order_key,line_number',
       (SELECT COUNT(*) FROM (SELECT 1 FROM in_items GROUP BY order_key, line_number HAVING COUNT(*) > 1))
UNION ALL SELECT 'order_items', 'not_null', 'quantity', COUNT(*) FILTER (WHERE quantity IS NULL) FROM in_items
UNION ALL SELECT 'order_items', 'range', 'discount_rate',
       COUNT(*) FILTER (WHERE discount_rate NOT BETWEEN 0 AND 1) FROM in_items
UNION ALL SELECT 'order_items', 'price_identity', 'net_cents', COUNT(*) FILTER (WHERE bad_net) FROM in_items
UNION ALL SELECT 'order_items', 'foreign_key', 'order_key', COUNT(*) FROM in_items
       WHERE order_key NOT IN (SELECT o_orderkey FROM orders)
UNION ALL SELECT 'order_items', 'foreign_key', 'product_key', COUNT(*) FROM in_items
       WHERE product_key NOT IN (SELECT p_partkey FROM part)
UNION ALL SELECT 'events', 'unique', 'event_key',
       (SELECT COUNT(*) FROM (SELECT event_key FROM in_events GROUP BY 1 HAVING COUNT(*) > 1))
UNION ALL SELECT 'events', 'not_null', 'customer_key', COUNT(*) FILTER (WHERE customer_key IS NULL) FROM in_events
UNION ALL SELECT 'events', 'allowed_values', 'event_type',
       COUNT(*) FILTER (WHERE event_type <> lower(event_type)) FROM in_events
""")
def q_quality_report(spark, d):
    """Q01-Q07 on incoming batches (damaged by a fixed rule, so that no rule counts 0 by construction)."""
    from shopcube.operators import quality as Q
    t = _m(spark, d).t
    o, items, ev = incoming.orders(t), incoming.order_items(t), incoming.events(t)
    identity = F.col("net_cents") == F.col("gross_cents") - F.col("discount_cents")
    return Q.quality_report(
        Q.keyed_checks(o, "orders", ["order_key"],
                       Q.not_null("order_date", "customer_key") + Q.one_of("status_code", ["F", "O", "P"])
                       + Q.in_range("not_negative", "total", F.col("total") >= 0)),
        Q.orphan_check(o, "orders", "customer_key", t.customer, "c_custkey"),
        Q.keyed_checks(items, "order_items", ["order_key", "line_number"],
                       Q.not_null("quantity") + Q.in_range("range", "discount_rate", F.col("discount_rate").between(0, 1))
                       + Q.holds("price_identity", "net_cents", identity)),
        Q.orphan_check(items, "order_items", "order_key", t.orders, "o_orderkey"),
        Q.orphan_check(items, "order_items", "product_key", t.part, "p_partkey"),
        Q.keyed_checks(ev, "events", ["event_key"],
                       Q.not_null("customer_key") + Q.in_range("allowed_values", "event_type",
                                                               F.col("event_type") == F.lower("event_type"))),
    )


@query("enforce_batch", O.with_(incoming.ORACLE) + """,
o AS (SELECT *, CASE WHEN order_date IS NULL THEN 'not_null:order_date' WHEN customer_key IS NULL THEN 'not_null:customer_key'
                     WHEN status_code NOT IN ('F', 'O', 'P') THEN 'allowed_values:status_code'
                     WHEN total < 0 THEN 'not_negative:total' END AS own FROM in_orders),
o2 AS (SELECT *, CASE WHEN own IS NOT NULL THEN own
                      WHEN COUNT(*) FILTER (WHERE own IS NULL) OVER (PARTITION BY order_key) > 1 THEN 'unique:order_key'
                      WHEN customer_key NOT IN (SELECT c_custkey FROM customer) THEN 'foreign_key:customer_key' END AS reason FROM o),
i AS (SELECT *, CASE WHEN quantity IS NULL THEN 'not_null:quantity' WHEN discount_rate NOT BETWEEN 0 AND 1 THEN 'range:discount_rate'
                     WHEN bad_net THEN 'price_identity:net_cents' END AS own FROM in_items),
i2 AS (SELECT *, CASE WHEN own IS NOT NULL THEN own
                      WHEN COUNT(*) FILTER (WHERE own IS NULL) OVER (PARTITION BY order_key, line_number, product_key) > 1
                        THEN 'unique:order_key,line_number,product_key'
                      WHEN order_key NOT IN (SELECT order_key FROM o2 WHERE reason IS NULL) THEN 'foreign_key:order_key'
                      WHEN product_key NOT IN (SELECT p_partkey FROM part) THEN 'foreign_key:product_key' END AS reason FROM i)
SELECT 'orders' AS table_name, COALESCE(reason, 'accepted') AS outcome, COUNT(*) AS rows FROM o2 GROUP BY ALL
UNION ALL SELECT 'order_items', COALESCE(reason, 'accepted'), COUNT(*) FROM i2 GROUP BY ALL
""")
def q_enforce_batch(spark, d):
    """J06, Q01-Q07 as enforcement: orders and lines as they come in, split into accepted and rejected rows by first cause."""
    from shopcube.operators import quality as Q
    from shopcube.operators.enforce import Constraints, Parent, enforce
    t = _m(spark, d).t
    identity = F.col("net_cents") == F.col("gross_cents") - F.col("discount_cents")
    tables = [
        Constraints("order_items", ["order_key", "line_number", "product_key"],
                    Q.not_null("quantity") + Q.in_range("range", "discount_rate", F.col("discount_rate").between(0, 1))
                    + Q.holds("price_identity", "net_cents", identity),
                    [Parent("order_key", "orders", "order_key"), Parent("product_key", "products", "p_partkey")]),
        Constraints("orders", ["order_key"],
                    Q.not_null("order_date", "customer_key") + Q.one_of("status_code", ["F", "O", "P"])
                    + Q.in_range("not_negative", "total", F.col("total") >= 0), [Parent("customer_key", "customers", "c_custkey")])]
    accepted, rejected = enforce({"orders": incoming.orders(t), "order_items": incoming.order_items(t)}, tables,
                                 {"customers": t.customer, "products": t.part})
    out = None
    for name in ("orders", "order_items"):
        rows = (accepted[name].select(F.lit("accepted").alias("outcome"))
                .unionByName(rejected[name].select(F.col("reason").alias("outcome"))))
        rows = rows.groupBy(F.lit(name).alias("table_name"), "outcome").agg(F.count(F.lit(1)).alias("rows"))
        out = rows if out is None else out.unionByName(rows)
    return out


# ---------------------------------------------------------------------------
# Phase 4: vouchers, customer state over time
# ---------------------------------------------------------------------------

@query("customer_state_before_order", O.with_(*O.FULL) + """
SELECT customer_key, order_key, order_date,
       COUNT(*) OVER w AS prior_orders,
       CAST(COALESCE(SUM(buyer_paid_price) OVER w, 0) AS DOUBLE) AS prior_spent,
       MAX(order_date) OVER w AS previous_order_date
FROM priced
WINDOW w AS (PARTITION BY customer_key ORDER BY order_ts, order_key
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
""")
def q_customer_state_before_order(spark, d):
    from shopcube.operators.history import state_before_order
    return doubles(state_before_order(_m(spark, d).priced_orders))


@query("customer_history", O.with_(*O.FULL, O.HISTORY) + """
SELECT customer_key, valid_from, CAST(orders_to_date AS BIGINT) AS orders_to_date,
       CAST(spent_to_date AS DOUBLE) AS spent_to_date, previous_order_date, segment,
       lead(valid_from) OVER (PARTITION BY customer_key ORDER BY valid_from) AS valid_to
FROM hist2
""")
def q_customer_history(spark, d):
    from shopcube.operators.history import customer_history
    return doubles(customer_history(_m(spark, d).priced_orders))


@query("customer_history_batches", O.with_(*O.FULL, O.HISTORY) + """
SELECT h.customer_key, h.valid_from, CAST(h.orders_to_date AS BIGINT) AS orders_to_date,
       CAST(h.spent_to_date AS DOUBLE) AS spent_to_date, h.previous_order_date, h.segment,
       LEAD(h.valid_from) OVER (PARTITION BY h.customer_key ORDER BY h.valid_from) AS valid_to
FROM hist2 h
""")
def q_customer_history_batches(spark, d):
    """D23 by batches: three loads whose days overlap, late rows split stored intervals."""
    from shopcube.operators.dims import stored
    from shopcube.operators.history import load_history
    from shopcube.session import scratch_path
    root, orders = scratch_path(spark, "customer-history"), stored(_m(spark, d).priced_orders.select(
        "customer_key", "order_key", "order_date", "buyer_paid_price"))
    for n in (1, 2, 0):
        load_history(orders.where(F.col("order_key") % 3 == n), root, buckets=16)
    return doubles(spark.read.parquet(root).select("customer_key", "valid_from", "orders_to_date", "spent_to_date",
                                                   "previous_order_date", "segment", "valid_to"))


@query("new_customers_batches", O.with_(*O.FULL) + """
SELECT order_date, platform_key, COUNT(*) AS new_customers FROM priced WHERE is_first_order GROUP BY order_date, platform_key
""")
def q_new_customers_batches(spark, d):
    """W01 by batches: new customers of each day from the changes of a stored index, the latest orders loaded first."""
    from shopcube.operators.history import FIRST, load_first_orders
    from shopcube.session import scratch_path
    root, orders, changes = scratch_path(spark, "first-orders"), _m(spark, d).orders.select(*FIRST), []
    for lo, hi in (("1998-01-01", "2100-01-01"), ("1995-01-01", "1999-06-01"), ("1900-01-01", "1996-06-01")):
        changes.append(load_first_orders(orders.where(F.col("order_date").between(F.lit(lo), F.lit(hi))), root, buckets=16))
    both = changes[0].unionByName(changes[1]).unionByName(changes[2])
    return both.groupBy("order_date", "platform_key").agg(F.sum("change").alias("new_customers")).where("new_customers <> 0")


@query("voucher_usage", O.with_(*O.FULL, O.USAGE, O.HISTORY) + """
SELECT u.usage_key, u.voucher_key, u.order_key, u.customer_key, u.time_key, u.voucher_code,
       CAST(u.discount_amount AS DOUBLE) AS discount_amount,
       CAST(u.order_value_before_discount AS DOUBLE) AS order_value_before_discount,
       CAST(u.order_value_after_discount AS DOUBLE) AS order_value_after_discount,
       u.usage_date, u.first_time_customer,
       CASE WHEN h.segment IS NULL THEN 'New'
            WHEN date_diff('day', h.valid_from, CAST(u.usage_date AS DATE)) > 365 THEN 'Inactive'
            ELSE h.segment END AS customer_segment_at_usage
FROM usage u ASOF LEFT JOIN hist2 h
  ON u.customer_key = h.customer_key AND CAST(u.usage_date AS DATE) > h.valid_from
""")
def q_voucher_usage(spark, d):
    """F07 + J08: usage rows with the customer's segment as of the usage."""
    from shopcube.operators.history import segment_at_usage
    m = _m(spark, d)
    return doubles(segment_at_usage(m.usage, m.priced_orders).withColumn("usage_key", F.col("usage_key").cast("bigint")))


@query("voucher_eligibility", O.with_(*O.FULL, O.USAGE, O.VOUCHERS) + """,
elig AS (
  SELECT v.voucher_key, COUNT(*) AS n FROM priced p JOIN vouchers v
    ON p.order_ts BETWEEN v.start_date AND v.end_date AND p.order_total_price >= v.minimum_spend
  WHERE NOT p.is_cancelled GROUP BY v.voucher_key),
uses AS (
  SELECT u.voucher_key, COUNT(*) AS uses,
         COUNT(*) FILTER (WHERE u.usage_date BETWEEN v.start_date AND v.end_date
                          AND u.order_value_before_discount >= v.minimum_spend) AS valid_uses,
         COUNT(*) FILTER (WHERE NOT (u.usage_date BETWEEN v.start_date AND v.end_date)) AS outside_window,
         COUNT(*) FILTER (WHERE u.usage_date BETWEEN v.start_date AND v.end_date
                          AND u.order_value_before_discount < v.minimum_spend) AS below_minimum
  FROM usage u JOIN vouchers v ON u.voucher_key = v.voucher_key GROUP BY u.voucher_key)
SELECT v.voucher_key, v.voucher_code, COALESCE(e.n, 0) AS eligible_orders,
       COALESCE(s.uses, 0) AS uses, COALESCE(s.valid_uses, 0) AS valid_uses,
       COALESCE(s.outside_window, 0) AS outside_window, COALESCE(s.below_minimum, 0) AS below_minimum
FROM vouchers v LEFT JOIN elig e ON v.voucher_key = e.voucher_key
LEFT JOIN uses s ON v.voucher_key = s.voucher_key
""")
def q_voucher_eligibility(spark, d):
    from shopcube.operators.vouchers import voucher_eligibility
    m = _m(spark, d)
    return voucher_eligibility(m.vouchers, m.priced_orders, m.usage)


@query("voucher_audience", O.with_(*O.FULL, O.HISTORY, O.VOUCHERS) + """,
o AS (
  SELECT p.*, CASE WHEN h.segment IS NULL THEN 'New' WHEN date_diff('day', h.valid_from, p.order_date) > 365 THEN 'Inactive'
                   ELSE h.segment END AS segment
  FROM priced p ASOF LEFT JOIN hist2 h ON p.customer_key = h.customer_key AND p.order_date > h.valid_from),
v AS (SELECT *, CASE WHEN voucher_key % 4 = 0 THEN 'new_customers' WHEN voucher_key % 4 = 2 THEN 'vip' ELSE 'all' END AS target_audience
      FROM vouchers)
SELECT v.voucher_key, v.target_audience, COUNT(o.order_key) AS eligible_orders
FROM v LEFT JOIN o ON o.order_ts BETWEEN v.start_date AND v.end_date AND o.order_total_price >= v.minimum_spend AND NOT o.is_cancelled
  AND (v.target_audience = 'all' OR v.target_audience = 'new_customers' AND o.is_first_order
       OR v.target_audience = 'vip' AND o.segment = 'VIP')
GROUP BY v.voucher_key, v.target_audience
""")
def q_voucher_audience(spark, d):
    """F09 with target audiences: first orders, orders of VIPs, or all."""
    from shopcube.operators.vouchers import audience_eligibility
    m = _m(spark, d)
    return audience_eligibility(m.vouchers, m.priced_orders)


@query("campaign_reach", O.with_(*O.FULL) + """,
windows AS (
  SELECT i.product_key, MIN(i.ship_date) AS s, MAX(i.ship_date) AS e,
         CAST(ANY_VALUE(CAST(p.p_retailprice AS DECIMAL(10,2))) * 100 AS DECIMAL(12,2)) AS least
  FROM items i JOIN part p ON i.product_key = p.p_partkey GROUP BY i.product_key)
SELECT w.product_key, w.s AS start_day, w.e AS end_day, CAST(w.least AS DOUBLE) AS minimum_spend,
       COUNT(o.order_key) AS orders_reached
FROM windows w LEFT JOIN priced o ON o.order_date BETWEEN w.s AND w.e AND o.order_total_price >= w.least
GROUP BY w.product_key, w.s, w.e, w.least
""")
def q_campaign_reach(spark, d):
    """F09 with a window for every product, from its first to its last shipment: as many windows as products."""
    from shopcube.functions.money import dec
    from shopcube.operators.intervals import count_in_windows
    m = _m(spark, d)
    windows = (m.items.groupBy("product_key").agg(F.min("ship_date").alias("start_day"), F.max("ship_date").alias("end_day"))
               .join(m.products.select("product_key", (F.col("list_price") * dec("100")).cast("decimal(12,2)").alias("minimum_spend")),
                     "product_key"))
    reach = count_in_windows(m.priced_orders.select("order_date", F.col("order_total_price").cast("decimal(12,2)").alias("total")),
                             "order_date", "total", windows, "product_key", "start_day", "end_day", "minimum_spend")
    return (windows.join(reach, "product_key", "left")
            .select("product_key", "start_day", "end_day", F.col("minimum_spend").cast("double").alias("minimum_spend"),
                    F.coalesce("points", F.lit(0)).cast("bigint").alias("orders_reached")))


@query("voucher_discounts", O.with_(*O.FULL, O.USAGE, O.VOUCHERS) + """,
r AS (
  SELECT u.voucher_key, u.order_value_before_discount AS before, u.discount_amount, v.maximum_discount,
         CASE WHEN v.voucher_type = 'percentage'
              THEN CAST(u.order_value_before_discount * v.discount_percentage * 0.01 AS DECIMAL(10,2))
              ELSE v.discount_value END AS raw
  FROM usage u JOIN vouchers v ON u.voucher_key = v.voucher_key)
SELECT voucher_key, COUNT(*) AS uses, CAST(SUM(raw) AS DOUBLE) AS uncapped_discount,
       CAST(SUM(CAST(least(raw, COALESCE(maximum_discount, raw), before) AS DECIMAL(10,2))) AS DOUBLE)
         AS entitled_discount,
       COUNT(*) FILTER (WHERE raw > maximum_discount) AS capped_uses,
       CAST(SUM(discount_amount) AS DOUBLE) AS applied_discount
FROM r GROUP BY voucher_key
""")
def q_voucher_discounts(spark, d):
    from shopcube.operators.vouchers import voucher_discounts
    m = _m(spark, d)
    return voucher_discounts(m.vouchers, m.usage)


@query("voucher_limits", O.with_(*O.FULL, O.USAGE, O.VOUCHERS) + """,
pc AS (
  SELECT u.voucher_key, u.customer_key, u.order_key, u.usage_date, v.usage_limit,
         v.usage_limit_per_customer,
         row_number() OVER (PARTITION BY u.voucher_key, u.customer_key ORDER BY u.usage_date, u.order_key)
           AS customer_rank
  FROM usage u JOIN vouchers v ON u.voucher_key = v.voucher_key),
ok AS (
  SELECT order_key, voucher_key,
         row_number() OVER (PARTITION BY voucher_key ORDER BY usage_date, order_key) AS voucher_rank
  FROM pc WHERE customer_rank <= usage_limit_per_customer)
SELECT pc.voucher_key, pc.customer_key, pc.order_key, pc.usage_date, pc.usage_limit,
       pc.usage_limit_per_customer, pc.customer_rank,
       pc.customer_rank <= pc.usage_limit_per_customer AS within_customer_limit, ok.voucher_rank,
       pc.customer_rank <= pc.usage_limit_per_customer AND ok.voucher_rank <= pc.usage_limit AS accepted
FROM pc LEFT JOIN ok ON pc.order_key = ok.order_key AND pc.voucher_key = ok.voucher_key
""")
def q_voucher_limits(spark, d):
    from shopcube.operators.vouchers import voucher_limits
    m = _m(spark, d)
    return voucher_limits(m.vouchers, m.usage)


# ---------------------------------------------------------------------------
# Phase 4/5: facts from schema B, cube/rollup, traffic, rankings, analytics
# ---------------------------------------------------------------------------

@query("fact_orders", O.with_(*O.BASE, O.FACT_ORDERS) + """
SELECT order_key, line_number, time_key, product_key, customer_key, platform_key,
       CAST(paid_price AS DOUBLE) AS paid_price, item_quantity, cancellation_reason, return_reason,
       CAST(commission AS DOUBLE) AS seller_commission_fee,
       CAST(subsidy AS DOUBLE) AS platform_subsidy_amount,
       CAST(CAST(paid_price - commission AS DECIMAL(12,2)) AS DOUBLE) AS seller_payout
FROM fact_orders
""")
def q_fact_orders(spark, d):
    from shopcube.operators.facts import fact_orders
    m = _m(spark, d)
    return doubles(fact_orders(m.items, m.orders))


def _fact_year(m: Model) -> DataFrame:
    return m.fact.withColumn("year", (F.col("time_key") / 10000).cast("int"))


@query("sales_cube", O.with_(*O.BASE, O.FACT) + """
SELECT year, platform_key, is_returned,
       GROUPING_ID(year, platform_key, is_returned) AS grouping_id, COUNT(*) AS row_count,
       CAST(SUM(quantity) AS DOUBLE) AS total_quantity, CAST(SUM(net) AS DOUBLE) AS net_sales
FROM (SELECT *, time_key // 10000 AS year FROM fact)
GROUP BY CUBE (year, platform_key, is_returned)
""")
def q_sales_cube(spark, d):
    from shopcube.operators.marts import sales_cube
    return sales_cube(_fact_year(_m(spark, d)), ["year", "platform_key", "is_returned"])


@query("sales_cube_levels", O.with_(*O.FULL, O.CUSTOMERS, O.FACT) + """
SELECT p.p_type AS category, c.customer_segment, GROUPING_ID(p.p_type, c.customer_segment) AS grouping_id,
       COUNT(*) AS row_count, CAST(SUM(f.quantity) AS DOUBLE) AS total_quantity,
       CAST(SUM(f.net) AS DOUBLE) AS net_sales
FROM fact f LEFT JOIN part p ON f.product_key = p.p_partkey
LEFT JOIN dim_customers c ON f.customer_key = c.customer_key
GROUP BY CUBE (p.p_type, c.customer_segment)
""")
def q_sales_cube_levels(spark, d):
    """G20 over levels of the product and customer dimensions."""
    from shopcube.operators.marts import sales_cube
    m = _m(spark, d)
    f = (m.fact.join(m.products.select("product_key", "category"), "product_key", "left")
         .join(m.dim_customers.select("customer_key", "customer_segment"), "customer_key", "left"))
    return sales_cube(f, ["category", "customer_segment"])


@query("time_rollup", O.with_(*O.BASE, O.FACT) + """
SELECT year, quarter, month, day, GROUPING_ID(year, quarter, month, day) AS grouping_id, COUNT(*) AS row_count,
       CAST(SUM(quantity) AS DOUBLE) AS total_quantity, CAST(SUM(net) AS DOUBLE) AS net_sales
FROM (SELECT *, time_key // 10000 AS year, ((time_key // 100) % 100 + 2) // 3 AS quarter,
             (time_key // 100) % 100 AS month, time_key % 100 AS day FROM fact)
GROUP BY ROLLUP (year, quarter, month, day)
""")
def q_time_rollup(spark, d):
    from shopcube.operators.marts import sales_cube
    f = _fact_year(_m(spark, d))
    month = (F.col("time_key") / 100).cast("int") % 100
    f = (f.withColumn("month", month).withColumn("quarter", ((month + 2) / 3).cast("int"))
         .withColumn("day", F.col("time_key") % 100))
    return sales_cube(f, ["year", "quarter", "month", "day"], rollup=True)


# Fixed value: lines that a cell of the iceberg cube holds at least.
ICEBERG_LINES = 10


@query("sales_cube_iceberg", O.with_(*O.BASE, O.FACT) + f"""
SELECT time_key, product_key, customer_key, platform_key,
       GROUPING_ID(time_key, product_key, customer_key, platform_key) AS grouping_id, COUNT(*) AS row_count,
       CAST(SUM(quantity) AS BIGINT) AS total_quantity, CAST(SUM(net) AS DOUBLE) AS net_sales
FROM fact GROUP BY CUBE (time_key, product_key, customer_key, platform_key) HAVING COUNT(*) >= {ICEBERG_LINES}
""")
def q_sales_cube_iceberg(spark, d):
    """G20 at the declared grain, day x product x customer x platform: all cells of 10 lines and more."""
    from shopcube.operators.iceberg import iceberg_cube
    fact = _m(spark, d).fact.select("time_key", "product_key", "customer_key", "platform_key",
                                    F.col("quantity_sold").cast("bigint").alias("quantity"), "net_sales_amount")
    cells = iceberg_cube(fact, ["time_key", "product_key", "customer_key", "platform_key"],
                         {"quantity": "total_quantity", "net_sales_amount": "net_sales"}, ICEBERG_LINES)
    return cells.withColumn("net_sales", F.col("net_sales").cast("double"))


_PEOPLE = ", ".join(f"COUNT(DISTINCT customer_key) FILTER (WHERE {rule}) AS {kind}" for kind, rule in (
    ("visitors", "TRUE"), ("buyers", "NOT is_cancelled"), ("add_to_cart_users", "voucher_total > 0"),
    ("wishlist_users", "has_return")))


def _people(spark, d):
    """The stored bitmaps of all days: nothing after this reads an order."""
    from shopcube.operators.dims import assign_surrogate_keys
    from shopcube.operators.people import people_bitmaps, store_bitmaps
    from shopcube.session import scratch_path
    m = _m(spark, d)
    numbers = assign_surrogate_keys(m.customers.select("customer_key"), "customer_key")
    path = scratch_path(spark, "people-bitmaps")
    store_bitmaps(people_bitmaps(m.priced_orders, numbers), path)
    return m, spark.read.parquet(path)


@query("people_rollup", O.with_(*O.FULL) + " UNION ALL ".join(f"""
SELECT '{grain}' AS grain, CAST(date_trunc('{grain}', order_date) AS DATE) AS period_start, {platform} AS platform_key, {_PEOPLE}
FROM priced GROUP BY ALL""" for grain in ("week", "month", "quarter", "year") for platform in ("platform_key", "CAST(NULL AS INTEGER)")))
def q_people_rollup(spark, d):
    """G18 over any period: distinct people by week, month, quarter and year, for each platform and all."""
    from shopcube.operators.people import people_rollup
    return people_rollup(_people(spark, d)[1])


@query("kpi_rollup_people", O.with_(*O.FULL, KPI_PERIOD) + """
SELECT platform, period_start, total_sales_value, total_orders, visitors, buyers, add_to_cart_users, wishlist_users,
       conversion_rate, revenue_per_buyer, visitor_value
FROM (SELECT platform, period_start, """ + O.KPI_MEASURES + " FROM kp)")
def q_kpi_rollup_people(spark, d):
    """K06 whole: months from day rows and stored bitmaps, people columns and the ratios on them included."""
    from shopcube.operators.dims import with_platform_name
    from shopcube.operators.kpi import people_ratios, rollup_kpis
    from shopcube.operators.people import people_counts
    m, bitmaps = _people(spark, d)
    people = with_platform_name(people_counts(bitmaps, ["platform_key", F.trunc("date", "month").alias("period_start")]), spark)
    return doubles(people_ratios(rollup_kpis(m.kpi.daily), people))


@query("fact_traffic", O.with_(O.EVENTS) + "SELECT * FROM traffic")
def q_fact_traffic(spark, d):
    from shopcube.operators.traffic import fact_traffic
    return fact_traffic(_m(spark, d).t.events)


@query("visits", O.with_(O.EVENTS) + """
SELECT customer_key, session_start, MAX(ts) AS last_event, COUNT(*) AS events
FROM sess GROUP BY customer_key, session_start
""")
def q_visits(spark, d):
    from shopcube.operators.traffic import sessions
    return sessions(_m(spark, d).t.events)


@query("fact_activity", O.with_(O.EVENTS) + "SELECT * FROM activity")
def q_fact_activity(spark, d):
    from shopcube.operators.traffic import fact_activity
    return fact_activity(_m(spark, d).t.events)


@query("traffic_totals", O.with_(O.EVENTS) + """
SELECT time_key, platform_key, CAST(SUM(page_views) AS BIGINT) AS page_views,
       CAST(SUM(visits) AS BIGINT) AS visits, CAST(SUM(add_to_cart_count) AS BIGINT) AS add_to_cart,
       CAST(SUM(wishlist_add_count) AS BIGINT) AS wishlist_adds,
       COUNT(DISTINCT product_key) AS products_viewed
FROM traffic GROUP BY time_key, platform_key
""")
def q_traffic_totals(spark, d):
    from shopcube.operators.traffic import fact_traffic, traffic_totals
    return traffic_totals(fact_traffic(_m(spark, d).t.events))


@query("traffic_by_product", O.with_(O.EVENTS) + """
SELECT product_key, CAST(SUM(page_views) AS BIGINT) AS page_views, CAST(SUM(visits) AS BIGINT) AS visits,
       CAST(SUM(add_to_cart_count) AS BIGINT) AS add_to_cart,
       CAST(SUM(wishlist_add_count) AS BIGINT) AS wishlist_adds, COUNT(DISTINCT time_key) AS days_viewed
FROM traffic GROUP BY product_key
""")
def q_traffic_by_product(spark, d):
    from shopcube.operators.traffic import fact_traffic, traffic_by_product
    return traffic_by_product(fact_traffic(_m(spark, d).t.events))


@query("acquisition_cost", O.with_(*O.FULL, O.USAGE) + """
SELECT voucher_key, voucher_code, CAST(SUM(discount_amount) AS DOUBLE) AS discount_total,
       COUNT(*) FILTER (WHERE first_time_customer) AS new_customers,
       CAST(SUM(discount_amount) AS DOUBLE)
         / NULLIF(CAST(COUNT(*) FILTER (WHERE first_time_customer) AS DOUBLE), 0) AS acquisition_cost
FROM usage GROUP BY voucher_key, voucher_code
""")
def q_acquisition_cost(spark, d):
    from shopcube.operators.analytics import acquisition_cost
    return acquisition_cost(_m(spark, d).usage)


@query("activity_daily", O.with_(O.EVENTS) + """,
daily AS (
  SELECT platform_key, time_key, COUNT(*) FILTER (WHERE activity_type = 'CHAT_SENT') AS chats,
         CAST(SUM(chat_response_time_seconds) AS DOUBLE)
           / NULLIF(CAST(COUNT(chat_response_time_seconds) AS DOUBLE), 0) AS avg_chat_response_seconds,
         COALESCE(SUM(follower_count_change), 0) AS follower_net_change
  FROM activity GROUP BY platform_key, time_key)
SELECT *, CAST(SUM(follower_net_change) OVER (PARTITION BY platform_key ORDER BY time_key
          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS followers_running_total
FROM daily
""")
def q_activity_daily(spark, d):
    from shopcube.operators.traffic import activity_daily, fact_activity
    return activity_daily(fact_activity(_m(spark, d).t.events))


@query("usage_pattern", O.with_(*O.BASE, O.FIRST, O.USAGE) + """
SELECT hour(usage_date) AS hour, isodow(usage_date) AS day_of_week, COUNT(*) AS uses,
       CAST(SUM(discount_amount) AS DOUBLE) AS discount_total
FROM usage GROUP BY 1, 2
""")
def q_usage_pattern(spark, d):
    from shopcube.operators.analytics import usage_pattern
    return usage_pattern(_m(spark, d).usage)


@query("reason_totals", O.with_(*O.BASE, O.FACT_ORDERS) + """
SELECT 'cancellation' AS reason_type, cancellation_reason AS reason, COUNT(*) AS lines,
       CAST(SUM(paid_price) AS DOUBLE) AS amount
FROM fact_orders WHERE cancellation_reason IS NOT NULL GROUP BY cancellation_reason
UNION ALL
SELECT 'return', return_reason, COUNT(*), CAST(SUM(paid_price) AS DOUBLE)
FROM fact_orders WHERE return_reason IS NOT NULL GROUP BY return_reason
""")
def q_reason_totals(spark, d):
    from shopcube.operators.analytics import reason_totals
    from shopcube.operators.facts import fact_orders
    m = _m(spark, d)
    return reason_totals(fact_orders(m.items, m.orders))


@query("revenue_trend", "WITH summary AS (" + SUMMARY_SQL + """)
SELECT platform, date, net_revenue,
       lag(net_revenue) OVER w AS prev_net_revenue,
       net_revenue - lag(net_revenue) OVER w AS change_net_revenue,
       SUM(net_revenue) OVER (w ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)
         / COUNT(net_revenue) OVER (w ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS avg7_net_revenue
FROM summary WINDOW w AS (PARTITION BY platform ORDER BY date)
""")
def q_revenue_trend(spark, d):
    from shopcube.operators.windows import daily_trend
    s = _m(spark, d).summary.select("platform", "date", "net_revenue")
    return daily_trend(s, "platform", "date", "net_revenue")


PRODUCT_SALES = """,
psales AS (
  SELECT f.product_key, p.p_type AS category, p.p_name AS product_name,
         CAST(SUM(f.net) AS DOUBLE) AS net_sales, CAST(SUM(f.quantity) AS BIGINT) AS units
  FROM fact f JOIN part p ON f.product_key = p.p_partkey
  WHERE NOT f.is_cancelled GROUP BY f.product_key, p.p_type, p.p_name)"""


def _product_sales(m: Model) -> DataFrame:
    live = m.fact.filter(F.col("is_cancelled") == F.lit(False))
    s = live.groupBy("product_key").agg(F.sum("net_sales_amount").cast("double").alias("net_sales"),
                                        F.sum("quantity_sold").cast("bigint").alias("units"))
    return s.join(m.products.select("product_key", "category", "product_name"), "product_key")


@query("top_products_per_category", O.with_(*O.BASE, O.FACT) + PRODUCT_SALES + """
SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY category ORDER BY net_sales DESC, product_key) AS rank
  FROM psales) WHERE rank <= 3
""")
def q_top_products_per_category(spark, d):
    from shopcube.operators.windows import top_n_per_group
    s = _product_sales(_m(spark, d))
    return top_n_per_group(s, ["category"], [F.col("net_sales").desc(), F.col("product_key")], 3)


@query("best_sellers", O.with_(*O.BASE, O.FACT) + PRODUCT_SALES + """
SELECT * FROM psales ORDER BY units DESC, product_key LIMIT 10
""")
def q_best_sellers(spark, d):
    from shopcube.operators.windows import top_k
    s = _product_sales(_m(spark, d))
    return top_k(s, [F.col("units").desc(), F.col("product_key")], 10)


@query("cohort_retention", O.with_(O.ORDERS) + """,
m AS (SELECT DISTINCT customer_key, CAST(date_trunc('month', order_date) AS DATE) AS month FROM ords),
f AS (SELECT customer_key, MIN(month) AS cohort FROM m GROUP BY customer_key)
SELECT f.cohort, CAST(date_diff('month', f.cohort, m.month) AS INTEGER) AS months_since,
       COUNT(*) AS customers
FROM m JOIN f ON m.customer_key = f.customer_key GROUP BY 1, 2
""")
def q_cohort_retention(spark, d):
    from shopcube.operators.analytics import cohort_retention
    return cohort_retention(_m(spark, d).orders)


@query("inventory_turnover", O.with_(*O.BASE, O.FACT) + """
SELECT p.p_partkey AS product_key, p.p_size AS stock_on_hand,
       CAST(COALESCE(s.units, 0) AS BIGINT) AS units_sold,
       CAST(COALESCE(s.units, 0) AS DOUBLE) / NULLIF(CAST(p.p_size AS DOUBLE), 0) AS turnover
FROM part p LEFT JOIN (SELECT product_key, SUM(quantity) AS units FROM fact WHERE NOT is_cancelled
                       GROUP BY product_key) s ON p.p_partkey = s.product_key
""")
def q_inventory_turnover(spark, d):
    from shopcube.operators.analytics import inventory_turnover
    m = _m(spark, d)
    return inventory_turnover(m.fact, m.products)


@query("discount_rate", O.with_(*O.BASE, O.FACT) + """
SELECT time_key // 10000 AS year, platform_key, CAST(SUM(discount) AS DOUBLE) AS total_discounts,
       CAST(SUM(gross) AS DOUBLE) AS gross_sales,
       CAST(SUM(discount) AS DOUBLE) / NULLIF(CAST(SUM(gross) AS DOUBLE), 0) AS discount_rate
FROM fact WHERE NOT is_cancelled GROUP BY 1, 2
""")
def q_discount_rate(spark, d):
    from shopcube.operators.analytics import discount_rate
    return discount_rate(_m(spark, d).fact)


@query("product_identity", O.with_(*O.BASE, O.FACT) + """,
a AS (SELECT DISTINCT product_key FROM fact WHERE platform_key = 1),
b AS (SELECT DISTINCT product_key FROM fact WHERE platform_key = 2)
SELECT COALESCE(a.product_key, b.product_key) AS product_key,
       CASE WHEN a.product_key IS NOT NULL THEN 'L-' || CAST(a.product_key AS VARCHAR) END AS lazada_item_id,
       CASE WHEN b.product_key IS NOT NULL THEN 'S-' || CAST(b.product_key AS VARCHAR) END AS shopee_item_id,
       p.p_name AS product_name, p.p_type AS category_l2
FROM a FULL JOIN b ON a.product_key = b.product_key
LEFT JOIN part p ON COALESCE(a.product_key, b.product_key) = p.p_partkey
""")
def q_product_identity(spark, d):
    from shopcube.operators.analytics import product_identity
    m = _m(spark, d)
    return product_identity(m.fact, m.products)


CATALOGUES_SQL = """
WITH parts AS (SELECT *, CAST(floor(p_retailprice * 100 + 0.5) AS BIGINT) AS cents, split_part(p_name, ' ', 1) AS w1,
                      split_part(p_name, ' ', -1) AS w2 FROM part),
c1 AS (SELECT 'L' || substr(md5('L' || p_partkey), 1, 16) AS item_id, p_name AS title, p_brand AS brand, p_type AS type,
              p_size AS size, cents, p_partkey FROM parts WHERE p_partkey % 10 <> 4),
c2a AS (SELECT *, CASE WHEN p_partkey % 5 = 1 THEN w2 || ' new' ELSE w2 || ', ' || w1 END AS t FROM parts WHERE p_partkey % 10 <> 7),
c2 AS (SELECT 'S' || substr(md5('S' || p_partkey), 1, 16) AS item_id, CASE WHEN p_partkey % 3 = 0 THEN upper(t) ELSE t END AS title,
              upper(replace(p_brand, '#', ' ')) AS brand, lower(p_type) AS type,
              CASE WHEN p_partkey % 11 = 3 THEN p_size + 1 ELSE p_size END AS size, cents + (p_partkey % 7 - 3) * 20 AS cents, p_partkey
       FROM c2a),
n AS (SELECT item_id, list_distinct(list_filter(regexp_split_to_array(lower(title), '[^a-z0-9]+'), lambda x: x <> '')) AS words,
             regexp_replace(lower(brand), '[^a-z0-9]+', '', 'g') AS brand, regexp_replace(lower(type), '[^a-z0-9]+', '', 'g') AS type,
             size, cents FROM (SELECT * FROM c1 UNION ALL SELECT * FROM c2)),
met AS (SELECT a.item_id AS a, b.item_id AS b, len(list_intersect(a.words, b.words)) AS common, len(a.words) + len(b.words) AS n,
               a.size = b.size AS same_size, abs(a.cents - b.cents) AS gap
        FROM n a JOIN n b ON a.brand = b.brand AND a.type = b.type AND a.item_id LIKE 'L%' AND b.item_id LIKE 'S%'
         AND abs(a.cents - b.cents) <= 1000),
pairs AS (SELECT a, b, 200 * common // n + CASE WHEN same_size THEN 50 ELSE 0 END + 50 - gap * 50 // 1000 AS score
          FROM met WHERE common > 0 AND 200 * common // n + CASE WHEN same_size THEN 50 ELSE 0 END + 50 - gap * 50 // 1000 >= 60),
matches AS (SELECT a, b, score FROM (
  SELECT *, row_number() OVER (PARTITION BY a ORDER BY score DESC, b) AS ra, row_number() OVER (PARTITION BY b ORDER BY score DESC, a) AS rb
  FROM pairs) WHERE ra = 1 AND rb = 1)"""


def _catalogues(spark, d):
    from shopcube.sources.catalogues import first_catalogue, second_catalogue
    part = _m(spark, d).t.part
    return first_catalogue(part), second_catalogue(part)


@query("catalogue_pairs", CATALOGUES_SQL + " SELECT a AS lazada_item_id, b AS shopee_item_id, CAST(score AS BIGINT) AS score FROM pairs")
def q_catalogue_pairs(spark, d):
    """Blocking and scoring of two catalogues without a common key."""
    from shopcube.operators.matching import scored_pairs
    return scored_pairs(*_catalogues(spark, d), every=True).select(F.col("a").alias("lazada_item_id"), F.col("b").alias("shopee_item_id"), "score")


@query("catalogue_identity", CATALOGUES_SQL + """
SELECT COALESCE(x.item_id, y.item_id) AS universal_id, x.item_id AS lazada_item_id, y.item_id AS shopee_item_id,
       COALESCE(x.title, y.title) AS title, CAST(m.score AS BIGINT) AS score
FROM c1 x LEFT JOIN matches m ON x.item_id = m.a FULL JOIN c2 y ON m.b = y.item_id
""")
def q_catalogue_identity(spark, d):
    """One row a product, with its id in either marketplace, from mutual best matches."""
    from shopcube.operators.matching import named, one_to_one, placed, scored_pairs, universal_products
    first, second = _catalogues(spark, d)
    (a, a_places), (b, b_places) = placed(first), placed(second)
    matches = one_to_one(scored_pairs(a, b), rounds=1, by_place=True)
    return universal_products(first, second, named(matches, a_places, b_places))


@query("voucher_products", O.with_(*O.BASE, O.VOUCHERS) + """
SELECT DISTINCT v.voucher_key, p.p_partkey AS product_key,
       'V' || lpad(CAST(v.voucher_key AS VARCHAR), 3, '0') AS voucher_id,
       'SKU-' || CAST(p.p_partkey AS VARCHAR) AS sku_id,
       CAST(v.discount_value AS DOUBLE) AS discount_value,
       CAST(v.discount_percentage AS DOUBLE) AS discount_percentage
FROM (SELECT *, unnest(CAST(applicable_categories AS JSON)::VARCHAR[]) AS category FROM vouchers) v
JOIN part p ON p.p_type = v.category
""")
def q_voucher_products(spark, d):
    from shopcube.operators.analytics import voucher_products
    m = _m(spark, d)
    return doubles(voucher_products(m.vouchers, m.products))


@query("voucher_product_lists", O.with_(*O.BASE, O.VOUCHERS) + """,
named AS (
  SELECT v.voucher_key, p.p_partkey AS product_key
  FROM (SELECT *, unnest(CAST(applicable_categories AS JSON)::VARCHAR[]) AS category FROM vouchers) v
  JOIN part p ON p.p_type = v.category WHERE v.voucher_key % 3 <> 2
  UNION SELECT v.voucher_key, p.p_partkey FROM vouchers v JOIN part p ON p.p_partkey % 40 = v.voucher_key)
SELECT n.voucher_key, n.product_key, 'SKU-' || CAST(n.product_key AS VARCHAR) AS sku_id FROM named n
""")
def q_voucher_product_lists(spark, d):
    """F08 with both lists: vouchers that name products by id (every 40th, by voucher), categories, or both."""
    from shopcube.operators.analytics import voucher_products
    m = _m(spark, d)
    top = m.products.agg(F.max("product_key")).scalar()
    named = F.transform(F.sequence(F.col("voucher_key").cast("bigint"), F.col("top"), F.lit(40).cast("bigint")),
                        lambda k: F.concat(F.lit("SKU-"), k.cast("string")))
    lists = (m.vouchers.select("voucher_key").withColumn("top", top).where("voucher_key <= top AND voucher_key < 40")
             .select("voucher_key", F.to_json(named).alias("applicable_products")))
    vouchers = (m.vouchers.drop("applicable_products").join(lists, "voucher_key", "left")
                .withColumn("applicable_categories", F.when(F.col("voucher_key") % 3 == 2, "[broken")
                            .otherwise(F.col("applicable_categories"))))
    return voucher_products(vouchers, m.products).select("voucher_key", "product_key", "sku_id")


@query("voucher_status", O.with_(*O.BASE, O.VOUCHERS) + """
SELECT voucher_key, voucher_code, start_date, end_date,
       CASE WHEN a.d > end_date THEN 'Expired' WHEN a.d < start_date THEN 'Inactive' ELSE 'Active' END
         AS status
FROM vouchers, (SELECT CAST(MAX(o_orderdate) AS TIMESTAMP) AS d FROM orders) a
""")
def q_voucher_status(spark, d):
    from shopcube.operators.analytics import voucher_status
    m = _m(spark, d)
    as_of = m.orders.agg(F.max("order_ts")).scalar()
    v = m.vouchers
    return v.select("voucher_key", "voucher_code", "start_date", "end_date",
                    voucher_status(as_of, F.col("start_date"), F.col("end_date")).alias("status"))


@query("headline_totals", O.with_(*O.FULL, O.VOUCHERS, O.EVENTS) + """
SELECT COUNT(*) AS orders, COUNT(*) FILTER (WHERE line_count > 0) AS orders_with_lines,
       CAST(SUM(buyer_paid_price) FILTER (WHERE NOT is_cancelled) AS DOUBLE) AS net_revenue,
       (SELECT COUNT(*) FROM lineitem) AS order_items, (SELECT COUNT(*) FROM customer) AS customers,
       (SELECT COUNT(*) FROM part) AS products,
       (SELECT date_diff('day', date_trunc('year', MIN(order_date)), date_trunc('year', MAX(order_date)) + INTERVAL 1 YEAR)
        FROM ords) AS calendar_days,
       (SELECT COUNT(*) FROM vouchers) AS vouchers, (SELECT COUNT(*) FROM activity) AS activities
FROM priced
""")
def q_headline_totals(spark, d):
    from shopcube.operators.analytics import headline_totals
    return headline_totals(_m(spark, d))


COLOUR_SQL = "['red', 'blue', 'green', 'black', 'white', 'yellow', 'pink', 'purple', 'orange', " \
             "'brown', 'grey', 'gray', 'silver', 'gold']"
SIZE_SQL = "['small', 'medium', 'large', 'xs', 's', 'm', 'l', 'xl', 'xxl']"


@query("dim_products", O.with_(*O.BASE, O.FACT) + f""",
live AS (SELECT * FROM fact WHERE NOT is_cancelled),
roll AS (SELECT product_key, SUM(quantity) AS qty, SUM(net) AS amount, MIN(order_date) AS first_sold_date,
                MAX(order_date) AS last_sold_date FROM live GROUP BY product_key),
latest AS (SELECT product_key, unit_price FROM (
             SELECT product_key, unit_price, row_number() OVER (PARTITION BY product_key
                    ORDER BY order_ts DESC, order_key DESC, unit_price DESC) AS rn FROM live) WHERE rn = 1),
p AS (SELECT p_partkey, p_name, p_brand, p_type, p_size, CAST(p_retailprice AS DECIMAL(10,2)) AS price,
             CASE WHEN p_size <= 45 THEN CAST(CAST(p_retailprice AS DECIMAL(10,2)) * 0.6 AS DECIMAL(10,2)) END
               AS cost,
             regexp_split_to_array(lower(p_name), '[^a-z0-9]+') AS words FROM part),
as_of AS (SELECT MAX(CAST(o_orderdate AS DATE)) AS d FROM orders)
SELECT p.p_partkey AS product_key, 'SKU-' || CAST(p.p_partkey AS VARCHAR) AS sku_id,
       p.p_name AS product_name, p.p_brand || '-' || CAST(p.p_partkey AS VARCHAR) AS product_sku,
       p.p_type AS category, p.p_brand AS brand,
       CAST(COALESCE(l.unit_price, p.price) AS DOUBLE) AS last_price, CAST(p.cost AS DOUBLE) AS cost_price,
       CAST((COALESCE(l.unit_price, p.price) - p.cost) * 100 AS DOUBLE)
         / NULLIF(CAST(COALESCE(l.unit_price, p.price) AS DOUBLE), 0) AS margin_percentage,
       COALESCE(NULLIF(regexp_extract(lower(p.p_name), 'colou?r\\s*[:=]\\s*([a-z]+)', 1), ''),
                list_filter(p.words, lambda w: list_contains({COLOUR_SQL}, w))[1]) AS color_family,
       COALESCE(NULLIF(regexp_extract(lower(p.p_name), 'size\\s*[:=]\\s*([a-z0-9]+)', 1), ''),
                list_filter(p.words, lambda w: list_contains({SIZE_SQL}, w))[1]) AS size,
       CAST(COALESCE(r.qty, 0) AS BIGINT) AS total_sales_quantity,
       CAST(COALESCE(r.amount, 0) AS DOUBLE) AS total_sales_amount,
       {O.half_up('CAST(r.amount * 100 AS BIGINT)', 'r.qty')} AS average_selling_price,
       r.first_sold_date, r.last_sold_date,
       CASE WHEN r.last_sold_date IS NULL OR date_diff('day', r.last_sold_date, (SELECT d FROM as_of)) > 730
              THEN 'Discontinued'
            WHEN date_diff('day', r.last_sold_date, (SELECT d FROM as_of)) > 180 THEN 'Inactive'
            ELSE 'Active' END AS inventory_status,
       p.p_size AS stock_on_hand
FROM p LEFT JOIN roll r ON p.p_partkey = r.product_key LEFT JOIN latest l ON p.p_partkey = l.product_key
""")
def q_dim_products(spark, d):
    from shopcube.operators.dims import build_dim_products
    m = _m(spark, d)
    return doubles(build_dim_products(m.products, m.fact, m.orders, m.as_of))


@query("display_format", O.with_(*O.BASE, O.FACT) + """,
s AS (SELECT p.p_partkey AS product_key, CAST(SUM(f.net) * 100 AS BIGINT) AS n, SUM(f.quantity) AS q
      FROM part p LEFT JOIN fact f ON f.product_key = p.p_partkey AND NOT f.is_cancelled
      GROUP BY p.p_partkey)
SELECT product_key,
       CASE WHEN n IS NULL THEN 'N/A' WHEN n % 100 = 0 THEN format('{:,}', n // 100)
            ELSE CAST(CAST(n AS DECIMAL(38,0)) * 0.01 AS DECIMAL(38,4))::VARCHAR END AS net_sales_display,
       CASE WHEN n IS NULL OR q IS NULL OR q = 0 THEN 'N/A'
            WHEN n % (100 * q) = 0 THEN format('{:,}', n // (100 * q))
            ELSE CAST(CAST((n * 200 + q) // (2 * q) AS DECIMAL(38,0)) * 0.0001 AS DECIMAL(38,4))::VARCHAR
       END AS revenue_per_unit_display
FROM s
""")
def q_display_format(spark, d):
    """Display strings for money and per-unit values."""
    from shopcube.operators.analytics import display_value
    m = _m(spark, d)
    live = m.fact.filter(F.col("is_cancelled") == F.lit(False))
    s = live.groupBy("product_key").agg(F.sum("net_sales_amount").alias("n"),
                                        F.sum("quantity_sold").alias("q"))
    j = m.products.select("product_key").join(s, "product_key", "left")
    rpu = F.col("n") / F.nullif(F.col("q").cast("decimal(20,0)"), F.lit(0).cast("decimal(20,0)"))
    return j.select("product_key", display_value(F.col("n")).alias("net_sales_display"),
                    display_value(rpu).alias("revenue_per_unit_display"))


@query("upload_summary", O.with_(*O.FULL, KPI_DAILY) + """
SELECT 'Processed ' || CAST(COUNT(*) AS VARCHAR) || ' rows from ' || platform AS message,
       COUNT(*) AS rows_processed, 19 AS column_count,
       'platform,source_file,date,total_sales_value,visitors,buyers,total_orders,pageviews,units_sold,conversion_rate,revenue_per_buyer,visitor_value,add_to_cart_users,add_to_cart_units,wishlists,wishlist_users,average_order_value,average_basket_size,cancelled_amount,return_refund_amount' AS columns
FROM kd GROUP BY platform
""")
def q_upload_summary(spark, d):
    """The upload result envelope per marketplace (message, row count,
    column list); records themselves are written, never collected."""
    daily = _m(spark, d).kpi.daily
    cols = daily.columns
    return (daily.groupBy("platform").agg(F.count(F.lit(1)).alias("rows_processed"))
            .select(F.format_string("Processed %d rows from %s", "rows_processed", "platform")
                    .alias("message"), "rows_processed",
                    F.lit(len(cols) - 1).alias("column_count"), F.lit(",".join(cols)).alias("columns")))


@query("kpi_preview", O.with_(*O.FULL, KPI_DAILY) + """
SELECT platform, date, CAST(rev AS DOUBLE) AS total_sales_value, CAST(orders AS BIGINT) AS total_orders
FROM kd ORDER BY platform, date LIMIT 5
""")
def q_kpi_preview(spark, d):
    """The first rows of the cleaned feed in a stated order (a preview)."""
    k = _m(spark, d).kpi.daily
    return doubles(k.select("platform", "date", "total_sales_value", "total_orders")
                   .orderBy("platform", "date").limit(5))


# ---------------------------------------------------------------------------
# Phase 5: streaming jobs, run incrementally to completion
# ---------------------------------------------------------------------------

def _stream_to_snapshot(spark, stream: DataFrame, name: str, mode: str = "complete") -> DataFrame:
    from shopcube.session import scratch_path
    from shopcube.streaming.jobs import complete_to_table, latest_snapshot, run_available_now
    out = scratch_path(spark, f"{name}-out")
    run_available_now(stream, scratch_path(spark, f"{name}-ckpt"), mode, sink=complete_to_table(out))
    return latest_snapshot(spark, out)


@query("stream_event_rollup", O.with_(O.EVENTS) + """
SELECT CAST(ts AS DATE) AS day, event_type, COUNT(*) AS events,
       CAST(SUM(CAST(value AS DECIMAL(12,2))) AS DOUBLE) AS value_total
FROM (SELECT DISTINCT ON (event_id) * FROM ev) GROUP BY 1, 2
""")
def q_stream_event_rollup(spark, d):
    """S03 + S04: the streaming daily roll-up (de-duplicated), complete mode."""
    from shopcube.streaming.jobs import BACKFILL, event_rollup_stream, event_stream
    s = event_rollup_stream(event_stream(spark, f"{d}/events.parquet*"), BACKFILL)
    return _stream_to_snapshot(spark, s.drop("approx_users"), "event-rollup")


@query("stream_sessions", O.with_(O.EVENTS) + """
SELECT customer_key AS user_id, session_start, MAX(ts) + INTERVAL 30 MINUTE AS session_end,
       COUNT(*) AS events
FROM sess GROUP BY customer_key, session_start
""")
def q_stream_sessions(spark, d):
    """Visits from the event stream via session windows."""
    from shopcube.streaming.jobs import BACKFILL, event_stream, session_stream
    s = session_stream(event_stream(spark, f"{d}/events.parquet*"), watermark=BACKFILL)
    snap = _stream_to_snapshot(spark, s, "sessions")
    return snap.select("user_id", "session_start", "session_end", "events")


@query("stream_alerts", O.with_(O.EVENTS) + """
SELECT day, event_type, events, 'error events >= 2' AS alert FROM (
  SELECT CAST(ts AS DATE) AS day, event_type, COUNT(*) AS events FROM (SELECT DISTINCT ON (event_id) * FROM ev)
  GROUP BY 1, 2) WHERE event_type = 'error' AND events >= 2
""")
def q_stream_alerts(spark, d):
    """Days on which the streamed roll-up crosses a threshold."""
    from shopcube.streaming.jobs import BACKFILL, alert_stream, event_rollup_stream, event_stream
    s = event_rollup_stream(event_stream(spark, f"{d}/events.parquet*"), BACKFILL)
    return alert_stream(_stream_to_snapshot(spark, s, "event-alerts"), "error", 2)


def _arriving(spark, d) -> tuple[str, DataFrame]:
    """The events as files in the order of arrival: every 17th id comes three files late, every 13th comes twice."""
    from shopcube.operators.dims import checkpointed
    from shopcube.session import scratch_path
    ev, folder = _m(spark, d).t.events, scratch_path(spark, "event-files")
    lo, hi = ev.agg(F.min("ts")).scalar(), ev.agg(F.max("ts")).scalar()
    days = F.datediff("ts", lo) * 5 / (F.datediff(hi, lo) + 1)
    late = F.when(F.col("event_id") % 17 == 0, 3).otherwise(0)
    file = F.floor(days).cast("int") + late
    each = F.when(F.col("event_id") % 13 == 0, F.array(file, file + 1)).otherwise(F.array(file))
    dealt = checkpointed(ev.withColumn("file", F.explode(each)))
    for n in range(9):
        dealt.where(F.col("file") == n).drop("file").coalesce(1).write.mode("append").parquet(folder)
    return folder, ev


def _reconciled(spark, d) -> DataFrame:
    from shopcube.session import scratch_path
    from shopcube.streaming.jobs import run_available_now
    from shopcube.streaming.lateness import closed_days_stream, reconciled, route
    folder, ev = _arriving(spark, d)
    root, out = scratch_path(spark, "routed"), scratch_path(spark, "closed-days")
    files = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1).parquet(folder)
    run_available_now(files, scratch_path(spark, "route-ckpt"), sink=route(root))
    run_available_now(closed_days_stream(spark, root, ev.schema, files=40), scratch_path(spark, "closed-ckpt"), path=out)
    closed = "day date, event_type string, events long, value_total decimal(28,2), users binary"
    return reconciled(spark, spark.read.schema(closed).parquet(out), root, ev.schema)


@query("stream_event_reconciled", ORACLES["stream_event_rollup"])
def q_stream_event_reconciled(spark, d):
    """S03, S04 with bounded state: late files are set aside and reconciled into closed days."""
    return _reconciled(spark, d).select("day", "event_type", "events", F.col("value_total").cast("double").alias("value_total"))


@query("stream_event_users", O.with_(O.EVENTS) + """
SELECT CAST(date_trunc('month', ts) AS DATE) AS period, event_type, COUNT(DISTINCT customer_key) AS users, TRUE AS within_error
FROM ev GROUP BY 1, 2
""")
def q_stream_event_users(spark, d):
    """Approximate users of each month from the days' sketches, held against the exact number."""
    from shopcube.streaming.lateness import USERS_ERROR, users_of
    exact = (_m(spark, d).t.events.groupBy(F.trunc(F.to_date("ts"), "month").alias("period"), "event_type")
             .agg(F.countDistinct("user_id").alias("users")))
    both = exact.join(users_of(_reconciled(spark, d)), ["period", "event_type"], "left")
    near = F.abs(F.col("approx_users") - F.col("users")) <= USERS_ERROR * F.col("users") + 1
    return both.select("period", "event_type", "users", F.coalesce(near, F.lit(False)).alias("within_error"))


@query("stream_upsert", "SELECT o_orderkey AS order_key, CAST(o_totalprice AS DOUBLE) AS total, o_orderstatus AS status FROM orders")
def q_stream_upsert(spark, d):
    """The orders merged batch by batch into a table that holds an older state of half of them."""
    from shopcube.operators.load import load_with_upsert, read_table
    from shopcube.session import scratch_path
    from shopcube.streaming.jobs import run_available_now, upsert_stream
    rows = lambda df: df.select(F.col("o_orderkey").alias("order_key"), F.col("o_totalprice").cast("double").alias("total"),
                                F.col("o_orderstatus").alias("status"), F.lit(1).alias("revision"))
    path, root = f"{d}/orders.parquet", scratch_path(spark, "orders-table")
    older = rows(spark.read.parquet(path)).where("order_key % 2 = 0")
    load_with_upsert(spark, older.withColumn("total", F.lit(0.0)).withColumn("revision", F.lit(0)), root, "order_key")
    stream = rows(spark.readStream.schema(spark.read.parquet(path).schema).parquet(f"{path}*"))
    run_available_now(stream, scratch_path(spark, "orders-ckpt"), sink=upsert_stream("order_key", root, "last", "revision"))
    return read_table(spark, root).drop("revision")


def _exported(spark, d) -> dict[str, str]:
    """The derived KPI export as CSV uploads, a folder for each file, each marketplace in its own layout: platform -> folder."""
    from shopcube.operators.dims import checkpointed
    from shopcube.session import scratch_path
    from shopcube.sources.kpi_csv import write_kpi_uploads
    from shopcube.sources.kpi_feed import kpi_feed_text
    feed, out = checkpointed(kpi_feed_text(_m(spark, d).priced_orders)), {}
    for platform in ("Lazada", "Shopee"):
        out[platform] = scratch_path(spark, f"kpi-csv-{platform}")
        write_kpi_uploads(feed, out[platform], platform)
    return out


UPLOAD = "regexp_extract(source_file, 'source_file=([^/]*)/', 1)"       # an upload is known by its folder
_CSV_DAILY = """SELECT platform, date, CAST(rev AS DOUBLE) AS total_sales_value, CAST(orders AS BIGINT) AS total_orders,
       CAST(visitors AS BIGINT) AS visitors FROM kd"""
_CSV_COLUMNS = ["platform", "date", "total_sales_value", "total_orders", "visitors"]


@query("kpi_csv_scan", O.with_(*O.FULL, KPI_DAILY) + _CSV_DAILY)
def q_kpi_csv_scan(spark, d):
    """The export written and scanned again as CSV, in two layouts."""
    from shopcube.operators.kpi import clean_kpi_feed
    from shopcube.sources.kpi_csv import read_kpi_csv
    found = [clean_kpi_feed(read_kpi_csv(spark, f"{path}/*", p).withColumn("source_file", F.expr(UPLOAD))).daily
             for p, path in _exported(spark, d).items()]
    return doubles(found[0].unionByName(found[1]).select(*_CSV_COLUMNS))


def _streamed(spark, d) -> str:
    """Folder of the day, period and quarantine tables that the streams of both marketplaces fill."""
    from shopcube.session import scratch_path
    from shopcube.streaming.jobs import kpi_ingest_stream, run_available_now, write_kpi_batches
    out = scratch_path(spark, "kpi-tables")
    for platform, path in _exported(spark, d).items():
        stream = kpi_ingest_stream(spark, f"{path}/*", platform).withColumn("source_file", F.expr(UPLOAD))
        run_available_now(stream, scratch_path(spark, f"kpi-ckpt-{platform}"), sink=write_kpi_batches(out))
    return out


@query("stream_kpi_ingest", f"""
SELECT platform, 'day' AS kind, date, NULL AS reason, total_sales_value, total_orders, visitors, CAST(1 AS BIGINT) AS rows
FROM ({O.with_(*O.FULL, KPI_DAILY) + _CSV_DAILY})
UNION ALL SELECT platform, 'rejected', NULL, reason, NULL, NULL, NULL, rows FROM ({ORACLES["kpi_quarantine"]})
""")
def q_stream_kpi_ingest(spark, d):
    """The files of both marketplaces dropped into folders and taken in by streams: the days, and what was rejected."""
    out = _streamed(spark, d)
    days = doubles(spark.read.parquet(f"{out}/daily").select(*_CSV_COLUMNS))
    days = days.select("platform", F.lit("day").alias("kind"), "date", F.lit(None).cast("string").alias("reason"),
                       *_CSV_COLUMNS[2:], F.lit(1).cast("bigint").alias("rows"))
    rejected = spark.read.parquet(f"{out}/quarantine").groupBy("platform", "reason").agg(F.count(F.lit(1)).alias("rows"))
    return days.unionByName(rejected.withColumn("kind", F.lit("rejected")), allowMissingColumns=True)


@query("stream_kpi_uploads", O.with_(*O.FULL, KPI_DAILY) + _CSV_DAILY)
def q_stream_kpi_uploads(spark, d):
    """The days of both marketplaces, each streamed in its own layout."""
    return doubles(spark.read.parquet(f"{_streamed(spark, d)}/daily").select(*_CSV_COLUMNS))


@query("stream_kpi_quarantine", ORACLES["kpi_quarantine"])
def q_stream_kpi_quarantine(spark, d):
    """What the streams of both marketplaces rejected, by reason."""
    q = spark.read.parquet(f"{_streamed(spark, d)}/quarantine")
    return q.groupBy("platform", "reason").agg(F.count(F.lit(1)).alias("rows"))


@query("sales_summary_batches", SUMMARY_SQL)
def q_sales_summary_batches(spark, d):
    """G15-G19 by change sets: a load with outdated orders, their corrections, and late orders."""
    from shopcube.operators.dims import checkpointed, with_platform_name
    from shopcube.operators.mart_batches import load_changes, read_summary
    from shopcube.session import scratch_path
    root, now = scratch_path(spark, "summary-tables"), checkpointed(_m(spark, d).priced_orders)
    outdated = F.col("order_key") % 7 == 0
    then = (now.withColumn("is_cancelled", F.when(outdated, ~F.col("is_cancelled")).otherwise(F.col("is_cancelled")))
            .withColumn("buyer_paid_price", F.when(outdated, F.col("buyer_paid_price") + 1).otherwise(F.col("buyer_paid_price")).cast("decimal(10,2)")))
    signed = lambda df, sign: df.withColumn("sign", F.lit(sign))
    first = F.col("order_key") % 3 != 0
    load_changes(signed(then.where(first), 1), root)
    load_changes(signed(then.where(first & outdated), -1).unionByName(signed(now.where(first & outdated), 1)), root)
    load_changes(signed(now.where(~first), 1), root)
    return with_platform_name(read_summary(spark, root), spark)


@query("daily_mart", "WITH summary AS (" + SUMMARY_SQL + """)
SELECT time_key, platform_key, total_orders, net_revenue, new_customers, CAST(year(date) AS INTEGER) AS year,
       CAST(month(date) AS INTEGER) AS month FROM summary
""")
def q_daily_mart(spark, d):
    """The daily summary stored by year and month, a month stored again, and read back."""
    from shopcube.operators.marts import write_mart
    from shopcube.session import scratch_path
    folder = scratch_path(spark, "daily-mart")
    mart = _m(spark, d).summary.withColumns({"year": F.year("date"), "month": F.month("date")}).select(
        "time_key", "platform_key", "total_orders", "net_revenue", "new_customers", "year", "month")
    write_mart(mart, folder)
    write_mart(mart.where("month = 1"), folder)
    return spark.read.parquet(folder)


@query("voucher_json", O.with_(*O.BASE, O.VOUCHERS) + """
SELECT voucher_code, voucher_type, CAST(discount_value AS DOUBLE) AS discount_value,
       CAST(discount_percentage AS DOUBLE) AS discount_percentage, CAST(minimum_spend AS DOUBLE) AS minimum_spend,
       start_date, end_date FROM vouchers
""")
def q_voucher_json(spark, d):
    """The voucher master landed as JSON lines and scanned with its declared schema."""
    from shopcube.session import scratch_path
    from shopcube.sources.json_feeds import read_vouchers
    folder = scratch_path(spark, "voucher-json")
    v = _m(spark, d).vouchers
    times = {c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in ("start_date", "end_date")}
    v.withColumns(times).write.json(folder)
    return doubles(read_vouchers(spark, folder).select(
        "voucher_code", "voucher_type", "discount_value", "discount_percentage", "minimum_spend", "start_date", "end_date"))


@query("voucher_products_json", ORACLES["voucher_products"].replace("SELECT DISTINCT v.voucher_key, p.p_partkey AS product_key,", "SELECT DISTINCT"))
def q_voucher_products_json(spark, d):
    """Voucher-product rules landed as JSON lines, some pairs twice, and scanned with their declared schema."""
    from shopcube.operators.analytics import voucher_products
    from shopcube.session import scratch_path
    from shopcube.sources.json_feeds import read_voucher_products
    folder, m = scratch_path(spark, "voucher-products-json"), _m(spark, d)
    rules = voucher_products(m.vouchers, m.products).select("voucher_id", "sku_id", "discount_value", "discount_percentage")
    rules.unionByName(rules.where("sku_id LIKE '%7'")).write.json(folder)
    return doubles(read_voucher_products(spark, folder))


@query("load_stamps", """
SELECT c_custkey AS customer_key, c_name AS name, TIMESTAMP '2024-05-01 00:00:00' AS created_at,
       CASE WHEN c_custkey % 4 = 0 THEN TIMESTAMP '2024-06-01 00:00:00' ELSE TIMESTAMP '2024-05-01 00:00:00' END AS updated_at
FROM customer WHERE c_custkey % 5 <> 2
UNION ALL SELECT c_custkey, c_name, TIMESTAMP '2024-06-01 00:00:00', TIMESTAMP '2024-06-01 00:00:00' FROM customer WHERE c_custkey % 5 = 2
""")
def q_load_stamps(spark, d):
    """Customers loaded twice into a stored table; created stays, updated follows the load."""
    from shopcube.operators.load import load_with_upsert, read_table, with_load_time
    from shopcube.session import scratch_path
    root, rows = scratch_path(spark, "customers-table"), _m(spark, d).t.customer.select(
        F.col("c_custkey").alias("customer_key"), F.col("c_name").alias("name"))
    old = F.col("customer_key") % 5 != 2
    load_with_upsert(spark, with_load_time(rows.where(old), "2024-05-01 00:00:00"), root, "customer_key")
    batch = rows.where(~old | (F.col("customer_key") % 4 == 0))
    kept = read_table(spark, root).select("customer_key", "created_at")
    load_with_upsert(spark, with_load_time(batch.join(kept, "customer_key", "left"), "2024-06-01 00:00:00"), root, "customer_key")
    return read_table(spark, root).select("customer_key", "name", "created_at", "updated_at")


@query("summary_json", "SELECT time_key, platform, total_orders, net_revenue, unique_customers FROM (" + SUMMARY_SQL + ")")
def q_summary_json(spark, d):
    """The daily summary exported as JSON records and read back."""
    from shopcube.operators.load import export_json
    from shopcube.session import scratch_path
    folder = scratch_path(spark, "summary-json")
    export_json(_m(spark, d).summary, folder)
    return spark.read.schema("time_key int, platform string, total_orders long, net_revenue double, unique_customers long").json(folder)


@query("sales_trends_keyed", "WITH summary AS (" + SUMMARY_SQL + """)
SELECT s.time_key, s.platform, year(s.date) AS year, quarter(s.date) AS quarter,
       monthname(s.date) AS month_name, weekofyear(s.date) AS week, dayname(s.date) AS day_name,
       isodow(s.date) >= 6 AS is_weekend, s.total_orders, s.net_revenue, s.average_order_value,
       s.unique_customers, s.voucher_adoption_rate
FROM summary s ORDER BY s.time_key, s.platform
""")
def q_sales_trends_keyed(spark, d):
    """O02 keyed variant: the trend view plus time_key and platform, so each
    row is identifiable (the view as written can repeat rows)."""
    from shopcube.operators.views import sales_trends
    m = _m(spark, d)
    return sales_trends(m.dim_time, m.summary, keyed=True)
