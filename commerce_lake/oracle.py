"""Independent DuckDB SQL for the registered queries.

The Spark side goes relational tables -> JSON change events -> bronze
-> silver -> gold.  These statements compute the same results straight
from the relational tables with the FIXTURES.md mapping, so a match
checks encoding, parsing, de-duplication, joins and aggregation
together.  Tables available as views: region nation customer supplier
part orders lineitem events (and the rest of the given set).
"""

from __future__ import annotations

import datetime as _dt

AS_OF = "TIMESTAMP '2024-01-01 00:00:00'"
AS_OF_ORDERS = _dt.date(2001, 8, 1)
ORDERS_RECENT_FROM = (AS_OF_ORDERS - _dt.timedelta(days=7)).isoformat()

_STG_CUSTOMERS = f"""
cust_src AS (
  SELECT c_custkey, CAST(c_custkey AS VARCHAR) AS customer_id, 'Customer' AS first_name,
         substr(c_name, 10) AS last_name, 'c' || CAST(c_custkey AS VARCHAR) || '@example.com' AS email,
         {AS_OF} - to_days(CAST(c_custkey % 800 AS INTEGER)) AS registered_at
  FROM customer),
stg_customers AS (
  SELECT customer_id, first_name, last_name, email, registered_at,
         'r' AS _operation, CAST(1000 AS BIGINT) AS _event_timestamp_ms, c_custkey FROM cust_src
  UNION ALL
  SELECT customer_id, first_name, last_name || '-x', email, registered_at,
         'u', CAST(2000 AS BIGINT), c_custkey FROM cust_src WHERE c_custkey % 3 = 0)"""


def _dim_customers(deletes: str = "ignore") -> str:
    where = "rn = 1" + (" AND c_custkey % 10 <> 0" if deletes == "apply" else "")
    return f"""
dim_customers AS (
  SELECT customer_id, first_name, last_name, first_name || ' ' || last_name AS full_name, email,
         registered_at,
         CASE WHEN registered_at >= {AS_OF} - INTERVAL 30 DAY THEN 'New'
              WHEN registered_at >= {AS_OF} - INTERVAL 365 DAY THEN 'Recent'
              ELSE 'Established' END AS customer_segment,
         CAST(date_diff('day', registered_at, {AS_OF}) AS INTEGER) AS days_since_registration,
         _event_timestamp_ms, {AS_OF} AS _extracted_at, {AS_OF} AS _processed_at
  FROM (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY _event_timestamp_ms DESC) AS rn
        FROM stg_customers)
  WHERE {where})"""


_STG_PRODUCTS = """
prod_src AS (
  SELECT p_partkey, CAST(p_partkey AS VARCHAR) AS product_id, p_name AS product_name,
         p_size * CAST(6.5 AS DOUBLE) AS price, CAST(p_partkey % 60 AS INTEGER) AS stock_quantity
  FROM part),
stg_products AS (
  SELECT product_id, product_name, price, stock_quantity, 'r' AS _operation,
         CAST(1000 AS BIGINT) AS _event_timestamp_ms FROM prod_src
  UNION ALL
  SELECT product_id, product_name, price, stock_quantity + 1, 'u', CAST(2000 AS BIGINT)
  FROM prod_src WHERE p_partkey % 4 = 1)"""

def _dim_products(deletes: str = "ignore") -> str:
    where = "rn = 1" + (" AND CAST(product_id AS BIGINT) % 12 <> 5" if deletes == "apply" else "")
    return f"""
dim_products AS (
  SELECT product_id, product_name, price, round_even(price, 2) AS price_rounded,
         CASE WHEN price < 50 THEN 'Low' WHEN price < 200 THEN 'Medium' ELSE 'High' END AS price_category,
         stock_quantity,
         CASE WHEN stock_quantity = 0 THEN 'Out of Stock' WHEN stock_quantity < 10 THEN 'Low Stock'
              WHEN stock_quantity < 50 THEN 'Medium Stock' ELSE 'High Stock' END AS inventory_status,
         stock_quantity = 0 AS is_out_of_stock,
         _event_timestamp_ms, {AS_OF} AS _extracted_at, {AS_OF} AS _processed_at
  FROM (SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY _event_timestamp_ms DESC) AS rn
        FROM stg_products)
  WHERE {where})"""


_STATUS = ("CASE o_orderstatus WHEN 'O' THEN 'shipped' WHEN 'F' THEN 'delivered' "
           "WHEN 'P' THEN 'pending' END")


def _stg_orders(updates: bool = False, deletes: str = "ignore") -> str:
    live = " WHERE o_orderkey % 11 <> 3" if deletes == "apply" else ""
    upd = """
  UNION ALL
  SELECT order_id, customer_id, ordered_at, 'delivered', 'u', CAST(2000 AS BIGINT), o_orderkey
  FROM ord_src WHERE o_orderkey % 7 = 0""" if updates else ""
    return f"""
ord_src AS (
  SELECT o_orderkey, CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_custkey AS VARCHAR) AS customer_id,
         o_orderdate AS ordered_at, {_STATUS} AS order_status
  FROM orders{live}),
stg_orders AS (
  SELECT order_id, customer_id, ordered_at, order_status, 'r' AS _operation,
         CAST(1000 AS BIGINT) AS _event_timestamp_ms, o_orderkey FROM ord_src{upd})"""


_LINES = f"""
item_src AS (
  SELECT l_orderkey, CAST(l_partkey AS VARCHAR) AS product_id,
         CAST(CAST(l_quantity AS INTEGER) AS DOUBLE) AS quantity,
         p_size * CAST(6.5 AS DOUBLE) + CASE WHEN l_discount > CAST(0.05 AS DOUBLE)
              THEN CAST(1.25 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS unit_price
  FROM lineitem JOIN part ON p_partkey = l_partkey),
lines AS (
  SELECT s.order_id, s.customer_id, i.product_id, s.ordered_at, CAST(s.ordered_at AS DATE) AS order_date,
         s.order_status, i.quantity, i.unit_price, i.quantity * i.unit_price AS line_total,
         s._operation, s._event_timestamp_ms, {AS_OF} AS _extracted_at
  FROM stg_orders s JOIN item_src i ON i.l_orderkey = s.o_orderkey
  WHERE s.order_status IN ('shipped', 'delivered', 'pending'))"""


def _fact(unmatched: str = "defaults") -> str:
    def d(expr: str, default: str) -> str:
        return f"coalesce({expr}, {default})" if unmatched == "defaults" else expr

    price = d("p.price", "CAST(0 AS DOUBLE)")
    return f"""
fact_orders AS (
  SELECT l.order_id, l.customer_id, l.product_id, l.ordered_at, l.order_date, l.order_status,
         l.quantity, l.unit_price, l.line_total,
         {d('c.full_name', "''")} AS customer_name, {d('c.first_name', "''")} AS customer_first_name,
         {d('c.last_name', "''")} AS customer_last_name, {d('c.email', "''")} AS customer_email,
         {d('c.customer_segment', "''")} AS customer_segment, c.days_since_registration,
         {d('p.product_name', "''")} AS product_name, {price} AS current_product_price,
         {d('p.price_category', "''")} AS price_category, {d('p.inventory_status', "''")} AS inventory_status,
         {d('p.is_out_of_stock', 'false')} AS is_out_of_stock,
         abs(l.unit_price - {price}) AS price_difference,
         coalesce(abs(l.unit_price - {price}) > 0.01, false) AS has_price_variance,
         sum(l.line_total) OVER (PARTITION BY l.order_id) AS order_total_value,
         count(*) OVER (PARTITION BY l.order_id) AS items_in_order,
         avg(l.unit_price) OVER (PARTITION BY l.order_id) AS avg_item_price_in_order,
         count(DISTINCT l.order_id) OVER (PARTITION BY l.customer_id) AS customer_lifetime_orders,
         sum(l.line_total) OVER (PARTITION BY l.customer_id) AS customer_lifetime_value,
         sum(l.quantity) OVER (PARTITION BY l.product_id) AS product_total_quantity_sold,
         sum(l.line_total) OVER (PARTITION BY l.product_id) AS product_total_revenue,
         l._operation, l._event_timestamp_ms, l._extracted_at, {AS_OF} AS _processed_at
  FROM lines l
  LEFT JOIN dim_customers c ON l.customer_id = c.customer_id
  LEFT JOIN dim_products p ON l.product_id = p.product_id)"""


_ORDER_TOTALS = """
order_totals AS (
  SELECT order_id, customer_id, order_date, sum(line_total) AS order_total_value,
         count(*) AS line_items_count
  FROM lines GROUP BY order_id, customer_id, order_date
  HAVING sum(line_total) > 0)"""

_DAILY = f"""
fct_daily_sales AS (
  SELECT order_date, sum(order_total_value) AS total_revenue,
         count(DISTINCT order_id) AS total_orders_placed,
         count(DISTINCT customer_id) AS total_unique_customers,
         avg(order_total_value) AS avg_order_value,
         CAST(sum(line_items_count) AS BIGINT) AS total_line_items,
         {AS_OF} AS _calculated_at
  FROM order_totals GROUP BY order_date)"""


def with_models(select: str, *, customers_deletes: str = "ignore", order_updates: bool = False,
                unmatched: str = "defaults", deletes: str = "ignore") -> str:
    """Wrap a final SELECT with every model CTE (unused CTEs cost nothing)."""
    if deletes == "apply":
        customers_deletes = "apply"
    ctes = [_STG_CUSTOMERS, _dim_customers(customers_deletes), _STG_PRODUCTS, _dim_products(deletes),
            _stg_orders(order_updates, deletes), _LINES, _fact(unmatched), _ORDER_TOTALS, _DAILY]
    return "WITH " + ",".join(c.strip("\n") for c in ctes) + "\n" + select.strip()


# --- the change log built from the events table ---------------------------------

EVENTS_TABLE = ("CASE user_id % 3 WHEN 0 THEN 'mongo_ecom_customers' WHEN 1 THEN 'mongo_ecom_products' "
                "ELSE 'mongo_ecom_orders' END")
EVENTS_TOPIC = ("CASE user_id % 3 WHEN 0 THEN 'mongo.ecom.ecom.customers' "
                "WHEN 1 THEN 'mongo.ecom.ecom.products' ELSE 'mongo.ecom.ecom.orders' END")
