"""Independent DuckDB SQL for the correctness gate.

Each entry recomputes a registered query from the raw test tables (views
``region nation customer supplier part orders lineitem``) with plain SQL.
The role views are restated here as CTEs (written separately from the
DataFrame code in ``mercato.sources.roles``), so the check covers the
derivation as well as the operator.
"""

from __future__ import annotations

import re

ROLE_CTES = """
orders_r AS (
  SELECT o_orderkey AS order_id,
         o_custkey AS customer_id,
         CASE WHEN o_orderstatus IN ('F', 'O') THEN 'delivered'
              WHEN o_orderkey % 4 = 0 THEN 'shipped'
              WHEN o_orderkey % 4 = 1 THEN 'canceled'
              WHEN o_orderkey % 4 = 2 THEN 'invoiced'
              ELSE 'processing' END AS order_status,
         o_orderdate + ((o_orderkey * 37) % 1440) * INTERVAL '1' MINUTE AS order_purchase_timestamp,
         CASE WHEN o_orderstatus IN ('F', 'O') AND o_orderkey % 101 <> 0 THEN
              o_orderdate + ((o_orderkey * 37) % 1440) * INTERVAL '1' MINUTE
              + (2 + (o_orderkey * 13) % 22
                   + CASE WHEN month(o_orderdate) IN (2, 3, 11) THEN 9 ELSE 0 END) * INTERVAL '1' DAY
              + ((o_orderkey * 29) % 1440) * INTERVAL '1' MINUTE
         END AS order_delivered_customer_date,
         o_orderdate + (22 + o_orderkey % 4) * INTERVAL '1' DAY AS order_estimated_delivery_date
  FROM orders
),
customers_r AS (
  SELECT c_custkey AS customer_id,
         CASE WHEN c_custkey % 10 = 9 THEN c_custkey - 1 ELSE c_custkey END AS customer_unique_id,
         concat(n_name, '-', c_mktsegment) AS customer_city,
         n_name AS customer_state
  FROM customer JOIN nation ON c_nationkey = n_nationkey
),
payments_r AS (
  SELECT l_orderkey AS order_id,
         l_linenumber AS payment_sequential,
         CASE WHEN l_returnflag = 'A' THEN 'credit_card'
              WHEN l_returnflag = 'N' AND l_linestatus = 'F' THEN 'boleto'
              WHEN l_returnflag = 'N' AND l_linestatus = 'O' THEN 'debit_card'
              WHEN l_returnflag = 'R' THEN 'voucher' END AS payment_type,
         CAST(1 + l_quantity % 10 AS INTEGER) AS payment_installments,
         CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 + CAST(l_tax AS DECIMAL(4,2))) AS DECIMAL(18,2)) AS payment_value
  FROM lineitem
),
reviews_r AS (
  SELECT 2 * o_orderkey AS review_id, o_orderkey AS order_id,
         CAST(1 + CASE WHEN (o_orderkey * 13) % 22
                              + CASE WHEN month(o_orderdate) IN (2, 3, 11) THEN 9 ELSE 0 END >= 21
                         THEN o_orderkey % 3 ELSE 2 + o_orderkey % 3 END AS INTEGER) AS review_score
  FROM orders WHERE o_orderkey % 9 <> 0
  UNION ALL
  SELECT 2 * o_orderkey + 1, o_orderkey, CAST(1 + o_orderkey % 5 AS INTEGER)
  FROM orders WHERE o_orderkey % 11 = 0
),
items_r AS (
  SELECT l_orderkey AS order_id, l_linenumber AS order_item_id, l_partkey AS product_id,
         l_suppkey AS seller_id,
         CAST(l_extendedprice AS DECIMAL(18,2)) AS price,
         CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_tax AS DECIMAL(4,2)) AS DECIMAL(18,2)) AS freight_value
  FROM lineitem
),
products_r AS (
  SELECT p_partkey AS product_id,
         CASE WHEN p_partkey % 50 = 0 THEN NULL ELSE concat(p_type, '/', p_brand) END AS product_category_name,
         CAST(CASE WHEN p_partkey % 40 = 1 THEN NULL ELSE p_size * 100 END AS DOUBLE) AS product_weight_g,
         CAST(10 + p_size AS DOUBLE) AS product_length_cm,
         CAST(5 + p_size % 7 AS DOUBLE) AS product_height_cm,
         CAST(8 + p_size % 11 AS DOUBLE) AS product_width_cm
  FROM part
),
translation_r AS (
  SELECT DISTINCT concat(p_type, '/', p_brand) AS product_category_name,
         lower(concat(p_type, '/', p_brand)) AS product_category_name_english
  FROM part WHERE p_type <> 'PROMO'
),
sellers_r AS (
  SELECT s_suppkey AS seller_id, n_name AS seller_city, r_name AS seller_state
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  WHERE s_suppkey % 25 <> 0
),
fact_r AS (
  SELECT o.order_id, o.customer_id, o.order_status, o.order_purchase_timestamp,
         o.order_delivered_customer_date, o.order_estimated_delivery_date,
         p.payment_sequential, p.payment_type, p.payment_installments, p.payment_value,
         c.customer_unique_id, c.customer_city, c.customer_state, CAST(r.review_score AS DOUBLE) AS review_score,
         strftime(o.order_purchase_timestamp, '%Y-%m') AS order_month
  FROM orders_r o
  JOIN payments_r p ON p.order_id = o.order_id
  JOIN customers_r c ON c.customer_id = o.customer_id
  LEFT JOIN reviews_r r ON r.order_id = o.order_id
),
delivered_r AS (
  SELECT *,
         CAST(floor((epoch_us(order_delivered_customer_date) - epoch_us(order_purchase_timestamp)) / 86400000000.0) AS BIGINT) AS delivery_days,
         coalesce(order_delivered_customer_date > order_estimated_delivery_date, false) AS is_late
  FROM orders_r
  WHERE order_status = 'delivered' AND order_delivered_customer_date IS NOT NULL
)
"""


def with_roles(body: str) -> str:
    """Prefix a query body with the role CTEs (plus optional extra CTEs)."""
    body = body.strip()
    if re.match(r"(?i)WITH\s", body):
        return "WITH " + ROLE_CTES.strip() + ",\n" + body[5:]
    return "WITH " + ROLE_CTES.strip() + "\n" + body


ORACLE_BODIES: dict[str, str] = {}


def oracle(name: str, body: str) -> None:
    ORACLE_BODIES[name] = body


def oracle_sql() -> dict[str, str]:
    return {k: with_roles(v) for k, v in ORACLE_BODIES.items()}
