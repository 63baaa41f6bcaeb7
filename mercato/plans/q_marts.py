"""Role views, the sales fact and the revenue/KPI marts."""

from __future__ import annotations

from pyspark.sql import functions as F

from mercato.operators import marts
from mercato.operators.fact import sales_by_order, sales_fact
from mercato.plans.catalog import M, R, register, tables
from mercato.sources.readers import register_views

# ---------------------------------------------------------------- role views


@register("role_orders", "SELECT * FROM orders_r")
def q_role_orders(spark, d):
    return tables(spark, d)["orders"]


@register("role_customers", "SELECT * FROM customers_r")
def q_role_customers(spark, d):
    return tables(spark, d)["customers"]


@register("role_payments", "SELECT * REPLACE (CAST(payment_value AS DOUBLE) AS payment_value) FROM payments_r")
def q_role_payments(spark, d):
    return tables(spark, d)["payments"]


@register("role_reviews", "SELECT * FROM reviews_r")
def q_role_reviews(spark, d):
    return tables(spark, d)["reviews"]


@register(
    "role_items",
    "SELECT * REPLACE (CAST(price AS DOUBLE) AS price, CAST(freight_value AS DOUBLE) AS freight_value) FROM items_r",
)
def q_role_items(spark, d):
    return tables(spark, d)["items"]


@register("role_products", "SELECT * FROM products_r")
def q_role_products(spark, d):
    return tables(spark, d)["products"]


@register("role_category_translation", "SELECT * FROM translation_r")
def q_role_translation(spark, d):
    return tables(spark, d)["category_translation"]


@register("role_sellers", "SELECT * FROM sellers_r")
def q_role_sellers(spark, d):
    return tables(spark, d)["sellers"]


_COUNT_SQL = " UNION ALL ".join(
    f"SELECT '{n}' AS table_name, count(*) AS rows, CAST({c} AS BIGINT) AS columns FROM {v}"
    for n, v, c in [
        ("orders", "orders_r", 6),
        ("payments", "payments_r", 5),
        ("customers", "customers_r", 4),
        ("reviews", "reviews_r", 3),
        ("items", "items_r", 6),
        ("products", "products_r", 6),
        ("category_translation", "translation_r", 2),
        ("sellers", "sellers_r", 3),
    ]
)


@register("table_row_counts", _COUNT_SQL)
def q_table_row_counts(spark, d):
    """Rows and columns per loaded table (the loaders' shape log, as a table)."""
    t = tables(spark, d)
    parts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(name).alias("table_name"), "rows", F.lit(len(df.columns)).cast("bigint").alias("columns")
        )
        for name, df in t.items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


_SCAN_SQL = " UNION ALL ".join(
    f"SELECT '{n}' AS table_name, count(*) AS rows, count(DISTINCT {k}) AS distinct_keys FROM {v}"
    for n, v, k in [
        ("orders", "orders_r", "order_id"),
        ("payments", "payments_r", "order_id"),
        ("customers", "customers_r", "customer_id"),
        ("reviews", "reviews_r", "review_id"),
        ("items", "items_r", "order_id"),
        ("products", "products_r", "product_id"),
        ("category_translation", "translation_r", "product_category_name"),
        ("sellers", "sellers_r", "seller_id"),
    ]
)

_KEYS = {
    "orders": "order_id",
    "payments": "order_id",
    "customers": "customer_id",
    "reviews": "review_id",
    "items": "order_id",
    "products": "product_id",
    "category_translation": "product_category_name",
    "sellers": "seller_id",
}


@register("scan_tables", _SCAN_SQL)
def q_scan_tables(spark, d):
    """Scan every canonical table: rows and distinct primary/foreign keys."""
    t = tables(spark, d)
    out = None
    for name, df in t.items():
        part = df.agg(F.count(F.lit(1)).alias("rows"), F.countDistinct(_KEYS[name]).alias("distinct_keys"))
        part = part.select(F.lit(name).alias("table_name"), "rows", "distinct_keys")
        out = part if out is None else out.unionByName(part)
    return out


# ---------------------------------------------------------------- the fact


@register("sales_fact", "SELECT * REPLACE (CAST(payment_value AS DOUBLE) AS payment_value) FROM fact_r")
def q_sales_fact(spark, d):
    return sales_fact(tables(spark, d))


@register(
    "sales_fact_order_grain",
    """
    SELECT o.*, CAST(p.payment_value AS DOUBLE) AS payment_value, p.payment_installments, p.payment_rows, r.review_score,
           c.customer_unique_id, c.customer_city, c.customer_state,
           strftime(o.order_purchase_timestamp, '%Y-%m') AS order_month
    FROM orders_r o
    JOIN (SELECT order_id, CAST(sum(payment_value) AS DECIMAL(18,2)) AS payment_value,
                 max(payment_installments) AS payment_installments, count(*) AS payment_rows
          FROM payments_r GROUP BY order_id) p ON p.order_id = o.order_id
    LEFT JOIN (SELECT order_id, avg(review_score) AS review_score FROM reviews_r GROUP BY order_id) r
         ON r.order_id = o.order_id
    JOIN customers_r c ON c.customer_id = o.customer_id
    """,
)
def q_sales_fact_order(spark, d):
    return sales_fact(tables(spark, d), grain="order")


# ---------------------------------------------------------------- marts


@register("monthly_revenue", f"SELECT order_month, {M('payment_value')} AS revenue FROM fact_r GROUP BY order_month")
def q_monthly_revenue(spark, d):
    return marts.monthly_revenue(sales_by_order(tables(spark, d)))


@register(
    "sql_monthly_revenue",
    f"SELECT order_month, {M('payment_value')} AS revenue FROM fact_r GROUP BY order_month",
)
def q_sql_monthly_revenue(spark, d):
    """The same mart as SQL text: joins and aggregation over the catalogued tables."""
    t = tables(spark, d)
    register_views({n: t[n] for n in ("orders", "payments", "reviews", "customers")}, suffix="_v")
    return spark.sql(
        """
        SELECT date_format(o.order_purchase_timestamp, 'yyyy-MM') AS order_month,
               round(CAST(sum(p.payment_value) AS DOUBLE), 2) AS revenue
        FROM orders_v o
        JOIN payments_v p ON p.order_id = o.order_id
        LEFT JOIN reviews_v r ON r.order_id = o.order_id
        JOIN customers_v c ON c.customer_id = o.customer_id
        GROUP BY 1
        ORDER BY 1
        """
    )


@register(
    "kpi_summary",
    f"""
    SELECT {M('payment_value')} AS total_revenue,
           count(DISTINCT order_id) AS total_orders,
           count(DISTINCT customer_unique_id) AS total_customers,
           {R('CAST(sum(payment_value) AS DOUBLE) / CAST(count(DISTINCT order_id) AS DOUBLE)')} AS avg_order_value
    FROM fact_r
    """,
)
def q_kpi_summary(spark, d):
    return marts.kpi_summary(sales_by_order(tables(spark, d)))


@register(
    "revenue_by_state",
    f"""
    SELECT customer_state, {M('payment_value')} AS revenue,
           count(DISTINCT customer_unique_id) AS customers, count(DISTINCT order_id) AS orders
    FROM fact_r WHERE customer_state IS NOT NULL GROUP BY customer_state
    """,
)
def q_revenue_by_state(spark, d):
    return marts.revenue_by_state(sales_by_order(tables(spark, d)))


@register(
    "revenue_by_city",
    f"""
    SELECT customer_city, customer_state, {M('payment_value')} AS revenue,
           count(DISTINCT customer_unique_id) AS customers, count(DISTINCT order_id) AS orders
    FROM fact_r WHERE customer_city IS NOT NULL AND customer_state IS NOT NULL
    GROUP BY customer_city, customer_state
    ORDER BY revenue DESC, customer_city, customer_state LIMIT 20
    """,
)
def q_revenue_by_city(spark, d):
    return marts.revenue_by_city(sales_by_order(tables(spark, d)))


@register(
    "payment_methods",
    f"""
    SELECT payment_type, count(DISTINCT order_id) AS orders,
           {R('CAST(sum(payment_value) AS DOUBLE) / CAST(count(payment_value) AS DOUBLE)')} AS avg_order_value,
           {M('payment_value')} AS total_revenue
    FROM fact_r WHERE payment_type IS NOT NULL GROUP BY payment_type
    """,
)
def q_payment_methods(spark, d):
    return marts.payment_methods(sales_fact(tables(spark, d)))


@register(
    "order_status",
    f"""
    SELECT order_status, count(*) AS order_count,
           {R('CAST(count(*) AS DOUBLE) / CAST(sum(count(*)) OVER () AS DOUBLE) * 100')} AS pct_of_orders
    FROM orders_r WHERE order_status IS NOT NULL GROUP BY order_status
    """,
)
def q_order_status(spark, d):
    return marts.order_status(tables(spark, d)["orders"])


@register(
    "top_categories",
    f"""
    SELECT coalesce(t.product_category_name_english, p.product_category_name, 'unknown') AS category,
           {M('i.price')} AS revenue, count(DISTINCT i.order_id) AS orders,
           {R('CAST(sum(i.price) AS DOUBLE) / CAST(count(i.price) AS DOUBLE)')} AS avg_price
    FROM items_r i
    LEFT JOIN products_r p ON p.product_id = i.product_id
    LEFT JOIN translation_r t ON t.product_category_name = p.product_category_name
    GROUP BY 1 ORDER BY revenue DESC, category LIMIT 20
    """,
)
def q_top_categories(spark, d):
    t = tables(spark, d)
    return marts.top_categories(t["items"], t["products"], t["category_translation"])


@register(
    "top_sellers",
    f"""
    SELECT i.seller_id, s.seller_city, s.seller_state, {M('i.price')} AS revenue,
           count(DISTINCT i.order_id) AS orders, count(i.order_item_id) AS items_sold,
           {R('avg(r.review_score)')} AS avg_review_score
    FROM items_r i
    LEFT JOIN reviews_r r ON r.order_id = i.order_id
    LEFT JOIN sellers_r s ON s.seller_id = i.seller_id
    WHERE s.seller_city IS NOT NULL AND s.seller_state IS NOT NULL
    GROUP BY 1, 2, 3 ORDER BY revenue DESC, i.seller_id LIMIT 20
    """,
)
def q_top_sellers(spark, d):
    t = tables(spark, d)
    return marts.top_sellers(t["items"], t["sellers"], t["reviews"])


@register(
    "delivery_performance",
    f"""
    SELECT {R('avg(delivery_days)')} AS avg_delivery_days,
           CAST(quantile_cont(delivery_days, 0.5) AS DOUBLE) AS median_delivery_days,
           {R('(1 - avg(CAST(is_late AS INTEGER))) * 100')} AS on_time_rate_pct,
           {R('avg(CAST(is_late AS INTEGER)) * 100')} AS late_rate_pct,
           count(*) AS orders_analyzed
    FROM delivered_r
    """,
)
def q_delivery_performance(spark, d):
    return marts.delivery_performance(tables(spark, d)["orders"])


@register(
    "delivered_orders",
    """
    SELECT order_id, delivery_days, is_late FROM delivered_r
    """,
)
def q_delivered_orders(spark, d):
    return marts.delivery_days_frame(tables(spark, d)["orders"])


@register(
    "payment_mix",
    f"""
    SELECT payment_type, count(*) AS transactions,
           {R('CAST(count(*) AS DOUBLE) / CAST(sum(count(*)) OVER () AS DOUBLE) * 100')} AS share_pct
    FROM fact_r WHERE payment_type IS NOT NULL GROUP BY payment_type
    """,
)
def q_payment_mix(spark, d):
    return marts.payment_mix(sales_fact(tables(spark, d)))


@register(
    "geo_top10",
    f"""
    SELECT customer_state, {M('payment_value')} AS total_revenue,
           count(DISTINCT customer_unique_id) AS unique_customers,
           {R('CAST(sum(payment_value) AS DOUBLE) / 1000', 3)} AS revenue_thousands
    FROM fact_r WHERE customer_state IS NOT NULL GROUP BY customer_state
    ORDER BY total_revenue DESC, customer_state LIMIT 10
    """,
)
def q_geo_top10(spark, d):
    return marts.geo_top10(sales_by_order(tables(spark, d)))


@register(
    "state_share",
    f"""
    SELECT customer_state, {M('payment_value')} AS revenue,
           {R('CAST(sum(payment_value) AS DOUBLE) / CAST(sum(sum(payment_value)) OVER () AS DOUBLE) * 100')} AS share_pct
    FROM fact_r WHERE customer_state IS NOT NULL GROUP BY customer_state
    """,
)
def q_state_share(spark, d):
    return marts.state_share(sales_by_order(tables(spark, d)))


@register(
    "review_distribution",
    "SELECT review_score, count(*) AS reviews FROM fact_r WHERE review_score IS NOT NULL GROUP BY review_score",
)
def q_review_distribution(spark, d):
    return marts.review_distribution(sales_fact(tables(spark, d)))


@register(
    "delivered_rate",
    f"""
    SELECT {R("avg(CAST(coalesce(order_status = 'delivered', false) AS INTEGER)) * 100")} AS delivered_rate, count(*) AS orders
    FROM orders_r
    """,
)
def q_delivered_rate(spark, d):
    return marts.delivered_rate(tables(spark, d)["orders"])


@register(
    "executive_summary",
    f"""
    WITH per_customer AS (
      SELECT customer_unique_id, count(DISTINCT order_id) AS n_orders FROM fact_r
      WHERE customer_unique_id IS NOT NULL GROUP BY 1
    )
    SELECT (SELECT {M('payment_value')} FROM fact_r) AS total_revenue,
           (SELECT count(DISTINCT order_id) FROM fact_r) AS total_orders,
           {R('avg(CAST(n_orders > 1 AS INTEGER)) * 100')} AS repeat_customer_rate_pct
    FROM per_customer
    """,
)
def q_executive_summary(spark, d):
    return marts.executive_summary(sales_by_order(tables(spark, d)))


@register(
    "kpi_banner",
    """
    WITH k AS (
      SELECT CAST(sum(payment_value) AS DOUBLE) AS rev, count(DISTINCT order_id) AS n_orders,
             count(DISTINCT customer_unique_id) AS n_customers
      FROM fact_r
    ), r AS (
      SELECT avg(CAST(coalesce(order_status = 'delivered', false) AS INTEGER)) * 100 AS rate FROM orders_r
    )
    SELECT format('{:,.2f}', CAST(round(CAST(CAST(rev AS VARCHAR) AS DECIMAL(38,18)), 2) AS DOUBLE)) AS revenue_text,
           format('{:,}', n_orders) AS orders_text,
           format('{:,}', n_customers) AS customers_text,
           format('{:,.2f}', rev / n_orders) AS aov_text,
           format('{:,.1f}', rate) AS delivered_rate_text,
           'Customers: ' || format('{:,}', n_customers) || ' | Avg Order Value: R$'
             || format('{:,.2f}', rev / n_orders) || ' | Delivered Rate: ' || format('{:,.1f}', rate) || '%' AS banner
    FROM k, r
    """,
)
def q_kpi_banner(spark, d):
    t = tables(spark, d)
    return marts.kpi_banner(sales_by_order(t), t["orders"])
