"""Revenue and KPI marts (flat, pre-aggregated tables).

Conventions, applied on both sides of every oracle check:
* money is summed as DECIMAL (exact) and emitted as ``double`` rounded to 2;
* averages of money are ``exact decimal sum / count``;
* counts are ``bigint``; null group keys are dropped (pandas ``groupby``);
* top-n results carry an explicit tie-breaker so they are deterministic.

Aggregations rely on Spark's partial (map-side) aggregation, so a hot key
(one state with a third of the revenue) is reduced before the shuffle.
Marts over persons and orders take ``sales_by_order`` (one row per order):
persons are counted as the groups of a first aggregation, so a hot state or
city is spread by person and no row is expanded for distinct counts.
Window functions appear only over already-aggregated, bounded results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mercato.functions.common import distinct_count, exact_mean, money_sum, pct, top_n
from mercato.functions.timefx import floor_days



def _all() -> Window:
    """Whole-frame window; only ever used on small aggregated frames."""
    return Window.partitionBy()


def _per_person(sales: DataFrame, *keys: str) -> DataFrame:
    """Revenue and orders per (keys, person) of sales with one row per order."""
    return sales.groupBy(*keys, "customer_unique_id").agg(F.sum("payment_value").alias("_rev"), F.count("order_id").alias("_orders"))


def kpi_summary(sales: DataFrame) -> DataFrame:
    """Totals of ``sales_by_order``: distinct persons are the groups of a first aggregation, orders its rows."""
    agg = _per_person(sales).agg(
        F.sum("_rev").cast("double").alias("_rev"),
        F.coalesce(F.sum("_orders"), F.lit(0)).alias("total_orders"),
        F.count("customer_unique_id").alias("total_customers"),
    )
    return agg.select(
        F.round("_rev", 2).alias("total_revenue"),
        "total_orders",
        "total_customers",
        F.round(F.try_divide(F.col("_rev"), F.col("total_orders").cast("double")), 2).alias("avg_order_value"),
    )


def monthly_revenue(fact: DataFrame) -> DataFrame:
    """Revenue by purchase month; months without sales are absent (no gap filling)."""
    return (
        fact.groupBy("order_month")
        .agg(F.round(money_sum("payment_value"), 2).alias("revenue"))
        .orderBy("order_month")
    )


def revenue_by_state(sales: DataFrame) -> DataFrame:
    return (
        _per_person(sales.where(F.col("customer_state").isNotNull()), "customer_state")
        .groupBy("customer_state")
        .agg(
            F.round(money_sum("_rev"), 2).alias("revenue"),
            F.count("customer_unique_id").alias("customers"),
            F.sum("_orders").alias("orders"),
        )
        .orderBy(F.desc("revenue"), "customer_state")
    )


def revenue_by_city(sales: DataFrame, n: int = 20) -> DataFrame:
    known = sales.where(F.col("customer_city").isNotNull() & F.col("customer_state").isNotNull())
    agg = (
        _per_person(known, "customer_city", "customer_state")
        .groupBy("customer_city", "customer_state")
        .agg(
            F.round(money_sum("_rev"), 2).alias("revenue"),
            F.count("customer_unique_id").alias("customers"),
            F.sum("_orders").alias("orders"),
        )
    )
    return top_n(agg, n, F.desc("revenue"), "customer_city", "customer_state")


def payment_methods(fact: DataFrame, approx: bool = False) -> DataFrame:
    """Per payment type: distinct orders, mean *payment row* value, revenue."""
    return (
        fact.where(F.col("payment_type").isNotNull())
        .groupBy("payment_type")
        .agg(
            distinct_count("order_id", approx).alias("orders"),
            F.round(exact_mean("payment_value"), 2).alias("avg_order_value"),
            F.round(money_sum("payment_value"), 2).alias("total_revenue"),
        )
        .orderBy(F.desc("orders"), "payment_type")
    )


def order_status(orders: DataFrame) -> DataFrame:
    counts = orders.where(F.col("order_status").isNotNull()).groupBy("order_status").agg(
        F.count(F.lit(1)).alias("order_count")
    )
    return counts.select(
        "order_status",
        "order_count",
        pct(F.col("order_count"), F.sum("order_count").over(_all())).alias("pct_of_orders"),
    ).orderBy(F.desc("order_count"), "order_status")


def top_categories(items: DataFrame, products: DataFrame, translation: DataFrame, n: int = 20) -> DataFrame:
    """Category revenue: English name, else original name, else ``'unknown'``."""
    cat = items.join(products.select("product_id", "product_category_name"), "product_id", "left").join(
        translation, "product_category_name", "left"
    )
    cat = cat.withColumn(
        "category",
        F.coalesce(F.col("product_category_name_english"), F.col("product_category_name"), F.lit("unknown")),
    )
    agg = cat.groupBy("category").agg(
        F.round(money_sum("price"), 2).alias("revenue"),
        F.countDistinct("order_id").alias("orders"),
        F.round(exact_mean("price"), 2).alias("avg_price"),
    )
    return top_n(agg, n, F.desc("revenue"), "category")


def top_sellers(items: DataFrame, sellers: DataFrame, reviews: DataFrame, n: int = 20) -> DataFrame:
    """Seller performance with the item x review fan-out of the original mart.

    Every item row is repeated once per review of its order (once when the
    order has none), so revenue and items_sold count an item once per review
    and the mean review is over those repeated rows.  Instead of materialising
    that fan-out, reviews are first reduced to one row per order
    (row count, score sum, score count) and the fan-out is applied as a
    weight: identical results, no row multiplication before the shuffle.
    Sellers missing from the seller table form null groups and are dropped.
    """
    per_order = reviews.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("_rows"),
        F.sum("review_score").alias("_score_sum"),
        F.count("review_score").alias("_score_n"),
    )
    w = F.coalesce("_rows", F.lit(1))
    # Pre-aggregate to one row per (order, seller) before the seller shuffle:
    # on order-bucketed items this needs no exchange, and it turns the
    # per-seller distinct order count into a row count.
    per_order_seller = (
        items.join(per_order, "order_id", "left")
        .groupBy("order_id", "seller_id")
        .agg(
            F.sum(F.col("price") * w).alias("_rev"),
            F.sum(F.when(F.col("order_item_id").isNotNull(), w).otherwise(0)).alias("_items"),
            F.sum(F.coalesce("_score_sum", F.lit(0))).alias("_score_sum"),
            F.sum(F.coalesce("_score_n", F.lit(0))).alias("_score_n"),
        )
    )
    joined = per_order_seller.join(sellers, "seller_id", "left").where(
        F.col("seller_city").isNotNull() & F.col("seller_state").isNotNull()
    )
    agg = joined.groupBy("seller_id", "seller_city", "seller_state").agg(
        F.round(F.sum("_rev").cast("double"), 2).alias("revenue"),
        F.count("order_id").alias("orders"),  # one row per (order, seller)
        F.sum("_items").cast("bigint").alias("items_sold"),
        F.round(F.try_divide(F.sum("_score_sum").cast("double"), F.sum("_score_n").cast("double")), 2).alias(
            "avg_review_score"
        ),
    )
    return top_n(agg, n, F.desc("revenue"), "seller_id")


def delivery_days_frame(orders: DataFrame) -> DataFrame:
    """Delivered orders with a date: floored delivery days and lateness flag."""
    delivered = orders.where(F.col("order_status") == "delivered").na.drop(
        subset=["order_delivered_customer_date"]
    )
    return delivered.select(
        "order_id",
        floor_days("order_delivered_customer_date", "order_purchase_timestamp").alias("delivery_days"),
        F.coalesce(
            F.col("order_delivered_customer_date") > F.col("order_estimated_delivery_date"), F.lit(False)
        ).alias("is_late"),
    )


def delivery_performance(orders: DataFrame) -> DataFrame:
    d = delivery_days_frame(orders)
    late = F.col("is_late").cast("int")
    return d.agg(
        F.round(F.avg("delivery_days"), 2).alias("avg_delivery_days"),
        F.median("delivery_days").cast("double").alias("median_delivery_days"),
        F.round((1 - F.avg(late)) * 100, 2).alias("on_time_rate_pct"),
        F.round(F.avg(late) * 100, 2).alias("late_rate_pct"),
        F.count(F.lit(1)).alias("orders_analyzed"),
    )


def payment_mix(fact: DataFrame) -> DataFrame:
    """Transactions (fact rows) per payment type and their share."""
    counts = fact.where(F.col("payment_type").isNotNull()).groupBy("payment_type").agg(
        F.count(F.lit(1)).alias("transactions")
    )
    return counts.select(
        "payment_type",
        "transactions",
        pct(F.col("transactions"), F.sum("transactions").over(_all())).alias("share_pct"),
    ).orderBy(F.desc("transactions"), "payment_type")


def geo_top10(sales: DataFrame, n: int = 10) -> DataFrame:
    """Top states by revenue with unique customers; revenue also in thousands."""
    agg = (
        _per_person(sales.where(F.col("customer_state").isNotNull()), "customer_state")
        .groupBy("customer_state")
        .agg(
            F.sum("_rev").cast("double").alias("_rev"),
            F.count("customer_unique_id").alias("unique_customers"),
        )
        .select(
            "customer_state",
            F.round("_rev", 2).alias("total_revenue"),
            "unique_customers",
            F.round(F.col("_rev") / 1000, 3).alias("revenue_thousands"),
        )
    )
    return top_n(agg, n, F.desc("total_revenue"), "customer_state")


def state_share(fact: DataFrame) -> DataFrame:
    """Each state's share of total revenue."""
    agg = (
        fact.where(F.col("customer_state").isNotNull())
        .groupBy("customer_state")
        .agg(F.sum("payment_value").alias("_rev"))
    )
    total = F.sum("_rev").over(_all())
    return agg.select(
        "customer_state",
        F.round(F.col("_rev").cast("double"), 2).alias("revenue"),
        pct(F.col("_rev"), total).alias("share_pct"),
    ).orderBy(F.desc("revenue"), "customer_state")


def review_distribution(fact: DataFrame) -> DataFrame:
    return (
        fact.where(F.col("review_score").isNotNull())
        .groupBy("review_score")
        .agg(F.count(F.lit(1)).alias("reviews"))
        .orderBy("review_score")
    )


def _delivered():
    return F.coalesce(F.col("order_status") == "delivered", F.lit(False)).cast("int")


def delivered_rate(orders: DataFrame) -> DataFrame:
    """Share of orders with status 'delivered' (published as an on-time rate); a missing status is not delivered."""
    return orders.agg(
        F.round(F.avg(_delivered()) * 100, 2).alias("delivered_rate"),
        F.count(F.lit(1)).alias("orders"),
    )


def executive_summary(sales: DataFrame) -> DataFrame:
    """Revenue, distinct orders and repeat-customer rate (> 1 distinct order; rows without a person have no rate).

    ``sales`` has one row per order, so the rows of a person are its orders.
    """
    per_customer = _per_person(sales)
    repeat = F.when(F.col("customer_unique_id").isNotNull(), (F.col("_orders") > 1).cast("int"))
    return per_customer.agg(
        F.round(F.sum("_rev").cast("double"), 2).alias("total_revenue"),
        F.sum("_orders").alias("total_orders"),
        F.round(F.avg(repeat) * 100, 2).alias("repeat_customer_rate_pct"),
    )


def kpi_banner(sales: DataFrame, orders: DataFrame) -> DataFrame:
    """KPI tiles as formatted text (thousands separators, 2 dp, 1 dp %)."""
    k = _per_person(sales).agg(
        F.sum("_rev").cast("double").alias("_rev"),
        F.coalesce(F.sum("_orders"), F.lit(0)).alias("_orders"),
        F.count("customer_unique_id").alias("_customers"),
    )
    rate = orders.select(F.avg(_delivered()) * 100).scalar()
    out = k.select(
        F.format_number(F.round("_rev", 2), 2).alias("revenue_text"),
        F.format_number("_orders", 0).alias("orders_text"),
        F.format_number("_customers", 0).alias("customers_text"),
        F.format_number(F.try_divide(F.col("_rev"), F.col("_orders").cast("double")), 2).alias("aov_text"),
        F.format_number(rate, 1).alias("delivered_rate_text"),
    )
    return out.withColumn(
        "banner",
        F.concat(
            F.lit("Customers: "), "customers_text",
            F.lit(" | Avg Order Value: R$"), "aov_text",
            F.lit(" | Delivered Rate: "), "delivered_rate_text", F.lit("%"),
        ),
    )
