"""The conformed sales fact (orders x payments x customers, reviews attached).

``grain="reference"`` keeps payments and reviews at their own grain, as the
analysis and mart code it replaces does: an order with *p* payments and *r*
reviews contributes ``p * max(r, 1)`` rows, so ``sum(payment_value)``
counts each payment once per review.  ``grain="order"`` pre-aggregates both
sides per order first (no fan-out).

Join plan: the three ``order_id`` joins share one partitioning.  On the
landed tables (bucketed by ``order_id``, see ``sources.landing``) they need
no exchange at all; on unbucketed inputs the large sides are shuffled once
on ``order_id``.  Only the customer lookup shuffles, on ``customer_id``
(both sides, so AQE can split a skewed customer; or it is broadcast when
its measured size allows).  Inner joins and the reviews left join commute
because the reviews join touches only ``order_id``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.functions.timefx import month_text


def sales_fact(tables: dict[str, DataFrame], grain: str = "reference", with_reviews: bool = True) -> DataFrame:
    """The fact; ``with_reviews=False`` omits the reviews left join.

    Leaving it out is only valid for consumers of distinct (person, month) or
    (person, order) sets, which a left join can only multiply, never change:
    the cohort operators use it.
    """
    orders = tables["orders"]
    payments = tables["payments"]
    customers = tables["customers"]
    # review_score becomes nullable through the left join; like the merged
    # pandas frame it is carried as double.
    reviews = tables["reviews"].select("order_id", F.col("review_score").cast("double").alias("review_score"))

    if grain == "order":
        payments = payments.groupBy("order_id").agg(
            F.sum("payment_value").cast("decimal(18,2)").alias("payment_value"),
            F.max("payment_installments").alias("payment_installments"),
            F.count(F.lit(1)).alias("payment_rows"),
        )
        reviews = reviews.groupBy("order_id").agg(F.avg("review_score").alias("review_score"))
    elif grain != "reference":
        raise ValueError(f"unknown grain {grain!r}")

    fact = orders.join(payments, "order_id", "inner")
    if with_reviews:
        fact = fact.join(reviews, "order_id", "left")
    fact = fact.join(customers, "customer_id", "inner")
    return fact.withColumn("order_month", month_text("order_purchase_timestamp"))


def sales_by_order(tables: dict[str, DataFrame], with_reviews: bool = True) -> DataFrame:
    """The reference fact reduced to one row per order before its customer is joined.

    An order's ``p`` payments and ``r`` reviews make ``p * max(r, 1)`` fact rows;
    here ``payment_value`` is their sum (DECIMAL, exact) and ``fact_rows`` their
    number, applied as a weight, so no multiplied row is ever made.  Payments and
    reviews are reduced on ``order_id`` first (no exchange on landed tables); the
    customer join then shuffles one row per order.  ``customer_id`` is the key of
    the customers, so an order keeps one row.
    """
    payments = tables["payments"].groupBy("order_id").agg(
        F.sum("payment_value").alias("_paid"), F.count(F.lit(1)).alias("_payments")
    )
    sales = tables["orders"].join(payments, "order_id", "inner")
    weight = F.lit(1)
    if with_reviews:
        reviews = tables["reviews"].groupBy("order_id").agg(F.count(F.lit(1)).alias("_reviews"))
        sales = sales.join(reviews, "order_id", "left")
        weight = F.coalesce("_reviews", F.lit(1))
    sales = sales.withColumn("payment_value", (F.col("_paid") * weight).cast("decimal(28,2)"))
    sales = sales.withColumn("fact_rows", F.col("_payments") * weight).drop("_paid", "_payments", "_reviews")
    sales = sales.join(tables["customers"], "customer_id", "inner")
    return sales.withColumn("order_month", month_text("order_purchase_timestamp"))
