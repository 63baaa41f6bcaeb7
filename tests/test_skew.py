"""A customer holding a third of all rows: AQE splits the skewed join partition."""

from __future__ import annotations

import contextlib
import io

from pyspark.sql import functions as F

from mercato.operators import marts
from mercato.operators.fact import sales_by_order


def _final_plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def test_hot_customer_join_is_split(spark):
    n = 30_000
    orders = spark.range(n).select(
        F.col("id").alias("order_id"),
        F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id") % 997 + 2).alias("customer_id"),
        F.lit("delivered").alias("order_status"),
        F.lit("2020-01-01 10:00:00").cast("timestamp_ntz").alias("order_purchase_timestamp"),
        F.lit(None).cast("timestamp_ntz").alias("order_delivered_customer_date"),
        F.lit("2020-01-20 00:00:00").cast("timestamp_ntz").alias("order_estimated_delivery_date"),
    )
    payments = spark.range(n).select(
        F.col("id").alias("order_id"),
        F.lit(1).alias("payment_sequential"),
        F.lit("credit_card").alias("payment_type"),
        F.lit(1).alias("payment_installments"),
        F.lit(10).cast("decimal(18,2)").alias("payment_value"),
    )
    customers = spark.range(1, 1000).select(
        F.col("id").alias("customer_id"),
        F.col("id").alias("customer_unique_id"),
        F.lit("c").alias("customer_city"),
        F.concat(F.lit("s"), (F.col("id") % 5).cast("string")).alias("customer_state"),
    )
    reviews = spark.range(0).select(
        F.col("id").alias("review_id"), F.col("id").alias("order_id"), F.lit(5).alias("review_score")
    )
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",  # one narrow row per order compresses well
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        sales = sales_by_order(dict(orders=orders, payments=payments, customers=customers, reviews=reviews))
        out = marts.revenue_by_state(sales)
        rows = out.collect()
        assert sum(r.orders for r in rows) == n  # whole result, nothing dropped
        plan = _final_plan(out)
        assert "isFinalPlan=true" in plan
        assert "skew=true" in plan
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
