"""Explicit schemas of the eight canonical marketplace tables.

Ids are kept as strings in the CSV layout of a marketplace export; the role
views over the test tables produce ``bigint`` ids.  Both are accepted by the
operators (they only compare ids for equality).  Money is DECIMAL(18,2) so
that sums are exact and independent of shuffle order.
"""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)
TS = T.TimestampNTZType()


def _s(*fields: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


CANONICAL_SCHEMAS: dict[str, T.StructType] = {
    "orders": _s(
        ("order_id", T.StringType(), False),
        ("customer_id", T.StringType(), False),
        ("order_status", T.StringType(), False),
        ("order_purchase_timestamp", TS, False),
        ("order_delivered_customer_date", TS, True),
        ("order_estimated_delivery_date", TS, False),
    ),
    "payments": _s(
        ("order_id", T.StringType(), False),
        ("payment_sequential", T.IntegerType(), False),
        ("payment_type", T.StringType(), False),
        ("payment_installments", T.IntegerType(), False),
        ("payment_value", MONEY, False),
    ),
    "customers": _s(
        ("customer_id", T.StringType(), False),
        ("customer_unique_id", T.StringType(), False),
        ("customer_city", T.StringType(), False),
        ("customer_state", T.StringType(), False),
    ),
    "reviews": _s(
        ("review_id", T.StringType(), False),
        ("order_id", T.StringType(), False),
        ("review_score", T.IntegerType(), True),
    ),
    "items": _s(
        ("order_id", T.StringType(), False),
        ("order_item_id", T.IntegerType(), False),
        ("product_id", T.StringType(), False),
        ("seller_id", T.StringType(), False),
        ("price", MONEY, False),
        ("freight_value", MONEY, False),
    ),
    "products": _s(
        ("product_id", T.StringType(), False),
        ("product_category_name", T.StringType(), True),
        ("product_weight_g", T.DoubleType(), True),
        ("product_length_cm", T.DoubleType(), True),
        ("product_height_cm", T.DoubleType(), True),
        ("product_width_cm", T.DoubleType(), True),
    ),
    "category_translation": _s(
        ("product_category_name", T.StringType(), False),
        ("product_category_name_english", T.StringType(), False),
    ),
    "sellers": _s(
        ("seller_id", T.StringType(), False),
        ("seller_city", T.StringType(), False),
        ("seller_state", T.StringType(), False),
    ),
}

# Columns whose nulls break the marts (data-quality gate, see operators.quality).
CRITICAL_COLUMNS: dict[str, list[str]] = {
    "orders": ["order_id", "customer_id", "order_status", "order_purchase_timestamp"],
    "payments": ["order_id", "payment_type", "payment_value"],
    "customers": ["customer_id", "customer_unique_id", "customer_state"],
    "reviews": ["order_id", "review_score"],
    "items": ["order_id", "product_id", "seller_id", "price"],
    "products": ["product_id", "product_category_name"],
    "category_translation": ["product_category_name"],
    "sellers": ["seller_id", "seller_state"],
}

TABLE_NAMES = list(CANONICAL_SCHEMAS)
