"""Role views: the driver's TPC-H-like tables in the canonical marketplace shape.

The test tables are not a marketplace, so each canonical table is derived
from them with integer, decimal and interval arithmetic only (see
FIXTURES.md section 2).  Everything here is a lazy projection/join of the
given tables, so the work grows with them; ``k`` below is ``o_orderkey``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.sources.readers import load_parquet_tables

RAW_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]


def _minutes(n: Column) -> Column:
    return F.make_dt_interval(mins=n.cast("int"))


def _days(n: Column) -> Column:
    return F.make_dt_interval(days=n.cast("int"))


def _lag_days(k: Column, orderdate: Column) -> Column:
    """Synthetic shipping lag: key-driven, +9 days in peak months (2, 3, 11)."""
    return (k * 13) % 22 + F.when(F.month(orderdate).isin(2, 3, 11), 9).otherwise(0)


def orders_view(orders: DataFrame) -> DataFrame:
    k = F.col("o_orderkey")
    od = F.col("o_orderdate")
    delivered = F.col("o_orderstatus").isin("F", "O")
    status = (
        F.when(delivered, "delivered")
        .when(k % 4 == 0, "shipped")
        .when(k % 4 == 1, "canceled")
        .when(k % 4 == 2, "invoiced")
        .otherwise("processing")
    )
    purchase = od + _minutes((k * 37) % 1440)
    delivered_at = F.when(
        delivered & (k % 101 != 0),
        purchase + _days(2 + _lag_days(k, od)) + _minutes((k * 29) % 1440),
    )
    return orders.select(
        k.alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        status.alias("order_status"),
        purchase.alias("order_purchase_timestamp"),
        delivered_at.alias("order_delivered_customer_date"),
        (od + _days(22 + k % 4)).alias("order_estimated_delivery_date"),
    )


def customers_view(customer: DataFrame, nation: DataFrame) -> DataFrame:
    c = F.col("c_custkey")
    return customer.join(nation, customer.c_nationkey == nation.n_nationkey, "inner").select(
        c.alias("customer_id"),
        F.when(c % 10 == 9, c - 1).otherwise(c).alias("customer_unique_id"),
        F.concat(F.col("n_name"), F.lit("-"), F.col("c_mktsegment")).alias("customer_city"),
        F.col("n_name").alias("customer_state"),
    )


def payments_view(lineitem: DataFrame) -> DataFrame:
    rf, ls = F.col("l_returnflag"), F.col("l_linestatus")
    ptype = (
        F.when(rf == "A", "credit_card")
        .when((rf == "N") & (ls == "F"), "boleto")
        .when((rf == "N") & (ls == "O"), "debit_card")
        .when(rf == "R", "voucher")
    )
    value = (
        F.col("l_extendedprice").cast("decimal(12,2)") * (F.lit(1) + F.col("l_tax").cast("decimal(4,2)"))
    ).cast("decimal(18,2)")
    return lineitem.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("payment_sequential"),
        ptype.alias("payment_type"),
        (F.lit(1) + F.col("l_quantity") % 10).cast("int").alias("payment_installments"),
        value.alias("payment_value"),
    )


def reviews_view(orders: DataFrame) -> DataFrame:
    """0, 1 or 2 reviews per order; late-prone orders score lower."""
    k = F.col("o_orderkey")
    lag = _lag_days(k, F.col("o_orderdate"))
    first = orders.where(k % 9 != 0).select(
        (k * 2).alias("review_id"),
        k.alias("order_id"),
        (F.lit(1) + F.when(lag >= 21, k % 3).otherwise(2 + k % 3)).cast("int").alias("review_score"),
    )
    second = orders.where(k % 11 == 0).select(
        (k * 2 + 1).alias("review_id"),
        k.alias("order_id"),
        (F.lit(1) + k % 5).cast("int").alias("review_score"),
    )
    return first.unionByName(second)


def items_view(lineitem: DataFrame) -> DataFrame:
    price = F.col("l_extendedprice")
    return lineitem.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("order_item_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("seller_id"),
        price.cast("decimal(18,2)").alias("price"),
        (price.cast("decimal(12,2)") * F.col("l_tax").cast("decimal(4,2)")).cast("decimal(18,2)").alias("freight_value"),
    )


def _category_name() -> Column:
    return F.concat(F.col("p_type"), F.lit("/"), F.col("p_brand"))


def products_view(part: DataFrame) -> DataFrame:
    pk, size = F.col("p_partkey"), F.col("p_size")
    return part.select(
        pk.alias("product_id"),
        F.when(pk % 50 != 0, _category_name()).alias("product_category_name"),
        F.when(pk % 40 != 1, size * 100).cast("double").alias("product_weight_g"),
        (10 + size).cast("double").alias("product_length_cm"),
        (5 + size % 7).cast("double").alias("product_height_cm"),
        (8 + size % 11).cast("double").alias("product_width_cm"),
    )


def category_translation_view(part: DataFrame) -> DataFrame:
    """Translation is deliberately incomplete: PROMO names fall back to the original."""
    return (
        part.where(F.col("p_type") != "PROMO")
        .select(_category_name().alias("product_category_name"))
        .distinct()
        .select("product_category_name", F.lower("product_category_name").alias("product_category_name_english"))
    )


def sellers_view(supplier: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    """Every 25th supplier is missing, so item rows meet unmatched sellers."""
    return (
        supplier.where(F.col("s_suppkey") % 25 != 0)
        .join(nation, supplier.s_nationkey == nation.n_nationkey, "inner")
        .join(region, F.col("n_regionkey") == region.r_regionkey, "inner")
        .select(
            F.col("s_suppkey").alias("seller_id"),
            F.col("n_name").alias("seller_city"),
            F.col("r_name").alias("seller_state"),
        )
    )


def role_tables(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Canonical tables from the raw test tables (all lazy)."""
    return {
        "orders": orders_view(raw["orders"]),
        "payments": payments_view(raw["lineitem"]),
        "customers": customers_view(raw["customer"], raw["nation"]),
        "reviews": reviews_view(raw["orders"]),
        "items": items_view(raw["lineitem"]),
        "products": products_view(raw["part"]),
        "category_translation": category_translation_view(raw["part"]),
        "sellers": sellers_view(raw["supplier"], raw["nation"], raw["region"]),
    }


def load_role_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return role_tables(load_parquet_tables(spark, sf_dir, RAW_TABLES))
