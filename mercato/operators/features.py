"""Order-level feature table and model inputs (delay and review models).

All side tables are reduced to one row per ``order_id`` before they meet
the orders, so no join fans out.  The four ``order_id``-keyed inputs share
one hash partitioning (landed tables are bucketed by ``order_id``, so their
roll-ups and joins need no exchange at all; others are shuffled once, reduced
before it, with the columns in use); only the product and customer
lookups shuffle on their own keys (or are broadcast by AQE when their
measured size is small).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.functions.common import reuse_checkpointed
from mercato.functions.ranking import rank_rows
from mercato.functions.timefx import floor_days, weekday_monday0

# Model feature lists of the reference (fixed values).
DELAY_FEATURES = [
    "price", "freight_value", "n_items", "product_weight_g",
    "product_length_cm", "product_height_cm", "product_width_cm",
    "payment_installments", "estimated_delivery_days",
    "purchase_month", "purchase_dayofweek",
]
REVIEW_FEATURES = [
    "price", "freight_value", "n_items", "payment_installments",
    "payment_value", "actual_delivery_days", "estimated_delivery_days",
    "is_late",
]
# Columns of the feature table that the RFM roll-up reads, besides the key.
PERSON_COLUMNS = ["customer_unique_id", "order_purchase_timestamp", "payment_value"]
# Tables of the feature table.
FEATURE_TABLES = ["orders", "items", "payments", "reviews", "products", "customers"]
SPLIT_SEED = 42
TEST_PERCENT = 20


def order_item_rollup(items: DataFrame) -> DataFrame:
    """Per order: item price and freight sums, item count, first product.

    "First" is the product of the lowest ``order_item_id`` among rows with a
    product (ties by product id) - a deterministic stand-in for file order.
    """
    pid = F.col("product_id")
    return items.groupBy("order_id").agg(
        F.sum("price").cast("double").alias("price"),
        F.sum("freight_value").cast("double").alias("freight_value"),
        F.count("order_item_id").alias("n_items"),
        F.min(F.when(pid.isNotNull(), F.struct("order_item_id", "product_id")))["product_id"].alias("product_id"),
    )


def order_payment_rollup(payments: DataFrame) -> DataFrame:
    return payments.groupBy("order_id").agg(
        F.sum("payment_value").cast("double").alias("payment_value"),
        F.max("payment_installments").alias("payment_installments"),
    )


def reviews_deduped(reviews: DataFrame) -> DataFrame:
    """One review per order: the lowest review id (``drop_duplicates`` keeps the first)."""
    return reviews.groupBy("order_id").agg(
        F.min_by("review_score", "review_id").cast("double").alias("review_score")
    )


def delivered_order_features(orders: DataFrame) -> DataFrame:
    """Delivered orders with a delivery date, with delivery and calendar features."""
    d = orders.where(F.col("order_status") == "delivered").na.drop(subset=["order_delivered_customer_date"])
    purchase = F.col("order_purchase_timestamp")
    return d.select(
        "order_id",
        "customer_id",
        "order_purchase_timestamp",
        floor_days("order_delivered_customer_date", purchase).alias("actual_delivery_days"),
        floor_days("order_estimated_delivery_date", purchase).alias("estimated_delivery_days"),
        F.coalesce(
            F.col("order_delivered_customer_date") > F.col("order_estimated_delivery_date"), F.lit(False)
        ).cast("int").alias("is_late"),
        F.month(purchase).alias("purchase_month"),
        weekday_monday0(purchase).alias("purchase_dayofweek"),
    )


def order_features(tables: dict[str, DataFrame]) -> DataFrame:
    orders = delivered_order_features(tables["orders"])
    items = order_item_rollup(tables["items"])
    payments = order_payment_rollup(tables["payments"])
    reviews = reviews_deduped(tables["reviews"])
    products = tables["products"].select(
        "product_id", "product_weight_g", "product_length_cm", "product_height_cm",
        "product_width_cm", "product_category_name",
    )
    customers = tables["customers"].select("customer_id", "customer_unique_id", "customer_state")
    by_order = (
        orders.join(items, "order_id", "inner")
        .join(payments, "order_id", "inner")
        .join(reviews, "order_id", "left")
    )
    return by_order.join(products, "product_id", "left").join(customers, "customer_id", "left")


def complete_cases(features: DataFrame, columns: list[str], label: str) -> DataFrame:
    return features.na.drop(subset=[*columns, label]).select("order_id", *columns, label)


def delay_model_input(features: DataFrame) -> DataFrame:
    return complete_cases(features, DELAY_FEATURES, "is_late")


def review_model_input(features: DataFrame) -> DataFrame:
    return complete_cases(features, REVIEW_FEATURES, "review_score")


def split_bucket(key: str = "order_id", seed: int = SPLIT_SEED):
    """0..99 bucket from the first 32 bits of ``md5(key || '#seed')``.

    Stable under any repartitioning or recomputation (``randomSplit`` is
    not), and reproducible in SQL.
    """
    h = F.md5(F.concat(F.col(key).cast("string"), F.lit(f"#{seed}")))
    return (F.conv(F.substring(h, 1, 8), 16, 10).cast("bigint") % 100).cast("int")


def with_split(df: DataFrame, test_percent: int = TEST_PERCENT, seed: int = SPLIT_SEED) -> DataFrame:
    return df.withColumn("split", F.when(split_bucket(seed=seed) < test_percent, "test").otherwise("train"))


def with_stratified_split(df: DataFrame, label: str, key: str = "order_id", test_percent: int = TEST_PERCENT, seed: int = SPLIT_SEED) -> DataFrame:
    """Test side: the first ``test_percent`` % (rounded up) of every class by md5 of the key.

    Ranks come from the distributed ranker (the classes are few), so no class is sorted in one task.
    """
    h = F.md5(F.concat(F.col(key).cast("string"), F.lit(f"#{seed}")))
    ranked = rank_rows(df.withColumn("_h", h), ["_h", key], group=[label], bounded_groups=True)
    test = F.col("_rank") <= F.ceil(F.col("_n") * test_percent / 100)
    return ranked.withColumn("split", F.when(test, "test").otherwise("train")).drop("_h", "_rank", "_n")


def split_balance(df: DataFrame, label: str) -> DataFrame:
    """Rows per (split, label): the class balance of each side."""
    return with_stratified_split(df.select("order_id", label), label).groupBy("split", label).agg(F.count(F.lit(1)).alias("rows")).orderBy("split", label)


def class_weights(train: DataFrame, label: str) -> DataFrame:
    """``n / (k * n_c)`` per class (balanced weights, not rounded); k = number of classes."""
    counts = train.groupBy(label).agg(F.count(F.lit(1)).alias("rows"))
    n = F.sum("rows").over(_all())
    k = F.count(F.lit(1)).over(_all())
    return counts.select(label, "rows", (n / (k * F.col("rows"))).alias("weight")).orderBy(label)


def with_class_weights(train: DataFrame, label: str, weight_col: str = "weight") -> DataFrame:
    """Attach the balanced weight (class table: one row per class) to each row."""
    w = class_weights(train, label).select(label, F.col("weight").alias(weight_col))
    return train.join(F.broadcast(w), label, "inner")


def _all():
    from pyspark.sql import Window

    return Window.partitionBy()


def standardize(fit_df: DataFrame, apply_df: DataFrame, columns: list[str], suffix: str = "_z") -> DataFrame:
    """``(x - mean) / population std`` fitted on ``fit_df`` and applied to ``apply_df``.

    Population std (ddof 0) as in scikit-learn's scaler; MLlib's
    ``StandardScaler`` uses the sample std and does not centre by default.
    The fitted statistics are scalar subqueries (merged into one job).
    """
    out = apply_df
    for c in columns:
        mean = fit_df.select(F.avg(F.col(c).cast("double"))).scalar()
        std = fit_df.select(F.stddev_pop(F.col(c).cast("double"))).scalar()
        out = out.withColumn(
            c + suffix,
            F.when(std == 0, F.col(c).cast("double") - mean).otherwise((F.col(c).cast("double") - mean) / std),
        )
    return out


def customer_rfm_from_features(features: DataFrame) -> DataFrame:
    """Per person from delivered orders: recency, distinct orders, order-level spend."""
    per = features.groupBy("customer_unique_id").agg(
        F.max("order_purchase_timestamp").alias("_last"),
        F.countDistinct("order_id").alias("frequency"),
        F.sum("payment_value").alias("monetary"),
    )
    # Written once; the snapshot covers all feature rows (the null-person
    # group included), then the person groupby drops that group.
    per = reuse_checkpointed(per)
    snapshot = per.select(F.max("_last") + F.make_dt_interval(days=F.lit(1))).scalar()
    return per.where(F.col("customer_unique_id").isNotNull()).select(
        "customer_unique_id",
        floor_days(snapshot, F.col("_last")).alias("recency"),
        "frequency",
        "monetary",
    )
