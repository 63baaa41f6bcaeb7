"""Hand-made frames for the semantics that must match pandas."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from mercato.functions.common import money_sum_0
from mercato.functions.timefx import floor_days, month_index, month_index_from_text, weekday_monday0
from mercato.operators.customers import safe_corr
from mercato.operators.fact import sales_fact


def _ts(s):
    return dt.datetime.fromisoformat(s)


def test_floor_days(spark):
    rows = [
        (_ts("2020-01-01 23:00"), _ts("2020-01-02 08:00"), 0),  # 9 h later: 0 days (datediff says 1)
        (_ts("2020-01-02 23:00"), _ts("2020-01-02 01:00"), -1),  # 22 h earlier: -1
        (_ts("2020-01-04 00:00"), _ts("2020-01-01 02:00"), -3),  # -70 h floors to -3 (truncation: -2)
        (_ts("2020-01-01 00:00"), _ts("2020-01-03 00:00"), 2),
    ]
    df = spark.createDataFrame(rows, "a timestamp_ntz, b timestamp_ntz, want int")
    got = df.select(floor_days("b", "a").alias("d"), "want").collect()
    assert [r.d for r in got] == [r.want for r in got]


def test_weekday_and_month_ordinal(spark):
    df = spark.createDataFrame([(_ts("2024-01-01 10:00"), "2017-01", "2018-03")], "t timestamp_ntz, a string, b string")
    r = df.select(
        weekday_monday0("t").alias("wd"),
        (month_index_from_text("b") - month_index_from_text("a")).alias("dist"),
        month_index("t").alias("mi"),
    ).first()
    assert r.wd == 0  # Monday
    assert r.dist == 14
    assert r.mi == 2024 * 12


def test_round_half_up(spark):
    r = spark.range(1).select(F.round(F.lit(0.125), 2).alias("x"), F.bround(F.lit(0.125), 2).alias("y")).first()
    assert r.x == 0.13 and r.y == 0.12


def test_all_null_sum_is_zero_and_null_groups(spark):
    df = spark.createDataFrame([("a", None), ("a", None), (None, Decimal("1.00"))], "k string, v decimal(18,2)")
    got = df.where(F.col("k").isNotNull()).groupBy("k").agg(money_sum_0("v").alias("s")).collect()
    assert [(r.k, r.s) for r in got] == [("a", 0.0)]


def test_constant_column_correlation_is_null(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0), (1.0, 4.0)], "x double, y double")
    assert df.agg(safe_corr(F.col("x"), F.col("y")).alias("c")).first().c is None


def test_fanout_two_payments_two_reviews(spark):
    t = dict(
        orders=spark.createDataFrame(
            [(1, 10, "delivered", _ts("2020-01-05 10:00"), None, _ts("2020-01-20 00:00"))],
            "order_id long, customer_id long, order_status string, order_purchase_timestamp timestamp_ntz, "
            "order_delivered_customer_date timestamp_ntz, order_estimated_delivery_date timestamp_ntz",
        ),
        payments=spark.createDataFrame(
            [(1, 1, "credit_card", 1, 10.0), (1, 2, "voucher", 1, 5.0)],
            "order_id long, payment_sequential int, payment_type string, payment_installments int, payment_value double",
        ).withColumn("payment_value", F.col("payment_value").cast("decimal(18,2)")),
        customers=spark.createDataFrame([(10, 100, "c", "s")], "customer_id long, customer_unique_id long, customer_city string, customer_state string"),
        reviews=spark.createDataFrame([(1, 1, 5), (2, 1, 3)], "review_id long, order_id long, review_score int"),
    )
    fact = sales_fact(t)
    assert fact.count() == 4
    assert fact.agg(F.sum("payment_value")).first()[0] == 30  # payments counted once per review
    order_grain = sales_fact(t, grain="order")
    assert order_grain.count() == 1
    assert order_grain.first().payment_value == 15


def test_qcut_duplicate_edges_raise(spark):
    from mercato.functions.binning import qcut

    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate([1, 1, 1, 1, 1, 1, 2])], "id long, x double")
    with pytest.raises(Exception, match="Bin edges must be unique"):
        qcut(df, "x", 5, "b", tiebreak=["id"]).collect()
    # duplicates="drop" collapses the repeated edges like pandas
    got = qcut(df, "x", 5, "b", tiebreak=["id"], duplicates="drop").orderBy("id").select("b").collect()
    import pandas as pd

    want = pd.qcut(pd.Series([1, 1, 1, 1, 1, 1, 2], dtype=float), 5, labels=False, duplicates="drop") + 1
    assert [r.b for r in got] == list(want)


def test_approx_distinct_option(spark):
    from mercato.operators import marts
    from mercato.plans.catalog import tables

    from conftest import SF_SMALL

    fact = sales_fact(tables(spark, SF_SMALL))
    exact = {r.payment_type: r.orders for r in marts.payment_methods(fact).collect()}
    approx = {r.payment_type: r.orders for r in marts.payment_methods(fact, approx=True).collect()}
    assert exact.keys() == approx.keys()
    for k, v in exact.items():
        assert abs(approx[k] - v) <= max(3, 0.05 * v)
