"""Null persons and statuses, counts beyond 64-bit products, the schema gate, plan shapes."""

from __future__ import annotations

from decimal import Decimal

from conftest import SF_SMALL
from mercato.functions.binning import qcut
from mercato.operators import evaluation as ev
from mercato.operators import features as fe
from mercato.operators import marts
from mercato.operators import quality as dq


def test_null_persons_have_no_repeat_rate(spark):
    sales = spark.createDataFrame(
        [(1, 10, Decimal("1.00")), (1, 11, Decimal("2.00")), (None, 12, Decimal("4.00"))],
        "customer_unique_id long, order_id long, payment_value decimal(28,2)",
    )
    r = marts.executive_summary(sales).first()
    assert (r.total_revenue, r.total_orders, r.repeat_customer_rate_pct) == (7.0, 3, 100.0)
    k = marts.kpi_summary(sales).first()
    assert (k.total_orders, k.total_customers) == (3, 1)


def test_null_status_is_not_delivered(spark):
    orders = spark.createDataFrame([("delivered",), (None,), ("shipped",)], "order_status string")
    assert marts.delivered_rate(orders).first().delivered_rate == 33.33


def test_auc_of_billions_per_threshold(spark, monkeypatch):
    n = 3_000_000_000
    counts = spark.createDataFrame([(0.1, 0, n), (0.5, n, n), (0.9, n, 0)], "threshold double, pos long, neg long")
    monkeypatch.setattr(ev, "_score_counts", lambda *_: counts)
    r = ev.roc_auc(counts).first()
    assert r.roc_auc == 0.875 and r.positives == r.negatives == 2 * n


def test_class_weights_are_not_rounded(spark):
    t = spark.createDataFrame([(0,)] * 7 + [(1,)] * 3, "label int")
    assert {r.label: r.weight for r in fe.class_weights(t, "label").collect()} == {0: 10 / 14, 1: 10 / 6}


def test_schema_report_finds_missing_and_mistyped(spark):
    orders = spark.createDataFrame([("o1", "c1", "yesterday"), ("o2", "c2", None)], "order_id string, customer_id string, order_purchase_timestamp string")
    by = {r.column_name: r for r in dq.schema_report({"orders": orders}).collect()}
    assert by["order_id"].type_ok and by["order_id"].rows == 2
    assert not by["order_status"].present and not by["order_status"].type_ok
    assert by["order_purchase_timestamp"].misfits == 1 and not by["order_purchase_timestamp"].type_ok


def _executed(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_marts_expand_nothing(spark, queries):
    for name in ("kpi_summary", "revenue_by_state", "kpi_banner"):
        assert "Expand" not in _executed(queries[name](spark, SF_SMALL)), name


def test_qcut_ranks_with_one_range_exchange(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.range(1000).selectExpr("id", "cast(id * 7 % 1001 as double) as x")
        plan = _executed(qcut(df, "x", 4, "b", tiebreak=["id"]))
        # The written copy is read back; offsets and wanted ranks are broadcast, no ranked row is shuffled again.
        assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
