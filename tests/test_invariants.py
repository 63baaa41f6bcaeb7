"""Invariants visible in the reference's published marts, on sf0.001."""

from __future__ import annotations

import pytest

from conftest import SF_SMALL


@pytest.fixture(scope="module")
def r(spark, queries):
    def run(name):
        return queries[name](spark, SF_SMALL).toPandas()

    return run


def test_revenue_totals_agree(r):
    kpi = r("kpi_summary").iloc[0]
    for name, col in [("monthly_revenue", "revenue"), ("revenue_by_state", "revenue"), ("payment_methods", "total_revenue")]:
        assert r(name)[col].sum() == pytest.approx(kpi.total_revenue, abs=0.01 * 100)
    assert kpi.avg_order_value == pytest.approx(round(kpi.total_revenue / kpi.total_orders, 2), abs=0.01)


def test_order_and_customer_counts(r):
    kpi = r("kpi_summary").iloc[0]
    states = r("revenue_by_state")
    assert states.orders.sum() == kpi.total_orders  # an order has one customer row
    assert states.customers.sum() >= kpi.total_customers  # persons in several states
    assert r("payment_methods").orders.sum() >= kpi.total_orders
    status = r("order_status")
    fanout = r("dq_join_fanout").iloc[0]
    assert status.order_count.sum() == fanout.orders
    assert fanout.orders >= kpi.total_orders


def test_delivery_rates(r):
    d = r("delivery_performance").iloc[0]
    assert d.on_time_rate_pct + d.late_rate_pct == pytest.approx(100, abs=0.011)
    delivered = r("order_status").set_index("order_status").order_count["delivered"]
    assert d.orders_analyzed <= delivered


def test_rfm_and_cohorts(r):
    kpi = r("kpi_summary").iloc[0]
    assert r("rfm_segments").customers.sum() == kpi.total_customers
    ret = r("cohort_retention")
    assert (ret[ret.period == 0].retention_pct == 100).all()
    assert r("value_segment_counts").customers.sum() == kpi.total_customers


def test_entry_smoke(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["segment", "customers", "avg_recency", "avg_frequency", "avg_monetary"]
