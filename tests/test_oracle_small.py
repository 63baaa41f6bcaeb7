"""Spark results equal the DuckDB oracle SQL on sf0.001 (a fast subset of the gate)."""

from __future__ import annotations

import math

import pytest

from conftest import SF_SMALL

NAMES = [
    "sales_fact",
    "monthly_revenue",
    "kpi_summary",
    "revenue_by_city",
    "top_categories",
    "top_sellers",
    "delivery_performance",
    "customer_value_segments",
    "value_segment_describe",
    "spend_histogram",
    "satisfaction_correlation",
    "rfm_scored",
    "rfm_segments_rows",
    "cohort_retention",
    "cohort_matrix",
    "revenue_by_state",
    "executive_summary",
    "kpi_banner",
    "delivered_rate",
    "sql_monthly_revenue",
    "stream_monthly_revenue",
    "dq_schema",
    "class_weights",
    "cohort_retention_corner",
    "order_features",
    "roc_curve",
    "roc_auc",
    "silhouette",
    "segment_names",
    "segment_profile",
    "segment_sizes",
    "segment_filter",
    "train_test_split_balance",
    "dq_nulls",
]


def _rows(pdf):
    cols = sorted(pdf.columns)
    out = []
    for rec in pdf[cols].itertuples(index=False, name=None):
        norm = []
        for v in rec:
            if hasattr(v, "item"):
                v = v.item()
            if isinstance(v, float) and math.isnan(v):
                v = None
            norm.append(v)
        out.append(tuple(norm))
    return cols, sorted(out, key=repr)


@pytest.mark.parametrize("name", NAMES)
def test_matches_oracle(spark, queries, oracles, duck_small, name):
    got_cols, got = _rows(queries[name](spark, SF_SMALL).toPandas())
    want_cols, want = _rows(duck_small.execute(oracles[name]).df())
    assert got_cols == want_cols
    assert len(got) == len(want)
    assert got == want
