"""The driver contract: every registered query has oracle SQL unless it is a model fit or a sketch."""

from __future__ import annotations

ROWS_ONLY = {
    "delay_model",
    "delay_feature_importance",
    "review_model",
    "review_predictions",
    "review_feature_importance",
    "customer_clusters",
    "cluster_profile",
    "cluster_sizes",
    "model_metrics",
}
# Edges of a randomised sketch: tests/test_gates_and_inference.py holds them to their bound.
SKETCHES = {"customer_value_segments_approx"}


def test_every_query_has_oracle_or_is_a_model(queries, oracles):
    from mercato.plans.catalog import all_oracles, all_queries

    assert set(oracles) <= set(queries)
    assert set(all_queries()) - set(all_oracles()) == ROWS_ONLY | SKETCHES


def test_oracle_sql_is_plain_duckdb(oracles, duck_small):
    # Every oracle parses and plans in DuckDB (EXPLAIN does not run it).
    for name, sql in oracles.items():
        duck_small.execute("EXPLAIN " + sql)
