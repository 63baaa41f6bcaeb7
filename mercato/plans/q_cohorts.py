"""Cohort retention queries."""

from __future__ import annotations

from mercato.operators import cohort as co
from mercato.operators.fact import sales_by_order
from mercato.plans.catalog import R, register, tables

_COHORT = f"""WITH
cm AS (
  SELECT DISTINCT customer_unique_id, order_month FROM fact_r
  WHERE customer_unique_id IS NOT NULL AND order_month IS NOT NULL
),
ca AS (SELECT customer_unique_id, order_month, min(order_month) OVER (PARTITION BY customer_unique_id) AS cohort FROM cm),
cp AS (
  SELECT *, CAST((CAST(substr(order_month, 1, 4) AS INTEGER) * 12 + CAST(substr(order_month, 6, 2) AS INTEGER))
               - (CAST(substr(cohort, 1, 4) AS INTEGER) * 12 + CAST(substr(cohort, 6, 2) AS INTEGER)) AS INTEGER) AS period
  FROM ca
),
cc AS (SELECT cohort, period, count(*) AS customers FROM cp GROUP BY cohort, period),
cr AS (
  SELECT cohort, period, customers,
         {R('CAST(customers AS DOUBLE) / CAST(max(CASE WHEN period = 0 THEN customers END) OVER (PARTITION BY cohort) AS DOUBLE) * 100')} AS retention_pct
  FROM cc
)"""


def _assign(spark, d):
    # Cohorts read distinct (person, month) pairs: one row per order is enough, reviews cannot change them.
    return co.cohort_assignment(sales_by_order(tables(spark, d), with_reviews=False))


@register("cohort_assignment", _COHORT + "\nSELECT * FROM cp")
def q_cohort_assignment(spark, d):
    return _assign(spark, d)


@register("cohort_counts", _COHORT + "\nSELECT * FROM cc")
def q_cohort_counts(spark, d):
    return co.cohort_counts(_assign(spark, d))


@register("cohort_retention", _COHORT + "\nSELECT * FROM cr")
def q_cohort_retention(spark, d):
    return co.cohort_retention(co.cohort_counts(_assign(spark, d)))


@register(
    "cohort_retention_corner",
    _COHORT
    + """,
c6 AS (SELECT cohort FROM (SELECT DISTINCT cohort FROM cr) ORDER BY cohort LIMIT 6),
p6 AS (SELECT period FROM (SELECT DISTINCT period FROM cr) ORDER BY period LIMIT 6)
SELECT c6.cohort, p6.period, cr.retention_pct
FROM c6 CROSS JOIN p6 LEFT JOIN cr ON cr.cohort = c6.cohort AND cr.period = p6.period
""",
)
def q_cohort_retention_corner(spark, d):
    return co.cohort_retention_corner(co.cohort_retention(co.cohort_counts(_assign(spark, d))))


@register(
    "cohort_matrix",
    _COHORT
    + """
, g AS (SELECT c.cohort, CAST(p.period AS INTEGER) AS period
        FROM (SELECT DISTINCT cohort FROM cc) c, (SELECT unnest(range(0, (SELECT max(period) FROM cc) + 1)) AS period) p)
SELECT g.cohort, g.period, CAST(cc.customers AS DOUBLE) AS customers FROM g LEFT JOIN cc ON cc.cohort = g.cohort AND cc.period = g.period
""",
)
def q_cohort_matrix(spark, d):
    """The cohort x period matrix as dense rows, one per cell (a missing cell is null)."""
    return co.cohort_cells(co.cohort_counts(_assign(spark, d)))
