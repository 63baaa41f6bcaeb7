"""Customer value, satisfaction and RFM queries."""

from __future__ import annotations

from mercato.functions import sketches as sk
from mercato.functions.common import reuse_checkpointed
from mercato.operators import customers as cu
from mercato.operators.fact import sales_fact
from mercato.plans.catalog import R, register, tables


def _fact(spark, d):
    return sales_fact(tables(spark, d))


_CV = """cv AS (
  SELECT customer_unique_id, CAST(sum(payment_value) AS DOUBLE) AS total_spent, count(order_id) AS order_count
  FROM fact_r WHERE customer_unique_id IS NOT NULL GROUP BY customer_unique_id
)"""

_SEG = f"""WITH {_CV},
e AS (SELECT quantile_cont(total_spent, [0.0, 0.25, 0.5, 0.75, 1.0]) AS q FROM cv),
seg AS (
  SELECT cv.*, CAST(1 + CAST(total_spent > q[2] AS INTEGER) + CAST(total_spent > q[3] AS INTEGER)
                      + CAST(total_spent > q[4] AS INTEGER) AS INTEGER) AS segment_rank
  FROM cv, e
),
segs AS (
  SELECT *, ['Low', 'Medium', 'High', 'VIP'][segment_rank] AS value_segment FROM seg
)"""


@register("customer_value", f"WITH {_CV} SELECT * FROM cv")
def q_customer_value(spark, d):
    return cu.customer_value(_fact(spark, d))


@register("customer_value_segments", _SEG + "\nSELECT * FROM segs")
def q_customer_value_segments(spark, d):
    return cu.customer_value_segments(_fact(spark, d))


@register("customer_value_segments_approx")
def q_customer_value_segments_approx(spark, d):
    """The segments' edges from a sketch, with the exact rank error of each and its stated bound."""
    return sk.edge_errors(reuse_checkpointed(cu.customer_value(_fact(spark, d))), "total_spent", [i / 4 for i in range(5)])


@register(
    "value_segment_describe",
    _SEG
    + f"""
    SELECT segment_rank, value_segment, count(total_spent) AS count,
           {R('avg(total_spent)', 4)} AS mean, {R('stddev_samp(total_spent)', 4)} AS std,
           {R('min(total_spent)')} AS min,
           {R('quantile_cont(total_spent, 0.25)', 4)} AS p25,
           {R('quantile_cont(total_spent, 0.5)', 4)} AS p50,
           {R('quantile_cont(total_spent, 0.75)', 4)} AS p75,
           {R('max(total_spent)')} AS max
    FROM segs GROUP BY segment_rank, value_segment
    """,
)
def q_value_segment_describe(spark, d):
    return cu.value_segment_describe(cu.customer_value_segments(_fact(spark, d)))


@register(
    "value_segment_counts",
    _SEG + "\nSELECT segment_rank, value_segment, count(*) AS customers FROM segs GROUP BY 1, 2",
)
def q_value_segment_counts(spark, d):
    return cu.value_segment_counts(cu.customer_value_segments(_fact(spark, d)))


@register(
    "customer_value_median",
    f"WITH {_CV} SELECT count(*) AS customers, {R('quantile_cont(total_spent, 0.5)', 4)} AS median_total_spent FROM cv",
)
def q_customer_value_median(spark, d):
    return cu.customer_value_median(_fact(spark, d))


@register(
    "spend_histogram",
    f"""
    WITH {_CV},
    mm AS (SELECT min(total_spent) AS lo, max(total_spent) AS hi FROM cv),
    b AS (
      SELECT CASE WHEN hi - lo = 0 THEN 1
                  ELSE least(CAST(floor((total_spent - lo) / (hi - lo) * 50) AS INTEGER) + 1, 50) END AS bin
      FROM cv, mm
    ),
    c AS (SELECT bin, count(*) AS customers FROM b GROUP BY bin),
    g AS (SELECT CAST(range AS INTEGER) AS bin FROM range(1, 51))
    SELECT g.bin, {R('lo + (g.bin - 1) * (hi - lo) / 50')} AS bin_start,
           {R('lo + g.bin * (hi - lo) / 50')} AS bin_end,
           CAST(coalesce(c.customers, 0) AS BIGINT) AS customers
    FROM g CROSS JOIN mm LEFT JOIN c ON c.bin = g.bin
    """,
)
def q_spend_histogram(spark, d):
    return cu.spend_histogram(_fact(spark, d))


_SAT = """sat AS (
  SELECT customer_unique_id, sum(s) / CAST(sum(c) AS DOUBLE) AS review_score, count(*) AS num_orders
  FROM (SELECT customer_unique_id, order_id, sum(review_score) AS s, count(review_score) AS c
        FROM fact_r WHERE customer_unique_id IS NOT NULL GROUP BY 1, 2)
  GROUP BY customer_unique_id
  HAVING sum(c) > 0
)"""


@register(
    "repeat_customers",
    f"WITH {_SAT} SELECT customer_unique_id, {R('review_score', 6)} AS review_score, num_orders FROM sat WHERE num_orders > 1",
)
def q_repeat_customers(spark, d):
    return cu.repeat_customers(_fact(spark, d))


@register(
    "satisfaction_correlation",
    f"""
    WITH {_SAT}, rc AS (SELECT * FROM sat WHERE num_orders > 1)
    SELECT {R("CASE WHEN isnan(corr(review_score, CAST(num_orders AS DOUBLE))) THEN NULL ELSE corr(review_score, CAST(num_orders AS DOUBLE)) END", 6)} AS correlation,
           count(*) AS repeat_customers
    FROM rc
    """,
)
def q_satisfaction_correlation(spark, d):
    return cu.satisfaction_correlation(_fact(spark, d))


def _rfm_sql(freq: str) -> str:
    f = "count(DISTINCT order_id)" if freq == "orders" else "count(order_id)"
    return f"""WITH
base0 AS (
  SELECT customer_unique_id, max(order_purchase_timestamp) AS last_ts, {f} AS frequency,
         CAST(sum(payment_value) AS DOUBLE) AS monetary
  FROM fact_r WHERE customer_unique_id IS NOT NULL GROUP BY customer_unique_id
),
snap AS (SELECT max(order_purchase_timestamp) + INTERVAL 1 DAY AS s FROM fact_r),
base AS (
  SELECT customer_unique_id,
         CAST(floor((epoch_us(s) - epoch_us(last_ts)) / 86400000000.0) AS BIGINT) AS recency,
         CAST(frequency AS BIGINT) AS frequency, monetary
  FROM base0, snap
),
edges AS (
  SELECT quantile_cont(CAST(recency AS DOUBLE), [0.0, 0.2, 0.4, 0.6, 0.8, 1.0]) AS re,
         quantile_cont(monetary, [0.0, 0.2, 0.4, 0.6, 0.8, 1.0]) AS me, count(*) AS n
  FROM base
),
ranked AS (SELECT *, row_number() OVER (ORDER BY frequency, customer_unique_id) AS rk FROM base),
scored0 AS (
  SELECT customer_unique_id, recency, frequency, monetary,
         CAST(6 - (1 + CAST(recency > re[2] AS INTEGER) + CAST(recency > re[3] AS INTEGER)
                     + CAST(recency > re[4] AS INTEGER) + CAST(recency > re[5] AS INTEGER)) AS INTEGER) AS r_score,
         CAST(greatest(1, ceil((rk - 1) * 5.0 / (n - 1))) AS INTEGER) AS f_score,
         CAST(1 + CAST(monetary > me[2] AS INTEGER) + CAST(monetary > me[3] AS INTEGER)
                + CAST(monetary > me[4] AS INTEGER) + CAST(monetary > me[5] AS INTEGER) AS INTEGER) AS m_score
  FROM ranked, edges
),
scored AS (
  SELECT *, r_score + f_score + m_score AS rfm_score,
         CASE WHEN r_score + f_score + m_score >= 13 THEN 'Champion'
              WHEN r_score + f_score + m_score >= 10 THEN 'Loyal'
              WHEN r_score + f_score + m_score >= 7 THEN 'At Risk'
              ELSE 'Lost' END AS segment
  FROM scored0
)"""


_SEGMENTS_BODY = f"""
SELECT segment, count(recency) AS customers,
       {R('avg(recency)')} AS avg_recency, {R('avg(frequency)')} AS avg_frequency,
       {R('avg(monetary)')} AS avg_monetary
FROM scored GROUP BY segment
"""


@register("rfm_base", _rfm_sql("orders") + "\nSELECT * FROM base")
def q_rfm_base(spark, d):
    return cu.rfm_base(_fact(spark, d), frequency="orders")


@register("rfm_base_rows", _rfm_sql("rows") + "\nSELECT * FROM base")
def q_rfm_base_rows(spark, d):
    return cu.rfm_base(_fact(spark, d), frequency="rows")


@register("rfm_scored", _rfm_sql("orders") + "\nSELECT * FROM scored")
def q_rfm_scored(spark, d):
    return cu.rfm_scored(cu.rfm_base(_fact(spark, d)))


@register("rfm_scored_rows", _rfm_sql("rows") + "\nSELECT * FROM scored")
def q_rfm_scored_rows(spark, d):
    return cu.rfm_scored(cu.rfm_base(_fact(spark, d), frequency="rows"))


@register("rfm_segments", _rfm_sql("orders") + _SEGMENTS_BODY)
def q_rfm_segments(spark, d):
    """Published mart: distinct-order frequency."""
    return cu.rfm_segments(cu.rfm_scored(cu.rfm_base(_fact(spark, d))))


@register("rfm_segments_rows", _rfm_sql("rows") + _SEGMENTS_BODY)
def q_rfm_segments_rows(spark, d):
    """Analysis variant: fan-out row frequency."""
    return cu.rfm_segments(cu.rfm_scored(cu.rfm_base(_fact(spark, d), frequency="rows")))


@register(
    "rfm_spend_by_segment",
    _rfm_sql("rows") + f"\nSELECT segment, {R('avg(monetary)')} AS avg_monetary FROM scored GROUP BY segment",
)
def q_rfm_spend_by_segment(spark, d):
    return cu.rfm_spend_by_segment(cu.rfm_scored(cu.rfm_base(_fact(spark, d), frequency="rows")))


@register(
    "segment_lift",
    _rfm_sql("orders")
    + f"""
    SELECT segment, count(*) AS customers, {R('avg(monetary)')} AS avg_monetary,
           {R('avg(monetary) / (SELECT avg(monetary) FROM scored)', 4)} AS lift
    FROM scored GROUP BY segment
    """,
)
def q_segment_lift(spark, d):
    return cu.segment_lift(cu.rfm_scored(cu.rfm_base(_fact(spark, d))))
