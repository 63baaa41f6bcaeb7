"""Feature-table, split and fixed-scorer evaluation queries.

"Fixed scorer" queries evaluate plain rule columns (not a fitted model) so
the metric operators themselves get exact oracles:
* delay rule: predict late in the peak months 2, 3, 11; score adds the
  estimated days / 1000 to break ties;
* review rule: 2.5 stars for late orders, 4.0 otherwise.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from mercato.operators import evaluation as ev
from mercato.operators import features as fe
from mercato.operators import models as mo
from mercato.plans.catalog import R, register, tables

_FEATURES = """
ir AS (
  SELECT order_id, CAST(sum(price) AS DOUBLE) AS price, CAST(sum(freight_value) AS DOUBLE) AS freight_value,
         count(order_item_id) AS n_items,
         first(product_id ORDER BY order_item_id, product_id) FILTER (WHERE product_id IS NOT NULL) AS product_id
  FROM items_r GROUP BY order_id
),
pr AS (
  SELECT order_id, CAST(sum(payment_value) AS DOUBLE) AS payment_value, max(payment_installments) AS payment_installments
  FROM payments_r GROUP BY order_id
),
rd AS (SELECT order_id, CAST(arg_min(review_score, review_id) AS DOUBLE) AS review_score FROM reviews_r GROUP BY order_id),
dfo AS (
  SELECT order_id, customer_id, order_purchase_timestamp,
         CAST(floor((epoch_us(order_delivered_customer_date) - epoch_us(order_purchase_timestamp)) / 86400000000.0) AS BIGINT) AS actual_delivery_days,
         CAST(floor((epoch_us(order_estimated_delivery_date) - epoch_us(order_purchase_timestamp)) / 86400000000.0) AS BIGINT) AS estimated_delivery_days,
         CAST(coalesce(order_delivered_customer_date > order_estimated_delivery_date, false) AS INTEGER) AS is_late,
         CAST(month(order_purchase_timestamp) AS INTEGER) AS purchase_month,
         CAST(isodow(order_purchase_timestamp) - 1 AS INTEGER) AS purchase_dayofweek
  FROM orders_r WHERE order_status = 'delivered' AND order_delivered_customer_date IS NOT NULL
),
feat AS (
  SELECT dfo.*, ir.price, ir.freight_value, ir.n_items, ir.product_id,
         pr.payment_value, pr.payment_installments, rd.review_score,
         p.product_weight_g, p.product_length_cm, p.product_height_cm, p.product_width_cm, p.product_category_name,
         c.customer_unique_id, c.customer_state
  FROM dfo
  JOIN ir ON ir.order_id = dfo.order_id
  JOIN pr ON pr.order_id = dfo.order_id
  LEFT JOIN rd ON rd.order_id = dfo.order_id
  LEFT JOIN products_r p ON p.product_id = ir.product_id
  LEFT JOIN customers_r c ON c.customer_id = dfo.customer_id
),
"""

_DELAY_COLS = ", ".join(fe.DELAY_FEATURES)
_REVIEW_COLS = ", ".join(fe.REVIEW_FEATURES)
_SPLIT = "CASE WHEN CAST(('0x' || substr(md5(CAST(order_id AS VARCHAR) || '#42'), 1, 8)) AS BIGINT) % 100 < 20 THEN 'test' ELSE 'train' END"

_INPUTS = f"""
delay_in AS (
  SELECT order_id, {_DELAY_COLS}, is_late FROM feat
  WHERE {' AND '.join(c + ' IS NOT NULL' for c in fe.DELAY_FEATURES)} AND is_late IS NOT NULL
),
review_in AS (
  SELECT order_id, {_REVIEW_COLS}, review_score FROM feat
  WHERE {' AND '.join(c + ' IS NOT NULL' for c in fe.REVIEW_FEATURES)} AND review_score IS NOT NULL
),
delay_split AS (
  SELECT *, CASE WHEN row_number() OVER (PARTITION BY is_late ORDER BY md5(CAST(order_id AS VARCHAR) || '#42'), order_id)
                      <= ceil(count(*) OVER (PARTITION BY is_late) * 20 / 100.0) THEN 'test' ELSE 'train' END AS split
  FROM delay_in
),
delay_test AS (
  SELECT *, CAST(purchase_month IN (2, 3, 11) AS INTEGER) AS prediction,
         CAST(purchase_month IN (2, 3, 11) AS DOUBLE) + estimated_delivery_days / 1000.0 AS score
  FROM delay_split WHERE split = 'test'
),
review_test AS (
  SELECT *, CASE WHEN is_late = 1 THEN 2.5 ELSE 4.0 END AS prediction FROM review_in WHERE {_SPLIT} = 'test'
)"""


def W(body: str) -> str:
    return "WITH " + _FEATURES + _INPUTS.strip() + "\n" + body


def order_features_frame(spark, d):
    # Every table is reduced to one row per order and read once, so none is landed for it.
    return fe.order_features(tables(spark, d).at_hand(fe.FEATURE_TABLES))


def delay_test_scored(spark, d):
    # The split ranks and writes its rows: only the columns of the rule go through it.
    rows = fe.delay_model_input(order_features_frame(spark, d)).select("order_id", "purchase_month", "estimated_delivery_days", "is_late")
    x = fe.with_stratified_split(rows, "is_late").where(F.col("split") == "test")
    peak = F.col("purchase_month").isin(2, 3, 11)
    return x.withColumn("prediction", peak.cast("int")).withColumn(
        "score", peak.cast("double") + F.col("estimated_delivery_days") / 1000.0
    )


def review_test_scored(spark, d):
    x = fe.with_split(fe.review_model_input(order_features_frame(spark, d))).where(F.col("split") == "test")
    return x.withColumn("prediction", F.when(F.col("is_late") == 1, 2.5).otherwise(4.0))


@register("order_item_rollup", W("SELECT * FROM ir"))
def q_order_item_rollup(spark, d):
    return fe.order_item_rollup(tables(spark, d)["items"])


@register("order_payment_rollup", W("SELECT * FROM pr"))
def q_order_payment_rollup(spark, d):
    return fe.order_payment_rollup(tables(spark, d)["payments"])


@register("reviews_deduped", W("SELECT * FROM rd"))
def q_reviews_deduped(spark, d):
    return fe.reviews_deduped(tables(spark, d)["reviews"])


@register("order_features", W("SELECT * FROM feat"))
def q_order_features(spark, d):
    return order_features_frame(spark, d)


@register("delay_model_input", W("SELECT * FROM delay_in"))
def q_delay_model_input(spark, d):
    return fe.delay_model_input(order_features_frame(spark, d))


@register("review_model_input", W("SELECT * FROM review_in"))
def q_review_model_input(spark, d):
    return fe.review_model_input(order_features_frame(spark, d))


@register(
    "train_test_split_balance",
    W("SELECT split, is_late, count(*) AS rows FROM delay_split GROUP BY 1, 2"),
)
def q_split_balance(spark, d):
    return fe.split_balance(fe.delay_model_input(order_features_frame(spark, d)), "is_late")


@register(
    "class_weights",
    W(
        f"""
        , c AS (SELECT is_late, count(*) AS rows FROM delay_split WHERE split = 'train' GROUP BY is_late)
        SELECT is_late, rows,
               {R('CAST(sum(rows) OVER () AS DOUBLE) / CAST(count(*) OVER () * rows AS DOUBLE)', 6)} AS weight
        FROM c
        """
    ),
)
def q_class_weights(spark, d):
    rows = fe.delay_model_input(order_features_frame(spark, d)).select("order_id", "is_late")
    x = fe.with_stratified_split(rows, "is_late").where(F.col("split") == "train")
    return fe.class_weights(x, "is_late").withColumn("weight", F.round("weight", 6))


@register(
    "classification_metrics",
    W(
        """
        SELECT CAST(sum(CAST(is_late = prediction AS INTEGER)) AS DOUBLE) / count(*) AS accuracy,
               coalesce(CAST(sum(CAST(is_late = 1 AND prediction = 1 AS INTEGER)) AS DOUBLE)
                        / nullif(sum(prediction), 0), 0.0) AS precision,
               coalesce(CAST(sum(CAST(is_late = 1 AND prediction = 1 AS INTEGER)) AS DOUBLE)
                        / nullif(sum(is_late), 0), 0.0) AS recall,
               CAST(sum(CAST(is_late = 1 AND prediction = 1 AS INTEGER)) AS BIGINT) AS tp,
               CAST(sum(CAST(is_late = 0 AND prediction = 1 AS INTEGER)) AS BIGINT) AS fp,
               CAST(sum(CAST(is_late = 0 AND prediction = 0 AS INTEGER)) AS BIGINT) AS tn,
               CAST(sum(CAST(is_late = 1 AND prediction = 0 AS INTEGER)) AS BIGINT) AS fn
        FROM delay_test
        """
    ),
)
def q_classification_metrics(spark, d):
    return ev.classification_metrics(delay_test_scored(spark, d), "is_late", "prediction")


@register(
    "confusion_matrix",
    W(
        """
        SELECT is_late AS actual,
               CAST(count(*) FILTER (WHERE prediction = 0) AS BIGINT) AS predicted_0,
               CAST(count(*) FILTER (WHERE prediction = 1) AS BIGINT) AS predicted_1
        FROM delay_test GROUP BY is_late
        """
    ),
)
def q_confusion_matrix(spark, d):
    return ev.confusion_matrix(delay_test_scored(spark, d), "is_late", "prediction")


@register(
    "roc_curve",
    W(
        """
        , sc AS (
          SELECT score AS threshold, sum(is_late) AS pos, sum(1 - is_late) AS neg FROM delay_test GROUP BY score
        ), cum AS (
          SELECT threshold,
                 sum(pos) OVER (ORDER BY threshold DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cp,
                 sum(neg) OVER (ORDER BY threshold DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cn,
                 sum(pos) OVER () AS P, sum(neg) OVER () AS N
          FROM sc
        )
        SELECT CAST(NULL AS DOUBLE) AS threshold, 0.0 AS fpr, 0.0 AS tpr
        UNION ALL
        SELECT threshold, CAST(cn AS DOUBLE) / CAST(N AS DOUBLE), CAST(cp AS DOUBLE) / CAST(P AS DOUBLE) FROM cum
        """
    ),
)
def q_roc_curve(spark, d):
    return ev.roc_curve(delay_test_scored(spark, d), "is_late", "score")


@register(
    "roc_curve_thinned",
    W(
        """
        , sc AS (
          SELECT score AS threshold, sum(is_late) AS pos, sum(1 - is_late) AS neg FROM delay_test GROUP BY score
        ), cum AS (
          SELECT threshold, pos, neg,
                 sum(pos) OVER o AS cp, sum(neg) OVER o AS cn, sum(pos) OVER () AS P, sum(neg) OVER () AS N,
                 lag(threshold) OVER (ORDER BY threshold DESC) AS before,
                 lead(pos) OVER (ORDER BY threshold DESC) AS next_pos, lead(neg) OVER (ORDER BY threshold DESC) AS next_neg
          FROM sc WINDOW o AS (ORDER BY threshold DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
        )
        SELECT CAST(NULL AS DOUBLE) AS threshold, 0.0 AS fpr, 0.0 AS tpr
        UNION ALL
        SELECT threshold, CAST(cn AS DOUBLE) / CAST(N AS DOUBLE), CAST(cp AS DOUBLE) / CAST(P AS DOUBLE)
        FROM cum WHERE before IS NULL OR next_pos IS NULL OR next_pos <> pos OR next_neg <> neg
        """
    ),
)
def q_roc_curve_thinned(spark, d):
    """The curve without the inner points on a straight line, scikit-learn's default."""
    return ev.roc_curve(delay_test_scored(spark, d), "is_late", "score", drop_intermediate=True)


@register(
    "roc_auc",
    W(
        """
        , sc AS (SELECT score, sum(is_late) AS pos, sum(1 - is_late) AS neg FROM delay_test GROUP BY score),
        cum AS (SELECT *, sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS below FROM sc)
        SELECT CAST(sum(2 * pos * coalesce(below, 0) + pos * neg) AS DOUBLE) / CAST(2 * sum(pos) * sum(neg) AS DOUBLE) AS roc_auc,
               CAST(sum(pos) AS BIGINT) AS positives, CAST(sum(neg) AS BIGINT) AS negatives
        FROM cum
        """
    ),
)
def q_roc_auc(spark, d):
    return ev.roc_auc(delay_test_scored(spark, d), "is_late", "score")


@register(
    "regression_metrics",
    W(
        f"""
        SELECT {R('1 - sum((review_score - prediction) * (review_score - prediction)) / (sum(review_score * review_score) - sum(review_score) * sum(review_score) / count(*))', 6)} AS r2,
               {R('sqrt(sum((review_score - prediction) * (review_score - prediction)) / count(*))', 6)} AS rmse,
               {R('avg(abs(review_score - prediction))', 6)} AS mae,
               count(*) AS rows
        FROM review_test
        """
    ),
)
def q_regression_metrics(spark, d):
    m = ev.regression_metrics(review_test_scored(spark, d), "review_score", "prediction")
    return m.select(*[F.round(c, 6).alias(c) for c in ("r2", "rmse", "mae")], "rows")


_RFM_F = """
, rf AS (
  SELECT customer_unique_id,
         CAST(floor((epoch_us((SELECT max(order_purchase_timestamp) + INTERVAL 1 DAY FROM feat)) - epoch_us(max(order_purchase_timestamp))) / 86400000000.0) AS BIGINT) AS recency,
         count(DISTINCT order_id) AS frequency, sum(payment_value) AS monetary
  FROM feat WHERE customer_unique_id IS NOT NULL GROUP BY customer_unique_id
), z AS (
  SELECT *,
         CASE WHEN stddev_pop(recency) OVER () = 0 THEN recency - avg(recency) OVER ()
              ELSE (recency - avg(recency) OVER ()) / stddev_pop(recency) OVER () END AS recency_z,
         CASE WHEN stddev_pop(frequency) OVER () = 0 THEN frequency - avg(frequency) OVER ()
              ELSE (frequency - avg(frequency) OVER ()) / stddev_pop(frequency) OVER () END AS frequency_z,
         CASE WHEN stddev_pop(monetary) OVER () = 0 THEN monetary - avg(monetary) OVER ()
              ELSE (monetary - avg(monetary) OVER ()) / stddev_pop(monetary) OVER () END AS monetary_z
  FROM rf
)"""


def rfm_scaled_frame(spark, d, features=None):
    rfm = fe.customer_rfm_from_features(order_features_frame(spark, d) if features is None else features)
    return fe.standardize(rfm, rfm, ["recency", "frequency", "monetary"])


@register(
    "rfm_scaled",
    W(
        _RFM_F
        + f"""
        SELECT customer_unique_id, recency, frequency, {R('monetary')} AS monetary,
               {R('recency_z', 6)} AS recency_z, {R('frequency_z', 6)} AS frequency_z, {R('monetary_z', 6)} AS monetary_z
        FROM z
        """
    ),
)
def q_rfm_scaled(spark, d):
    z = rfm_scaled_frame(spark, d)
    return z.select(
        "customer_unique_id", "recency", "frequency", F.round("monetary", 2).alias("monetary"),
        *[F.round(c, 6).alias(c) for c in ("recency_z", "frequency_z", "monetary_z")],
    )


def _fixed_cluster():
    return (F.col("recency") > 180).cast("int") * 2 + (F.col("frequency") > 7).cast("int")


@register(
    "silhouette",
    W(
        _RFM_F
        + f"""
        , pts AS (
          SELECT row_number() OVER () AS pt,
                 CAST(recency > 180 AS INTEGER) * 2 + CAST(frequency > 7 AS INTEGER) AS c,
                 recency_z AS x0, frequency_z AS x1, monetary_z AS x2,
                 recency_z * recency_z + frequency_z * frequency_z + monetary_z * monetary_z AS sq
          FROM z
        ), st AS (
          SELECT c AS oc, count(*) AS cn, avg(sq) AS csq, avg(x0) AS m0, avg(x1) AS m1, avg(x2) AS m2 FROM pts GROUP BY c
        ), dd AS (
          SELECT pt, c, oc, cn, sq - 2 * (x0 * m0 + x1 * m1 + x2 * m2) + csq AS d FROM pts, st
        ), per AS (
          SELECT pt, max(CASE WHEN oc = c THEN cn END) AS n, max(CASE WHEN oc = c THEN d END) AS a0,
                 min(CASE WHEN oc <> c THEN d END) AS b
          FROM dd GROUP BY pt
        ), s AS (
          SELECT CASE WHEN n <= 1 THEN 0.0 WHEN b IS NULL THEN 0.0
                      WHEN a0 * n / (n - 1) < b THEN 1 - (a0 * n / (n - 1)) / b
                      WHEN a0 * n / (n - 1) > b THEN b / (a0 * n / (n - 1)) - 1 ELSE 0.0 END AS s
          FROM per
        )
        SELECT {R('avg(s)', 6)} AS silhouette_sq_euclidean, count(*) AS points FROM s
        """
    ),
)
def q_silhouette(spark, d):
    z = rfm_scaled_frame(spark, d).withColumn("cluster", _fixed_cluster())
    s = ev.silhouette_sq_euclidean(z, ["recency_z", "frequency_z", "monetary_z"], "cluster")
    return s.select(F.round("silhouette", 6).alias("silhouette_sq_euclidean"), "points")


@register(
    "silhouette_sample",
    W(
        _RFM_F
        + f"""
        , pts AS (
          SELECT md5(CAST(customer_unique_id AS VARCHAR)) AS pt, CAST(recency > 180 AS INTEGER) * 2 + CAST(frequency > 7 AS INTEGER) AS c,
                 recency_z AS x0, frequency_z AS x1, monetary_z AS x2
          FROM z ORDER BY pt LIMIT 10000
        ), sizes AS (SELECT c, count(*) AS n FROM pts GROUP BY c
        ), sums AS (
          SELECT p.pt, p.c, q.c AS oc,
                 sum(sqrt((p.x0 - q.x0) * (p.x0 - q.x0) + (p.x1 - q.x1) * (p.x1 - q.x1) + (p.x2 - q.x2) * (p.x2 - q.x2))) AS d
          FROM pts p, pts q GROUP BY p.pt, p.c, q.c
        ), per AS (
          SELECT pt, max(CASE WHEN oc = sums.c THEN n END) AS n, max(CASE WHEN oc = sums.c AND n > 1 THEN d / (n - 1) END) AS a,
                 min(CASE WHEN oc <> sums.c THEN d / n END) AS b
          FROM sums JOIN sizes ON sizes.c = oc GROUP BY pt
        )
        SELECT {R('avg(CASE WHEN n <= 1 OR b IS NULL THEN 0.0 ELSE coalesce((b - a) / nullif(greatest(a, b), 0), 0.0) END)', 6)} AS silhouette_euclidean,
               count(*) AS points
        FROM per
        """
    ),
)
def q_silhouette_sample(spark, d):
    """Euclidean silhouette over the 10,000 persons with the smallest key hashes (fixed labels)."""
    z = rfm_scaled_frame(spark, d).withColumn("cluster", _fixed_cluster())
    s = ev.silhouette_sample(z, ["recency_z", "frequency_z", "monetary_z"], "cluster", "customer_unique_id")
    return s.select(F.round("silhouette", 6).alias("silhouette_euclidean"), "points")


_SEGMENTS = """
, lab AS (SELECT *, CAST(recency > 180 AS INTEGER) * 2 + CAST(frequency > 7 AS INTEGER) AS cluster FROM z),
nm AS (
  SELECT cluster, (['Champions', 'Loyal', 'At Risk', 'Lost'])[row_number() OVER (ORDER BY avg(monetary) DESC, cluster)] AS segment
  FROM lab GROUP BY cluster
), seg AS (SELECT lab.*, nm.segment FROM lab JOIN nm ON nm.cluster = lab.cluster)
"""


def _fixed_segments(spark, d):
    """Named segments of fixed cluster labels, so that naming, profile and sizes have an exact oracle."""
    return mo.name_segments(rfm_scaled_frame(spark, d).withColumn("cluster", _fixed_cluster()))


@register("segment_names", W(_RFM_F + _SEGMENTS + f"SELECT customer_unique_id, {R('monetary')} AS monetary, cluster, segment FROM seg"))
def q_segment_names(spark, d):
    s = _fixed_segments(spark, d)
    return s.select("customer_unique_id", F.round("monetary", 2).alias("monetary"), "cluster", "segment")


@register(
    "segment_profile",
    W(
        _RFM_F
        + _SEGMENTS
        + f"""
        SELECT cluster, segment, {R('avg(recency)')} AS recency, {R('avg(frequency)')} AS frequency, {R('avg(monetary)')} AS monetary,
               count(*) AS count
        FROM seg GROUP BY cluster, segment
        """
    ),
)
def q_segment_profile(spark, d):
    return mo.cluster_profile(_fixed_segments(spark, d))


@register("segment_sizes", W(_RFM_F + _SEGMENTS + "SELECT segment, count(*) AS customers FROM seg GROUP BY segment"))
def q_segment_sizes(spark, d):
    return mo.segment_sizes(_fixed_segments(spark, d))


@register("segment_filter", W(_RFM_F + _SEGMENTS + "SELECT customer_unique_id, recency, frequency FROM seg WHERE segment = 'Champions'"))
def q_segment_filter(spark, d):
    """One segment's persons (the scatter chart's filter by cluster)."""
    return _fixed_segments(spark, d).where(F.col("segment") == mo.CLUSTER_NAMES_BY_SPEND[0]).select("customer_unique_id", "recency", "frequency")
