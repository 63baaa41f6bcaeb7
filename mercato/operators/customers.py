"""Customer value, satisfaction and RFM operators (person = ``customer_unique_id``).

Per-customer aggregates are two-level where a distinct order count is
needed: ``(customer, order)`` first, then ``customer``.  The first level is
keyed by the order as well, so a customer holding a third of all rows is
spread over many reducers, and map-side partial aggregation shrinks the
fan-out rows before any shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercato.functions.binning import apply_bins, label_bucket, qcut, quantile_table, quantiles_from_ranked
from mercato.functions.common import reuse_checkpointed, scalar
from mercato.functions.ranking import rank_first_bucket, rank_with_offsets
from mercato.functions.sketches import approx_qcut
from mercato.functions.timefx import floor_days, plus_days

CUST = "customer_unique_id"

# Fixed labels and thresholds of the reference segmentations.
VALUE_SEGMENT_LABELS = ["Low", "Medium", "High", "VIP"]
RFM_SEGMENT_THRESHOLDS = [(13, "Champion"), (10, "Loyal"), (7, "At Risk")]
RFM_SEGMENT_DEFAULT = "Lost"


# ------------------------------------------------------------ customer value


def customer_value(fact: DataFrame) -> DataFrame:
    """Total spend and **row** count per person (``count(order_id)`` over fan-out rows)."""
    return fact.where(F.col(CUST).isNotNull()).groupBy(CUST).agg(
        F.sum("payment_value").cast("double").alias("total_spent"),
        F.count("order_id").alias("order_count"),
    )


def customer_value_segments(fact: DataFrame, approx: bool = False) -> DataFrame:
    """Quartile value segments Low/Medium/High/VIP on total spend (``qcut(.., 4)``).

    ``approx`` takes the edges from a mergeable sketch (``functions.sketches``, rank error
    ``rank_error()``) instead of ranking all persons; the persons are computed once.
    """
    if approx:
        binned = approx_qcut(reuse_checkpointed(customer_value(fact)), "total_spent", 4, "segment_rank")
    else:
        binned = qcut(customer_value(fact), "total_spent", 4, "segment_rank", tiebreak=[CUST])
    return binned.withColumn("value_segment", label_bucket(F.col("segment_rank"), VALUE_SEGMENT_LABELS))


def value_segment_describe(segments: DataFrame) -> DataFrame:
    """``groupby(segment).describe()``: count, mean, sample std, min, quartiles, max."""
    stats = segments.groupBy("segment_rank", "value_segment").agg(
        F.count("total_spent").alias("count"),
        F.avg("total_spent").alias("mean"),
        F.stddev_samp("total_spent").alias("std"),
        F.min("total_spent").alias("min"),
        F.max("total_spent").alias("max"),
    )
    qs = quantile_table(segments, "total_spent", [0.25, 0.5, 0.75], group=["segment_rank"], tiebreak=[CUST])
    qs = qs.select(
        "segment_rank",
        F.col("_edges")[0].alias("p25"),
        F.col("_edges")[1].alias("p50"),
        F.col("_edges")[2].alias("p75"),
    )
    out = stats.join(qs, "segment_rank", "left")
    return out.select(
        "segment_rank",
        "value_segment",
        "count",
        F.round("mean", 4).alias("mean"),
        F.round("std", 4).alias("std"),
        F.round("min", 2).alias("min"),
        F.round("p25", 4).alias("p25"),
        F.round("p50", 4).alias("p50"),
        F.round("p75", 4).alias("p75"),
        F.round("max", 2).alias("max"),
    ).orderBy("segment_rank")


def value_segment_counts(segments: DataFrame) -> DataFrame:
    return (
        segments.groupBy("segment_rank", "value_segment")
        .agg(F.count(F.lit(1)).alias("customers"))
        .orderBy("segment_rank")
    )


def customer_value_median(fact: DataFrame) -> DataFrame:
    cv = customer_value(fact)
    q = quantile_table(cv, "total_spent", [0.5], tiebreak=[CUST])
    return q.select(F.col("_n").alias("customers"), F.round(F.col("_edges")[0], 4).alias("median_total_spent"))


def spend_histogram(fact: DataFrame, bins: int = 50) -> DataFrame:
    """Equal-width histogram of total spend (``hist(bins=50)``), empty bins included.

    Bin i covers ``[min + (i-1)w, min + i w)``, the last bin is closed on the
    right; a constant input falls into one bin.  The bin list is generated
    from the bin count and left-joined to the counts (``bins`` rows).
    """
    cv = reuse_checkpointed(customer_value(fact))
    lo = scalar(cv, F.min("total_spent"))
    hi = scalar(cv, F.max("total_spent"))
    width = hi - lo
    x = F.col("total_spent")
    b = F.when(width == 0, F.lit(1)).otherwise(
        F.least(F.floor((x - lo) / width * bins).cast("int") + 1, F.lit(bins))
    )
    counts = cv.groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("customers"))
    spark = fact.sparkSession
    grid = spark.range(1, bins + 1).select(F.col("id").cast("int").alias("bin"))
    out = grid.join(F.broadcast(counts), "bin", "left")
    return out.select(
        "bin",
        F.round(lo + (F.col("bin") - 1) * width / bins, 2).alias("bin_start"),
        F.round(lo + F.col("bin") * width / bins, 2).alias("bin_end"),
        F.coalesce("customers", F.lit(0)).cast("bigint").alias("customers"),
    ).orderBy("bin")


# ------------------------------------------------------------ satisfaction


def customer_satisfaction(fact: DataFrame) -> DataFrame:
    """Mean review over fan-out rows and distinct orders per person, incomplete rows dropped."""
    per_order = fact.where(F.col(CUST).isNotNull()).groupBy(CUST, "order_id").agg(
        F.sum("review_score").alias("_s"), F.count("review_score").alias("_c")
    )
    per_cust = per_order.groupBy(CUST).agg(
        F.try_divide(F.sum("_s"), F.sum("_c").cast("double")).alias("review_score"),
        F.count(F.lit(1)).alias("num_orders"),
    )
    return per_cust.na.drop(subset=["review_score", "num_orders"])


def repeat_customers(fact: DataFrame) -> DataFrame:
    """Scatter rows behind the satisfaction chart: persons with more than one order."""
    return customer_satisfaction(fact).where(F.col("num_orders") > 1).select(
        CUST, F.round("review_score", 6).alias("review_score"), "num_orders"
    )


def safe_corr(x: Column, y: Column) -> Column:
    """Pearson correlation; NULL (not an ANSI divide-by-zero) for a constant column."""
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))


def satisfaction_correlation(fact: DataFrame) -> DataFrame:
    rc = customer_satisfaction(fact).where(F.col("num_orders") > 1)
    return rc.agg(
        F.round(safe_corr(F.col("review_score"), F.col("num_orders").cast("double")), 6).alias("correlation"),
        F.count(F.lit(1)).alias("repeat_customers"),
    )


# ------------------------------------------------------------ RFM


def rfm_base(fact: DataFrame, frequency: str = "orders") -> DataFrame:
    """Recency (floored days before the snapshot), frequency, monetary per person.

    The snapshot is one day after the last purchase in the fact, a scalar
    subquery.  ``frequency="orders"`` counts distinct orders, ``"rows"``
    counts fact rows (the two variants found in the reference).
    """
    if frequency == "orders":
        per = fact.groupBy(CUST, "order_id").agg(
            F.max("order_purchase_timestamp").alias("_last"), F.sum("payment_value").alias("_m")
        ).groupBy(CUST).agg(
            F.max("_last").alias("_last"), F.count(F.lit(1)).alias("frequency"), F.sum("_m").alias("_m")
        )
    elif frequency == "rows":
        per = fact.groupBy(CUST).agg(
            F.max("order_purchase_timestamp").alias("_last"),
            F.count("order_id").alias("frequency"),
            F.sum("payment_value").alias("_m"),
        )
    else:
        raise ValueError(f"unknown frequency {frequency!r}")
    # One row per person, written once.  The null-person group is kept until
    # the snapshot (latest purchase of the whole fact + 1 day) has been read,
    # so the fact joins are scanned once; the person groupby then drops it.
    per = reuse_checkpointed(per)
    snapshot = scalar(per, plus_days(F.max("_last"), 1))
    return per.where(F.col(CUST).isNotNull()).select(
        CUST,
        floor_days(snapshot, F.col("_last")).alias("recency"),
        F.col("frequency").cast("bigint").alias("frequency"),
        F.col("_m").cast("double").alias("monetary"),
    )


def rfm_label(score: Column) -> Column:
    expr = None
    for threshold, label in RFM_SEGMENT_THRESHOLDS:
        expr = F.when(score >= threshold, label) if expr is None else expr.when(score >= threshold, label)
    return expr.otherwise(RFM_SEGMENT_DEFAULT)


def rfm_scored(base: DataFrame, num_partitions: int | None = None) -> DataFrame:
    """Quintile scores (recency reversed), rank-first frequency score, label.

    r: ``qcut(recency, 5)`` reversed; f: ``qcut(frequency.rank('first'), 5)``
    with the person id as tie order (a groupby result is sorted by it);
    m: ``qcut(monetary, 5)``.

    One distributed ranking pass serves all three: the base is stacked into
    (metric, value) rows and ranked per metric by (value, person).  The
    frequency rows carry the rank-first numbers; the recency and monetary
    rows give the quantile edges (2 order statistics per edge); the stacked
    rows are written once by the ranker, so nothing below is recomputed.
    """
    metrics = ["recency", "frequency", "monetary"]
    stacked = base.select(
        CUST,
        *metrics,
        F.explode(
            F.array(*[F.struct(F.lit(m).alias("_metric"), F.col(m).cast("double").alias("_v")) for m in metrics])
        ).alias("_s"),
    ).select(CUST, *metrics, "_s._metric", "_s._v")
    ranked, offsets = rank_with_offsets(
        stacked,
        ["_v", CUST],
        group=["_metric"],
        rank_col="_rank",
        count_col="_n",
        num_partitions=num_partitions,
        bounded_groups=True,  # three metrics
    )
    probs = [i / 5 for i in range(6)]
    edges = quantiles_from_ranked(
        ranked.where(F.col("_metric") != "frequency"),
        offsets.where(F.col("_metric") != "frequency"),
        "_v",
        probs,
        group=["_metric"],
        bounded_groups=True,
    )
    both = edges.agg(
        F.max(F.when(F.col("_metric") == "recency", F.col("_edges"))).alias("r"),
        F.max(F.when(F.col("_metric") == "monetary", F.col("_edges"))).alias("m"),
    ).select(F.struct("r", "m")).scalar()
    freq = ranked.where(F.col("_metric") == "frequency").withColumn("_e", both)
    scored = freq.select(
        CUST,
        F.col("recency").cast("bigint").alias("recency"),
        F.col("frequency").cast("bigint").alias("frequency"),
        F.col("monetary").cast("double").alias("monetary"),
        (6 - apply_bins(F.col("recency"), F.col("_e.r"), 5)).cast("int").alias("r_score"),
        rank_first_bucket(F.col("_rank"), F.col("_n"), 5).alias("f_score"),
        apply_bins(F.col("monetary"), F.col("_e.m"), 5).cast("int").alias("m_score"),
    )
    scored = scored.withColumn("rfm_score", F.col("r_score") + F.col("f_score") + F.col("m_score"))
    return scored.withColumn("segment", rfm_label(F.col("rfm_score")))


def rfm_segments(scored: DataFrame) -> DataFrame:
    """Customers and mean recency/frequency/monetary per segment (2 dp)."""
    return scored.groupBy("segment").agg(
        F.count("recency").alias("customers"),
        F.round(F.avg("recency"), 2).alias("avg_recency"),
        F.round(F.avg("frequency"), 2).alias("avg_frequency"),
        F.round(F.avg("monetary"), 2).alias("avg_monetary"),
    ).orderBy("segment")  # groupby order of the published mart (labels sorted)


def rfm_spend_by_segment(scored: DataFrame) -> DataFrame:
    return (
        scored.groupBy("segment")
        .agg(F.round(F.avg("monetary"), 2).alias("avg_monetary"))
        .orderBy(F.desc("avg_monetary"), "segment")
    )


def segment_lift(scored: DataFrame) -> DataFrame:
    """Segment mean spend relative to the overall mean spend (e.g. 2.1x)."""
    overall = scalar(scored, F.avg("monetary"))
    return scored.groupBy("segment").agg(
        F.count(F.lit(1)).alias("customers"),
        F.round(F.avg("monetary"), 2).alias("avg_monetary"),
        F.round(F.avg("monetary") / overall, 4).alias("lift"),
    ).orderBy(F.desc("lift"), "segment")
