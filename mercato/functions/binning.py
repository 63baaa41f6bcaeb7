"""Exact quantiles and ``pd.qcut``-compatible binning.

Quantiles use linear interpolation between order statistics
(``h = (n-1)p``; ``q = x[floor h] + (x[floor h + 1] - x[floor h]) * frac(h)``),
the definition shared by pandas, numpy and SQL ``quantile_cont``.  They are
computed from the distributed ranker, so no reducer has to hold all values
(Spark's ``percentile`` keeps a value -> count map on one reducer, and
``percentile_approx`` is approximate).  Only 2 rows per requested
probability and group leave the ranked data.

Binning follows ``pd.qcut``: edges at the quantiles of 0, 1/q, ..., 1,
right-closed bins with the lowest edge included, equal values always in the
same bin, nulls stay null, repeated edges raise (or are dropped on request).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercato.functions.ranking import rank_with_offsets


def quantile_table(
    df: DataFrame,
    value: str,
    probs: Sequence[float],
    group: Sequence[str] = (),
    tiebreak: Sequence[str] = (),
    num_partitions: int | None = None,
) -> DataFrame:
    """One row per group: ``(*group, _n, _edges array<double>)`` in ``probs`` order.

    ``tiebreak`` columns extend the range-partitioning key so that heavy
    ties on ``value`` do not land in one partition.
    """
    group = list(group)
    vals = df.where(F.col(value).isNotNull()).select(
        *group, F.col(value).cast("double").alias("_x"), *[F.col(t) for t in tiebreak]
    )
    ranked, offsets = rank_with_offsets(vals, ["_x", *tiebreak], group=group, num_partitions=num_partitions)
    return quantiles_from_ranked(ranked, offsets, "_x", probs, group)


def quantiles_from_ranked(
    ranked: DataFrame,
    offsets: DataFrame,
    value: str,
    probs: Sequence[float],
    group: Sequence[str] = (),
    bounded_groups: bool = False,
) -> DataFrame:
    """Quantile edges per group from rows already numbered by :func:`rank_with_offsets`.

    Only the order statistics the interpolation needs (2 per probability and
    group) are read from ``ranked``; group sizes come from ``offsets``.
    """
    group = list(group)
    keyed = group or ["_g"]
    if not group:
        ranked = ranked.withColumn("_g", F.lit(0))
        offsets = offsets.withColumn("_g", F.lit(0))

    # Needed order statistics per group, from the (tiny) offsets table.
    counts = offsets.select(*keyed, "_n").distinct()
    probs_arr = F.array(*[F.lit(float(p)) for p in probs])
    needed = (
        counts.select(*keyed, "_n", F.posexplode(probs_arr).alias("_k", "_p"))
        .withColumn("_h", (F.col("_n") - 1).cast("double") * F.col("_p"))
        .withColumn("_lo", F.floor("_h").cast("bigint"))
    )
    needed = needed.withColumn("_hi", F.least(F.col("_lo") + 1, F.col("_n") - 1))
    wanted = needed.select(*keyed, F.explode(F.array(F.col("_lo") + 1, F.col("_hi") + 1)).alias("_rank")).distinct()
    # One pass over the ranked rows keeps 2 rows per probability and group.
    # The wanted ranks are 2 per probability and group: broadcast when the
    # number of groups is fixed; else they grow with it and the planner decides.
    picked = (
        ranked.join(F.broadcast(wanted) if bounded_groups or not group else wanted, [*keyed, "_rank"], "inner")
        .groupBy(*keyed)
        .agg(F.map_from_entries(F.collect_list(F.struct("_rank", F.col(value).cast("double")))).alias("_m"))
    )
    xlo = F.element_at("_m", F.col("_lo") + 1)
    xhi = F.element_at("_m", F.col("_hi") + 1)
    q = needed.join(picked, keyed).select(
        *keyed, "_n", "_k", (xlo + (xhi - xlo) * (F.col("_h") - F.col("_lo"))).alias("_q")
    )
    edges = q.groupBy(*keyed, "_n").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("_k", "_q"))), lambda s: s["_q"]).alias("_edges")
    )
    return edges.drop("_g") if not group else edges


def _bucket_from_edges(x: Column, edges: Column, q: int, duplicates: str) -> Column:
    """1-based bin of ``x`` for the q+1 edges (right-closed, lowest included).

    The comparisons are unrolled (q is known when the plan is built), which
    keeps the expression codegen-friendly and lets ``edges`` be a scalar
    subquery (not allowed inside higher-order functions).
    """
    def above(arr: Column, pos: int) -> Column:
        return F.when(x > F.try_element_at(arr, F.lit(pos)), 1).otherwise(0)

    if duplicates == "drop":
        # Bins collapse where edges repeat: count distinct inner edges below x.
        uniq = F.array_distinct(edges)
        bucket = F.lit(1)
        for pos in range(2, q + 1):
            bucket = bucket + F.when(F.lit(pos) <= F.size(uniq) - 1, above(uniq, pos)).otherwise(0)
        return F.when(x.isNotNull(), bucket)
    bucket = F.lit(1)
    for pos in range(2, q + 1):
        bucket = bucket + above(edges, pos)
    dup = F.size(F.array_distinct(edges)) < F.size(edges)
    return F.when(x.isNull(), F.lit(None)).when(
        dup, F.raise_error(F.lit("Bin edges must be unique (qcut); use duplicates='drop'"))
    ).otherwise(bucket)


def apply_bins(x: Column, edges: Column, q: int, duplicates: str = "raise") -> Column:
    """Bin ``x`` by a scalar or a grouped edge column."""
    return _bucket_from_edges(x.cast("double"), edges, q, duplicates)


def qcut(
    df: DataFrame,
    value: str,
    q: int,
    out: str,
    group: Sequence[str] = (),
    tiebreak: Sequence[str] = (),
    duplicates: str = "raise",
    num_partitions: int | None = None,
) -> DataFrame:
    """Add ``out`` = quantile bin (1..q) of ``value``, like ``pd.qcut(x, q)``.

    One ranking pass: every row is numbered within its group by
    (value nulls last, tiebreak), so non-null rows are 1..n; the rows are
    written once by the ranker, the quantile edges read 2 rows per edge from
    that copy, and the output rows come from the same copy, so the input is
    computed once.  Without ``group`` the edges are a scalar subquery; with
    ``group`` the per-group edge table (one row per group) is joined.
    """
    group = list(group)
    probs = [i / q for i in range(q + 1)]
    base = df.withColumn("_x", F.col(value).cast("double"))
    # The offsets carry the number of non-null values, so no pass over the rows counts them.
    ranked, offsets = rank_with_offsets(
        base,
        [F.col("_x").asc_nulls_last(), *tiebreak],
        group=group,
        count_col=None,
        num_partitions=num_partitions,
        valid=F.col("_x").isNotNull(),
    )
    edges = quantiles_from_ranked(ranked, offsets.where("_n > 0"), "_x", probs, group)
    if not group:
        binned = ranked.withColumn("_edges", edges.select("_edges").scalar())
    else:
        binned = ranked.join(edges.select(*group, "_edges"), group, "left")
    binned = binned.withColumn(out, apply_bins(F.col("_x"), F.col("_edges"), q, duplicates))
    return binned.select(*df.columns, out)


def label_bucket(bucket: Column, labels: Sequence) -> Column:
    """Map bucket 1..k to ``labels[bucket-1]`` (ordered categorical labels)."""
    return F.element_at(F.array(*[F.lit(v) for v in labels]), bucket)
