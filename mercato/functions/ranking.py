"""Distributed global ranking (row index in a total order, optionally per group).

``row_number().over(Window.orderBy(...))`` moves every row into a single
partition.  Here the rows are range-partitioned on the ordering key, sorted
within each partition, and numbered with ``monotonically_increasing_id``
(consecutive inside a partition); a table with one row per
(partition, group) then gives how many rows of the same group precede the
partition.  That table is bounded by ``partitions + groups`` rows, so it
is broadcast; the range shuffle is the only exchange of the data.

Consistency: the partition id and row id are stored with the rows in a
written table (the cluster's checkpoint folder) before the counting and
the numbering read them.  Two separate range shuffles (Catalyst prunes the
two branches differently, so they would not share one exchange) could
sample different range bounds when the input's row order is not fixed,
e.g. a shuffle output or a recomputed task; reading one written copy
rules that out by construction.  Per-partition counts and first ids do
not depend on the order of tied rows; callers pass a total order when tie
order matters.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mercato.functions.common import reuse_checkpointed


def _partitions(df: DataFrame, num_partitions: int | None) -> int:
    if num_partitions:
        return int(num_partitions)
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def rank_with_offsets(
    df: DataFrame,
    order: Sequence[str | Column],
    group: Sequence[str] = (),
    rank_col: str = "_rank",
    count_col: str | None = "_n",
    num_partitions: int | None = None,
    bounded_groups: bool = False,
    valid: Column | None = None,
) -> tuple[DataFrame, DataFrame]:
    """:func:`rank_rows` plus its offsets table ``(_pid, *group, _first, _before, _n)``.

    ``bounded_groups`` says that the number of groups is fixed (such as the
    three metrics of RFM), so the offsets can be broadcast.  With ``valid``,
    ``_n`` of the offsets counts only the rows for which it is true.

    The offsets table has at most ``partitions + groups`` rows; group row
    counts can be read from it without touching the ranked data again.
    """
    group = list(group)
    keys = [F.col(g) for g in group] + [F.col(o) if isinstance(o, str) else o for o in order]
    n_parts = _partitions(df, num_partitions)
    tagged = reuse_checkpointed(
        df.repartitionByRange(n_parts, *keys)
        .sortWithinPartitions(*keys)
        .withColumn("_pid", F.spark_partition_id())
        .withColumn("_mid", F.monotonically_increasing_id())
    )
    stats = tagged.groupBy("_pid", *group).agg(
        F.count(F.lit(1)).alias("_cnt"),
        F.min("_mid").alias("_first"),
        F.count_if(valid if valid is not None else F.lit(True)).alias("_valid"),
    )
    before = Window.partitionBy(*group).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = stats.select(
        "_pid",
        *group,
        "_first",
        F.coalesce(F.sum("_cnt").over(before), F.lit(0)).alias("_before"),
        F.sum("_valid").over(Window.partitionBy(*group)).alias("_n"),
    )
    # Without groups the offsets table has one row per partition (a proven
    # bound) and is broadcast; with groups its size grows with the number of
    # groups, so the join strategy is left to the size-checked planner/AQE.
    side = F.broadcast(offsets) if bounded_groups or not group else offsets
    ranked = tagged.join(side, ["_pid", *group], "inner")
    ranked = ranked.withColumn(rank_col, F.col("_before") + (F.col("_mid") - F.col("_first")) + 1)
    if count_col and count_col != "_n":
        ranked = ranked.withColumnRenamed("_n", count_col)
    drop = ["_pid", "_mid", "_first", "_before"] + ([] if count_col else ["_n"])
    return ranked.drop(*drop), offsets


def rank_rows(
    df: DataFrame,
    order: Sequence[str | Column],
    group: Sequence[str] = (),
    rank_col: str = "_rank",
    count_col: str | None = "_n",
    num_partitions: int | None = None,
    bounded_groups: bool = False,
) -> DataFrame:
    """Add a 1-based ``rank_col`` (row number in ``order``) within ``group``.

    Rows tied on ``order`` get distinct consecutive numbers in an arbitrary
    order; pass a unique key as the last ordering column for rank-first
    semantics.  ``count_col`` (if given) holds the group's row count.
    """
    ranked, _ = rank_with_offsets(df, order, group, rank_col, count_col, num_partitions, bounded_groups)
    return ranked


def rank_first_bucket(rank: Column, n: Column, q: int) -> Column:
    """``pd.qcut(x.rank(method='first'), q)`` bucket (1..q) in closed form.

    With distinct ranks 1..n the bin edges are ``1 + (n-1)k/q`` and bins are
    right-closed, so rank r falls in ``max(1, ceil((r-1)q/(n-1)))``; computed
    with integers, no floating edge.  ``ntile`` is a different split.
    """
    num = (rank - 1) * q
    den = n - 1
    # A single row gives one repeated edge; pandas refuses that, and so do we.
    bucket = F.when(den <= 0, F.raise_error(F.lit("Bin edges must be unique (one ranked row)"))).otherwise(
        F.floor((num + den - 1) / den)
    )
    return F.greatest(F.lit(1), bucket.cast("int"))


def running_totals(
    df: DataFrame,
    order: Sequence[str | Column],
    values: Sequence[str],
    prefix: str = "cum_",
    num_partitions: int | None = None,
    following: Sequence[str] = (),
) -> DataFrame:
    """Inclusive running sums of ``values`` along a total ``order``, distributed.

    Range partitions give each partition a contiguous slice of the order;
    a running sum within the slice (window per partition id) plus the sums
    of all earlier slices (a table of one row per partition, broadcast)
    gives the global running sum.  No single-partition exchange.

    ``following`` names columns whose value in the next row comes as ``next_<name>``
    (null in the last row): ``lead`` within a slice, and for a slice's last row the
    first row of the next slice, which is part of the one-row-per-partition table.
    """
    keys = [F.col(o) if isinstance(o, str) else o for o in order]
    n_parts = _partitions(df, num_partitions)
    # Written once so that the totals and the running sums see the same
    # partition of every row (see the module note on consistency).
    tagged = reuse_checkpointed(df.repartitionByRange(n_parts, *keys).withColumn("_pid", F.spark_partition_id()))
    within = Window.partitionBy("_pid").orderBy(*keys)
    if following:
        first = F.struct(*following)
        tagged = tagged.withColumn("_row", F.row_number().over(within)).withColumn("_next", F.lead(first).over(within))
    edges = [F.max(F.when(F.col("_row") == 1, F.struct(*following))).alias("_head")] if following else []
    totals = tagged.groupBy("_pid").agg(*[F.sum(v).alias(f"_t_{v}") for v in values], *edges)
    in_order = Window.orderBy("_pid")
    before = in_order.rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "_pid",
        *[F.coalesce(F.sum(f"_t_{v}").over(before), F.lit(0)).alias(f"_o_{v}") for v in values],
        *([F.lead("_head").over(in_order).alias("_next_head")] if following else []),
    )
    out = tagged.join(F.broadcast(offsets), "_pid", "inner")
    for v in values:
        running = F.sum(v).over(within.rowsBetween(Window.unboundedPreceding, 0))
        out = out.withColumn(prefix + v, F.col(f"_o_{v}") + running)
    for f in following:
        out = out.withColumn(f"next_{f}", F.coalesce("_next", "_next_head")[f])
    return out.drop("_pid", "_row", "_next", "_next_head", *[f"_o_{v}" for v in values])
