"""Approximate quantiles from mergeable KLL sketches, for inputs too large to rank.

A sketch keeps some hundred to thousand values whatever the input; partial
sketches merge map-side, so quantiles of any number of rows and groups cost one
aggregation without a global sort.  The rank of a returned edge is off by at
most ``rank_error(k)`` of the rows with 99 % confidence.  Exact quantiles
(``functions.binning``) stay the default everywhere.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.functions.binning import apply_bins

K = 2000


def rank_error(k: int = K) -> float:
    """Normalised rank error of one quantile from a KLL sketch of size ``k`` (published fit of its authors' measurements)."""
    return 2.296 / k**0.9021


def approx_quantile_table(df: DataFrame, value: str, probs: Sequence[float], group: Sequence[str] = (), k: int = K) -> DataFrame:
    """``(*group, _n, _edges array<double>)`` in ``probs`` order; null values are left out."""
    x = F.col(value).cast("double")
    sketches = df.where(x.isNotNull()).groupBy(*group).agg(F.kll_sketch_agg_double(x, F.lit(k)).alias("_s"), F.count(F.lit(1)).alias("_n"))
    edges = F.kll_sketch_get_quantile_double("_s", F.array(*[F.lit(float(p)) for p in probs]))
    return sketches.select(*group, "_n", F.when(F.col("_n") > 0, edges).alias("_edges"))


def approx_qcut(df: DataFrame, value: str, q: int, out: str, k: int = K, duplicates: str = "raise") -> DataFrame:
    """``binning.qcut`` with edges from a sketch: one aggregation and one projection, no ranking."""
    edges = approx_quantile_table(df, value, [i / q for i in range(q + 1)], k=k)
    binned = df.withColumn("_edges", edges.select("_edges").scalar())
    return binned.select(*df.columns, apply_bins(F.col(value), F.col("_edges"), q, duplicates).alias(out))


def edge_errors(df: DataFrame, value: str, probs: Sequence[float], k: int = K) -> DataFrame:
    """``probability, edge, rank_error, bound``: each edge's exact rank error, by one more aggregate.

    The exact rank of an edge is any share between the rows below it and the rows up to it.
    """
    x = F.col(value).cast("double")
    edges = approx_quantile_table(df, value, probs, k=k).select("_edges").scalar()
    rows = df.where(x.isNotNull()).select(x.alias("_x")).withColumn("_edges", edges)
    aggs = [F.count(F.lit(1)).alias("_n"), F.any_value("_edges").alias("_edges")]
    for i in range(len(probs)):
        aggs += [F.count_if(F.col("_x") < F.col("_edges")[i]).alias(f"_b{i}"), F.count_if(F.col("_x") <= F.col("_edges")[i]).alias(f"_u{i}")]
    cells = []
    for i, p in enumerate(probs):
        below, upto = (F.try_divide(F.col(f"_{c}{i}").cast("double"), F.col("_n")) for c in "bu")
        off = F.greatest(F.lit(0.0), below - p, p - upto)
        cells.append(F.struct(F.lit(float(p)).alias("probability"), F.col("_edges")[i].alias("edge"), off.alias("rank_error"), F.lit(rank_error(k)).alias("bound")))
    return rows.agg(*aggs).select(F.inline(F.array(*cells)))
