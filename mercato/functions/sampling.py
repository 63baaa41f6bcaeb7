"""Bottom-k hash samples: the ``k`` rows whose keys have the smallest hashes.

The sample depends on the keys alone, not on partitions or row order, and is
mergeable: the bottom-k of a union is the bottom-k of the parts' samples.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PREFIX = 4  # hexadecimal digits of the hash that are counted: 65,536 at most


def key_hash(key: str) -> Column:
    """md5 of the key's text (32 hexadecimal digits, ordered as text); null keys come last."""
    return F.coalesce(F.md5(F.col(key).cast("string")), F.lit("~"))


def bottom_k(df: DataFrame, key: str, k: int) -> DataFrame:
    """The ``k`` rows with the smallest key hashes (all rows when there are fewer).

    Counts by hash prefix (one partial aggregate of at most 65,536 groups) tell
    up to which prefix ``k`` rows are reached; only those rows, ``k`` and a small
    share of one prefix, go on to the ordered limit.  Rows of equal keys are ordered by
    their content, so the sample is the same on every run.
    """
    if k < 1:
        raise ValueError("a sample has one row at least")
    prefix = F.substring(key_hash(key), 1, PREFIX)
    counted = df.groupBy(prefix.alias("_p")).agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("_n")
    last = counted.select("_p", before.alias("_before")).where(F.col("_before") < k).select(F.max("_p")).scalar()
    content = F.xxhash64(*[F.col(c) for c in df.columns])
    return df.where(prefix <= last).orderBy(key_hash(key), content).limit(k)
