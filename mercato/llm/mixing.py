"""Operator 6, mixing sources to target weights: subset-sum budget fitting.

Sources, by code point (null last), weigh 5, 2, 1, repeating, and share the
corpus' words; a target above ``max_repeats`` times its source's words is cut
there and the excess reshared by weight.  A source is taken whole as often as
its budget allows; the remaining budget is fitted with a subset of its
documents.  That subset is chosen on the source's length counts: first the
same share of every length, then longest lengths while the rest is above
``DP_WORDS``, then a bounded-knapsack dynamic program over the lengths still
available for the rest.  How many documents of each length are taken is thus
fixed; which ones follows a seeded hash of doc_id.

Only length counts reach one task per source (at most one row per distinct
length).  Ranking inside a (source, length) group is split by hash ranges, so
a source or length with a third of all rows is spread over many tasks.

Defined cases: null text has size 0; documents of size 0 are never taken;
null sources form one source; null doc_id values rank first; repeated rows
are separate documents; extra columns are ignored by ``plan_mix`` and kept by
``mixed_documents``; an empty table returns no rows; a corpus without words
takes nothing.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mercato.functions.common import reuse_checkpointed
from mercato.llm.text import beside, boxed

WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3
DP_WORDS = 1 << 15
HASH_RANGES = 256
SEED = 6


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(source_sizes: DataFrame, weights=WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """``source_key, source_size, target`` from one row per source (the only unpartitioned windows: over sources)."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.row_number().over(by_name) - 1) % len(weights) + 1)
    s = source_sizes.select("source_key", "source", "source_size", w.alias("weight"))
    cap = F.col("source_size") * float(max_repeats)
    # Water level: sources in order of cap / weight are cut while their cap is below their share of what is left.
    by_cap = Window.orderBy(F.col("cap_rate"), F.col("source").asc_nulls_last())
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_cap.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    s = s.withColumn("cap_rate", cap / F.col("weight"))
    s = s.withColumn(
        "level",
        (F.sum("source_size").over(everything) - F.coalesce(F.sum(cap).over(before), F.lit(0.0))) / F.sum("weight").over(onward),
    )
    # The first source in that order that is not cut has the level of all the others after it.
    first = F.struct("cap_rate", F.col("source").isNull(), "source", "level")
    s = s.withColumn("level", F.min(F.when(F.col("cap_rate") >= F.col("level"), first)).over(everything)["level"])
    return s.select("source_key", "source_size", F.least(cap, F.col("level") * F.col("weight")).alias("target"))


def fit_budget(sizes: np.ndarray, counts: np.ndarray, budget: int, dp_words: int = DP_WORDS) -> np.ndarray:
    """How many of ``counts[i]`` documents of ``sizes[i] > 0`` words to take for a sum near ``budget``."""
    take = np.zeros(len(sizes), dtype=np.int64)
    total = int((sizes * counts).sum())
    if budget <= 0 or total == 0:
        return take
    if budget >= total:
        return counts.astype(np.int64)
    take = np.array([int(c) * budget // total for c in counts], dtype=np.int64)
    rest = budget - int((take * sizes).sum())
    order = np.argsort(-sizes, kind="stable")
    for i in order:
        if rest <= dp_words:
            break
        k = min(int(counts[i] - take[i]), (rest - dp_words // 2) // int(sizes[i]))
        take[i] += k
        rest -= k * int(sizes[i])
    # Reachable sums as the bits of one integer, up to twice the rest; one step per power-of-two batch of equal lengths.
    steps: list[tuple[int, int, int]] = []
    reach, mask = 1, (1 << (2 * rest + 1)) - 1
    for i in order:
        size, left = int(sizes[i]), int(counts[i] - take[i])
        left, k = min(left, 2 * rest // size), 1
        while left > 0 and not reach >> rest & 1:
            k = min(k, left)
            wider = (reach | reach << (k * size)) & mask
            if wider != reach:
                steps.append((reach, int(i), k))
                reach = wider
            left, k = left - k, 2 * k
        if reach >> rest & 1:
            break
    below = (reach & ((1 << (rest + 1)) - 1)).bit_length() - 1
    above = reach >> rest
    over = (above & -above).bit_length() - 1 if above else rest + 1
    at = rest + over if over < rest - below else below
    for earlier, i, k in reversed(steps):
        if not earlier >> at & 1:
            take[i] += k
            at -= k * int(sizes[i])
    return take


KEY = ("_source_key", "_size", "_range")


def _keyed(docs: DataFrame, seed: int) -> DataFrame:
    """``docs`` with its size, source key, seeded hash and hash range."""
    h = F.xxhash64(F.col("doc_id"), F.lit(seed))
    return docs.withColumns(
        {
            "_size": n_words(F.col("text")),
            "_source_key": F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("n")),
            "_h": h,
            "_range": F.pmod(h, F.lit(HASH_RANGES)),
        }
    )


def _budgets(counts: DataFrame, weights=WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """Per (source, length, hash range): ``source_size, target, whole, need`` from the counts ``n`` and names ``source``.

    Every document is taken ``whole`` times, the first ``need`` of the range once more.
    """
    sources = counts.groupBy("_source_key").agg(F.first("source").alias("source"), F.sum(F.col("_size") * F.col("n")).alias("source_size"))
    targets = source_targets(sources.withColumnRenamed("_source_key", "source_key"), weights, max_repeats).withColumnRenamed("source_key", "_source_key")

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_size", kind="stable")
        total, target = int(pdf["source_size"].iloc[0]), float(pdf["target"].iloc[0])
        budget = int(target + 0.5)
        whole = min(max_repeats, budget // total) if total else 0
        sizes, n = pdf["_size"].to_numpy(), pdf["n"].to_numpy()
        extra = np.zeros(len(pdf), dtype=np.int64)
        if whole < max_repeats:
            some = sizes > 0
            extra[some] = fit_budget(sizes[some], n[some], budget - whole * total)
        return pd.DataFrame({"_source_key": pdf["_source_key"], "_size": sizes, "source_size": total, "target": target, "whole": whole, "extra": extra})

    fitted = (
        counts.groupBy("_source_key", "_size")
        .agg(F.sum("n").alias("n"))
        .join(targets, "_source_key")
        .groupBy("_source_key")
        .applyInPandas(fit, "_source_key string, _size long, source_size long, target double, whole long, extra long")
    )
    earlier = Window.partitionBy("_source_key", "_size").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    return (
        counts.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
        .join(fitted, ["_source_key", "_size"])
        .select(*KEY, "source_size", "target", "whole", (F.col("extra") - F.col("before")).alias("need"))
    )


def _planned(keyed: DataFrame, counted: DataFrame) -> DataFrame:
    """``keyed`` with ``source_size``, ``target`` and ``copies``."""
    counts = reuse_checkpointed(counted.groupBy(*KEY).agg(F.count("*").alias("n"), F.first("source").alias("source")))
    need = _budgets(counts).select(*KEY, F.struct("source_size", "target", "whole", "need").alias("_b"))
    rank = F.row_number().over(Window.partitionBy(*KEY).orderBy("_h", "doc_id"))
    copies = F.when(F.col("_size") == 0, F.lit(0)).otherwise(F.col("_b.whole") + (rank <= F.col("_b.need")).cast("long"))
    return keyed.join(need, list(KEY)).withColumn("_copies", copies.cast("long"))


def plan_mix(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """``doc_id, size, source_size, target, copies, taken`` for every document."""
    sized = reuse_checkpointed(_keyed(docs.select("doc_id", "source", "text"), seed).drop("text"))
    return _planned(sized, sized).select(
        "doc_id",
        F.col("_size").alias("size"),
        "_b.source_size",
        "_b.target",
        F.col("_copies").alias("copies"),
        (F.col("_copies") * F.col("_size")).alias("taken"),
    )


def mixed_documents(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """The mixed corpus: every document as often as the plan takes it, with its ``size`` and ``copy`` number
    from 1; columns of those names come as ``input_<name>``."""
    keyed = _keyed(boxed(docs, "doc_id", "source", "text"), seed).drop("text")
    copy = F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int")))
    own = beside(docs, "size", "copy")
    return _planned(keyed, keyed).where("_copies > 0").select(*own, F.col("_size").alias("size"), copy.alias("copy"))
