"""Small expression helpers shared by the operators."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.session import ensure_checkpoint_dir

_writes_lock = threading.Lock()
_writes = {"open": 0, "before": "false"}
# Folders written since the innermost ``settled`` of this thread began.
_written: ContextVar[list[str] | None] = ContextVar("written", default=None)


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def money_sum(col) -> Column:
    """Exact decimal sum, returned as double (nearest double to the exact cents)."""
    return F.sum(_c(col)).cast("double")


def money_sum_0(col) -> Column:
    """Like :func:`money_sum` but 0 for empty/all-null groups (pandas ``sum``)."""
    return F.coalesce(F.sum(_c(col)).cast("double"), F.lit(0.0))


def exact_mean(col) -> Column:
    """Mean of a decimal column: exact decimal sum / count, one rounding step.

    ``avg(decimal)`` yields DECIMAL(p+4, s+4); this form gives the same double
    in any engine because only the final division is floating point.
    """
    c = _c(col)
    return F.try_divide(F.sum(c).cast("double"), F.count(c).cast("double"))


def distinct_count(col, approx: bool = False, rsd: float = 0.01) -> Column:
    """Exact ``count(DISTINCT col)``, or HyperLogLog++ (relative error ``rsd``) when ``approx``.

    The exact form keeps the distinct column in the shuffle key (one extra
    aggregation level); the approximate form is a fixed-size sketch per
    group, merged map-side, for very large inputs where an exact count is
    not required.
    """
    c = _c(col)
    return F.approx_count_distinct(c, rsd=rsd) if approx else F.countDistinct(c)


def pct(num: Column, den: Column, digits: int = 2) -> Column:
    """``round(num / den * 100, digits)``; NULL instead of an ANSI error on 0."""
    return F.round(F.try_divide(num.cast("double"), den.cast("double")) * 100, digits)


def scalar(df: DataFrame, expr: Column) -> Column:
    """A one-value aggregate of ``df`` as a scalar subquery column.

    Spark evaluates it once, ahead of the main plan, and merges sibling
    subqueries over the same plan; no cross join, nothing passes the driver.
    """
    return df.select(expr).scalar()


def top_n(df: DataFrame, n: int, *order: Column) -> DataFrame:
    """Top-n by a total order (``TakeOrderedAndProject``: per-partition heaps, no full sort)."""
    return df.orderBy(*order).limit(n)


def reuse_checkpointed(df: DataFrame) -> DataFrame:
    """Materialise a reduced table that several passes will scan.

    The rows are written once as a Parquet table under the cluster's
    checkpoint folder (``spark.checkpoint.dir``) and read back: the lineage
    is cut, later ranking passes and scalar subqueries scan the written rows
    instead of recomputing the joins and aggregations below, a lost executor
    does not force that recomputation, and AQE sees the real size.  (An RDD
    ``checkpoint()`` would compute the input twice: once to count, once to
    write.)
    """
    path = f"{materialized_folder(df.sparkSession)}/{uuid.uuid4().hex}"
    with _shuffles_dropped(df.sparkSession):
        df.write.mode("overwrite").parquet(path)
    if _written.get() is not None:
        _written.get().append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def settled(build: Callable[[], DataFrame | tuple[DataFrame, ...]]) -> DataFrame | tuple[DataFrame, ...]:
    """``reuse_checkpointed(build())``, or of each where there are several; the tables that ``build`` itself has written are deleted after.

    Only for steps whose written tables nothing but their results read: these are on disk by then.
    """
    outer, own = _written.get(), []
    token = _written.set(own)
    try:
        made = build()
        several = made if isinstance(made, tuple) else (made,)
        out = tuple(reuse_checkpointed(df) for df in several)
    finally:
        _written.reset(token)
    passing, kept = own[: -len(out)], own[-len(out) :]
    if outer is not None:
        outer.extend(kept)
    _delete(out[0].sparkSession, *passing)
    return out if isinstance(made, tuple) else out[0]


@contextmanager
def passing(spark: SparkSession) -> Iterator[None]:
    """Tables that ``reuse_checkpointed`` writes inside are deleted at its end: for steps whose result is not a table."""
    own: list[str] = []
    token = _written.set(own)
    try:
        yield
    finally:
        _written.reset(token)
        _delete(spark, *own)


@contextmanager
def _shuffles_dropped(spark: SparkSession):
    """Let Spark delete the shuffle files of a write when it ends: the written rows take their place.

    The session's own setting comes back after the last of the writes that run side by side.
    """
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    with _writes_lock:
        if not _writes["open"]:
            _writes["before"] = spark.conf.get(key)
            spark.conf.set(key, "true")
        _writes["open"] += 1
    try:
        yield
    finally:
        with _writes_lock:
            _writes["open"] -= 1
            if not _writes["open"]:
                spark.conf.set(key, _writes["before"])


def materialized_folder(spark: SparkSession) -> str:
    return ensure_checkpoint_dir(spark).rstrip("/") + "/mercato-materialized"


def drop_materialized(spark: SparkSession) -> None:
    """Delete what this application's ``reuse_checkpointed`` has written; DataFrames built on it end with it."""
    _delete(spark, materialized_folder(spark))


def _delete(spark: SparkSession, *folders: str) -> None:
    for folder in folders:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
