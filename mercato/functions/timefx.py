"""Time helpers with pandas-compatible semantics, all built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_US_PER_DAY = 86_400_000_000


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def floor_days(end, start) -> Column:
    """Whole elapsed 24-hour days from ``start`` to ``end``, floored.

    ``(end - start).dt.days`` in pandas floors (-70 h -> -3).  ``datediff``
    counts calendar boundaries and ``timestampdiff(DAY)`` truncates toward
    zero, so both differ; the microsecond difference floored is exact.
    """
    us = F.timestamp_diff("MICROSECOND", _c(start), _c(end))
    return F.floor(us / F.lit(_US_PER_DAY)).cast("bigint")


def month_text(ts) -> Column:
    """Calendar month as ``yyyy-MM`` text (a monthly period label)."""
    return F.date_format(_c(ts), "yyyy-MM")


def month_index(ts) -> Column:
    """Month ordinal ``year*12 + month - 1``; differences are month distances."""
    t = _c(ts)
    return (F.year(t) * 12 + F.month(t) - 1).cast("int")


def month_index_from_text(text) -> Column:
    """Inverse of :func:`month_text` for ordinals (``'2017-01'`` -> 24204)."""
    t = _c(text)
    return (F.substring(t, 1, 4).cast("int") * 12 + F.substring(t, 6, 2).cast("int") - 1).cast("int")


def weekday_monday0(ts) -> Column:
    """Day of week with Monday = 0 (``dt.dayofweek``); not ``dayofweek`` (Sunday = 1)."""
    return F.weekday(_c(ts))


def plus_days(ts, n: int) -> Column:
    return _c(ts) + F.make_dt_interval(days=F.lit(n))
