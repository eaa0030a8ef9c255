"""Time helpers for SQL written in other dialects (§2.9).

Spark has no ``date_bin``/``time_bucket``; ``date_bin`` is the same binning as
epoch arithmetic on ``timestamp_ntz`` values, independent of the session time
zone. ``distinct_on`` is the ``row_number() = 1`` rewrite of ``DISTINCT ON``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EPOCH = "1970-01-01 00:00:00"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def date_bin(stride: dt.timedelta, col, origin: str = EPOCH) -> Column:
    """Start of the ``stride``-wide bin holding each ``timestamp_ntz`` value,
    bins aligned on ``origin`` (floor, also before the origin)."""
    micros = int(stride / dt.timedelta(microseconds=1))
    if micros <= 0:
        raise ValueError("stride must be positive")
    start = F.lit(origin).cast("timestamp_ntz")
    offset = F.timestamp_diff("MICROSECOND", start, _c(col))
    floored = offset - F.pmod(offset, F.lit(micros))
    return F.timestamp_add("MICROSECOND", floored, start)


def trunc_ntz(unit: str, col) -> Column:
    """``date_trunc`` that keeps ``timestamp_ntz`` and ignores the session time
    zone (Spark's ``date_trunc`` returns ``timestamp``)."""
    unit = unit.upper()
    c = _c(col)
    day = F.to_date(c).cast("timestamp_ntz")
    if unit == "DAY":
        return day
    if unit == "HOUR":
        return F.timestamp_add("HOUR", F.hour(c), day)
    if unit == "MINUTE":
        return F.timestamp_add("MINUTE", F.hour(c) * 60 + F.minute(c), day)
    if unit == "MONTH":
        return F.make_date(F.year(c), F.month(c), F.lit(1)).cast("timestamp_ntz")
    if unit == "YEAR":
        return F.make_date(F.year(c), F.lit(1), F.lit(1)).cast("timestamp_ntz")
    raise ValueError(f"unsupported unit {unit!r}")


def distinct_on(df: DataFrame, keys, order_by) -> DataFrame:
    """First row per ``keys`` in ``order_by`` order (``DISTINCT ON``)."""
    from ringcast.operators.fanout import latest_per_key

    return latest_per_key(df, keys, order_by)
