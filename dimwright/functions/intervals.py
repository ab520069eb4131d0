"""Elapsed-time measures (F3) from day/hour/minute interval parts.

``end - start`` of two TIMESTAMP_NTZ values is a day-time interval; its parts
are components (2 days 01:45:50 -> 2, 1, 45), all negative when ``end`` is
earlier, seconds dropped. Hours round up when the minute part is 30 or more.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def interval_parts(start: str | Column, end: str | Column) -> tuple[Column, Column, Column]:
    iv = _c(end) - _c(start)
    return (F.extract(F.lit("DAY"), iv).cast("long"),
            F.extract(F.lit("HOUR"), iv).cast("long"),
            F.extract(F.lit("MINUTE"), iv).cast("long"))


def elapsed_days(start: str | Column, end: str | Column) -> Column:
    return interval_parts(start, end)[0]


def elapsed_hours(start: str | Column, end: str | Column) -> Column:
    d, h, m = interval_parts(start, end)
    return d * 24 + h + F.when(m >= 30, 1).otherwise(0)


def elapsed_minutes(start: str | Column, end: str | Column) -> Column:
    d, h, m = interval_parts(start, end)
    return (d * 24 + h) * 60 + m


def duration_measures(start: str | Column, end: str | Column, prefix: str) -> list[Column]:
    """``{prefix}_days``, ``{prefix}_hours``, ``{prefix}_minutes`` for ``end - start``."""
    return [elapsed_days(start, end).alias(f"{prefix}_days"),
            elapsed_hours(start, end).alias(f"{prefix}_hours"),
            elapsed_minutes(start, end).alias(f"{prefix}_minutes")]


def pending_days(start: str | Column, end: str | Column, as_of) -> Column:
    """Open age in days while ``end`` is null; the caller's ``as_of`` stands in for now()."""
    as_of_col = as_of if isinstance(as_of, Column) else F.lit(as_of).cast("timestamp_ntz")
    return F.when(_c(end).isNull(), elapsed_days(start, as_of_col))
