"""Calendar helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_start(c: str | Column) -> Column:
    """First day of the month of a date, as DATE (``date_trunc`` gives a timestamp)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.trunc(c, "month")


def whole_months_between(start: str | Column, end: str | Column) -> Column:
    """Calendar-month distance ``(y2-y1)*12 + m2-m1`` (int); inputs are dates."""
    start = F.col(start) if isinstance(start, str) else start
    end = F.col(end) if isinstance(end, str) else end
    return (F.year(end) - F.year(start)) * 12 + F.month(end) - F.month(start)
