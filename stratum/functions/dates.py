"""Time bucketing on ``date`` values, independent of the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_of(c: str | Column) -> Column:
    """First day of the month, as ``date``."""
    return F.trunc(F.to_date(c), "month")


def quarter_of(c: str | Column) -> Column:
    return F.trunc(F.to_date(c), "quarter")


def day_of(c: str | Column) -> Column:
    return F.to_date(c)


def hour_of(c: str | Column) -> Column:
    """Start of the hour, kept as ``timestamp_ntz``."""
    return F.date_trunc("hour", F.col(c) if isinstance(c, str) else c).cast("timestamp_ntz")
