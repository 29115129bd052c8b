"""Day spines and date ranges."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F


def days_between(start: str | dt.date, end: str | dt.date) -> Column:
    """Array of every day from start to end, both included."""
    first, last = F.lit(str(start)).cast("date"), F.lit(str(end)).cast("date")
    return F.sequence(first, last, F.expr("interval 1 day"))


def lookback(today: dt.date, days: int) -> tuple[dt.date, dt.date]:
    """First and last of the ``days`` full days before today."""
    return today - dt.timedelta(days=days), today - dt.timedelta(days=1)
