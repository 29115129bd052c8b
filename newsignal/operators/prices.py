"""Price series: percent change per ticker and its backfill.

A window over a ticker holds one row per trading day, because closes are made unique
per (ticker, day) first; its size is the number of days, whatever the input holds.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window, functions as F

from newsignal.functions import numeric
from newsignal.operators.clean import first_per_key


def one_close_per_day(closes: DataFrame, order: list[Column | str]) -> DataFrame:
    """One row per (ticker, event_date): the first in the given order, nulls left out."""
    return first_per_key(closes.filter("close is not null"), ["ticker", "event_date"], order)


def price_change(closes: DataFrame) -> DataFrame:
    """Close and change against the previous close in percent; 0.0 on the first day.

    Days without a close are dropped, so the previous row holds the last known close.
    """
    w = Window.partitionBy("ticker").orderBy("event_date")
    before = F.nullif(F.lag("close").over(w), F.lit(0.0))
    change = (F.col("close") / before - F.lit(1.0)) * F.lit(100.0)
    return closes.filter("close is not null").select(
        "*",
        numeric.half_even(F.col("close")).alias("close_price"),
        F.coalesce(numeric.half_even(change), F.lit(0.0)).alias("price_change_pct"),
    ).drop("close")


def changes_around(closes: DataFrame, first: str, last: str) -> DataFrame:
    """Changes of all days from ``first`` to ``last``, and of each ticker's next day.

    The close before comes from the last stored day of the ticker, however far back; the
    next day is included because its change is against the last close of the range.
    Earlier closes are reduced to one row per ticker before the window sees them.
    """
    known = closes.filter("close is not null")
    before = known.filter(F.col("event_date") < first)
    last_before = first_per_key(before, ["ticker"], [F.desc("event_date")])
    inside = known.filter(F.col("event_date").between(first, last))
    after = known.filter(F.col("event_date") > last)
    next_day = first_per_key(after, ["ticker"], ["event_date"])
    rows = last_before.unionByName(inside).unionByName(next_day)
    return price_change(rows).filter(F.col("event_date") >= first)


def price_backfill(
    closes: DataFrame, start: str | dt.date, end: str | dt.date, buffer_days: int = 7
) -> DataFrame:
    """Changes for [start, end], reading some days before start for the first change."""
    first, last = F.lit(str(start)).cast("date"), F.lit(str(end)).cast("date")
    day = F.col("event_date").cast("date")
    read = closes.filter(day.between(F.date_sub(first, buffer_days), last))
    return price_change(read).filter(day >= first)
