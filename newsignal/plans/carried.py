"""State that a run of the daily job carries to the next one.

A snapshot holds what later days need to know of all days up to its date: the last close
of each ticker, or the last joined rows of each ticker's correlation window.  A run reads
the latest snapshot before its first date and only what was stored after it, so a day in
order costs what that day holds, and a restated day the days from there on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from newsignal.operators import correlate, prices
from newsignal.sources import files, sinks, tables

AS_OF = "as_of"
WINDOW_ROWS = 7


def forget_from(spark: SparkSession, state: str, date: str) -> None:
    """Drops the snapshots that know of ``date`` or later.

    Comes before the data of the date is replaced: a run that breaks off leaves no
    snapshot of rows that are no longer stored.
    """
    for day in files.partitions(spark, state, AS_OF):
        if day >= date:
            files.delete(spark, f"{state}/{AS_OF}={day}")


def snapshot_before(spark: SparkSession, state: str, date: str) -> tuple[str, DataFrame | None]:
    """Date and rows of the latest snapshot before ``date``; ("", None) if there is none."""
    days = [day for day in files.partitions(spark, state, AS_OF) if day < date]
    if not days:
        return "", None
    return days[-1], spark.read.parquet(f"{state}/{AS_OF}={days[-1]}")


def keep(rows: DataFrame, state: str, date: str) -> None:
    """Stores the snapshot of ``date``."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{state}/{AS_OF}={date}")


def stored_after(spark: SparkSession, path: str, day: str, date: str = "event_date") -> DataFrame:
    """The rows of a dataset after a day; earlier folders are neither listed nor read."""
    return tables.read_dates(spark, path, [d for d in files.partitions(spark, path, date) if d > day], date)


def last_closes(closes: DataFrame) -> DataFrame:
    """One row per ticker: its last known close, from one close per ticker and day."""
    known = closes.filter("close is not null")
    others = [c for c in closes.columns if c not in ("ticker", "event_date")]
    return known.groupBy("ticker").agg(
        *[F.max_by(c, "event_date").alias(c) for c in others], F.max("event_date").alias("event_date")
    ).select(*closes.columns)


def known_closes(
    spark: SparkSession, path: str, state: str, first: str, early: DataFrame | None = None,
) -> DataFrame:
    """Closes that changes from ``first`` on can depend on.

    The last closes of the snapshot and the closes stored at ``path`` after it.  ``early``
    are closes from before the first run, one per ticker and day, as far as they are not
    stored.
    """
    as_of, carried = snapshot_before(spark, state, first)
    known = stored_after(spark, path, as_of)
    if early is not None:
        between = early.filter((F.col("event_date") > as_of) & (F.col("event_date") < first))
        known = known.unionByName(between.join(known, ["ticker", "event_date"], "left_anti").select(*known.columns))
    return known if carried is None else known.unionByName(carried)


def renewed_prices(
    spark: SparkSession, closes: str, stored: str, state: str, dates: list[str], early: DataFrame | None = None,
) -> tuple[DataFrame, list[str]]:
    """Price rows to replace after the closes of ``dates`` were stored, and their dates.

    These are the days of the run and each ticker's next day.  The next day of one ticker
    may hold rows of others, which are taken from ``stored`` as they are.  Writes the
    snapshot of the last date; ``forget_from`` must have gone before the closes.
    """
    first, last = min(dates), max(dates)
    known = known_closes(spark, closes, state, first, early)
    keep(last_closes(known.filter(F.col("event_date") <= last)), state, last)
    changed = prices.changes_around(known, first, last)
    days = sorted({*dates, *(r["event_date"] for r in changed.select("event_date").distinct().collect())})
    after = [day for day in days if day > last]
    if after:
        others = tables.read_dates(spark, stored, after, "event_date")
        changed = changed.unionByName(
            others.join(changed.select("ticker", "event_date"), ["ticker", "event_date"], "left_anti")
            .select(*changed.columns)
        )
    return changed, days


def last_rows(joined: DataFrame, n: int) -> DataFrame:
    """The last ``n`` rows of each ticker; map tasks drop all others before the shuffle."""
    newest = Window.partitionBy("ticker").orderBy(F.desc("event_date"))
    return joined.withColumn("_rn", F.row_number().over(newest)).filter(F.col("_rn") <= n).drop("_rn")


def joined_since(spark: SparkSession, daily: str, stored_prices: str, state: str, first: str) -> DataFrame:
    """The joined rows that correlations from ``first`` on can depend on: tail and later days."""
    as_of, tail = snapshot_before(spark, state, first)
    joined = correlate.sentiment_price_join(
        stored_after(spark, daily, as_of), stored_after(spark, stored_prices, as_of)
    )
    return joined if tail is None else joined.unionByName(tail)


def renewed_correlation(
    spark: SparkSession, daily: str, stored_prices: str, state: str, dates: list[str], rows: int = WINDOW_ROWS,
) -> DataFrame:
    """Correlations of all stored days from the first date on.

    Days after the run's look back at it, so they are renewed as well; a run in order has
    none.  Writes the tail of the last date; ``forget_from`` must have gone before the
    daily rows and prices of the dates were replaced.
    """
    first, last = min(dates), max(dates)
    joined = joined_since(spark, daily, stored_prices, state, first)
    keep(last_rows(joined.filter(F.col("event_date") <= last), rows - 1), state, last)
    return correlate.rolling_corr(joined, rows).filter(F.col("event_date") >= first)


def run_closes(
    spark: SparkSession, fresh: DataFrame, store: str, dates: list[str], early: DataFrame | None = None,
) -> tuple[int, list[str]]:
    """Replaces the closes of ``dates`` by ``fresh`` (one per ticker and day) and renews the prices.

    Works on ``closes``, ``prices`` and their snapshots below ``store``.  Returns the price
    rows written and their dates.
    """
    state = f"{store}/carried/closes"
    forget_from(spark, state, min(dates))
    # The tail of the correlation knows prices, of which the next days change too.
    forget_from(spark, f"{store}/carried/tail", min(dates))
    sinks.replace_dates(fresh, f"{store}/closes", dates, "event_date")
    changed, days = renewed_prices(spark, f"{store}/closes", f"{store}/prices", state, dates, early)
    return sinks.replace_dates(changed, f"{store}/prices", days, "event_date"), days


def run_correlation(spark: SparkSession, store: str, dates: list[str]) -> DataFrame:
    """``renewed_correlation`` of the daily rows and prices below ``store``."""
    return renewed_correlation(
        spark, f"{store}/daily", f"{store}/prices", f"{store}/carried/tail", dates
    )
