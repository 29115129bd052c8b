"""Sentiment against price: join, rolling correlation and its summary."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, WindowSpec, functions as F

from newsignal.functions import numeric

PAIR = ["ticker", "event_date"]


def sentiment_price_join(daily: DataFrame, prices: DataFrame) -> DataFrame:
    """Company-days with a price.  Both sides hold one row per (ticker, event_date)."""
    return daily.join(prices.select(*PAIR, "close_price", "price_change_pct"), PAIR)


def missing_prices(daily: DataFrame, prices: DataFrame) -> DataFrame:
    """Tickers with sentiment but without any day that also has a price."""
    priced = prices.select(*PAIR, F.lit(True).alias("_priced"))
    any_day = daily.select(*PAIR).join(priced, PAIR, "left").groupBy("ticker").agg(
        F.max("_priced").alias("_priced")
    )
    return any_day.filter("_priced is null").select("ticker")


def rolling_pearson(
    df: DataFrame, x: str, y: str, window: WindowSpec, min_pairs: int = 2
) -> DataFrame:
    """Adds ``_r``: Pearson correlation over the frame, null for short or constant frames.

    x and y are taken in whole units of their last published decimal, so the sums are
    exact and do not depend on their order.  Each sum is one window column.
    """
    both = F.col(x).isNotNull() & F.col(y).isNotNull()
    pairs = df.withColumn("_x", F.when(both, numeric.whole(F.col(x)))).withColumn(
        "_y", F.when(both, numeric.whole(F.col(y)))
    )
    a, b = F.col("_x"), F.col("_y")
    measures = {
        "_n": F.count(a), "_sx": F.sum(a), "_sy": F.sum(b), "_sxx": F.sum(a * a),
        "_syy": F.sum(b * b), "_sxy": F.sum(a * b), "_lx": F.min(a), "_hx": F.max(a),
        "_ly": F.min(b), "_hy": F.max(b),
    }
    summed = pairs.withColumns({name: m.over(window) for name, m in measures.items()})
    varied = (F.col("_lx") < F.col("_hx")) & (F.col("_ly") < F.col("_hy"))
    r = F.expr("_n * _sxy - _sx * _sy") / F.nullif(
        F.sqrt(F.expr("_n * _sxx - _sx * _sx")) * F.sqrt(F.expr("_n * _syy - _sy * _sy")),
        F.lit(0.0),
    )
    return summed.withColumn("_r", F.when(varied & (F.col("_n") >= min_pairs), r)).drop(
        "_x", "_y", *measures
    )


def rolling_corr(joined: DataFrame, rows: int = 7) -> DataFrame:
    """Correlation of score and price change over the last ``rows`` joined days.

    The window of a ticker holds one row per day.
    """
    w = Window.partitionBy("ticker").orderBy("event_date").rowsBetween(-(rows - 1), 0)
    return (
        rolling_pearson(joined, "sentiment_score", "price_change_pct", w)
        .withColumn("correlation_7d", F.coalesce(numeric.half_even(F.col("_r")), F.lit(0.0)))
        .drop("_r")
    )


def corr_summary(corr: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Mean correlation per entity with its direction, highest first."""
    keys = by or ["ticker", "company_name"]
    mean = corr.groupBy(*keys).agg(
        numeric.mean_half_even(F.col("correlation_7d")).alias("mean_corr")
    )
    return mean.withColumn("direction", numeric.direction(F.col("mean_corr"))).orderBy(
        F.desc("mean_corr"), *keys
    )
