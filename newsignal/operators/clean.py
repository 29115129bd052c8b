"""Cleaning and deduplication of raw articles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from newsignal.functions import text


def first_per_key(df: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """The first row of every key in the given total order.

    The rank filter sits right on the window, so Spark drops the losing rows of each
    map task before the shuffle: a key held by a third of the rows sends at most one
    row per task.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def with_dedup_key(articles: DataFrame) -> DataFrame:
    return articles.withColumn(
        "dedup_key",
        text.dedup_key(F.col("url"), F.col("title"), F.col("source"), F.col("publishedAt")),
    )


ARTICLE_ORDER = [
    "date", "publishedAt", "url", "title", "description", "source", "ticker", "company",
    "article_type", "content",
]


def clean_articles(articles: DataFrame, scope: str = "global") -> DataFrame:
    """Titled articles, one per dedup key.

    ``scope="day"`` keeps one copy per date, ``"global"`` one over all dates.  The
    earliest copy wins, untitled copies never do.
    """
    if scope not in ("day", "global"):
        raise ValueError(f"unknown scope: {scope}")
    titled = with_dedup_key(articles.filter(F.col("title").isNotNull()))
    keys = ["dedup_key"] if scope == "global" else ["date", "dedup_key"]
    order = [c for c in ["query_rank", *ARTICLE_ORDER] if c in titled.columns]
    if "query_rank" in order:  # the query that ran first wins within a day
        order = ["date", F.asc_nulls_last("query_rank"), *[c for c in ARTICLE_ORDER[1:] if c in order]]
    return first_per_key(titled, keys, order)


def not_stored(batch: DataFrame, stored_keys: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of the batch whose key is not among the stored ones.

    The batch is used once: give a stored batch, or one that is cheap to compute.
    """
    return batch.join(stored_keys.select(*keys), keys, "left_anti")
