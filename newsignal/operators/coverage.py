"""What each query returned: relevance, first-wins attribution and coverage counts.

A *hit* is one article returned by one query on one day.  Columns used: ``date``,
``ticker``, ``company``, ``article_type``, ``query_rank`` (order in which the queries
run), ``position`` (order inside the answer) and the article columns.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window, functions as F

from newsignal.functions import text
from newsignal.functions.dates import days_between
from newsignal.operators.clean import ARTICLE_ORDER, first_per_key, with_dedup_key


def is_relevant(
    company: Column, ticker: Column, title: Column, description: Column, mode: str = "substring"
) -> Column:
    """Company name or ticker occurs in the title or the description.

    ``mode="substring"`` matches inside words as well, ``"token"`` only whole words.
    """
    found = []
    for field in (title, description):
        lowered = F.lower(text.or_empty(field))
        for target in (F.lower(company), F.lower(ticker)):
            hit = F.contains(lowered, target)
            if mode == "token":
                hit = hit & F.rlike(lowered, text.bounded_pattern_of(target))
            elif mode != "substring":
                raise ValueError(f"unknown mode: {mode}")
            found.append(hit)
    result = found[0]
    for hit in found[1:]:
        result = result | hit
    return F.coalesce(result, F.lit(False))


def _relevant(mode: str) -> Column:
    # Macro topics take whatever their query returns.
    return (F.col("article_type") == "macro") | is_relevant(
        F.col("company"), F.col("ticker"), F.col("title"), F.col("description"), mode
    )


def relevant_hits(hits: DataFrame, mode: str = "substring") -> DataFrame:
    return hits.filter(_relevant(mode))


def first_wins(hits: DataFrame, mode: str = "substring") -> DataFrame:
    """Each article of a day goes to the first query that returned it as relevant."""
    keyed = with_dedup_key(relevant_hits(hits, mode))
    rest = [c for c in ARTICLE_ORDER if c in keyed.columns]
    order = [F.asc_nulls_last("query_rank"), F.asc_nulls_last("position"), *rest]
    return first_per_key(keyed, ["date", "dedup_key"], order)


def query_name() -> Column:
    """Name of the query that an article came from: the macro topic or the ticker."""
    return F.when(F.col("article_type") == "macro", F.col("company")).otherwise(F.col("ticker"))


def as_hits(articles: DataFrame, queries: DataFrame) -> DataFrame:
    """Raw articles as hits: with the rank of the query each one came from.

    Articles of a query that is not listed rank last.
    """
    ranks = queries.select(
        F.col("kind").alias("article_type"), F.col("name").alias("_name"), "query_rank"
    )
    named = articles.withColumn("_name", query_name())
    if "position" not in articles.columns:
        named = named.withColumn("position", F.lit(None).cast("int"))
    return named.join(ranks, ["article_type", "_name"], "left").drop("_name")


def coverage_manifest(
    kept: DataFrame, queries: DataFrame, start: str | dt.date | None = None,
    end: str | dt.date | None = None, dates: list[str] | None = None,
) -> DataFrame:
    """Kept articles per day and query, zeros included, in long form.

    ``queries`` lists every query: kind, name, query_rank.  ``kind`` is company or macro
    and ``name`` the ticker or the macro topic.  The days are those from ``start`` to
    ``end``, or exactly ``dates``.
    """
    if dates is None:
        days = days_between(start, end)
    else:
        days = F.array(*[F.lit(d).cast("date") for d in sorted(dates)])
    spine = queries.select(F.explode(days).alias("day"), "*").select(
        F.date_format("day", "yyyy-MM-dd").alias("date"), "kind", "name", "query_rank"
    )
    name = query_name()
    counts = kept.groupBy(
        "date", F.col("article_type").alias("kind"), name.alias("name")
    ).agg(F.count(F.lit(1)).alias("n"))
    return spine.join(counts, ["date", "kind", "name"], "left").select(
        "date", "kind", "name", "query_rank", F.coalesce("n", F.lit(0)).alias("kept")
    )


def zero_coverage(manifest: DataFrame) -> DataFrame:
    """Companies without a kept article, per day; macro topics are not listed."""
    return manifest.filter((F.col("kind") == "company") & (F.col("kept") == 0)).select(
        "date", F.col("name").alias("ticker"), "query_rank"
    )


def manifest_documents(manifest: DataFrame) -> DataFrame:
    """One nested row per day, the shape of the manifest file.

    A group holds one row per query, so its size is the number of queries.
    """

    def counts(kind: str) -> Column:
        pair = F.when(F.col("kind") == kind, F.struct("query_rank", "name", "kept"))
        listed = F.array_sort(F.collect_list(pair))
        return F.map_from_entries(
            F.transform(listed, lambda p: F.struct(p["name"], p["kept"].cast("int")))
        )

    empty = F.when(
        (F.col("kind") == "company") & (F.col("kept") == 0), F.struct("query_rank", "name")
    )
    return manifest.groupBy("date").agg(
        counts("company").alias("companies"),
        counts("macro").alias("macro"),
        F.transform(F.array_sort(F.collect_list(empty)), lambda p: p["name"]).alias(
            "zero_coverage"
        ),
    )


def run_rows(documents: DataFrame, status: str = "success", errors: str = "") -> DataFrame:
    """Run-log rows from the day manifests: articles kept and companies not covered."""
    total = F.aggregate(
        F.concat(F.map_values("companies"), F.map_values("macro")), F.lit(0), lambda a, x: a + x
    )
    return documents.select(
        F.col("date").alias("run_date"), F.lit(status).alias("status"),
        total.alias("articles_processed"),
        F.col("zero_coverage").alias("zero_coverage_tickers"), F.lit(errors).alias("errors"),
    )


def ingest_funnel(hits: DataFrame, mode: str = "substring") -> DataFrame:
    """Fetched, relevant and kept articles per day and query.

    Copies of an article are counted per (day, key, query) first, so the window that
    looks for the winning query sees at most one row per query.
    """
    flagged = with_dedup_key(hits.withColumn("_rel", _relevant(mode)))
    name = query_name()
    per_article = flagged.groupBy(
        "date", "dedup_key", "query_rank", F.col("article_type").alias("kind"), name.alias("name")
    ).agg(F.count(F.lit(1)).alias("fetched"), F.count_if("_rel").alias("relevant"))
    winner = F.min(F.when(F.col("relevant") > 0, F.col("query_rank"))).over(
        Window.partitionBy("date", "dedup_key")
    )
    return (
        per_article.withColumn("_kept", F.coalesce(F.col("query_rank") == winner, F.lit(False)))
        .groupBy("date", "kind", "name")
        .agg(
            F.sum("fetched").alias("fetched"),
            F.sum("relevant").alias("relevant"),
            F.count_if("_kept").alias("kept"),
        )
    )
