"""Read-side queries over the marts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from newsignal.functions import numeric
from newsignal.operators.clean import first_per_key


def apply_facets(
    mart: DataFrame, industries: list[str] | None = None, start: str | None = None,
    end: str | None = None, company: str | None = None,
) -> DataFrame:
    """Filters on industry, date range and company; the dates prune mart partitions."""
    out = mart
    if industries is not None:
        out = out.filter(F.col("industry").isin(industries))
    if start is not None:
        out = out.filter(F.col("event_date") >= F.lit(start).cast(mart.schema["event_date"].dataType))
    if end is not None:
        out = out.filter(F.col("event_date") <= F.lit(end).cast(mart.schema["event_date"].dataType))
    if company is not None:
        out = out.filter(F.col("company_name") == company)
    return out


def facets(mart: DataFrame) -> DataFrame:
    """Industries that occur, and the first and last date, as (facet, value) rows.

    The mart is read once; what is left after that is one row per industry.
    """
    per_industry = mart.groupBy("industry").agg(
        F.min("event_date").cast("string").alias("first"),
        F.max("event_date").cast("string").alias("last"),
    )
    pairs = F.create_map(
        F.lit("industry"), F.col("industry"), F.lit("first_date"), F.col("first"),
        F.lit("last_date"), F.col("last"),
    )
    kind = F.col("facet")
    return (
        per_industry.select(F.explode(pairs).alias("facet", "value"))
        .filter("value is not null")
        .groupBy("facet", F.when(kind == "industry", F.col("value")).alias("_industry"))
        .agg(F.min("value").alias("_min"), F.max("value").alias("_max"))
        .select("facet", F.when(kind == "last_date", F.col("_max")).otherwise(F.col("_min")).alias("value"))
        .orderBy("facet", "value")
    )


def _ties(mart: DataFrame, by: str) -> list[str]:
    """All other columns that can be ordered, ticker and industry first."""
    plain = [f.name for f in mart.schema if f.dataType.typeName() not in ("map", "variant")]
    rest = [c for c in plain if c not in (by, "event_date")]
    first = [c for c in ("ticker", "industry") if c in rest]
    return first + [c for c in rest if c not in first]


def latest_per_entity(
    mart: DataFrame, by: str = "company_name", null_skipping: bool = False,
    tie_breaker: list[str] | None = None,
) -> DataFrame:
    """Each entity's latest row; rows without an entity are left out.

    With ``null_skipping`` every column takes its latest non-null value, so one
    output row may mix dates.  Rows of one date are ordered by ``tie_breaker`` and then by
    all other columns, so the choice does not depend on the order of the input.
    """
    ties = [*(tie_breaker or []), *[c for c in _ties(mart, by) if c not in (tie_breaker or [])]]
    mart = mart.filter(F.col(by).isNotNull())
    if not null_skipping:
        return first_per_key(mart, [by], [F.desc("event_date"), *ties])
    rank = F.struct("event_date", *ties)
    latest = [
        F.max_by(F.col(c), F.when(F.col(c).isNotNull(), rank)).alias(c)
        for c in mart.columns if c != by
    ]
    return mart.groupBy(by).agg(*latest).select(*mart.columns)


def rankings(mart: DataFrame, **choice) -> DataFrame:
    """Latest row per company, rounded for display, best score first.

    Of several tickers of a company the first one of the latest day counts.
    """
    latest = latest_per_entity(apply_facets(mart, **choice))
    return latest.select(
        "company_name", "industry", "sentiment_label",
        numeric.half_even(F.col("sentiment_score")).alias("sentiment_score"),
        "mention_count",
        numeric.percent(F.col("pct_positive")).alias("pct_positive"),
        numeric.percent(F.col("pct_negative")).alias("pct_negative"),
        F.date_format("event_date", "yyyy-MM-dd").alias("event_date"),
    ).orderBy(F.desc("sentiment_score"), "company_name")


def kpis(mart: DataFrame, **choice) -> DataFrame:
    """One row: companies, positive and negative ones, mean latest score, all mentions.

    Each company is first reduced to its latest row and mention total.
    """
    chosen = apply_facets(mart, **choice)
    by_company = chosen.groupBy("company_name").agg(F.sum("mention_count").alias("mentions"))
    latest = latest_per_entity(chosen).select(
        "company_name", F.struct("sentiment_label", "sentiment_score").alias("latest")
    )
    per_company = by_company.join(latest, "company_name", "left")
    named = F.col("company_name").isNotNull()
    label = F.when(named, F.col("latest.sentiment_label"))
    return per_company.agg(
        F.count("company_name").alias("companies"),
        F.count_if(label == "positive").alias("positive"),
        F.count_if(label == "negative").alias("negative"),
        numeric.mean_half_even(F.when(named, F.col("latest.sentiment_score"))).alias("avg_score"),
        F.sum("mentions").alias("total_mentions"),
    )


def sketched_companies(sketches: DataFrame) -> DataFrame:
    """One row: estimated number of companies and all mentions of chosen ``company_sketches``."""
    merged = F.hll_union_agg("companies")
    return sketches.agg(
        F.coalesce(F.hll_sketch_estimate(merged), F.lit(0)).alias("estimated"),
        F.sum("mention_count").alias("total_mentions"),
    )


def entity_trend(mart: DataFrame, **choice) -> DataFrame:
    """Score and mentions over time per company, the last day flagged.

    One row per company and day, so a company's window is as long as its days.
    """
    last = F.max("event_date").over(Window.partitionBy("company_name"))
    return (
        apply_facets(mart, **choice)
        .select(
            "company_name", "event_date", "sentiment_score", "mention_count",
            (F.col("event_date") == last).alias("is_latest"),
        )
        .orderBy("company_name", "event_date")
    )


def entity_detail(mart: DataFrame, company: str, **choice) -> DataFrame:
    """The chosen company's latest row."""
    chosen = apply_facets(mart, company=company, **choice)
    return chosen.orderBy(F.desc("event_date"), *_ties(chosen, "company_name")).limit(1)


def overlay(corr: DataFrame, prices: DataFrame) -> DataFrame:
    """Score, close and correlation of each company-day in one row."""
    return corr.select(
        "ticker", "company_name", "event_date", "sentiment_score", "correlation_7d"
    ).join(prices.select("ticker", "event_date", "close_price"), ["ticker", "event_date"], "left")


def name_fix(df: DataFrame, entities: DataFrame) -> DataFrame:
    """Replaces names and industries that hold a bare ticker by the dictionary's."""
    dim = entities.select(
        F.col("ticker").alias("company_name"),
        F.col("full_name").alias("_name"),
        F.col("industry").alias("_industry"),
    )
    return (
        df.join(dim, "company_name", "left")
        .withColumn("industry", F.coalesce("_industry", "industry"))
        .withColumn("company_name", F.coalesce("_name", "company_name"))
        .drop("_name", "_industry")
        .select(*df.columns)
    )


def latest_runs(runs: DataFrame, n: int = 10) -> DataFrame:
    """The last attempt of each of the ``n`` most recent run dates, newest first.

    A log without attempts counts each row as the first one of its date.
    """
    if "attempt" not in runs.columns:
        runs = runs.withColumn("attempt", F.lit(1))
    last = first_per_key(runs, ["run_date"], [F.desc("attempt"), "status", "articles_processed", "errors"])
    return (
        last.select("run_date", "status", "articles_processed", "errors", "attempt")
        .orderBy(F.desc("run_date"))
        .limit(n)
    )


def global_metrics(df: DataFrame, score: Column, company: Column) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("n"),
        numeric.mean_half_even(score).alias("mean_score"),
        F.count_distinct(company).alias("companies"),
    )
