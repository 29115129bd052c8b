"""The daily job: articles and prices in, marts out."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from newsignal import schemas
from newsignal.functions.dates import lookback
from newsignal.operators import (
    aggregate, clean, correlate, coverage, prices, quality, scoring, tagging,
)
from newsignal.plans import carried
from newsignal.sources import articles as article_files, files, keys, sinks, tables
from newsignal.sources.snapshots import Snapshots

HEADLINE_ORDER = ["publishedAt", "dedup_key"]
MENTION = [*schemas.SCORED.names, "publishedAt"]


@dataclass
class Inputs:
    """``articles`` may hold broken records (see ``sources.articles``); ``closes`` may have
    a column ``version``, of which the largest counts for a ticker and day."""

    articles: DataFrame
    closes: DataFrame
    entities: DataFrame
    queries: DataFrame | None = None  # kind, name, query_rank; for the coverage manifest


def full_days(today: dt.date, days: int) -> list[str]:
    """The last ``days`` full days, oldest first: the dates of a scheduled run."""
    first, last = lookback(today, days)
    return [str(first + dt.timedelta(days=i)) for i in range((last - first).days + 1)]


def close_order(closes: DataFrame) -> list:
    return [F.desc("version"), F.desc("close")] if "version" in closes.columns else [F.desc("close")]


def daily_frames(
    inputs: Inputs,
    score: Callable[[DataFrame], DataFrame] = scoring.score_by_words,
    label_rule: str = "shares",
) -> dict[str, DataFrame]:
    """All stages as lazy frames, from clean articles to the correlation summary.

    A preview: the frames share nothing, so each one that is run computes what stands
    before it again.  ``run_day`` stores every stage instead.
    """
    cleaned = clean.clean_articles(article_files.good_articles(inputs.articles))
    tagged = tagging.combine_tags(tagging.match_entities(cleaned, inputs.entities))
    relevant = tagged.filter(F.size("matched_tickers") > 0)
    scored = score(scoring.with_scoring_text(relevant)).drop("text")
    mentions = tagging.explode_mentions(scored, inputs.entities).withColumnRenamed(
        "date", "event_date"
    )
    closes = tables.normalize_closes(inputs.closes, inputs.entities)
    price_rows = prices.price_change(prices.one_close_per_day(closes, close_order(closes)))
    mart = aggregate.sentiment_mart(mentions, HEADLINE_ORDER, label_rule)
    joined = correlate.sentiment_price_join(aggregate.daily_mean(mentions), price_rows)
    corr = correlate.rolling_corr(joined)
    return {
        "articles_clean": cleaned,
        "mentions": mentions,
        "price_data": price_rows,
        "company_sentiment": mart,
        "missing_prices": correlate.missing_prices(mart, price_rows),
        "sentiment_price_correlation": corr,
        "corr_summary": correlate.corr_summary(corr),
    }


def ingest(
    spark: SparkSession, inputs: Inputs, store: str, dates: list[str], mode: str = "substring",
) -> DataFrame | None:
    """Lands the relevant articles of the dates, and one manifest per date.

    The raw articles are parsed once, into a staging set.  Broken records, of the dates or
    of none, go to the quarantine; of the others those that are relevant to their query
    stay, each with the first query that returned it.  Manifests are counted from what was
    stored.  Returns them, one row per date.
    """
    rows = inputs.articles
    parsed = article_files.CORRUPT in rows.columns
    rows = article_files.with_file(rows) if parsed else rows
    staged = f"{store}/staging/raw"
    sinks.replace_dataset(rows.filter(F.col("date").isin(dates) | F.col("date").isNull()), staged)
    raw = spark.read.schema(rows.schema).parquet(staged)
    if parsed:
        broken = article_files.broken_records(raw, run=max(dates))
        sinks.replace_dates(broken, f"{store}/quarantine", [max(dates)], by="run")
    raw = article_files.good_articles(raw).filter("date is not null").drop("_file")
    if inputs.queries is None:
        kept = clean.clean_articles(raw, scope="day")
    else:
        kept = coverage.first_wins(coverage.as_hits(raw, inputs.queries), mode)
    sinks.replace_dates(kept, f"{store}/articles", dates)
    if inputs.queries is None:
        return None
    stored = tables.read_dates(spark, f"{store}/articles", dates)
    manifest = coverage.coverage_manifest(stored, inputs.queries, dates=dates)
    documents = coverage.manifest_documents(manifest)
    sinks.write_manifests(documents, f"{store}/manifests")
    return documents


def run_day(
    spark: SparkSession, inputs: Inputs, store: str, database: str, dates: list[str],
    model_version: str = "words-1",
    score: Callable[[DataFrame], DataFrame] = scoring.score_by_words,
    label_rule: str = "shares", mode: str = "substring",
    expected: quality.Expected | None = None, published: Snapshots | None = None,
) -> dict[str, int]:
    """Runs the given dates and writes the marts; safe to run again.

    Each stage is written below ``store`` and read back, so a lost executor repeats one
    stage only.  A stage replaces exactly its dates, those without rows included.  Besides
    the dates, the next stored price of each ticker and all later correlations are
    renewed; what they need of earlier days is carried from run to run (see ``carried``).
    Each run adds a row per date to the run log: "failed" when it breaks off or when a
    check fails, with the reason.  A run whose checks hold publishes its marts' dates in
    one commit to ``published``.  Returns the rows written by each stage, as the writes
    themselves observed them.
    """
    dates = sorted(dates)
    rows: dict[str, int] = {}
    try:
        documents = ingest(spark, inputs, store, dates, mode)
        written, touched = _write_stages(spark, inputs, store, database, dates, model_version, score, label_rule)
        rows |= written
        record_metrics(spark, store, dates)
        failed = [r["check"] for r in run_checks(spark, store, database, dates, expected).filter("not ok").collect()]
        if published is not None and not failed:
            marts = {t: tables.read_mart(spark, database, t).filter(F.col("event_date").isin(d)) for t, d in touched.items()}
            published.publish({t: (mart, touched[t]) for t, mart in marts.items()})
    except Exception as e:
        _log(spark, database, dates, "failed", f"{type(e).__name__}: {e}"[:2000])
        raise
    status, notes = "failed" if failed else "success", "; ".join(f"check failed: {c}" for c in failed)
    if documents is not None:
        sinks.append_runs(coverage.run_rows(documents, status, notes), database)
    else:
        _log(spark, database, dates, status, notes)
    return rows


def record_metrics(spark: SparkSession, store: str, dates: list[str]) -> None:
    """Stores the rows of each date in articles, clean and mentions, as history for later runs."""
    stages = [("articles", "date"), ("clean", "date"), ("mentions", "event_date")]
    counts = tables.union_all([
        quality.day_metrics(tables.read_dates(spark, f"{store}/{name}", dates, by), name, by) for name, by in stages
    ])
    names = [(name, "rows") for name, _ in stages]
    sinks.replace_dates(quality.with_quiet_days(counts, names, dates), f"{store}/metrics", dates)


def _log(spark: SparkSession, database: str, dates: list[str], status: str, errors: str) -> None:
    runs = spark.createDataFrame([(d, status, 0, [], errors) for d in dates], schemas.RUN)
    sinks.append_runs(runs, database)


def _write_stages(
    spark: SparkSession, inputs: Inputs, store: str, database: str, dates: list[str],
    model_version: str, score: Callable[[DataFrame], DataFrame], label_rule: str,
) -> tuple[dict[str, int], dict[str, list[str]]]:
    """The stages behind ingest: rows written by each, and the dates of each mart."""
    rows: dict[str, int] = {}

    def stage(name: str, date: str = "date") -> DataFrame:
        return tables.read_dates(spark, f"{store}/{name}", dates, date)

    known = keys.create_keys(spark, database)
    cleaned = clean.clean_articles(stage("articles").drop("dedup_key"))
    rows["clean"] = sinks.replace_dates(keys.unseen(cleaned, known, dates), f"{store}/clean", dates)
    keys.replace_keys(stage("clean"), known, dates)

    tagged = tagging.combine_tags(tagging.match_entities(stage("clean"), inputs.entities))
    relevant = scoring.with_scoring_text(tagged.filter(F.size("matched_tickers") > 0))
    rows["tagged"] = sinks.replace_dates(
        relevant.select("dedup_key", "date", "publishedAt", "title", "url", "text", "matched_tickers"),
        f"{store}/tagged", dates,
    )

    scores_path = f"{store}/scores"
    known = sinks.stored_or_none(spark, scores_path)
    texts = stage("tagged").select("dedup_key", "date", "text")
    if known is not None:
        texts = scoring.pending_articles(texts, known, model_version, dates=dates)
    fresh = score(texts).drop("text").withColumn("model_version", F.lit(model_version))
    sinks.append_scores(fresh, scores_path)

    scores = sinks.stored_or_none(spark, scores_path)
    narrow = stage("tagged").drop("text")
    if scores is None:  # nothing was ever relevant
        scored = narrow.limit(0).withColumns(
            {f.name: F.lit(None).cast(f.dataType) for f in schemas.SCORED if f.name not in narrow.columns}
        )
    else:
        scored = scoring.attach_scores(narrow, scores, model_version, dates=dates)
    mentions = tagging.explode_mentions(scored, inputs.entities).select(*MENTION)
    rows["mentions"] = sinks.replace_dates(
        mentions.withColumnRenamed("date", "event_date"), f"{store}/mentions", dates, "event_date"
    )
    mentions = stage("mentions", "event_date")
    rows["company_sentiment"] = sinks.overwrite_mart(
        aggregate.sentiment_mart(mentions, HEADLINE_ORDER, label_rule), database,
        "company_sentiment", dates,
    )
    carried.forget_from(spark, f"{store}/carried/tail", dates[0])
    rows["daily"] = sinks.replace_dates(
        aggregate.daily_mean(mentions), f"{store}/daily", dates, "event_date"
    )

    def one_close(closes: DataFrame) -> DataFrame:
        rows = tables.normalize_closes(closes, inputs.entities)
        return prices.one_close_per_day(rows, close_order(rows)).select(
            "ticker", "industry", F.col("close").cast("double").alias("close"),
            F.col("event_date").cast("string").alias("event_date"),
        )

    day = F.col("event_date").cast("string")
    fresh, early = inputs.closes.filter(day.isin(dates)), inputs.closes.filter(day < dates[0])
    rows["price_data"], price_days = carried.run_closes(
        spark, one_close(fresh), store, dates, one_close(early)
    )
    sinks.overwrite_mart(
        tables.read_dates(spark, f"{store}/prices", price_days, "event_date"), database,
        "price_data", price_days,
    )

    # Later days look back at the days of this run, so they are renewed as well.
    renewed = carried.run_correlation(spark, store, dates)
    mart = tables.read_mart(spark, database, "sentiment_price_correlation")
    later = mart.filter(F.col("event_date") >= dates[0]).select("event_date").distinct().collect()
    corr_days = sorted({*dates, *price_days, *(r["event_date"] for r in later)})
    rows["correlation"] = sinks.overwrite_mart(renewed, database, "sentiment_price_correlation", corr_days)
    return rows, {
        "company_sentiment": dates, "price_data": price_days, "sentiment_price_correlation": corr_days
    }


def run_checks(
    spark: SparkSession, store: str, database: str, dates: list[str], expected: quality.Expected | None = None,
) -> DataFrame:
    """Checks of the stores and marts on the dates of a run: (table, check, ok, detail).

    With ``expected`` also that each of them has rows, that enough raw days are stored, and
    that no date of the run falls behind the recorded days before it.
    """
    expected = expected or quality.Expected()
    least = [] if expected.min_rows is None else [quality.min_rows(expected.min_rows)]

    def check(table: str, df: DataFrame, rules: list[quality.Rule]) -> DataFrame:
        return quality.expectations(df, rules + least).select(
            F.lit(table).alias("table"), F.concat(F.lit(f"{table}."), "check").alias("check"),
            "ok", "detail",
        )

    def mart(name: str) -> DataFrame:
        return tables.read_mart(spark, database, name).filter(F.col("event_date").isin(dates))

    found = tables.union_all(
        [
            check("articles", tables.read_dates(spark, f"{store}/articles", dates),
                  [quality.unique_key("date", "dedup_key"), quality.max_nulls("dedup_key")]),
            check("clean", tables.read_dates(spark, f"{store}/clean", dates),
                  [quality.unique_key("dedup_key"), quality.max_nulls("title")]),
            check("mentions", tables.read_dates(spark, f"{store}/mentions", dates, "event_date"),
                  [quality.unique_key("dedup_key", "ticker"), quality.max_nulls("sentiment_label")]),
            check("company_sentiment", mart("company_sentiment"),
                  [quality.unique_key("event_date", "ticker"), quality.max_nulls("sentiment_score")]),
            check("price_data", mart("price_data"), [quality.unique_key("event_date", "ticker")]),
            check("sentiment_price_correlation", mart("sentiment_price_correlation"),
                  [quality.unique_key("event_date", "ticker"), quality.max_nulls("correlation_7d")]),
        ]
    )
    if expected.min_days is not None:
        days = len(files.partitions(spark, f"{store}/articles", "date"))
        row = [("articles", "articles.days", days >= expected.min_days, float(days))]
        found = found.unionByName(spark.createDataFrame(row, found.schema))
    if expected.trailing is not None:
        since = (dt.date.fromisoformat(min(dates)) - dt.timedelta(days=2 * expected.trailing)).isoformat()
        history = tables.read_partitioned(spark, f"{store}/metrics", "date").filter(
            (F.col("date") >= since) & (F.col("date") <= max(dates))
        )
        found = found.unionByName(quality.against_trailing(history, dates, expected).select(
            "table", F.concat_ws(".", "table", "metric", "date").alias("check"), "ok", F.col("value").alias("detail")
        ))
    return found
