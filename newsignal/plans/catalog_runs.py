"""Queries over runs of the daily job that are repeated, fail, or meet broken files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from newsignal import schemas
from newsignal.functions import numeric
from newsignal.plans import driver_tables as d
from newsignal.plans.catalog import (
    DAY_LABEL, HITS_CTE, INGESTED, ORACLES, QUERIES, SCORED, SHARES, TAGGED, _score, fresh_marts,
    news_sql, query, stored_inputs, up,
)
from newsignal.plans.companies import query_table
from newsignal.plans.daily import Inputs, ingest, run_checks, run_day
from newsignal.session import scratch_dir
from newsignal.sources import articles as article_files, sinks, tables
from newsignal.streaming import ingest as stream

__all__ = ["ORACLES", "QUERIES"]

MONTH = [f"2024-01-{day:02d}" for day in range(1, 31)]
QUIET, LOST, RESTATED = MONTH[0], MONTH[11], [MONTH[14], MONTH[19]]
_runs: dict[tuple[str, str], tuple[str, str]] = {}


def _fails(texts: DataFrame) -> DataFrame:
    raise RuntimeError("model not found")


def rerun_month(spark: SparkSession, sf: str) -> tuple[str, str]:
    """The store and the database after a month of runs, made once per session.

    The first day is quiet.  Days 11 to 20 run twice: the second time day 12 has lost its
    articles and the close of day 20 is restated.  Then day 15 is restated alone, a run of
    day 6 fails and is repeated, and the rest of the month is run without day 25, which
    follows last.
    """
    key = (spark.sparkContext.applicationId, sf)
    if key in _runs:
        return _runs[key]
    database, store = fresh_marts(spark), scratch_dir(spark, "rerun")
    base = stored_inputs(spark, sf)

    def run(days: list[str], lost: tuple = (), restated: tuple = (), score=_score) -> None:
        gone = [QUIET, *lost]
        closes = base.closes.withColumn(
            "close", F.when(F.col("event_date").isin(list(restated)), F.col("close") * 2).otherwise(F.col("close"))
        )
        inputs = Inputs(base.articles.filter(~F.col("date").isin(gone)), closes, base.entities, base.queries)
        run_day(spark, inputs, store, database, days, score=score)

    run(MONTH[:1])
    run(MONTH[1:10])
    run(MONTH[10:20])
    run(MONTH[10:20], (LOST,), (RESTATED[1],))
    run([RESTATED[0]], (LOST,), tuple(RESTATED))
    try:
        run([MONTH[5]], score=_fails)
    except RuntimeError:
        pass
    run([MONTH[5]])
    run([x for x in MONTH[20:] if x != MONTH[24]], (LOST,), tuple(RESTATED))
    run([MONTH[24]], (LOST,), tuple(RESTATED))
    _runs[key] = database, store
    return _runs[key]


# The articles that are left in the end, and the closes as restated.
LEFT = d.ARTICLES_SQL.replace("FROM docs)", f"FROM docs WHERE day NOT IN ('{QUIET}', '{LOST}'))")
RESTATED_SQL = f"""restated AS (
  SELECT ticker, event_date,
    close * CASE WHEN event_date IN ('{RESTATED[0]}', '{RESTATED[1]}') THEN 2 ELSE 1 END AS close
  FROM word_closes)"""
LEFT_SQL = news_sql(
    d.WORD_ENTITIES_SQL, LEFT, INGESTED, TAGGED, SCORED, closes="restated"
).replace("word_changes AS (", RESTATED_SQL + ",\n    word_changes AS (")


@query(
    "rerun_company_sentiment",
    LEFT_SQL
    + f""", days AS (
      SELECT ticker, company_name, industry, event_date, count(*) AS mention_count, {SHARES},
        {up('sum(e4)', 'count(*)')} AS sentiment_score,
        array_to_string(list(title ORDER BY publishedAt, dedup_key)[1:3], '|') AS headlines
      FROM line_mentions GROUP BY ALL)
    SELECT *, {DAY_LABEL} AS sentiment_label FROM days""",
)
def rerun_company_sentiment(spark, sf):
    """The company mart after the runs, headlines included."""
    mart = tables.read_mart(spark, rerun_month(spark, sf)[0], "company_sentiment")
    doubles = {
        c: numeric.half_even(F.col(c).cast("double"))
        for c in ("pct_positive", "pct_negative", "sentiment_score")
    }
    return mart.withColumns(doubles).select(
        "ticker", "company_name", "industry", "event_date",
        F.col("mention_count").cast("bigint").alias("mention_count"), *doubles,
        F.array_join("sample_headlines", "|").alias("headlines"), "sentiment_label",
    )


@query(
    "rerun_prices",
    LEFT_SQL
    + """SELECT ticker, event_date, CAST(CAST(close_price AS FLOAT) AS DOUBLE) AS close_price,
      CAST(CAST(CASE WHEN pct_e4 = 0 THEN 0 ELSE pct_e4 / 1e4 END AS FLOAT) AS DOUBLE)
        AS price_change_pct FROM word_prices""",
)
def rerun_prices(spark, sf):
    """The price mart after the runs: the day behind a restated close is right as well."""
    mart = tables.read_mart(spark, rerun_month(spark, sf)[0], "price_data")
    doubles = [F.col(c).cast("double").alias(c) for c in ("close_price", "price_change_pct")]
    return mart.select("ticker", "event_date", *doubles)


MANIFEST_SQL = """, manifest AS (
  SELECT s.date, s.kind, s.name, s.query_rank, count(k.date) AS kept
  FROM (SELECT strftime(t.d, '%Y-%m-%d') AS date, q.* FROM query_list q,
        (SELECT unnest(generate_series(DATE '2024-01-01', DATE '2024-01-30', INTERVAL 1 DAY)) AS d) t) s
  LEFT JOIN landed k ON k.date = s.date AND k.article_type = s.kind
    AND s.name = CASE WHEN k.article_type = 'macro' THEN k.company ELSE k.ticker END
  GROUP BY ALL)"""
LISTED = """SELECT date,
  string_agg(name || '=' || kept, ',' ORDER BY name) FILTER (kind = 'company') AS companies,
  string_agg(name || '=' || kept, ',' ORDER BY name) FILTER (kind = 'macro') AS macro,
  coalesce(string_agg(name, ',' ORDER BY query_rank)
    FILTER (kind = 'company' AND kept = 0), '') AS zero_coverage
FROM manifest GROUP BY date"""


def read_manifests(spark: SparkSession, path: str) -> DataFrame:
    schema = (
        "companies map<string,int>, macro map<string,int>, zero_coverage array<string>, date string"
    )

    def listed(c: str):
        pairs = F.transform(F.map_entries(c), lambda e: F.concat_ws("=", e["key"], e["value"]))
        return F.array_join(F.array_sort(pairs), ",").alias(c)

    return spark.read.schema(schema).json(path).select(
        "date", listed("companies"), listed("macro"),
        F.array_join("zero_coverage", ",").alias("zero_coverage"),
    )


@query("rerun_manifests", LEFT_SQL + MANIFEST_SQL + LISTED)
def rerun_manifests(spark, sf):
    """Manifests after the runs; days without articles have zeros, a gap changes nothing."""
    return read_manifests(spark, f"{rerun_month(spark, sf)[1]}/manifests")


def _attempts() -> str:
    """(run_date, attempt, status, whether day 12 still had its articles)."""
    rows = [(day, 1, "success") for day in MONTH]
    rows += [(day, 2, "success") for day in MONTH[10:20]] + [(RESTATED[0], 3, "success")]
    rows += [(MONTH[5], 2, "failed"), (MONTH[5], 3, "success")]
    return ", ".join(f"('{a}', {b}, '{c}')" for a, b, c in rows)


FULL_SQL = news_sql(
    d.WORD_ENTITIES_SQL, d.ARTICLES_SQL.replace("FROM docs)", f"FROM docs WHERE day <> '{QUIET}')"),
    INGESTED, TAGGED, SCORED,
)


@query(
    "rerun_run_log",
    FULL_SQL
    + f"""SELECT a.run_date, CAST(a.attempt AS INTEGER) AS attempt, a.status,
      CAST(CASE WHEN a.status = 'failed' OR (a.run_date = '{LOST}' AND a.attempt = 2) THEN 0
        ELSE count(l.date) END AS INTEGER) AS articles_processed
    FROM (VALUES {_attempts()}) a(run_date, attempt, status) LEFT JOIN landed l ON l.date = a.run_date
    GROUP BY a.run_date, a.attempt, a.status""",
)
def rerun_run_log(spark, sf):
    """Every attempt of every date, the failed one included."""
    runs = tables.read_mart(spark, rerun_month(spark, sf)[0], "pipeline_runs")
    return runs.select("run_date", "attempt", "status", "articles_processed")


@query(
    "pipeline_checks",
    """SELECT * FROM (VALUES ('articles.duplicates_date_dedup_key'), ('articles.null_share_dedup_key'),
      ('clean.duplicates_dedup_key'), ('clean.null_share_title'),
      ('mentions.duplicates_dedup_key_ticker'), ('mentions.null_share_sentiment_label'),
      ('company_sentiment.duplicates_event_date_ticker'),
      ('company_sentiment.null_share_sentiment_score'), ('price_data.duplicates_event_date_ticker'),
      ('sentiment_price_correlation.duplicates_event_date_ticker'),
      ('sentiment_price_correlation.null_share_correlation_7d')) c("check"),
      (SELECT true AS ok, 0e0 AS detail)""",
)
def pipeline_checks(spark, sf):
    """The checks that a run makes of its stores and marts, over the whole month."""
    database, store = rerun_month(spark, sf)
    return run_checks(spark, store, database, MONTH).drop("table")


# ---- Ingest and broken files -----------------------------------------------------------


def raw_day_files(spark: SparkSession, sf: str) -> str:
    """Every hit of every query as day files, and broken records among them."""
    path = scratch_dir(spark, "raw")
    rows = schemas.align_to(d.hits(spark, sf, by_date=True), schemas.ARTICLE)
    sinks.write_day_files(rows, path, rebalance=False, compression="gzip")
    broken = d.articles(spark, sf).filter("doc_id % 50 = 0").select(
        F.concat(F.lit("{ not json "), F.col("doc_id")).alias("value"), "date"
    )
    broken.write.mode("append").partitionBy("date").text(path)
    return path


def ingested(spark: SparkSession, sf: str) -> str:
    """The store after the raw files of the month were ingested in two runs."""
    raw, store = raw_day_files(spark, sf), scratch_dir(spark, "ingest")
    entities = d.word_entities(spark)
    for days in (MONTH[:20], MONTH[20:]):
        rows = article_files.read_day_files(spark, raw, days)
        inputs = Inputs(rows, None, entities, query_table(entities, d.TOPICS))
        ingest(spark, inputs, store, days)
    return store


@query("ingest_day", HITS_CTE + "SELECT date, dedup_key, ticker, company, article_type FROM kept")
def ingest_day(spark, sf):
    """What is landed of all hits: relevant articles, each from its first query."""
    store = ingested(spark, sf)
    return tables.read_dates(spark, f"{store}/articles", MONTH).select(
        "date", "dedup_key", "ticker", "company", "article_type"
    )


@query("ingest_manifest", HITS_CTE + LISTED)
def ingest_manifest(spark, sf):
    return read_manifests(spark, f"{ingested(spark, sf)}/manifests")


BROKEN_SQL = "WITH " + d.ARTICLES_SQL + """
SELECT date, '{ not json ' || doc_id AS text FROM articles WHERE doc_id % 50 = 0"""


@query("quarantine", BROKEN_SQL)
def quarantine(spark, sf):
    """Broken records among good ones are kept apart, with their text and date."""
    return tables.read_parquet(spark, f"{ingested(spark, sf)}/quarantine").select("date", "text")


@query("stream_quarantine", BROKEN_SQL)
def stream_quarantine(spark, sf):
    """The same for files that arrive as a stream."""
    raw, base = raw_day_files(spark, sf), scratch_dir(spark, "quarantine")
    for _ in range(2):
        rows = stream.article_stream(spark, raw, "part-*", multi_line=False)
        for running in stream.store_articles(rows, f"{base}/good", f"{base}/bad", f"{base}/state", **stream.worth(spark, raw)):
            running.awaitTermination()
    return tables.read_partitioned(spark, f"{base}/bad", "date").select("date", "text")
