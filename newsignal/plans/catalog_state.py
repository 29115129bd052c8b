"""Queries over state that runs carry, publish and look up: snapshots, commits, keys, sketches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from newsignal import schemas
from newsignal.functions import numeric
from newsignal.operators import aggregate, clean, coverage, prices, report, scoring, tagging
from newsignal.plans import carried, driver_tables as d
from newsignal.plans.catalog import (
    CLEAN_COLUMNS, CORR_OUT, CORR_SQL, HIT_COLUMNS, LINE_DAILY, INGESTED, MART_COLUMNS, MART_SQL, MATCHES, ORACLES, PCT, QUERIES, SCORED, TAGGED,
    _score, _word_list, cleaned_articles, fresh_marts, line_mart, line_prices, news_sql, query,
    raw_articles, stored_inputs, with_,
)
from newsignal.operators.quality import Expected
from newsignal.plans.daily import Inputs, run_day
from newsignal.plans.catalog_runs import _attempts, rerun_month
from newsignal.session import scratch_dir
from newsignal.sources import articles as article_files, arrays, files, keys, sinks, tables
from newsignal.sources.snapshots import Snapshots
from newsignal.streaming import ingest
from newsignal.streaming.first_wins import first_wins_stream, rocksdb

__all__ = ["ORACLES", "QUERIES"]

# Months of the test tables that are special in these queries.
SECOND, THIRD = "1997-01-01", "1999-01-01"  # runs: before, from the third on, and last those between
WRONG = ["1996-07-01", "1999-02-01"]
GAP = ("1996-01-01", "1996-06-01")
RESTATED = "1998-06-01"
UNCHANGED, KILLED = "2001-06-01", "2001-03-01"


# ---- Carried state ---------------------------------------------------------------------

def text_dates(df: DataFrame) -> DataFrame:
    return df.withColumn("event_date", F.date_format("event_date", "yyyy-MM-dd"))


def stored(df: DataFrame, name: str) -> DataFrame:
    """The frame written to scratch and read back, for one that several runs read."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def months_of(*frames: DataFrame) -> list[str]:
    return sorted({r["event_date"] for df in frames for r in df.select("event_date").distinct().collect()})


def out_of_order(months: list[str]) -> list[list[str]]:
    early, late = [m for m in months if m < SECOND], [m for m in months if m >= THIRD]
    return [early, late, [m for m in months if SECOND <= m < THIRD]]


@query("corr_incremental", CORR_SQL + CORR_OUT)
def corr_incremental(spark, sf):
    """The rolling correlation from runs that read their dates and a tail only.

    The last years run before 1997 and 1998; two months are wrong at first and are
    restated, one of them long after its followers.
    """
    store, out = scratch_dir(spark, "carried"), scratch_dir(spark, "corr")
    daily = text_dates(aggregate.daily_mean(d.line_mentions(spark, sf), ["ticker", "event_date"]))
    price_rows = text_dates(line_prices(spark, sf))
    sinks.write_partitions(daily, f"{store}-daily")
    sinks.write_partitions(price_rows, f"{store}/prices")
    daily = tables.read_partitioned(spark, f"{store}-daily")
    months = months_of(daily)
    turned = daily.withColumn(
        "sentiment_score",
        F.when(F.col("event_date").isin(WRONG), -F.col("sentiment_score")).otherwise(F.col("sentiment_score")),
    )
    early, late, between = out_of_order(months)
    for rows, dates in ((turned, early), (turned, late), (daily, between), (daily, WRONG[1:]), (daily, WRONG[:1])):
        carried.forget_from(spark, f"{store}/carried/tail", min(dates))
        sinks.replace_dates(rows, f"{store}/daily", dates, "event_date")
        sinks.write_partitions(carried.run_correlation(spark, store, dates), out)
    corr = tagging.enrich(tables.read_partitioned(spark, out), d.supplier_entities(spark, sf))
    return corr.select(
        "ticker", "company_name", "industry", "event_date", "sentiment_score", "price_change_pct", "correlation_7d"
    )


CARRIED_CLOSES = d.CLOSES_SQL.replace("changes AS (\n  SELECT *,", f"""kept AS (
  SELECT ticker, day, close * CASE WHEN day = DATE '{RESTATED}' THEN 3 ELSE 1 END AS close FROM closes
  WHERE NOT (day BETWEEN DATE '{GAP[0]}' AND DATE '{GAP[1]}' AND CAST(ticker AS BIGINT) % 3 = 0)),
changes AS (
  SELECT *,""").replace("AS pct FROM closes)", "AS pct FROM kept)")


@query("close_carry", with_(CARRIED_CLOSES) + f"SELECT ticker, event_date, close_price, {PCT} FROM prices")
def close_carry(spark, sf):
    """Price rows from runs that carry each ticker's last close instead of reading all.

    A third of the tickers pause for half a year; 1997 and 1998 come last; one month is
    restated by closes of a later version, and the month behind it follows.
    """
    store = scratch_dir(spark, "closes")
    sinks.write_partitions(text_dates(d.closes(spark, sf)), f"{store}-raw")
    closes = tables.read_partitioned(spark, f"{store}-raw").withColumn("version", F.lit(1)).filter(
        ~(F.col("event_date").between(*GAP) & (F.col("ticker").cast("bigint") % 3 == 0))
    )
    second = closes.filter(F.col("event_date") == RESTATED).withColumns(
        {"close": F.col("close") * 3, "version": F.lit(2)}
    )

    def run(rows: DataFrame, dates: list[str]) -> None:
        chosen = rows.filter(F.col("event_date").isin(dates))
        one = prices.one_close_per_day(chosen, [F.desc("version"), F.desc("close")]).drop("version")
        carried.run_closes(spark, one, store, dates)

    for dates in out_of_order(months_of(closes)):
        run(closes, dates)
    run(closes.unionByName(second), [RESTATED])
    return tables.read_partitioned(spark, f"{store}/prices")


# ---- Published snapshots ---------------------------------------------------------------

PUBLISHED = with_(d.LINE_MENTIONS_SQL, d.CLOSES_SQL, LINE_DAILY) + """,
first_mart AS (SELECT ticker, event_date, -mention_count AS mention_count FROM line_daily),
last_mart AS (SELECT ticker, event_date, mention_count FROM line_daily),
seen AS (
  SELECT s.seen, m.* FROM first_mart m, (VALUES ('first'), ('killed'), ('bound')) s(seen)
  UNION ALL SELECT 'last', * FROM last_mart WHERE event_date <> 'UNCHANGED'
  UNION ALL SELECT 'last', * FROM first_mart WHERE event_date = 'UNCHANGED')
SELECT seen, event_date, count(*) AS n_rows, CAST(sum(mention_count) AS BIGINT) AS mentions,
  CAST(any_value(n_prices) AS BIGINT) AS n_prices
FROM seen JOIN (SELECT event_date, count(*) AS n_prices FROM prices GROUP BY event_date) USING (event_date)
GROUP BY seen, event_date""".replace("UNCHANGED", UNCHANGED)


@query("publish_atomic", PUBLISHED)
def publish_atomic(spark, sf):
    """Two marts per month as readers see them around a publication that is killed halfway.

    ``first``: after the first commit.  ``killed``: after a writer has stored all dates of
    one mart and died within the other's.  ``last``: after it has run again for all months
    but one.  ``bound``: a reader of the first commit, opened before and used after.
    """
    marts = Snapshots(spark, scratch_dir(spark, "published"))
    sentiment = stored(text_dates(line_mart(spark, sf).select("ticker", "event_date", "mention_count")), "monthly-mart")
    first = sentiment.withColumn("mention_count", -F.col("mention_count"))
    price_rows = stored(text_dates(line_prices(spark, sf)).select("ticker", "close_price", "event_date"), "monthly-prices")
    months, priced = months_of(sentiment), months_of(price_rows)
    version = marts.publish({"company_sentiment": (first, months), "price_data": (price_rows, priced)})

    def seen(name: str, at: int | None = None) -> DataFrame:
        n = marts.read("price_data", at).groupBy("event_date").agg(F.count(F.lit(1)).alias("n_prices"))
        rows = marts.read("company_sentiment", at).groupBy("event_date").agg(
            F.count(F.lit(1)).alias("n_rows"), F.sum("mention_count").alias("mentions")
        )
        return rows.join(n, "event_date").select(F.lit(name).alias("seen"), "event_date", "n_rows", "mentions", "n_prices")

    before, bound = seen("first"), seen("bound", version)
    broken = price_rows.withColumn(
        "close_price",
        F.when(F.col("event_date") == KILLED, F.raise_error(F.lit("killed")).cast("double")).otherwise(F.col("close_price")),
    )
    try:
        marts.publish({"company_sentiment": (sentiment, months), "price_data": (broken, priced)})
    except Exception as e:
        if "killed" not in str(e):
            raise
    killed = seen("killed")
    marts.publish({"company_sentiment": (sentiment, [m for m in months if m != UNCHANGED]), "price_data": (price_rows, priced)})
    marts.vacuum(keep=2, grace=0.0)
    return tables.union_all([before, bound, killed, seen("last")])


@query(
    "run_status",
    f"""SELECT run_date, CAST(attempt AS INTEGER) AS attempt, status FROM (VALUES {_attempts()}) a(run_date, attempt, status)
    QUALIFY row_number() OVER (PARTITION BY run_date ORDER BY attempt DESC) = 1
    ORDER BY run_date DESC LIMIT 28""",
)
def run_status(spark, sf):
    """The last attempt of each of the last 28 days, some of them repeated or failed first."""
    runs = tables.read_mart(spark, rerun_month(spark, sf)[0], "pipeline_runs")
    return report.latest_runs(runs, 28).select("run_date", "attempt", "status")


# ---- Keys, streams, sketches -----------------------------------------------------------

HITS_BYTES = 64 << 20  # of the articles that a file of hits comes from, one for each of its queries
HALVES = ["2024-01-15", "2024-01-30"]


@query("keys_against_history", ORACLES["article_clean"])
def keys_against_history(spark, sf):
    """Global deduplication in two runs, the second against the key table of the first.

    The second run is repeated, which must not let it meet its own keys.
    """
    store, database = scratch_dir(spark, "keyed"), fresh_marts(spark)
    known = keys.create_keys(spark, database)
    rows = raw_articles(spark, sf)
    days = [r["date"] for r in rows.select("date").distinct().collect()]
    early = [day for day in days if day <= HALVES[0]]
    late = [day for day in days if day > HALVES[0]]
    for dates in (early, late, late):
        cleaned = clean.clean_articles(rows.filter(F.col("date").isin(dates)))
        sinks.replace_dates(keys.unseen(cleaned, known, dates), f"{store}/clean", dates)
        keys.replace_keys(tables.read_dates(spark, f"{store}/clean", dates), known, dates)
    return tables.read_partitioned(spark, f"{store}/clean", "date").select(*CLEAN_COLUMNS.split(", "))


@query("stream_first_wins", ORACLES["first_wins"])
def stream_first_wins(spark, sf):
    """First wins among hits that arrive in any order, equal to the batch's choice.

    Files are dealt by hash, so the winner of an article often comes after its rivals.  A
    row of a later month closes all days.  The files, as many as the hits are worth, are one
    batch: between two batches the watermark would pass the days before the latest.
    """
    base = scratch_dir(spark, "first-wins")
    hits = coverage.relevant_hits(d.hits(spark, sf))
    keyed = clean.with_dedup_key(hits).withColumn("period", F.col("date").cast("timestamp"))
    dealt = max(6, 4 * files.size(spark, f"{sf}/documents.parquet") // HITS_BYTES)
    keyed.repartition(dealt, F.xxhash64("url", "company", "position")).write.parquet(f"{base}/in")
    later = keyed.limit(1).withColumns(
        {"period": F.lit("2024-03-01").cast("timestamp"), "date": F.lit("2024-03-01"), "dedup_key": F.lit("closing")}
    )
    later.write.mode("append").parquet(f"{base}/in")
    stream = spark.readStream.schema(keyed.schema).parquet(f"{base}/in")
    rest = [c for c in clean.ARTICLE_ORDER if c in keyed.columns]
    with rocksdb(spark):
        rows = first_wins_stream(stream, ["date", "dedup_key"], ["query_rank", "position", *rest], "period")
        ingest.store_stream(rows, f"{base}/out", f"{base}/state", **ingest.worth(spark, f"{base}/in")).awaitTermination()
    return tables.read_partitioned(spark, f"{base}/out", "date").select(*HIT_COLUMNS.split(", "), "dedup_key")


FACETS = [("ASIA", "1995-01-01", "1996-12-01"), (None, "1995-01-01", "2001-12-01"), ("EUROPE", "1997-01-01", "1998-12-01")]
FACETS_SQL = ", ".join(f"({'NULL' if i is None else repr(i)}, '{a}', '{b}')" for i, a, b in FACETS)


@query(
    "company_sketches",
    MART_SQL + f""", facets AS (SELECT * FROM (VALUES {FACETS_SQL}) f(industry_picked, first_day, last_day))
    SELECT coalesce(industry_picked, 'all') AS picked, first_day, last_day,
      count(DISTINCT company_name) AS companies, true AS estimate_within_error,
      CAST(sum(mention_count) AS BIGINT) AS mentions
    FROM facets JOIN mart ON (industry_picked IS NULL OR industry = industry_picked)
      AND event_date BETWEEN first_day AND last_day
    GROUP BY ALL""",
)
def company_sketches(spark, sf):
    """Distinct companies of facets from stored sketches of each industry and month.

    The exact count stands beside the estimate's verdict: whether it lies within three
    standard errors of it.
    """
    path = scratch_dir(spark, "sketches")
    mart = line_mart(spark, sf)
    aggregate.company_sketches(text_dates(mart)).write.parquet(path)
    stored, out = spark.read.parquet(path), []
    near = F.abs(F.col("estimated") - F.col("companies")) <= 3 * aggregate.SKETCH_ERROR * F.col("companies") + 0.5
    for industry, first, last in FACETS:
        pick = dict(industries=[industry] if industry else None, start=first, end=last)
        estimate = report.sketched_companies(report.apply_facets(stored, **pick))
        exact = report.apply_facets(text_dates(mart), **pick).agg(
            F.count_distinct("company_name").alias("companies"), F.sum("mention_count").alias("mentions")
        )
        facet = [F.lit(industry or "all").alias("picked"), F.lit(first).alias("first_day"), F.lit(last).alias("last_day")]
        out.append((exact.select(*facet, "*"), estimate.select(*facet, "estimated")))
    exact, estimated = map(tables.union_all, zip(*out))
    return exact.join(estimated, ["picked", "first_day", "last_day"]).select(
        "picked", "first_day", "last_day", "companies", near.alias("estimate_within_error"), "mentions"
    )


REFUSED = "mit"


@query(
    "score_in_budget",
    with_(d.WORD_ENTITIES_SQL, d.ARTICLES_SQL, MATCHES, SCORED)
    + f""", tokens AS (
      SELECT dedup_key, regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}_]+') AS w FROM texts),
    shares AS (
      SELECT dedup_key, len(w) AS n_tokens, list_contains(w, '{REFUSED}') AS failed,
        len(list_filter(w, lambda x: x IN ({_word_list(d.POSITIVE)}))) AS p,
        len(list_filter(w, lambda x: x IN ({_word_list(d.NEGATIVE)}))) AS n FROM tokens)
    SELECT dedup_key, CAST(n_tokens AS INTEGER) AS n_tokens, failed,
      CASE WHEN NOT failed THEN CASE WHEN p >= n AND 2 * p + n >= n_tokens THEN 'positive'
        WHEN 2 * n + p >= n_tokens THEN 'negative' ELSE 'neutral' END END AS sentiment_label,
      CASE WHEN NOT failed THEN CAST(p AS BIGINT) END AS positive_tokens
    FROM shares""",
)
def score_in_budget(spark, sf):
    """A model with a limit of 64 tokens over whole texts; it fails on some, which keeps the others.

    Label ties of nearly equal shares do not occur: shares are whole tokens of a text.
    """
    texts = scoring.with_scoring_text(cleaned_articles(spark, sf)).select("dedup_key", "text")
    model = scoring.share_model(d.POSITIVE, d.NEGATIVE, [REFUSED])
    scored = scoring.score_in_budget(texts, model, max_tokens=64, batch_tokens=2048)
    return scored.select(
        "dedup_key", "n_tokens", F.col("score_error").isNotNull().alias("failed"), "sentiment_label",
        F.round(F.col("prob_positive") * F.col("n_tokens")).cast("bigint").alias("positive_tokens"),
    )


# ---- Quality history -------------------------------------------------------------------

BEFORE, HALVED = [f"2024-01-{day:02d}" for day in range(1, 11)], "2024-01-11"
HALF = d.ARTICLES_SQL.replace("FROM docs)", f"FROM docs WHERE day <> '{HALVED}' OR doc_id % 2 = 0)")


SHORT = 0.75


def measured_sql(articles: str) -> str:
    """(tbl, run_date, n): what the run of each day stores."""
    return news_sql(d.WORD_ENTITIES_SQL, articles, INGESTED, TAGGED, SCORED) + """
      SELECT 'articles' AS tbl, date AS run_date, count(*) AS n FROM landed GROUP BY date
      UNION ALL SELECT 'clean', date, count(*) FROM cleaned GROUP BY date
      UNION ALL SELECT 'mentions', event_date, count(*) FROM line_mentions GROUP BY event_date"""


@query(
    "quality_history",
    f"""WITH half AS ({measured_sql(HALF)}), whole AS ({measured_sql(d.ARTICLES_SQL)}),
    tbls AS (SELECT unnest(['articles', 'clean', 'mentions']) AS tbl),
    means AS (SELECT tbl, coalesce(sum(n) FILTER (run_date < '{HALVED}'), 0) / 10 AS mean
      FROM tbls LEFT JOIN half USING (tbl) GROUP BY tbl),
    tried AS (
      SELECT 1 AS attempt, tbl, mean, coalesce(n, 0) AS n FROM means LEFT JOIN half h USING (tbl) WHERE h.run_date = '{HALVED}'
      UNION ALL SELECT 2, tbl, mean, coalesce(n, 0) FROM means LEFT JOIN whole w USING (tbl) WHERE w.run_date = '{HALVED}'),
    judged AS (SELECT attempt, bool_or(n < {SHORT} * mean) AS failed,
        bool_or(n < {SHORT} * mean) FILTER (tbl = 'articles') AS articles_flagged,
        max(n) FILTER (tbl = 'articles') AS n FROM tried GROUP BY attempt),
    days AS (SELECT strftime(t.d, '%Y-%m-%d') AS run_date FROM
      (SELECT unnest(generate_series(DATE '2024-01-01', DATE '2024-01-10', INTERVAL 1 DAY)) AS d) t),
    log AS (
      SELECT run_date, 1 AS attempt, false AS failed, false AS articles_flagged, coalesce(n, 0) AS n
      FROM days LEFT JOIN (SELECT * FROM half WHERE tbl = 'articles') USING (run_date)
      UNION ALL SELECT '{HALVED}', * FROM judged)
    SELECT run_date, attempt, CASE WHEN failed THEN 'failed' ELSE 'success' END AS status, articles_flagged,
      CAST(n AS INTEGER) AS articles_processed,
      1 + (SELECT count(*) FROM judged WHERE NOT failed) AS commits
    FROM log""",
)
def quality_history(spark, sf):
    """The run log of ten whole days, a day with half its articles, and the same day whole.

    The halved day falls behind the mean of the days before it: its run is logged as failed
    and not published.
    """
    database, store = fresh_marts(spark), scratch_dir(spark, "history")
    published = Snapshots(spark, scratch_dir(spark, "checked"))
    base = stored_inputs(spark, sf)
    half = d.articles(spark, sf).filter((F.col("date") != HALVED) | (F.col("doc_id") % 2 == 0))
    halved = schemas.align_to(half, schemas.ARTICLE)
    first, later = Expected(min_days=1), Expected(min_days=1, trailing=10, least_share=SHORT)
    for days, rows, expected in (
        (BEFORE, base.articles, first), ([HALVED], halved, later), ([HALVED], base.articles, later),
    ):
        inputs = Inputs(rows, base.closes, base.entities, base.queries)
        run_day(spark, inputs, store, database, days, score=_score, expected=expected, published=published)
    runs = tables.read_mart(spark, database, "pipeline_runs")
    return runs.select(
        "run_date", "attempt", "status", F.contains("errors", F.concat(F.lit("articles.rows."), "run_date")).alias("articles_flagged"),
        "articles_processed", F.lit(len(published.versions())).cast("long").alias("commits"),
    )


# ---- Lookups in stored marts -----------------------------------------------------------

LOOKED_UP = ("Supplier#000000007", "Supplier#000000004x")


@query(
    "entity_detail_stored",
    MART_SQL + f"""SELECT {MART_COLUMNS} FROM mart WHERE company_name IN {LOOKED_UP}
    QUALIFY row_number() OVER (PARTITION BY company_name ORDER BY event_date DESC) = 1""",
)
def entity_detail_stored(spark, sf):
    """A company's latest row from the stored mart, and none for a name that does not exist.

    The mart's files are sorted by company and hold Bloom filters, so a lookup reads one row
    group of a date at most.
    """
    database = fresh_marts(spark)
    mart = text_dates(line_mart(spark, sf)).withColumn("sample_headlines", F.array().cast("array<string>"))
    sinks.overwrite_mart(mart, database, "company_sentiment")
    tables.collect_statistics(spark, database)
    stored = tables.read_mart(spark, database, "company_sentiment")
    doubles = {
        c: numeric.half_even(F.col(c).cast("double")) for c in ("pct_positive", "pct_negative", "sentiment_score")
    }
    found = tables.union_all([report.entity_detail(stored, name) for name in LOOKED_UP])
    return found.withColumns(doubles).withColumn("mention_count", F.col("mention_count").cast("bigint")).select(
        *MART_COLUMNS.split(", ")
    )


# ---- Large array files -----------------------------------------------------------------

BLOCK = 64 << 10
ARRAY_BYTES = 64 << 20  # of the documents whose articles one array holds


@query(
    "array_file_split",
    with_(d.ARTICLES_SQL) + """
    SELECT date, url, title, description, false AS broken FROM articles
    UNION ALL SELECT 'unknown', NULL, NULL, '{ not json ' || doc_id, true FROM articles WHERE doc_id % 50 = 0""",
)
def array_file_split(spark, sf):
    """Large files with one indented JSON array of articles each, cut into blocks of 64 KB.

    Blocks are dealt over tasks, and records that cross their borders are put together.
    A file has one writer, so there are as many as the documents are worth, one up to 64 MB.
    Broken records among them are kept apart with their text.
    """
    base = scratch_dir(spark, "array")
    arrays_written = 1 + files.size(spark, f"{sf}/documents.parquet") // ARRAY_BYTES
    rows = d.articles(spark, sf)
    record = F.struct(*[F.col(f.name) for f in schemas.ARTICLE])
    body = F.to_json(record, {"pretty": "true", "ignoreNullFields": "false"})
    good = rows.select("doc_id", F.concat(F.lit("  "), F.replace(body, F.lit("\n"), F.lit("\n  ")), F.lit(",")).alias("value"))
    bad = rows.filter("doc_id % 50 = 0").select("doc_id", F.concat(F.lit("  { not json "), "doc_id").alias("value"))
    rows = good.unionByName(bad).withColumn("file", F.pmod(F.xxhash64("doc_id"), F.lit(arrays_written)).cast("int"))
    ends = [(place, value, file) for file in range(arrays_written) for place, value in ((-1, "["), (1 << 62, "]"))]
    every = rows.unionByName(spark.createDataFrame(ends, "doc_id long, value string, file int"))
    placed = every.repartitionById(arrays_written, F.col("file")).sortWithinPartitions("doc_id", F.desc("value"))
    placed.select("value").write.text(f"{base}/in")
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, str(BLOCK))
    try:
        arrays.read_array_files(spark, f"{base}/in", "*.txt").write.parquet(f"{base}/out")
    finally:
        spark.conf.set(key, before)
    read = spark.read.parquet(f"{base}/out")
    broken = article_files.broken_records(read).select(
        "date", F.lit(None).cast("string").alias("url"), F.lit(None).cast("string").alias("title"),
        F.col("text").alias("description"), F.lit(True).alias("broken"),
    )
    whole = article_files.good_articles(read).select("date", "url", "title", "description", F.lit(False).alias("broken"))
    return whole.unionByName(broken)
