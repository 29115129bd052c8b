"""Every operator as a query over the test tables, with its SQL twin where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from newsignal import schemas
from newsignal.functions import dates, numeric, text
from newsignal.operators import (
    aggregate, clean, correlate, coverage, prices, quality, report, scoring, tagging,
)
from newsignal.plans import driver_tables as d
from newsignal.plans.companies import query_table
from newsignal.plans.daily import Inputs, daily_frames, run_day
from newsignal.session import scratch_dir
from newsignal.sources import articles as article_files, sinks, tables
from newsignal.streaming import daily as stream_daily_ops, dedup, ingest, refresh

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
MODEL = "words-1"


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        QUERIES[name] = lambda spark, sf: plain(f(spark, sf))
        if sql:
            ORACLES[name] = sql
        return f

    return register


def plain(df: DataFrame) -> DataFrame:
    """Dates as text, so that results compare without a date type."""
    return df.select(
        *[
            F.date_format(c.name, "yyyy-MM-dd").alias(c.name)
            if isinstance(c.dataType, T.DateType) else F.col(f"`{c.name}`")
            for c in df.schema
        ]
    )


# ---- SQL pieces ------------------------------------------------------------------------


def with_(*parts: str) -> str:
    return "WITH " + ",\n".join(p.strip() for p in parts) + "\n"


def up(s: str, n: str) -> str:
    """s / n rounded half away from zero, as a number of four decimals."""
    return f"(sign({s}) * ((2 * abs({s}) + {n}) // (2 * {n}))) / 1e4"


def even(s: str, n: str) -> str:
    """s / n rounded half to even, as a number of four decimals."""
    return (
        f"(sign({s}) * CASE WHEN (2 * abs({s})) % (2 * {n}) = {n} "
        f"THEN 2 * ((abs({s}) // {n} + 1) // 2) ELSE (2 * abs({s}) + {n}) // (2 * {n}) END) / 1e4"
    )


def share(label: str) -> str:
    return up(f"(10000 * count(*) FILTER (sentiment_label = '{label}'))", "count(*)")


SHARES = f"{share('positive')} AS pct_positive, {share('negative')} AS pct_negative"
def _sql_found(where: str, needle: str) -> str:
    quoted = needle.replace("'", "''")
    pattern = text.bounded_pattern(needle).replace("'", "''")
    return f"(contains({where}, '{quoted}') AND regexp_matches({where}, '{pattern}'))"


DAY_LABEL = (
    "CASE WHEN 1 - pct_positive - pct_negative > pct_positive THEN 'neutral' "
    "WHEN pct_positive >= pct_negative THEN 'positive' ELSE 'negative' END"
)
LINE_DAILY = f"""
line_daily AS (
  SELECT ticker, event_date, count(*) AS mention_count, {SHARES},
    {up('sum(e4)', 'count(*)')} AS sentiment_score
  FROM line_mentions GROUP BY ALL)"""
MART = f"""
mart AS (
  SELECT ticker, full_name AS company_name, industry, event_date, mention_count, pct_positive,
    pct_negative, sentiment_score, {DAY_LABEL} AS sentiment_label
  FROM line_daily JOIN supplier_entities USING (ticker))"""
MART_SQL = with_(d.LINE_MENTIONS_SQL, d.SUPPLIER_ENTITIES_SQL, LINE_DAILY, MART)
JOINED = f"""
daily_even AS (
  SELECT ticker, event_date, {even('sum(e4)', 'count(*)')} AS sentiment_score,
    count(*) AS mention_count
  FROM line_mentions GROUP BY ALL),
joined AS (
  SELECT s.*, close_price, pct_e4, pct_e4 / 1e4 AS price_change_pct
  FROM daily_even s JOIN prices USING (ticker, event_date))"""
CORR = """
framed AS (
  SELECT *, round(sentiment_score * 1e4) AS x, pct_e4 AS y FROM joined),
sums AS (
  SELECT ticker, event_date, sentiment_score, price_change_pct, close_price,
    count(*) OVER w AS n, sum(x) OVER w AS sx, sum(y) OVER w AS sy, sum(x * x) OVER w AS sxx,
    sum(y * y) OVER w AS syy, sum(x * y) OVER w AS sxy, min(x) OVER w = max(x) OVER w AS flat_x,
    min(y) OVER w = max(y) OVER w AS flat_y
  FROM framed
  WINDOW w AS (PARTITION BY ticker ORDER BY event_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)),
corr AS (
  SELECT ticker, event_date, sentiment_score, price_change_pct, close_price,
    CASE WHEN n < 2 OR flat_x OR flat_y THEN 0 ELSE
      round((n * sxy - sx * sy) / (sqrt(n * sxx - sx * sx) * sqrt(n * syy - sy * sy)) * 1e4)
    END AS r4
  FROM sums)"""
CORR_SQL = with_(d.LINE_MENTIONS_SQL, d.SUPPLIER_ENTITIES_SQL, d.CLOSES_SQL, JOINED, CORR)
NO_MINUS_ZERO = "CASE WHEN r4 = 0 THEN 0e0 ELSE r4 / 1e4 END"


def line_mart(spark: SparkSession, sf: str, label_rule: str = "shares") -> DataFrame:
    """Company-month mart; companies are looked up after the aggregate, on few rows."""
    daily = aggregate.daily_sentiment(
        d.line_mentions(spark, sf), ["ticker", "event_date"], label_rule
    )
    return tagging.enrich(daily, d.supplier_entities(spark, sf))


def line_prices(spark: SparkSession, sf: str) -> DataFrame:
    return prices.price_change(d.closes(spark, sf))


def line_joined(spark: SparkSession, sf: str) -> DataFrame:
    daily = aggregate.daily_mean(d.line_mentions(spark, sf), ["ticker", "event_date"])
    return correlate.sentiment_price_join(daily, line_prices(spark, sf))


def line_corr(spark: SparkSession, sf: str) -> DataFrame:
    return tagging.enrich(
        correlate.rolling_corr(line_joined(spark, sf)), d.supplier_entities(spark, sf)
    )


# ---- Articles --------------------------------------------------------------------------

ARTICLE_ORDER = ", ".join(clean.ARTICLE_ORDER)
CLEAN_COLUMNS = "dedup_key, date, publishedAt, source, title, description, url, ticker"


@query(
    "article_clean",
    with_(d.ARTICLES_SQL)
    + f"""SELECT {CLEAN_COLUMNS} FROM (SELECT *, {d.KEY_SQL} AS dedup_key FROM articles
    WHERE title IS NOT NULL) QUALIFY row_number() OVER (PARTITION BY dedup_key
    ORDER BY {ARTICLE_ORDER}) = 1""",
)
def article_clean(spark, sf):
    return clean.clean_articles(d.articles(spark, sf)).select(*CLEAN_COLUMNS.split(", "))


@query(
    "article_clean_daily",
    with_(d.ARTICLES_SQL)
    + f"""SELECT {CLEAN_COLUMNS} FROM (SELECT *, {d.KEY_SQL} AS dedup_key FROM articles
    WHERE title IS NOT NULL) QUALIFY row_number() OVER (PARTITION BY date, dedup_key
    ORDER BY {ARTICLE_ORDER}) = 1""",
)
def article_clean_daily(spark, sf):
    cleaned = clean.clean_articles(d.articles(spark, sf), scope="day")
    return cleaned.select(*CLEAN_COLUMNS.split(", "))


@query(
    "page_url_dedup",
    """SELECT dedup_key, min(page_id) AS page_id, count(*) AS copies FROM (
      SELECT page_id, sha256(lower(trim(url))) AS dedup_key FROM pages
      UNION ALL SELECT page_id, sha256(lower(trim('  ' || upper(url) || '  '))) FROM pages
      UNION ALL SELECT page_id, sha256(lower(
        regexp_extract(html, '<title>([^<]*)</title>', 1) || 'web' || 'today')) FROM pages)
    GROUP BY dedup_key""",
)
def page_url_dedup(spark, sf):
    """Pages as they are, with padded capital urls, and without a url (keyed by title)."""
    pages = d.table(spark, sf, "pages")
    title = F.regexp_extract("html", r"<title>([^<]*)</title>", 1)
    base = pages.select("page_id", title.alias("title"), "url")
    shouted = base.withColumn("url", F.concat(F.lit("\t "), F.upper("url"), F.lit(" \n")))
    bare = base.withColumn("url", F.lit(None).cast("string"))
    rows = tables.union_all([base, shouted, bare]).withColumns(
        {"source": F.lit("web"), "publishedAt": F.lit("today")}
    )
    return clean.with_dedup_key(rows).groupBy("dedup_key").agg(
        F.min("page_id").alias("page_id"), F.count(F.lit(1)).alias("copies")
    )


HIT_COLUMNS = "date, query_rank, ticker, company, article_type, position"
HITS_CTE = with_(d.WORD_ENTITIES_SQL, d.HITS_SQL)


@query("relevance_filter", HITS_CTE + f"SELECT {HIT_COLUMNS} FROM relevant")
def relevance_filter(spark, sf):
    return coverage.relevant_hits(d.hits(spark, sf)).select(*HIT_COLUMNS.split(", "))


@query(
    "relevance_filter_token",
    HITS_CTE
    + f"""SELECT {HIT_COLUMNS} FROM (SELECT *, lower(coalesce(title, '')) AS t,
      lower(coalesce(description, '')) AS b FROM hits) WHERE article_type = 'macro' OR """
    + " OR ".join(
        f"(query_rank = {rank} AND ("
        + " OR ".join(
            _sql_found(field, target.lower()) for field in "tb" for target in (e[0], e[2])
        )
        + "))"
        for rank, e in enumerate(d.WORD_ENTITIES)
    ),
)
def relevance_filter_token(spark, sf):
    return coverage.relevant_hits(d.hits(spark, sf), "token").select(*HIT_COLUMNS.split(", "))


@query("first_wins", HITS_CTE + f"SELECT {HIT_COLUMNS}, dedup_key FROM kept")
def first_wins(spark, sf):
    return coverage.first_wins(d.hits(spark, sf)).select(*HIT_COLUMNS.split(", "), "dedup_key")


def manifest(spark: SparkSession, sf: str) -> DataFrame:
    queries = query_table(d.word_entities(spark), d.TOPICS)
    kept = coverage.first_wins(d.hits(spark, sf))
    return coverage.coverage_manifest(kept, queries, d.FIRST_DAY, d.LAST_DAY)


@query("coverage_manifest", HITS_CTE + "SELECT date, kind, name, kept FROM manifest")
def coverage_manifest(spark, sf):
    return manifest(spark, sf).select("date", "kind", "name", "kept")


@query(
    "zero_coverage",
    HITS_CTE + "SELECT date, name AS ticker FROM manifest WHERE kind = 'company' AND kept = 0",
)
def zero_coverage(spark, sf):
    return coverage.zero_coverage(manifest(spark, sf)).select("date", "ticker")


@query(
    "manifest_json",
    HITS_CTE
    + """SELECT date,
      string_agg(name || '=' || kept, ',' ORDER BY name) FILTER (kind = 'company') AS companies,
      string_agg(name || '=' || kept, ',' ORDER BY name) FILTER (kind = 'macro') AS macro,
      coalesce(string_agg(name, ',' ORDER BY query_rank)
        FILTER (kind = 'company' AND kept = 0), '') AS zero_coverage
    FROM manifest GROUP BY date""",
)
def manifest_json(spark, sf):
    """Manifests written as one JSON document per day and read back."""
    path = scratch_dir(spark, "manifests")
    sinks.write_manifests(coverage.manifest_documents(manifest(spark, sf)), path)
    schema = (
        "companies map<string,int>, macro map<string,int>, zero_coverage array<string>, "
        "date string"
    )
    back = spark.read.schema(schema).json(path)

    def listed(c: str):
        pairs = F.transform(F.map_entries(c), lambda e: F.concat_ws("=", e["key"], e["value"]))
        return F.array_join(F.array_sort(pairs), ",").alias(c)

    return back.select(
        "date", listed("companies"), listed("macro"),
        F.array_join("zero_coverage", ",").alias("zero_coverage"),
    )


@query(
    "ingest_funnel",
    HITS_CTE
    + """, f AS (SELECT date, article_type AS kind,
        CASE WHEN article_type = 'macro' THEN company ELSE ticker END AS name,
        count(*) AS fetched FROM hits GROUP BY ALL),
      r AS (SELECT date, article_type AS kind, name, count(*) AS relevant FROM relevant
        GROUP BY ALL),
      k AS (SELECT date, article_type AS kind, name, count(*) AS kept FROM kept GROUP BY ALL)
    SELECT date, kind, name, fetched, coalesce(relevant, 0) AS relevant, coalesce(kept, 0) AS kept
    FROM f LEFT JOIN r USING (date, kind, name) LEFT JOIN k USING (date, kind, name)""",
)
def ingest_funnel(spark, sf):
    return coverage.ingest_funnel(d.hits(spark, sf))


# ---- Tagging ---------------------------------------------------------------------------

def _sql_tag(ticker: str, full: str, short: str, _industry: str, safe: bool) -> str:
    found = [_sql_found("low", name.lower()) for name in (full, short)]
    if safe:
        found.append(_sql_found("body", ticker))
    return f"CASE WHEN {' OR '.join(found)} THEN '{ticker}' END"


CLEANED = f"""
cleaned AS MATERIALIZED (
  SELECT * FROM (SELECT *, {d.KEY_SQL} AS dedup_key FROM articles WHERE title IS NOT NULL)
  QUALIFY row_number() OVER (PARTITION BY dedup_key ORDER BY {ARTICLE_ORDER}) = 1)"""
# What the daily job lands: the relevant articles of a day, each from its first query.
INGESTED = f"""
query_list AS (
  SELECT 'company' AS kind, ticker AS name, query_rank FROM word_entities
  UNION ALL SELECT * FROM (VALUES {d._values([("macro", t, 1_000_000 + i) for i, t in enumerate(d.TOPICS)])})),
landed AS MATERIALIZED (
  SELECT * FROM (
    SELECT a.*, query_rank, {d.KEY_SQL} AS dedup_key FROM articles a
    LEFT JOIN query_list ON kind = article_type
      AND name = CASE WHEN article_type = 'macro' THEN company ELSE ticker END
    WHERE article_type = 'macro'
      OR contains(lower(coalesce(title, '')), lower(company))
      OR contains(lower(coalesce(title, '')), lower(ticker))
      OR contains(lower(coalesce(description, '')), lower(company))
      OR contains(lower(coalesce(description, '')), lower(ticker)))
  QUALIFY row_number() OVER (PARTITION BY date, dedup_key ORDER BY query_rank NULLS LAST, {ARTICLE_ORDER}) = 1),
cleaned AS MATERIALIZED (
  SELECT * FROM landed WHERE title IS NOT NULL
  QUALIFY row_number() OVER (
    PARTITION BY dedup_key ORDER BY date, query_rank NULLS LAST, {ARTICLE_ORDER}) = 1)"""
TAGGED = f"""
bodies AS MATERIALIZED (
  SELECT *, coalesce(title, '') || ' ' || coalesce(description, '') AS body, lower(body) AS low
  FROM cleaned),
text_matches AS MATERIALIZED (
  SELECT * FROM (SELECT dedup_key, unnest([
    {", ".join(_sql_tag(*e) for e in d.WORD_ENTITIES)}]) AS tag FROM bodies)
  WHERE tag IS NOT NULL),
tags AS (
  SELECT * FROM text_matches UNION
  SELECT dedup_key, ticker FROM cleaned WHERE article_type = 'company' AND ticker <> 'MACRO'),
mentions AS (
  SELECT c.* EXCLUDE (ticker), t.tag AS ticker, coalesce(full_name, t.tag) AS company_name,
    coalesce(industry, 'Unknown') AS industry
  FROM cleaned c JOIN tags t USING (dedup_key) LEFT JOIN word_entities e ON e.ticker = t.tag)"""
MATCHES = CLEANED + "," + TAGGED
TAG_CTE = with_(d.WORD_ENTITIES_SQL, d.ARTICLES_SQL, MATCHES)


def cleaned_articles(spark: SparkSession, sf: str) -> DataFrame:
    return clean.clean_articles(d.articles(spark, sf))


def tagged_articles(spark: SparkSession, sf: str) -> DataFrame:
    return tagging.combine_tags(
        tagging.match_entities(cleaned_articles(spark, sf), d.word_entities(spark))
    )


def mentions(spark: SparkSession, sf: str) -> DataFrame:
    return tagging.explode_mentions(tagged_articles(spark, sf), d.word_entities(spark))


MATCH_LISTS = TAG_CTE + """SELECT dedup_key, coalesce(tickers, '') AS tickers FROM cleaned
  LEFT JOIN (SELECT dedup_key, string_agg(tag, ',' ORDER BY tag) AS tickers FROM text_matches
    GROUP BY dedup_key) USING (dedup_key)"""


@query("entity_tag", MATCH_LISTS)
def entity_tag(spark, sf):
    rows = d.word_entities(spark).collect()
    tagged = tagging.match_by_expression(cleaned_articles(spark, sf), rows)
    return tagged.select("dedup_key", F.array_join("text_matches", ",").alias("tickers"))


@query("entity_tag_by_anchor", MATCH_LISTS)
def entity_tag_by_anchor(spark, sf):
    tagged = tagging.match_by_anchor(cleaned_articles(spark, sf), d.word_entities(spark))
    return tagged.select("dedup_key", F.array_join("text_matches", ",").alias("tickers"))


@query("entity_mentions", TAG_CTE + f"SELECT {', '.join(schemas.TAGGED.names)} FROM mentions")
def entity_mentions(spark, sf):
    return schemas.align_to(mentions(spark, sf), schemas.TAGGED)


@query(
    "entity_enrich",
    """SELECT l_orderkey, l_linenumber, l_suppkey, l_extendedprice,
      CASE WHEN l_suppkey % 10 = 0 THEN CAST(l_suppkey AS VARCHAR) ELSE s_name END AS company_name,
      CASE WHEN l_suppkey % 10 = 0 THEN 'Unknown' ELSE r_name END AS industry
    FROM lineitem LEFT JOIN (supplier JOIN nation ON s_nationkey = n_nationkey
      JOIN region ON n_regionkey = r_regionkey) ON l_suppkey = s_suppkey""",
)
def entity_enrich(spark, sf):
    """Every line item with its company; a tenth of the companies is not in the dictionary."""
    known = d.supplier_entities(spark, sf).filter(F.col("ticker").cast("bigint") % 10 != 0)
    rows = d.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice",
        F.col("l_suppkey").cast("string").alias("ticker"),
    )
    return tagging.enrich(rows, known).drop("ticker")


@query(
    "mentions_per_entity",
    TAG_CTE
    + "SELECT ticker, company_name, count(*) AS mentions FROM mentions GROUP BY ALL",
)
def mentions_per_entity(spark, sf):
    return tagging.mentions_per_entity(mentions(spark, sf))


@query(
    "unmatched_articles",
    TAG_CTE
    + "SELECT dedup_key, title FROM cleaned WHERE dedup_key NOT IN (SELECT dedup_key FROM tags)",
)
def unmatched_articles(spark, sf):
    return tagging.unmatched_articles(tagged_articles(spark, sf)).select("dedup_key", "title")


# ---- Scoring ---------------------------------------------------------------------------

def _word_list(words: list[str]) -> str:
    return ", ".join(f"'{w}'" for w in words)


SCORED = f"""
texts AS (
  SELECT *, CASE WHEN trim(body, chr(9) || chr(10) || chr(13) || ' ') <> ''
      THEN trim(body, chr(9) || chr(10) || chr(13) || ' ')
      ELSE coalesce(title, 'no text') END AS text
  FROM bodies),
counts AS (
  SELECT dedup_key, count(*) FILTER (w IN ({_word_list(d.POSITIVE)})) AS p,
    count(*) FILTER (w IN ({_word_list(d.NEGATIVE)})) AS n
  FROM (SELECT dedup_key, unnest(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}_]+')) AS w
        FROM texts) GROUP BY dedup_key),
logits AS (
  SELECT dedup_key, coalesce(p, 0) AS p, coalesce(n, 0) AS n,
    greatest(coalesce(p, 0), coalesce(n, 0), 1) AS top
  FROM texts LEFT JOIN counts USING (dedup_key)),
parts AS (
  SELECT dedup_key, p, n, exp(CAST(p - top AS DOUBLE)) AS ep, exp(CAST(n - top AS DOUBLE)) AS en,
    exp(CAST(1 - top AS DOUBLE)) AS eu FROM logits),
scores AS (
  SELECT dedup_key, ep / (ep + en + eu) AS pp, en / (ep + en + eu) AS pn,
    eu / (ep + en + eu) AS pu,
    CASE WHEN p >= n AND p >= 1 THEN 'positive' WHEN n >= 1 THEN 'negative' ELSE 'neutral' END
      AS sentiment_label
  FROM parts)"""
SCORE_CTE = with_(d.WORD_ENTITIES_SQL, d.ARTICLES_SQL, MATCHES, SCORED)
SCORE_SELECT = """SELECT dedup_key, sentiment_label,
  CASE WHEN p = n THEN 0e0 ELSE round((pp - pn) * 1e4) / 1e4 END AS sentiment_score,
  round(pp * 1e6) / 1e6 AS prob_positive, round(pn * 1e6) / 1e6 AS prob_negative,
  round(pu * 1e6) / 1e6 AS prob_neutral FROM scores JOIN parts USING (dedup_key)"""


def _scored_columns(df: DataFrame) -> DataFrame:
    return df.select(
        "dedup_key", "sentiment_label", "sentiment_score",
        *[numeric.half_even(F.col(p), 6).alias(p) for p in scoring.PROBABILITIES],
    )


def _score(df: DataFrame) -> DataFrame:
    return scoring.score_by_words(df, d.POSITIVE, d.NEGATIVE)


@query(
    "scoring_text",
    with_(d.WORD_ENTITIES_SQL, d.ARTICLES_SQL, MATCHES, SCORED)
    + "SELECT dedup_key, sha256(text) AS text_hash, length(text) AS n_chars FROM texts",
)
def scoring_text(spark, sf):
    return scoring.with_scoring_text(cleaned_articles(spark, sf)).select(
        "dedup_key", F.sha2("text", 256).alias("text_hash"),
        F.length("text").cast("bigint").alias("n_chars"),
    )


@query("score_by_words", SCORE_CTE + SCORE_SELECT)
def score_by_words(spark, sf):
    return _scored_columns(_score(scoring.with_scoring_text(cleaned_articles(spark, sf))))


@query("score_with_model", SCORE_CTE + SCORE_SELECT)
def score_with_model(spark, sf):
    texts = scoring.with_scoring_text(cleaned_articles(spark, sf)).select("dedup_key", "text")
    factory = scoring.word_scorer(d.POSITIVE, d.NEGATIVE)
    return _scored_columns(scoring.score_with_model(texts, factory))


@query(
    "label_distribution",
    SCORE_CTE + "SELECT sentiment_label, count(*) AS n FROM scores GROUP BY sentiment_label",
)
def label_distribution(spark, sf):
    scored = _score(scoring.with_scoring_text(cleaned_articles(spark, sf)))
    return scoring.label_distribution(scored)


@query(
    "incremental_scoring",
    SCORE_CTE
    + """SELECT model_version, date, count(*) AS articles,
      count(*) FILTER (sentiment_label = 'positive') AS positive
    FROM scores JOIN cleaned USING (dedup_key), (VALUES ('words-1'), ('words-2')) v(model_version)
    GROUP BY ALL""",
)
def incremental_scoring(spark, sf):
    """Scores the first 20 days, then everything, then all again with a new model."""
    path = scratch_dir(spark, "scores")
    stored = f"{path}-texts"
    sinks.replace_dataset(
        scoring.with_scoring_text(cleaned_articles(spark, sf)).select("dedup_key", "date", "text"), stored
    )
    texts = articles = tables.read_parquet(spark, stored)
    runs = [
        (texts.filter(F.col("date") <= "2024-01-20"), MODEL),
        (texts, MODEL), (texts, MODEL), (texts, "words-2"),
    ]
    for batch, version in runs:
        known = sinks.stored_or_none(spark, path)
        todo = batch if known is None else scoring.pending_articles(batch, known, version)
        scored = _score(todo).drop("text")
        sinks.append_scores(scored.withColumn("model_version", F.lit(version)), path)
    # An overlapping run appends scores that are there already.
    again = _score(texts.filter(F.col("date") <= "2024-01-05")).drop("text")
    sinks.append_scores(again.withColumn("model_version", F.lit(MODEL)), path)
    scores = tables.read_parquet(spark, path)
    both = [
        scoring.attach_scores(articles.select("dedup_key", "date"), scores, v)
        .withColumn("model_version", F.lit(v))
        for v in (MODEL, "words-2")
    ]
    return tables.union_all(both).groupBy("model_version", "date").agg(
        F.count(F.lit(1)).alias("articles"),
        F.count_if(F.col("sentiment_label") == "positive").alias("positive"),
    )


# ---- Aggregates ------------------------------------------------------------------------

EVENT_DAILY = with_(d.EVENT_MENTIONS_SQL) + f"""
SELECT ticker, event_date, count(*) AS mention_count, {SHARES},
  {up('sum(e4)', 'count(*)')} AS sentiment_score
FROM event_mentions GROUP BY ALL"""


@query("daily_sentiment", EVENT_DAILY)
def daily_sentiment(spark, sf):
    daily = aggregate.daily_sentiment(d.event_mentions(spark, sf), ["ticker", "event_date"])
    return daily.drop("sentiment_label")


MART_COLUMNS = (
    "ticker, company_name, industry, event_date, mention_count, pct_positive, pct_negative, "
    "sentiment_score, sentiment_label"
)


@query("sentiment_mart", MART_SQL + f"SELECT {MART_COLUMNS} FROM mart")
def sentiment_mart(spark, sf):
    return line_mart(spark, sf).select(*MART_COLUMNS.split(", "))


@query(
    "day_label_shares",
    EVENT_DAILY.replace("SELECT ticker, event_date, count", "SELECT ticker, event_date, "
    + DAY_LABEL + " AS sentiment_label FROM (SELECT ticker, event_date, count") + ")",
)
def day_label_shares(spark, sf):
    return aggregate.daily_sentiment(
        d.event_mentions(spark, sf), ["ticker", "event_date"]
    ).select("ticker", "event_date", "sentiment_label")


@query(
    "day_label_majority",
    with_(d.EVENT_MENTIONS_SQL)
    + """SELECT ticker, event_date, CASE WHEN p >= n AND p >= u THEN 'positive'
      WHEN n >= u THEN 'negative' ELSE 'neutral' END AS sentiment_label
    FROM (SELECT ticker, event_date, count(*) FILTER (sentiment_label = 'positive') AS p,
      count(*) FILTER (sentiment_label = 'negative') AS n,
      count(*) FILTER (sentiment_label = 'neutral') AS u FROM event_mentions GROUP BY ALL)""",
)
def day_label_majority(spark, sf):
    return aggregate.daily_sentiment(
        d.event_mentions(spark, sf), ["ticker", "event_date"], "majority"
    ).select("ticker", "event_date", "sentiment_label")


@query(
    "sample_headlines",
    with_(d.LINE_MENTIONS_SQL)
    + f"""SELECT ticker, event_date, string_agg(title, '|' ORDER BY rn) AS sample_headlines
    FROM (SELECT *, row_number() OVER (PARTITION BY ticker, event_date
      ORDER BY {', '.join(d.LINE_KEY)}) AS rn FROM line_mentions) WHERE rn <= 3 GROUP BY ALL""",
)
def sample_headlines(spark, sf):
    top = aggregate.sample_headlines(
        d.line_mentions(spark, sf), d.LINE_KEY, keys=["ticker", "event_date"]
    )
    return top.withColumn("sample_headlines", F.array_join("sample_headlines", "|"))


@query(
    "daily_mean_mentions",
    with_(d.EVENT_MENTIONS_SQL)
    + f"""SELECT ticker, event_date, {even('sum(e4)', 'count(*)')} AS sentiment_score,
      count(*) AS mention_count FROM event_mentions GROUP BY ALL""",
)
def daily_mean_mentions(spark, sf):
    return aggregate.daily_mean(d.event_mentions(spark, sf), ["ticker", "event_date"])


@query(
    "rows_per_date",
    "SELECT strftime(ts, '%Y-%m-%d') AS event_date, count(*) AS n FROM events GROUP BY ALL",
)
def rows_per_date(spark, sf):
    return aggregate.rows_per_date(d.event_mentions(spark, sf))


@query(
    "macro_context",
    with_(d.WORD_ENTITIES_SQL, d.ARTICLES_SQL, MATCHES, SCORED, d.EVENT_MENTIONS_SQL)
    + f""", macro AS (
      SELECT date, company AS topic,
        CAST(CASE WHEN pp = pn THEN 0 ELSE round((pp - pn) * 1e4) END AS BIGINT) AS e4
      FROM scores JOIN cleaned USING (dedup_key) WHERE article_type = 'macro'),
    per_day AS (
      SELECT date AS event_date,
        count(*) FILTER (topic = 'rates') AS rates_articles,
        count(*) FILTER (topic = 'energy') AS energy_articles,
        coalesce(sum(e4) FILTER (topic = 'rates'), 0) AS rs,
        coalesce(sum(e4) FILTER (topic = 'energy'), 0) AS es
      FROM macro GROUP BY date)
    SELECT ticker, event_date, mention_count, coalesce(rates_articles, 0) AS rates_articles,
      CASE WHEN rates_articles > 0 THEN {even('rs', 'greatest(rates_articles, 1)')} END
        AS rates_score,
      coalesce(energy_articles, 0) AS energy_articles,
      CASE WHEN energy_articles > 0 THEN {even('es', 'greatest(energy_articles, 1)')} END
        AS energy_score
    FROM (SELECT ticker, event_date, count(*) AS mention_count FROM event_mentions GROUP BY ALL)
    LEFT JOIN per_day USING (event_date)""",
)
def macro_context(spark, sf):
    days = aggregate.daily_mean(d.event_mentions(spark, sf), ["ticker", "event_date"]).select(
        "ticker", "mention_count", F.date_format("event_date", "yyyy-MM-dd").alias("event_date")
    )
    macro = cleaned_articles(spark, sf).filter(F.col("article_type") == "macro")
    scored = _score(scoring.with_scoring_text(macro)).select(
        F.col("date").alias("event_date"), F.col("company").alias("topic"), "sentiment_score"
    )
    return aggregate.macro_context(days, scored, d.TOPICS)


@query(
    "global_metrics",
    with_(d.LINE_MENTIONS_SQL)
    + f"""SELECT count(*) AS n, {even('sum(e4)', 'count(*)')} AS mean_score,
      count(DISTINCT ticker) AS companies FROM line_mentions""",
)
def global_metrics(spark, sf):
    return report.global_metrics(
        d.line_mentions(spark, sf), F.col("sentiment_score"), F.col("ticker")
    )


# ---- Prices and correlation ------------------------------------------------------------

PRICES_CTE = with_(d.CLOSES_SQL)
PCT = "CASE WHEN pct_e4 = 0 THEN 0e0 ELSE pct_e4 / 1e4 END AS price_change_pct"


@query("price_change", PRICES_CTE + f"SELECT ticker, event_date, close_price, {PCT} FROM prices")
def price_change(spark, sf):
    return line_prices(spark, sf)


@query(
    "price_change_backfill",
    with_(
        d.CLOSES_SQL.replace(
            "FROM closes)",
            "FROM closes WHERE day BETWEEN DATE '1998-01-01' - 40 AND DATE '2000-12-01')", 1,
        )
    )
    + f"""SELECT ticker, event_date, close_price, {PCT} FROM prices
    WHERE day >= DATE '1998-01-01'""",
)
def price_change_backfill(spark, sf):
    return prices.price_backfill(
        d.closes(spark, sf), "1998-01-01", "2000-12-01", buffer_days=40
    )


@query(
    "price_rows",
    with_(d.CLOSES_SQL, d.SUPPLIER_ENTITIES_SQL)
    + f"""SELECT ticker, event_date, close_price, {PCT},
      CASE WHEN CAST(ticker AS BIGINT) % 10 = 0 THEN 'Unknown' ELSE industry END AS industry
    FROM prices JOIN supplier_entities USING (ticker)""",
)
def price_rows(spark, sf):
    """Price rows from raw histories that hold some days twice and an unknown ticker."""
    known = d.supplier_entities(spark, sf).filter(F.col("ticker").cast("bigint") % 10 != 0)
    history = d.closes(spark, sf)
    doubled = tables.union_all(
        [history, history.withColumn("close", F.col("close") + 1.0),
         history.withColumn("close", F.lit(None).cast("double"))]
    )
    closes = prices.one_close_per_day(doubled, ["close"])
    return tables.normalize_closes(prices.price_change(closes), known)


JOIN_CTE = with_(d.LINE_MENTIONS_SQL, d.CLOSES_SQL, JOINED)


@query(
    "sentiment_price_join",
    JOIN_CTE
    + f"""SELECT ticker, event_date, sentiment_score, mention_count, close_price, {PCT}
    FROM joined""",
)
def sentiment_price_join(spark, sf):
    return line_joined(spark, sf)


@query(
    "missing_prices",
    with_(d.EVENT_MENTIONS_SQL, d.CLOSES_SQL)
    + """SELECT DISTINCT ticker FROM event_mentions WHERE ticker NOT IN
      (SELECT ticker FROM event_mentions SEMI JOIN
        (SELECT ticker, strftime(day + INTERVAL 26 YEAR, '%Y-%m-%d') AS event_date FROM closes)
        USING (ticker, event_date))""",
)
def missing_prices(spark, sf):
    """Users without any price on a day they were mentioned, prices moved by 26 years."""
    moved = d.closes(spark, sf).withColumn("event_date", F.add_months("event_date", 12 * 26))
    daily = aggregate.daily_mean(d.event_mentions(spark, sf), ["ticker", "event_date"])
    return correlate.missing_prices(daily, moved)


CORR_OUT = f"""SELECT ticker, full_name AS company_name, industry, event_date, sentiment_score,
  CASE WHEN price_change_pct = 0 THEN 0e0 ELSE price_change_pct END AS price_change_pct,
  {NO_MINUS_ZERO} AS correlation_7d FROM corr JOIN supplier_entities USING (ticker)"""


@query("rolling_corr", CORR_SQL + CORR_OUT)
def rolling_corr(spark, sf):
    return line_corr(spark, sf).select(
        "ticker", "company_name", "industry", "event_date", "sentiment_score",
        "price_change_pct", "correlation_7d",
    )


@query(
    "corr_summary",
    CORR_SQL
    + f"""SELECT ticker, company_name, mean_corr, CASE WHEN mean_corr > 0.1 THEN 'positive'
      WHEN mean_corr < -0.1 THEN 'negative' ELSE 'near-zero' END AS direction
    FROM (SELECT ticker, full_name AS company_name,
      {even('CAST(sum(r4) AS BIGINT)', 'count(*)')} AS mean_corr
      FROM corr JOIN supplier_entities USING (ticker) GROUP BY ALL)""",
)
def corr_summary(spark, sf):
    return correlate.corr_summary(line_corr(spark, sf))


# ---- Reports ---------------------------------------------------------------------------

LATEST = "QUALIFY row_number() OVER (PARTITION BY company_name ORDER BY event_date DESC) = 1"


@query("latest_per_entity", MART_SQL + f"SELECT {MART_COLUMNS} FROM mart {LATEST}")
def latest_per_entity(spark, sf):
    return report.latest_per_entity(line_mart(spark, sf)).select(*MART_COLUMNS.split(", "))


@query(
    "latest_nonnull",
    MART_SQL
    + """SELECT company_name, max(event_date) AS event_date,
      arg_max(sentiment_label, event_date) AS sentiment_label,
      arg_max(sentiment_score, event_date) FILTER (mention_count >= 8) AS sentiment_score
    FROM mart GROUP BY company_name""",
)
def latest_nonnull(spark, sf):
    """Latest non-null value per column; the score is blanked where mentions are few."""
    mart = line_mart(spark, sf).select(
        "company_name", "event_date", "sentiment_label",
        F.when(F.col("mention_count") >= 8, F.col("sentiment_score")).alias("sentiment_score"),
    )
    return report.latest_per_entity(mart, null_skipping=True)


PICK = {"industries": ["ASIA", "EUROPE"], "start": "1996-01-01", "end": "2000-12-31"}
PICK_SQL = (
    "industry IN ('ASIA', 'EUROPE') AND event_date BETWEEN '1996-01-01' AND '2000-12-31'"
)


@query("faceted_filter", MART_SQL + f"SELECT {MART_COLUMNS} FROM mart WHERE {PICK_SQL}")
def faceted_filter(spark, sf):
    return report.apply_facets(line_mart(spark, sf), **PICK).select(*MART_COLUMNS.split(", "))


@query(
    "rankings",
    MART_SQL
    + f"""SELECT company_name, industry, sentiment_label, sentiment_score, mention_count,
      ({d.even_units('(pct_positive * 1e2 * 1e1)')}) / 1e1 AS pct_positive,
      ({d.even_units('(pct_negative * 1e2 * 1e1)')}) / 1e1 AS pct_negative, event_date
    FROM (SELECT * FROM mart WHERE {PICK_SQL}) {LATEST}""",
)
def rankings(spark, sf):
    return report.rankings(line_mart(spark, sf), **PICK)


@query(
    "kpis",
    MART_SQL
    + f""", latest AS (SELECT * FROM (SELECT * FROM mart WHERE {PICK_SQL}) {LATEST})
    SELECT count(*) AS companies,
      count(*) FILTER (sentiment_label = 'positive') AS positive,
      count(*) FILTER (sentiment_label = 'negative') AS negative,
      {even('CAST(sum(round(sentiment_score * 1e4)) AS BIGINT)', 'count(*)')} AS avg_score,
      (SELECT CAST(sum(mention_count) AS BIGINT) FROM mart WHERE {PICK_SQL}) AS total_mentions
    FROM latest""",
)
def kpis(spark, sf):
    return report.kpis(line_mart(spark, sf), **PICK)


@query(
    "facets",
    MART_SQL
    + """SELECT DISTINCT 'industry' AS facet, industry AS value FROM mart
      WHERE industry IS NOT NULL
    UNION ALL SELECT 'first_date', min(event_date) FROM mart
    UNION ALL SELECT 'last_date', max(event_date) FROM mart""",
)
def facets(spark, sf):
    return report.facets(line_mart(spark, sf))


@query(
    "entity_trend",
    MART_SQL
    + """SELECT company_name, event_date, sentiment_score, mention_count,
      event_date = max(event_date) OVER (PARTITION BY company_name) AS is_latest FROM mart""",
)
def entity_trend(spark, sf):
    return report.entity_trend(line_mart(spark, sf))


@query(
    "entity_detail",
    MART_SQL
    + f"""SELECT {MART_COLUMNS} FROM mart WHERE company_name = 'Supplier#000000007'
    ORDER BY event_date DESC LIMIT 1""",
)
def entity_detail(spark, sf):
    return report.entity_detail(line_mart(spark, sf), "Supplier#000000007").select(
        *MART_COLUMNS.split(", ")
    )


@query(
    "overlay",
    CORR_SQL
    + f"""SELECT ticker, full_name AS company_name, event_date, sentiment_score,
      {NO_MINUS_ZERO} AS correlation_7d, close_price
    FROM corr JOIN supplier_entities USING (ticker)""",
)
def overlay(spark, sf):
    return report.overlay(line_corr(spark, sf), line_prices(spark, sf))


@query(
    "name_fix",
    with_(d.LINE_MENTIONS_SQL, d.SUPPLIER_ENTITIES_SQL, LINE_DAILY, MART)
    + "SELECT company_name, industry, event_date, mention_count FROM mart",
)
def name_fix(spark, sf):
    """A mart that holds bare tickers for half of the companies, repaired."""
    mart = line_mart(spark, sf)
    bare = F.col("ticker").cast("bigint") % 2 == 0
    broken = mart.select(
        F.when(bare, F.col("ticker")).otherwise(F.col("company_name")).alias("company_name"),
        F.when(bare, F.lit("Unknown")).otherwise(F.col("industry")).alias("industry"),
        "event_date", "mention_count",
    )
    return report.name_fix(broken, d.supplier_entities(spark, sf))


@query(
    "headlines_normalize",
    """SELECT doc_id, CASE doc_id % 4
        WHEN 0 THEN trim(split_part(text, chr(10), 1)) WHEN 1 THEN source || '|' || lang
        WHEN 2 THEN '' ELSE '' END AS headlines,
      CASE doc_id % 4 WHEN 0 THEN 1 WHEN 1 THEN 2 ELSE 0 END AS n
    FROM documents""",
)
def headlines_normalize(spark, sf):
    """Headlines stored as plain text, as a written list, blank, or missing."""
    kind = F.col("doc_id") % 4
    listed = F.concat(
        F.lit("['"), F.col("source"), F.lit("', '', '"), F.col("lang"), F.lit("']")
    )
    raw = (
        F.when(kind == 0, F.trim(F.substring_index("text", "\n", 1)))
        .when(kind == 1, listed)
        .when(kind == 2, F.lit("  "))
    )
    items = text.parse_headlines(raw)
    return d.table(spark, sf, "documents").select(
        "doc_id", F.array_join(items, "|").alias("headlines"), F.size(items).alias("n")
    )


@query(
    "day_spine",
    f"""SELECT CAST(user_id AS VARCHAR) AS ticker, strftime(d, '%Y-%m-%d') AS day
    FROM (SELECT DISTINCT user_id FROM events),
      unnest(generate_series(DATE '{d.FIRST_DAY}', DATE '{d.LAST_DAY}', INTERVAL 1 DAY)) t(d)""",
)
def day_spine(spark, sf):
    users = d.event_mentions(spark, sf).select("ticker").distinct()
    return users.select(
        "ticker", F.explode(dates.days_between(d.FIRST_DAY, d.LAST_DAY)).alias("day")
    )


CHECKS = f"""SELECT * FROM (
  SELECT unnest(['row_count', 'distinct_event_date', 'null_share_title',
    'duplicates_event_id', 'duplicates_ticker_event_date']) AS "check",
    unnest([n >= 1, days >= 14, TRUE, n = ids, n = pairs]) AS ok,
    unnest([n, days, 0, n - ids, n - pairs]::DOUBLE[]) AS detail
  FROM (SELECT count(*) AS n, count(DISTINCT event_date) AS days,
    count(DISTINCT event_id) AS ids, count(DISTINCT (ticker, event_date)) AS pairs
    FROM event_mentions))"""


@query("expectations", with_(d.EVENT_MENTIONS_SQL) + CHECKS)
def expectations(spark, sf):
    rows = d.event_mentions(spark, sf).withColumn("title", F.col("sentiment_label"))
    return quality.expectations(
        rows,
        [
            quality.min_rows(), quality.min_dates("event_date", 14), quality.max_nulls("title"),
            quality.unique_key("event_id"), quality.unique_key("ticker", "event_date"),
        ],
    )


# ---- Files and tables ------------------------------------------------------------------

RAW_COLUMNS = [c for c in schemas.ARTICLE.names]
RAW_SQL = with_(d.ARTICLES_SQL) + f"SELECT {', '.join(RAW_COLUMNS)} FROM articles"


def raw_articles(spark: SparkSession, sf: str) -> DataFrame:
    return schemas.align_to(d.articles(spark, sf), schemas.ARTICLE)


@query("json_articles", RAW_SQL)
def json_articles(spark, sf):
    """Nested answers of a news service, flattened, written as JSON and read back."""
    path = scratch_dir(spark, "articles")
    payload = d.articles(spark, sf).withColumn("source", F.struct(F.col("source").alias("name")))
    flat = article_files.normalize_payload(
        payload, F.col("date"), F.col("ticker"), F.col("company"), F.col("article_type")
    )
    sinks.write_day_files(flat, path)
    return article_files.good_articles(article_files.read_day_files(spark, path))


@query(
    "incremental_landing",
    with_(d.ARTICLES_SQL)
    + """SELECT date, CASE WHEN date <= '2024-01-20' THEN 'first' ELSE 'second' END AS folder,
      count(*) AS articles FROM articles WHERE date > '2024-01-10' GROUP BY ALL""",
)
def incremental_landing(spark, sf):
    """Two folders hold the same days; ten days are loaded before, the rest lands now."""
    base = scratch_dir(spark, "landing")
    rows = raw_articles(spark, sf)
    folders = [f"{base}/first", f"{base}/second"]
    (rows.filter(F.col("date") <= "2024-01-20").hint("rebalance", "date")
     .write.partitionBy("date").json(folders[0]))
    rows.hint("rebalance", "date").write.partitionBy("date").json(folders[1])
    files = article_files.landing_files(spark, folders, "*.json", "/date=")
    loaded = rows.filter(F.col("date") <= "2024-01-10")
    todo = article_files.new_landing_files(files, loaded)
    back = article_files.read_landed(spark, todo, pattern="*.json", multi_line=False)
    where = F.col("_file")
    return back.select(
        text.path_date(where, "/date=").alias("date"),
        F.regexp_extract(where, "/(first|second)/date=", 1).alias("folder"),
    ).groupBy("date", "folder").agg(F.count(F.lit(1)).alias("articles"))


@query(
    "append_idempotent",
    with_(d.ARTICLES_SQL, d.WORD_ENTITIES_SQL, MATCHES)
    + "SELECT dedup_key, date, title FROM cleaned",
)
def append_idempotent(spark, sf):
    """Three runs over the days, the second one twice; no article is stored twice."""
    path = scratch_dir(spark, "clean")
    spans = [("2024-01-01", "2024-01-10"), ("2024-01-11", "2024-01-20")]
    spans += [spans[1], ("2024-01-21", "2024-01-31")]
    for first, last in spans:
        batch = raw_articles(spark, sf).filter(F.col("date").between(first, last))
        sinks.append_new(clean.clean_articles(batch), path)
    return tables.read_partitioned(spark, path, "date").select("dedup_key", "date", "title")


@query(
    "partitioned_write",
    PRICES_CTE + f"SELECT ticker, event_date, close_price, {PCT} FROM prices",
)
def partitioned_write(spark, sf):
    path = scratch_dir(spark, "prices")
    sinks.write_partitions(line_prices(spark, sf), path)
    return tables.read_partitioned(spark, path)


@query(
    "path_date",
    PRICES_CTE + "SELECT event_date, count(*) AS n FROM prices GROUP BY event_date",
)
def path_date(spark, sf):
    """Dates taken from the paths of the files that hold the rows."""
    path = scratch_dir(spark, "prices")
    sinks.write_partitions(line_prices(spark, sf), path)
    return aggregate.rows_per_date(tables.with_path_date(tables.read_parquet(spark, path)))


@query(
    "partition_overwrite",
    with_(d.LINE_MENTIONS_SQL)
    + """SELECT ticker, event_date,
      CASE WHEN event_date >= '1998-01-01' THEN 2 ELSE 1 END AS run, count(*) AS n
    FROM line_mentions GROUP BY ALL""",
)
def partition_overwrite(spark, sf):
    """A second run replaces the dates it holds; earlier dates stay."""
    path = scratch_dir(spark, "mart")
    counts = d.line_mentions(spark, sf).groupBy("ticker", "event_date").agg(
        F.count(F.lit(1)).alias("n")
    )
    sinks.write_partitions(counts.withColumn("run", F.lit(1)), path)
    late = counts.filter(F.col("event_date") >= F.lit("1998-01-01").cast("date"))
    sinks.write_partitions(late.withColumn("run", F.lit(2)), path)
    return tables.read_partitioned(spark, path)


@query(
    "replace_dataset",
    CORR_SQL + "SELECT ticker, event_date, " + NO_MINUS_ZERO + " AS correlation_7d FROM corr",
)
def replace_dataset(spark, sf):
    path = scratch_dir(spark, "corr")
    rows = line_corr(spark, sf).select("ticker", "event_date", "correlation_7d")
    sinks.replace_dataset(rows.filter("correlation_7d > 0"), path)
    sinks.replace_dataset(rows, path)
    return tables.read_parquet(spark, path)


@query(
    "multi_file_union",
    """SELECT kind, count(*) AS n, CAST(sum(length(text)) AS BIGINT) AS n_chars,
      count(lang) AS with_lang FROM (
      SELECT 'documents' AS kind, text, lang FROM documents
      UNION ALL SELECT 'benchmark', text, NULL FROM benchmark
      UNION ALL SELECT 'conversations', text, NULL FROM conversations) GROUP BY kind""",
)
def multi_file_union(spark, sf):
    """Files of differing columns as one frame."""
    parts = [
        d.table(spark, sf, t).withColumn("kind", F.lit(t))
        for t in ("documents", "benchmark", "conversations")
    ]
    return tables.union_all(parts).groupBy("kind").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.length("text")).alias("n_chars"),
        F.count("lang").alias("with_lang"),
    )


def fresh_marts(spark: SparkSession) -> str:
    """A database of empty marts in the scratch folder."""
    path = scratch_dir(spark, "marts")
    database = "newsignal_" + path.rsplit("-", 1)[1]
    tables.create_marts(spark, database, path)
    return database


@query("mart_tables", MART_SQL + f"SELECT {MART_COLUMNS} FROM mart")
def mart_tables(spark, sf):
    """The company mart written to its table twice and read back.

    Shares and scores are single precision there; four decimals survive it.
    """
    database = fresh_marts(spark)
    mart = line_mart(spark, sf).withColumn(
        "sample_headlines", F.array().cast("array<string>")
    )
    sinks.overwrite_mart(mart, database, "company_sentiment")
    late = mart.filter(F.col("event_date") >= F.lit("2000-01-01").cast("date"))
    sinks.overwrite_mart(late, database, "company_sentiment")
    back = tables.read_mart(spark, database, "company_sentiment")
    doubles = {
        c: numeric.half_even(F.col(c).cast("double"))
        for c in ("pct_positive", "pct_negative", "sentiment_score")
    }
    return back.withColumns(doubles).withColumn(
        "mention_count", F.col("mention_count").cast("bigint")
    ).select(*MART_COLUMNS.split(", "))


@query(
    "run_log_latest",
    HITS_CTE
    + """, runs AS (
      SELECT date AS run_date, CASE WHEN max(z) > 0 THEN 'partial' ELSE 'success' END AS status,
        CAST(sum(kept) AS INTEGER) AS articles_processed, '' AS errors
      FROM (SELECT *, CASE WHEN kind = 'company' AND kept = 0 THEN 1 ELSE 0 END AS z
            FROM manifest) GROUP BY date)
    SELECT * FROM runs ORDER BY run_date DESC LIMIT 10""",
)
def run_log_latest(spark, sf):
    """One logged run per day, with that day's uncovered companies; the last ten."""
    database = fresh_marts(spark)
    documents = coverage.manifest_documents(manifest(spark, sf))
    runs = coverage.run_rows(documents).withColumn(
        "status", F.when(F.size("zero_coverage_tickers") > 0, "partial").otherwise("success")
    )
    sinks.append_runs(runs, database)
    return report.latest_runs(tables.read_mart(spark, database, "pipeline_runs")).drop("attempt")


# ---- Streams ---------------------------------------------------------------------------

def _event_files(spark: SparkSession, sf: str, copies: int = 1) -> tuple[str, T.StructType]:
    """Events as daily files to stream from, each row ``copies`` times."""
    path = f"{scratch_dir(spark, 'events')}/in"
    rows = d.event_mentions(spark, sf).withColumn(
        "copy", F.explode(F.sequence(F.lit(1), F.lit(copies)))
    )
    rows.withColumn("day", F.col("event_date")).hint("rebalance", "day").write.partitionBy(
        "day"
    ).parquet(path)
    return path, rows.schema


def _event_stream(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    reader = spark.readStream.schema(schema).option("recursiveFileLookup", True)
    return reader.option("maxFilesPerTrigger", 10).parquet(path)


@query("stream_ingest", RAW_SQL)
def stream_ingest(spark, sf):
    """Article files streamed into the store in two runs; no file is read twice."""
    base = scratch_dir(spark, "ingest")
    rows = raw_articles(spark, sf)
    for part in (F.col("date") <= "2024-01-15", F.col("date") > "2024-01-15"):
        rows.filter(part).write.mode("append").option("ignoreNullFields", "false").json(
            f"{base}/raw"
        )
        stream = ingest.article_stream(spark, f"{base}/raw", "*.json", multi_line=False)
        worth = ingest.worth(spark, f"{base}/raw")
        for query in ingest.store_articles(stream, f"{base}/store", f"{base}/bad", f"{base}/state", **worth):
            query.awaitTermination()
    back = tables.read_partitioned(spark, f"{base}/store", "date")
    return schemas.align_to(back, schemas.ARTICLE)


@query(
    "stream_dedup",
    with_(d.EVENT_MENTIONS_SQL)
    + "SELECT event_id, ticker, event_date, sentiment_label FROM event_mentions",
)
def stream_dedup(spark, sf):
    """Every event arrives three times; one copy is kept."""
    path, schema = _event_files(spark, sf, copies=3)
    rows = dedup.dedup_stream(
        _event_stream(spark, path, schema), "event_id", "published_ts", "60 days",
        spread=F.col("copy"),
    )
    out = f"{path}/../out"
    ingest.store_stream(rows, out, f"{path}/../state", by=None).awaitTermination()
    return spark.read.parquet(out).select("event_id", "ticker", "event_date", "sentiment_label")


@query("stream_daily", EVENT_DAILY)
def stream_daily(spark, sf):
    path, schema = _event_files(spark, sf)
    daily = stream_daily_ops.daily_stream(_event_stream(spark, path, schema), lateness="60 days")
    out = f"{path}/../out"
    stream_daily_ops.store_updates(daily, out, f"{path}/../state").awaitTermination()
    return stream_daily_ops.current_state(spark, out)


@query("stream_mart_refresh", EVENT_DAILY)
def stream_mart_refresh(spark, sf):
    """Events arrive twice; the mart is rebuilt for the dates each batch touches."""
    path, schema = _event_files(spark, sf, copies=2)
    out = f"{path}/../mart"

    def daily(rows: DataFrame) -> DataFrame:
        return aggregate.daily_sentiment(rows, ["ticker", "event_date"]).drop("sentiment_label")

    refresh.refresh_stream(
        _event_stream(spark, path, schema), f"{path}/../store", out, f"{path}/../state",
        daily, "event_id", ["copy"],
    ).awaitTermination()
    return tables.read_partitioned(spark, out)


# ---- The whole day ---------------------------------------------------------------------

def news_inputs(spark: SparkSession, sf: str) -> Inputs:
    """Documents as articles, and closes of their companies from the events' values."""
    n = len(d.WORD_ENTITIES)
    events = d.table(spark, sf, "events")
    tickers = F.array(*[F.lit(e[0]) for e in d.WORD_ENTITIES])
    closes = events.groupBy(
        F.element_at(tickers, (F.col("user_id") % n + 1).cast("int")).alias("ticker"),
        F.date_format("ts", "yyyy-MM-dd").alias("event_date"),
    ).agg((F.sum(numeric.whole(F.col("value"), 2)) / F.count("value") / 100.0).alias("close"))
    entities = d.word_entities(spark)
    return Inputs(raw_articles(spark, sf), closes, entities, query_table(entities, d.TOPICS))


def stored_inputs(spark: SparkSession, sf: str) -> Inputs:
    """``news_inputs`` for several runs: articles by date and closes, each computed and written once.

    A run then reads the folders of its dates, and no events.
    """
    base, path = news_inputs(spark, sf), scratch_dir(spark, "inputs")
    sinks.write_partitions(base.articles, f"{path}/articles", "date")
    base.closes.write.parquet(f"{path}/closes")
    articles = spark.read.schema(base.articles.schema).parquet(f"{path}/articles")
    closes = spark.read.schema(base.closes.schema).parquet(f"{path}/closes")
    return Inputs(articles.select(*schemas.ARTICLE.names), closes, base.entities, base.queries)


CLOSES = f"""word_closes AS (
      SELECT {d._pick([e[0] for e in d.WORD_ENTITIES], f'user_id % {len(d.WORD_ENTITIES)} + 1')}
        AS ticker, strftime(ts, '%Y-%m-%d') AS event_date,
        sum(round(value * 1e2)) / count(value) / 1e2 AS close FROM events GROUP BY ALL)"""


def news_sql(*parts: str, closes: str = "word_closes") -> str:
    """The SQL of all stages behind ``parts``, which end with ``scores``."""
    return with_(
        *parts, CLOSES,
        f"""word_changes AS (
      SELECT *, (close / nullif(lag(close) OVER (PARTITION BY ticker ORDER BY event_date), 0)
        - 1e0) * 1e2 AS pct FROM {closes}),
    word_prices AS (
      SELECT ticker, event_date, ({d.even_units('(close * 1e4)')}) / 1e4 AS close_price,
        coalesce({d.even_units('(pct * 1e4)')}, 0) AS pct_e4 FROM word_changes),
    line_mentions AS (
      SELECT m.dedup_key, m.publishedAt, m.title, sentiment_label, m.ticker, m.company_name,
        m.industry, m.date AS event_date,
        CAST(CASE WHEN pp = pn THEN 0 ELSE round((pp - pn) * 1e4) END AS BIGINT) AS e4
      FROM mentions m JOIN scores USING (dedup_key)),
    daily_even AS (
      SELECT ticker, company_name, industry, event_date,
        {even('sum(e4)', 'count(*)')} AS sentiment_score, count(*) AS mention_count
      FROM line_mentions GROUP BY ALL),
    joined AS (
      SELECT s.*, close_price, pct_e4, pct_e4 / 1e4 AS price_change_pct
      FROM daily_even s JOIN word_prices USING (ticker, event_date))""",
        CORR,
    )


NEWS_SQL = news_sql(d.WORD_ENTITIES_SQL, d.ARTICLES_SQL, MATCHES, SCORED)
RUN_SQL = news_sql(d.WORD_ENTITIES_SQL, d.ARTICLES_SQL, INGESTED, TAGGED, SCORED)
NEWS_OUT = f"""SELECT ticker, event_date, sentiment_score,
  CASE WHEN price_change_pct = 0 THEN 0e0 ELSE price_change_pct END AS price_change_pct,
  {NO_MINUS_ZERO} AS correlation_7d FROM corr"""
NEWS_COLUMNS = "ticker, event_date, sentiment_score, price_change_pct, correlation_7d"


@query("news_to_correlation", NEWS_SQL + NEWS_OUT)
def news_to_correlation(spark, sf):
    """All stages in one lazy plan, from raw articles to the rolling correlation."""
    frames = daily_frames(news_inputs(spark, sf), _score)
    return frames["sentiment_price_correlation"].select(*NEWS_COLUMNS.split(", "))


@query("daily_run", RUN_SQL + NEWS_OUT)
def daily_run(spark, sf):
    """The published correlation mart after two runs, the second one repeated."""
    database = fresh_marts(spark)
    store, inputs = scratch_dir(spark, "store"), stored_inputs(spark, sf)
    month = [f"2024-01-{day:02d}" for day in range(1, 31)]
    for days in (month[:15], month[15:], month[15:]):
        run_day(spark, inputs, store, database, days, score=_score)
    back = tables.read_mart(spark, database, "sentiment_price_correlation")
    rounded = {
        c: numeric.half_even(F.col(c).cast("double"))
        for c in ("sentiment_score", "price_change_pct", "correlation_7d")
    }
    return back.withColumns(rounded).select(*NEWS_COLUMNS.split(", "))
