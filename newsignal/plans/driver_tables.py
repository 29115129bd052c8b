"""The test tables in the shape of articles, mentions, companies and prices.

Each frame has a SQL twin, a common table expression of the same name and columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from newsignal import schemas
from newsignal.functions import numeric
from newsignal.sources.tables import local_table


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


# Invented words and letter groups that occur in the documents: ticker, full name,
# short name, industry, whether the bare symbol counts as a mention.
WORD_ENTITIES = [
    ("MIT", "Thtion Corporation", "thtion", "Technology", True),
    ("GNU", "Eriner Thanea", "eriner", "Technology", True),
    ("THE", "Attion Inc.", "attion", "Energy", False),
    ("ERHE", "Ertion of the", "ertion", "Healthcare", True),
    ("SS", "Réleou Eauoué", "réleou", "Materials", False),
    ("BYNC", "by-nc", "by-nc", "Financials", True),
    ("EXC", "example.com", "Example.com", "Industrials", True),
    ("ER", "erüver enau", "Erüver", "Energy", True),
    ("ZZQ", "Zzyqx Holdings", "zzyqx", "Utilities", True),
]
# The queries of two macro topics return whatever the documents hold.
TOPICS = ["rates", "energy"]
FIRST_DAY, LAST_DAY = "2024-01-01", "2024-01-30"
POSITIVE = ["thtion", "ertion", "thanea", "réleou"]
NEGATIVE = ["attion", "eriner", "licensed", "erüver"]


def word_entities(spark: SparkSession) -> DataFrame:
    rows = [(*e, rank) for rank, e in enumerate(WORD_ENTITIES)]
    return local_table(spark, rows, schemas.ENTITY)


def _values(rows: list[tuple]) -> str:
    def lit(v) -> str:
        if isinstance(v, str):
            return "'" + v.replace("'", "''") + "'"
        return str(v).lower()

    return ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)


WORD_ENTITIES_SQL = (
    "word_entities(ticker, full_name, short_name, industry, symbol_is_safe, query_rank) AS "
    "(VALUES " + _values([(*e, i) for i, e in enumerate(WORD_ENTITIES)]) + ")"
)
# Pattern pieces for SQL: no word character before and after.
SQL_BEFORE, SQL_AFTER = r"(^|[^\p{L}\p{N}_])", r"($|[^\p{L}\p{N}_])"


def articles(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as articles: first line as title, the rest as description.

    German documents have no url; the others get one from their text, padded and in
    capitals for every second copy, so that copies share it only after clean-up.
    """
    n = len(WORD_ENTITIES)
    text = F.col("text")
    title = F.substring_index(text, "\n", 1)
    day = F.date_add(F.lit(FIRST_DAY).cast("date"), (F.col("doc_id") % 30).cast("int"))
    macro = F.col("doc_id") % 5 == 0
    tickers = F.array(*[F.lit(e[0]) for e in WORD_ENTITIES])
    names = F.array(*[F.lit(e[2]) for e in WORD_ENTITIES])
    topics = F.array(*[F.lit(t) for t in TOPICS])
    slot = (F.col("doc_id") % n + 1).cast("int")
    link = F.concat(F.lit("https://news.example/"), F.md5(F.lower(text)))
    padded = F.concat(F.lit("  "), F.upper(link), F.lit(" "))
    return table(spark, sf, "documents").select(
        "doc_id",
        F.date_format(day, "yyyy-MM-dd").alias("date"),
        F.when(macro, "MACRO").otherwise(F.element_at(tickers, slot)).alias("ticker"),
        F.when(macro, F.element_at(topics, (F.col("doc_id") % 2 + 1).cast("int")))
        .otherwise(F.element_at(names, slot))
        .alias("company"),
        F.when(macro, "macro").otherwise("company").alias("article_type"),
        F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit("T00:00:00Z")).alias("publishedAt"),
        "source",
        title.alias("title"),
        F.substring(text, F.length(title) + 2, F.length(text)).alias("description"),
        "lang",
        F.lit(None).cast("string").alias("content"),
        F.when(F.col("lang") != "de", F.when(F.col("doc_id") % 2 == 0, link).otherwise(padded))
        .alias("url"),
    )


def _pick(values: list[str], slot: str) -> str:
    return "list_extract([" + ", ".join(f"'{v}'" for v in values) + f"], {slot})"


_N = len(WORD_ENTITIES)
ARTICLES_SQL = f"""
docs AS (
  SELECT *, split_part(text, chr(10), 1) AS first_line,
    strftime(DATE '{FIRST_DAY}' + CAST(doc_id % 30 AS INTEGER), '%Y-%m-%d') AS day,
    'https://news.example/' || md5(lower(text)) AS link
  FROM documents),
articles AS (
  SELECT doc_id, day AS date,
    CASE WHEN doc_id % 5 = 0 THEN 'MACRO'
         ELSE {_pick([e[0] for e in WORD_ENTITIES], f'doc_id % {_N} + 1')} END AS ticker,
    CASE WHEN doc_id % 5 = 0 THEN {_pick(TOPICS, 'doc_id % 2 + 1')}
         ELSE {_pick([e[2] for e in WORD_ENTITIES], f'doc_id % {_N} + 1')} END AS company,
    CASE WHEN doc_id % 5 = 0 THEN 'macro' ELSE 'company' END AS article_type,
    day || 'T00:00:00Z' AS publishedAt, source, first_line AS title,
    substr(text, length(first_line) + 2) AS description, lang,
    CAST(NULL AS VARCHAR) AS content,
    CASE WHEN lang <> 'de' THEN
      CASE WHEN doc_id % 2 = 0 THEN link ELSE '  ' || upper(link) || ' ' END END AS url
  FROM docs)"""
KEY_SQL = (
    "sha256(lower(CASE WHEN length(trim(url)) > 0 THEN trim(url) "
    "ELSE coalesce(title, '') || coalesce(source, '') || coalesce(publishedAt, '') END))"
)


def hits(spark: SparkSession, sf: str, by_date: bool = False) -> DataFrame:
    """Every document as returned by four of the queries (companies first, then topics).

    ``by_date`` brings the articles of a date together before they are multiplied.
    """
    names = [e[2] for e in WORD_ENTITIES] + TOPICS
    tickers = [e[0] for e in WORD_ENTITIES] + ["MACRO"] * len(TOPICS)
    q = len(names)
    ranks = F.array(*[((F.col("doc_id") + 3 * j) % q).cast("int") for j in range(4)])
    slot = F.col("query_rank") + 1
    found = articles(spark, sf)
    return (
        (found.hint("rebalance", "date") if by_date else found)
        .drop("ticker", "company", "article_type")
        .withColumn("query_rank", F.explode(ranks))
        .withColumn("ticker", F.element_at(F.array(*[F.lit(t) for t in tickers]), slot))
        .withColumn("company", F.element_at(F.array(*[F.lit(t) for t in names]), slot))
        .withColumn(
            "article_type",
            F.when(F.col("ticker") == "MACRO", F.lit("macro")).otherwise(F.lit("company")),
        )
        .withColumn("position", F.col("doc_id"))
    )


_Q = _N + len(TOPICS)
HITS_SQL = (
    ARTICLES_SQL
    + f""",
hits AS (
  SELECT a.* EXCLUDE (ticker, company, article_type), query_rank, doc_id AS position,
    {_pick([e[0] for e in WORD_ENTITIES] + ["MACRO"] * len(TOPICS), 'query_rank + 1')} AS ticker,
    {_pick([e[2] for e in WORD_ENTITIES] + TOPICS, 'query_rank + 1')} AS company,
    CASE WHEN query_rank >= {_N} THEN 'macro' ELSE 'company' END AS article_type
  FROM (SELECT *, unnest([doc_id % {_Q}, (doc_id + 3) % {_Q}, (doc_id + 6) % {_Q},
        (doc_id + 9) % {_Q}]) AS query_rank FROM articles) a),
relevant AS (
  SELECT *, {KEY_SQL} AS dedup_key,
    CASE WHEN article_type = 'macro' THEN company ELSE ticker END AS name
  FROM hits
  WHERE article_type = 'macro'
     OR contains(lower(coalesce(title, '')), lower(company))
     OR contains(lower(coalesce(title, '')), lower(ticker))
     OR contains(lower(coalesce(description, '')), lower(company))
     OR contains(lower(coalesce(description, '')), lower(ticker))),
kept AS (
  SELECT * FROM relevant QUALIFY row_number() OVER (
    PARTITION BY date, dedup_key ORDER BY query_rank, position) = 1),
query_list AS (
  SELECT 'company' AS kind, ticker AS name, query_rank FROM word_entities
  UNION ALL SELECT * FROM (VALUES {_values([("macro", t, 1_000_000 + i) for i, t in enumerate(TOPICS)])})),
manifest AS (
  SELECT s.date, s.kind, s.name, s.query_rank, count(k.name) AS kept
  FROM (SELECT strftime(d, '%Y-%m-%d') AS date, kind, name, query_rank
        FROM query_list, unnest(generate_series(DATE '{FIRST_DAY}', DATE '{LAST_DAY}',
             INTERVAL 1 DAY)) AS t(d)) s
  LEFT JOIN kept k ON k.date = s.date AND k.article_type = s.kind AND k.name = s.name
  GROUP BY ALL)"""
)

LINE_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice"]


def line_mentions(spark: SparkSession, sf: str) -> DataFrame:
    """Line items as scored mentions of their supplier, by month."""
    flag = F.col("l_returnflag")
    return table(spark, sf, "lineitem").select(
        F.col("l_suppkey").cast("string").alias("ticker"),
        F.trunc(F.col("l_shipdate").cast("date"), "month").alias("event_date"),
        F.when(flag == "A", "positive").when(flag == "R", "negative").otherwise("neutral")
        .alias("sentiment_label"),
        numeric.half_even(F.col("l_discount") - F.col("l_tax")).alias("sentiment_score"),
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey").alias("title"),
        *LINE_KEY,
    )


LINE_MENTIONS_SQL = f"""
line_mentions AS (
  SELECT CAST(l_suppkey AS VARCHAR) AS ticker,
    strftime(date_trunc('month', l_shipdate), '%Y-%m-%d') AS event_date,
    CASE l_returnflag WHEN 'A' THEN 'positive' WHEN 'R' THEN 'negative' ELSE 'neutral' END
      AS sentiment_label,
    CAST(round((l_discount - l_tax) * 1e4) AS BIGINT) AS e4,
    concat_ws('-', l_orderkey, l_linenumber, l_partkey) AS title, {", ".join(LINE_KEY)}
  FROM lineitem)"""


def supplier_entities(spark: SparkSession, sf: str) -> DataFrame:
    """Suppliers as companies, their region as the industry."""
    s, n, r = (table(spark, sf, t) for t in ("supplier", "nation", "region"))
    return (
        s.join(n, s["s_nationkey"] == n["n_nationkey"])
        .join(r, n["n_regionkey"] == r["r_regionkey"])
        .select(
            F.col("s_suppkey").cast("string").alias("ticker"),
            F.col("s_name").alias("full_name"),
            F.col("s_name").alias("short_name"),
            F.col("r_name").alias("industry"),
            F.lit(False).alias("symbol_is_safe"),
            F.col("s_suppkey").cast("int").alias("query_rank"),
        )
    )


SUPPLIER_ENTITIES_SQL = """
supplier_entities AS (
  SELECT CAST(s_suppkey AS VARCHAR) AS ticker, s_name AS full_name, r_name AS industry
  FROM supplier JOIN nation ON s_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey)"""


def closes(spark: SparkSession, sf: str) -> DataFrame:
    """Mean price per unit of each supplier's items by order month."""
    line, orders = table(spark, sf, "lineitem"), table(spark, sf, "orders")
    joined = line.join(orders, line["l_orderkey"] == orders["o_orderkey"])
    return joined.groupBy(
        F.col("l_suppkey").cast("string").alias("ticker"),
        F.trunc(F.col("o_orderdate").cast("date"), "month").alias("event_date"),
    ).agg(
        (F.sum(numeric.whole(F.col("l_extendedprice"), 2)) / F.sum("l_quantity") / F.lit(100.0))
        .alias("close")
    )


def even_units(v: str) -> str:
    """SQL for a value rounded half to even to a whole number."""
    return f"CASE WHEN {v} - floor({v}) = 0.5 THEN 2 * round({v} / 2) ELSE round({v}) END"


CLOSES_SQL = f"""
closes AS (
  SELECT CAST(l_suppkey AS VARCHAR) AS ticker,
    CAST(date_trunc('month', o_orderdate) AS DATE) AS day,
    sum(round(l_extendedprice * 1e2)) / sum(l_quantity) / 1e2 AS close
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL),
changes AS (
  SELECT *, (close / nullif(lag(close) OVER (PARTITION BY ticker ORDER BY day), 0) - 1e0) * 1e2
    AS pct FROM closes),
prices AS (
  SELECT ticker, strftime(day, '%Y-%m-%d') AS event_date, day,
    ({even_units('(close * 1e4)')}) / 1e4 AS close_price,
    coalesce({even_units('(pct * 1e4)')}, 0) AS pct_e4
  FROM changes)"""


def event_mentions(spark: SparkSession, sf: str) -> DataFrame:
    """Events as scored mentions of their user, by day, with a time for streams."""
    kind = F.col("event_type")
    return table(spark, sf, "events").select(
        "event_id",
        F.col("user_id").cast("string").alias("ticker"),
        F.col("ts").cast("timestamp").alias("published_ts"),
        F.col("ts").cast("date").alias("event_date"),
        F.when(kind == "purchase", "positive").when(kind == "error", "negative")
        .otherwise("neutral").alias("sentiment_label"),
        numeric.half_even((F.col("value") - F.lit(50.0)) / F.lit(50.0)).alias("sentiment_score"),
    )


EVENT_MENTIONS_SQL = """
event_mentions AS (
  SELECT event_id, CAST(user_id AS VARCHAR) AS ticker, strftime(ts, '%Y-%m-%d') AS event_date,
    CASE event_type WHEN 'purchase' THEN 'positive' WHEN 'error' THEN 'negative'
      ELSE 'neutral' END AS sentiment_label,
    CAST(round((value - 5e1) / 5e1 * 1e4) AS BIGINT) AS e4
  FROM events)"""
