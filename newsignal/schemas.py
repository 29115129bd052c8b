"""Table schemas and the projection that makes a frame fit one of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T


STRING, INT, FLOAT, DOUBLE, BOOLEAN = (
    T.StringType(), T.IntegerType(), T.FloatType(), T.DoubleType(), T.BooleanType()
)
STRINGS = T.ArrayType(STRING)


def _struct(strings: str = "", **columns: T.DataType) -> T.StructType:
    """Text columns first, then the others in the order given."""
    types = {**dict.fromkeys(strings.split(), STRING), **columns}
    return T.StructType([T.StructField(name, t) for name, t in types.items()])


ARTICLE = _struct(
    "date ticker company article_type publishedAt source title description content url"
)
PAYLOAD = T.StructType(
    [T.StructField("source", _struct("name"))]
    + _struct("title description content url publishedAt").fields
)
TAGGED = _struct(
    "dedup_key date publishedAt source title description content url article_type ticker "
    "company_name industry"
)
SCORED = _struct(
    "dedup_key date ticker company_name industry title url sentiment_label",
    sentiment_score=DOUBLE, prob_positive=DOUBLE, prob_negative=DOUBLE, prob_neutral=DOUBLE,
)
ENTITY = _struct(
    "ticker full_name short_name industry", symbol_is_safe=BOOLEAN, query_rank=INT
)
QUERY_LIST = _struct("kind name", query_rank=INT)

# Mart tables; the partition column comes last.
PRICE_DATA = _struct(
    "ticker industry", close_price=FLOAT, price_change_pct=FLOAT, event_date=STRING
)
# The ticker is kept so that readers can line the mart up with prices.
COMPANY_SENTIMENT = _struct(
    "ticker company_name industry", sentiment_score=FLOAT, sentiment_label=STRING,
    mention_count=INT, pct_positive=FLOAT, pct_negative=FLOAT, sample_headlines=STRINGS,
    event_date=STRING,
)
SENTIMENT_PRICE_CORRELATION = _struct(
    "ticker company_name industry", sentiment_score=FLOAT, price_change_pct=FLOAT,
    correlation_7d=FLOAT, event_date=STRING,
)
RUN = _struct(
    "run_date status", articles_processed=INT, zero_coverage_tickers=STRINGS, errors=STRING
)
PIPELINE_RUNS = T.StructType([*RUN.fields, T.StructField("attempt", INT)])

MARTS = {
    "price_data": (PRICE_DATA, "event_date"),
    "company_sentiment": (COMPANY_SENTIMENT, "event_date"),
    "sentiment_price_correlation": (SENTIMENT_PRICE_CORRELATION, "event_date"),
    "pipeline_runs": (PIPELINE_RUNS, None),
}
# Columns that readers look single companies up by.  Files are sorted by the first one.
LOOKUPS = {
    "price_data": ("ticker",),
    "company_sentiment": ("company_name", "ticker"),
    "sentiment_price_correlation": ("company_name", "ticker"),
}


def align_to(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select the schema's columns by name, in its order and with its types."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])
