"""The default company dictionary and macro topics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from newsignal import schemas
from newsignal.sources.tables import local_table

# Ticker, full name, short name, industry.
COMPANIES = [
    ("AAPL", "Apple Inc.", "Apple", "Technology"),
    ("MSFT", "Microsoft Corporation", "Microsoft", "Technology"),
    ("AMZN", "Amazon.com Inc.", "Amazon", "Consumer Discretionary"),
    ("AXP", "American Express Company", "American Express", "Financials"),
    ("AMGN", "Amgen Inc.", "Amgen", "Healthcare"),
    ("BA", "The Boeing Company", "Boeing", "Industrials"),
    ("CAT", "Caterpillar Inc.", "Caterpillar", "Industrials"),
    ("CRM", "Salesforce Inc.", "Salesforce", "Technology"),
    ("CSCO", "Cisco Systems Inc.", "Cisco", "Technology"),
    ("CVX", "Chevron Corporation", "Chevron", "Energy"),
    ("DIS", "The Walt Disney Company", "Disney", "Communication Services"),
    ("GS", "The Goldman Sachs Group Inc.", "Goldman Sachs", "Financials"),
    ("HD", "The Home Depot Inc.", "Home Depot", "Consumer Discretionary"),
    ("HON", "Honeywell International Inc.", "Honeywell", "Industrials"),
    ("IBM", "International Business Machines Corporation", "IBM", "Technology"),
    ("JNJ", "Johnson & Johnson", "Johnson & Johnson", "Healthcare"),
    ("JPM", "JPMorgan Chase & Co.", "JPMorgan", "Financials"),
    ("KO", "The Coca-Cola Company", "Coca-Cola", "Consumer Staples"),
    ("MCD", "McDonald's Corporation", "McDonald's", "Consumer Discretionary"),
    ("MMM", "3M Company", "3M", "Industrials"),
    ("MRK", "Merck & Co. Inc.", "Merck", "Healthcare"),
    ("NKE", "Nike Inc.", "Nike", "Consumer Discretionary"),
    ("PG", "The Procter & Gamble Company", "Procter & Gamble", "Consumer Staples"),
    ("TRV", "The Travelers Companies Inc.", "Travelers", "Financials"),
    ("UNH", "UnitedHealth Group Incorporated", "UnitedHealth", "Healthcare"),
    ("V", "Visa Inc.", "Visa", "Financials"),
    ("VZ", "Verizon Communications Inc.", "Verizon", "Communication Services"),
    ("WMT", "Walmart Inc.", "Walmart", "Consumer Staples"),
    ("NVDA", "NVIDIA Corporation", "NVIDIA", "Technology"),
    ("SHW", "The Sherwin-Williams Company", "Sherwin-Williams", "Materials"),
]
# Symbols too common in text to count as a mention.
AMBIGUOUS_SYMBOLS = {"V", "BA", "CAT", "GS", "HD", "KO", "MMM", "PG", "TRV"}
# Macro topics.
MACRO_TOPICS = [
    "Fed / Interest Rates", "CPI / Inflation", "Recession / GDP", "Oil / Energy",
    "DXY / Dollar", "Market Sentiment", "Trade / Tariffs", "Jobs / Employment",
]


def company_table(spark: SparkSession) -> DataFrame:
    """The dictionary as an entity table; pass another table to use other companies."""
    rows = [
        (ticker, full, short, industry, ticker not in AMBIGUOUS_SYMBOLS, rank)
        for rank, (ticker, full, short, industry) in enumerate(COMPANIES)
    ]
    return local_table(spark, rows, schemas.ENTITY)


def query_table(entities: DataFrame, topics: list[str]) -> DataFrame:
    """All queries in run order: companies, then macro topics."""
    spark = entities.sparkSession
    companies = entities.selectExpr(
        "'company' as kind", "ticker as name", "query_rank as query_rank"
    )
    macro = local_table(
        spark, [("macro", t, 1_000_000 + i) for i, t in enumerate(topics)], schemas.QUERY_LIST
    )
    return companies.unionByName(macro)
