"""Tag articles with the entities of a dictionary table.

The dictionary, of any size, is joined on a word of each name (its *anchor*), and only
the candidates found that way are checked against the text.  A caller who knows that the
dictionary is short can ask for one expression per entity instead, which needs no
shuffle.  Both give the same sorted tags.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row, functions as F

from newsignal.functions import text

MACRO = "MACRO"


def _no_tags() -> Column:
    return F.array().cast("array<string>")


def _has_word(name: str | None) -> bool:
    return bool(name) and re.search(r"\w", name) is not None


def _names(entity: Row) -> list[str]:
    names = (entity["full_name"], entity["short_name"])
    return sorted({n.lower() for n in names if _has_word(n)})


def _found(where: Column, needle: str) -> Column:
    # The plain search is cheap and rules out most texts before the regex runs.
    return F.contains(where, F.lit(needle)) & F.rlike(where, F.lit(text.bounded_pattern(needle)))


def _once(c: Column) -> Column:
    """Generates the value as a row of its own, so it is computed a single time.

    A plain column would be copied into every filter on it, and the search with it.
    """
    return F.explode_outer(F.array(c))


def match_by_expression(articles: DataFrame, entities: Sequence[Row]) -> DataFrame:
    """Adds ``text_matches``: tickers whose name or safe symbol occurs in the article.

    Names match in any letter case, symbols only as written and only when safe.
    """
    raw, low = F.col("_text"), F.col("_lower")
    hits = []
    for entity in entities:
        found = F.lit(False)
        for name in _names(entity):
            found = found | _found(low, name)
        if entity["symbol_is_safe"] and _has_word(entity["ticker"]):
            found = found | _found(raw, entity["ticker"])
        hits.append(F.when(found, F.lit(entity["ticker"])))
    matches = F.array_sort(F.array_distinct(F.array_compact(F.array(*hits)))) if hits else _no_tags()
    return (
        articles.withColumn("_text", text.match_text(F.col("title"), F.col("description")))
        .withColumn("_lower", F.lower("_text"))
        .withColumn("text_matches", _once(matches))
        .drop("_text", "_lower")
    )


def _targets(entities: DataFrame) -> DataFrame:
    """One row per name or safe symbol, with one of its words as the anchor.

    The anchor is the word that the fewest dictionary entries share, the longest of
    those, so that a word like "international" does not call up every other name.
    """
    names = entities.select(
        "ticker",
        F.explode(F.array(F.lower("full_name"), F.lower("short_name"))).alias("needle"),
        F.lit(False).alias("exact_case"),
    )
    symbols = entities.filter("symbol_is_safe").select(
        "ticker", F.col("ticker").alias("needle"), F.lit(True).alias("exact_case")
    )
    target = ["ticker", "needle", "exact_case"]
    words = (
        names.unionByName(symbols)
        .distinct()
        .select(*target, F.explode(F.array_distinct(text.tokens(F.lower("needle")))).alias("word"))
    )
    shared = words.groupBy("word").agg(F.count(F.lit(1)).alias("_n"))
    rank = F.struct("_n", -F.length("word"), "word")
    anchored = words.join(shared, "word").groupBy(*target).agg(F.min_by("word", rank).alias("anchor"))
    return anchored.withColumn("pattern", text.bounded_pattern_of(F.col("needle")))


def match_by_anchor(articles: DataFrame, entities: DataFrame, key: str = "dedup_key") -> DataFrame:
    """Adds ``text_matches`` for dictionaries of any size; ``key`` is unique per article.

    Only (key, word) pairs take part in the dictionary join.  Spark broadcasts the
    dictionary when it is small and splits frequent words when not.  The articles then
    meet their candidates by key: where there are too many candidates to broadcast, each
    text is shuffled once.
    """
    body = text.match_text(F.col("title"), F.col("description"))
    words = articles.select(
        key, F.explode(F.array_distinct(text.tokens(F.lower(body)))).alias("anchor")
    )
    candidates = (
        words.join(_targets(entities), "anchor")
        .groupBy(key)
        .agg(F.collect_set(F.struct("ticker", "needle", "exact_case", "pattern")).alias("_cand"))
    )

    def confirmed(c: Column) -> Column:
        where = F.when(c["exact_case"], F.col("_text")).otherwise(F.col("_lower"))
        return F.contains(where, c["needle"]) & F.rlike(where, c["pattern"])

    return (
        articles.join(candidates, key, "left")
        .withColumn("_text", body)
        .withColumn("_lower", F.lower("_text"))
        .withColumn(
            "text_matches",
            _once(
                F.coalesce(
                    F.array_sort(
                        F.array_distinct(
                            F.transform(F.filter("_cand", confirmed), lambda c: c["ticker"])
                        )
                    ),
                    _no_tags(),
                )
            ),
        )
        .drop("_text", "_lower", "_cand")
    )


def match_entities(articles: DataFrame, entities: DataFrame, key: str = "dedup_key") -> DataFrame:
    """The one way for dictionaries of every size, as a lazy plan."""
    return match_by_anchor(articles, entities, key)


def combine_tags(matched: DataFrame) -> DataFrame:
    """Adds ``matched_tickers``: text matches and the ticker the article was fetched for."""
    fetched_for = (
        (F.col("article_type") == "company") & (F.col("ticker") != "") & (F.col("ticker") != MACRO)
    )
    return matched.withColumn(
        "matched_tickers",
        F.array_union(
            "text_matches", F.when(fetched_for, F.array("ticker")).otherwise(_no_tags())
        ),
    )


def enrich(df: DataFrame, entities: DataFrame) -> DataFrame:
    """Company name and industry of each ticker; unknown tickers keep their symbol.

    No broadcast hint: Spark broadcasts the dimension when its size allows and
    otherwise joins by shuffle, splitting hot tickers.
    """
    dim = entities.select(
        "ticker", F.col("full_name").alias("_name"), F.col("industry").alias("_industry")
    )
    return (
        df.join(dim, "ticker", "left")
        .withColumn("company_name", F.coalesce("_name", "ticker"))
        .withColumn("industry", F.coalesce("_industry", F.lit("Unknown")))
        .drop("_name", "_industry")
    )


def explode_mentions(tagged: DataFrame, entities: DataFrame) -> DataFrame:
    """One row per (article, entity); articles without a match are left out."""
    rows = tagged.drop("ticker").withColumn("ticker", F.explode("matched_tickers"))
    return enrich(rows.drop("matched_tickers", "text_matches"), entities)


def unmatched_articles(tagged: DataFrame) -> DataFrame:
    return tagged.filter(F.size("matched_tickers") == 0)


def mentions_per_entity(mentions: DataFrame) -> DataFrame:
    return (
        mentions.groupBy("ticker", "company_name")
        .agg(F.count(F.lit(1)).alias("mentions"))
        .orderBy(F.desc("mentions"), "ticker")
    )
