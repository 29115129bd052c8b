"""Company-day aggregates of scored mentions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from newsignal.functions import numeric

KEYS = ["event_date", "ticker", "company_name", "industry"]


def day_label(pct_positive: Column, pct_negative: Column) -> Column:
    """Label from the two shares: neutral when its share beats the positive one,
    else positive or negative, whichever is larger (positive on a tie)."""
    neutral = F.lit(1) - pct_positive - pct_negative
    return (
        F.when(neutral > pct_positive, F.lit("neutral"))
        .when(pct_positive >= pct_negative, F.lit("positive"))
        .otherwise(F.lit("negative"))
    )


def majority_label(positive: Column, negative: Column, neutral: Column) -> Column:
    """Label with the most rows; ties go to positive, then negative."""
    return numeric.argmax_label(positive, negative, neutral)


def daily_sentiment(
    scored: DataFrame, keys: list[str] | None = None, label_rule: str = "shares"
) -> DataFrame:
    """Mentions, shares, mean score and label per company and day.

    ``label_rule`` is "shares" (``day_label``) or "majority".  One partial aggregate
    per task, one shuffle.
    """
    if label_rule not in ("shares", "majority"):
        raise ValueError(f"unknown label rule: {label_rule}")
    label = F.col("sentiment_label")
    out = scored.groupBy(*(keys or KEYS)).agg(
        F.count(F.lit(1)).alias("mention_count"),
        numeric.share(label == "positive").alias("pct_positive"),
        numeric.share(label == "negative").alias("pct_negative"),
        numeric.mean_half_up(F.col("sentiment_score")).alias("sentiment_score"),
        F.count_if(label == "positive").alias("_pos"),
        F.count_if(label == "negative").alias("_neg"),
    )
    if label_rule == "shares":
        day = day_label(F.col("pct_positive"), F.col("pct_negative"))
    else:
        rest = F.col("mention_count") - F.col("_pos") - F.col("_neg")
        day = majority_label(F.col("_pos"), F.col("_neg"), rest)
    return out.withColumn("sentiment_label", day).drop("_pos", "_neg")


def sample_headlines(
    scored: DataFrame, order: list[Column | str], k: int = 3, keys: list[str] | None = None,
    title: str = "title",
) -> DataFrame:
    """The first k titles per company and day in the given total order.

    Rows beyond k are dropped in each map task, so no group is ever collected whole.
    """
    by = keys or KEYS
    ranked = scored.withColumn(
        "_rn", F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    ).filter(F.col("_rn") <= k)
    return ranked.groupBy(*by).agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("_rn", F.col(title).alias("t")))),
            lambda r: r["t"],
        ).alias("sample_headlines")
    )


def sentiment_mart(
    scored: DataFrame, order: list[Column | str], label_rule: str = "shares"
) -> DataFrame:
    """``daily_sentiment`` with headlines, for scored rows of complete keys."""
    rows = scored.dropna(subset=KEYS)
    return daily_sentiment(rows, label_rule=label_rule).join(
        sample_headlines(rows, order), KEYS, "left"
    )


def daily_mean(scored: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Mean score and mentions per company and day; rows with a null key are dropped."""
    by = keys or KEYS
    return (
        scored.dropna(subset=by)
        .groupBy(*by)
        .agg(
            numeric.mean_half_even(F.col("sentiment_score")).alias("sentiment_score"),
            F.count("ticker").alias("mention_count"),
        )
    )


def rows_per_date(df: DataFrame, date: str = "event_date") -> DataFrame:
    return df.groupBy(date).agg(F.count(F.lit(1)).alias("n")).orderBy(date)


def macro_context(
    company_days: DataFrame, macro_scored: DataFrame, topics: list[str], date: str = "event_date"
) -> DataFrame:
    """Adds each macro topic's article count and mean score of the day to company rows.

    ``macro_scored`` holds (date, topic, sentiment_score); one row per day is joined on.
    """
    per_day = (
        macro_scored.groupBy(date)
        .pivot("topic", topics)
        .agg(
            F.count(F.lit(1)).alias("articles"),
            numeric.mean_half_even(F.col("sentiment_score")).alias("score"),
        )
    )
    joined = company_days.join(per_day, date, "left")
    return joined.withColumns(
        {f"{t}_articles": F.coalesce(F.col(f"`{t}_articles`"), F.lit(0)) for t in topics}
    )


# Sketches of 2**SKETCH_BITS cells; the standard error of their estimates.
SKETCH_BITS = 12
SKETCH_ERROR = 1.04 / 2 ** (SKETCH_BITS / 2)


def company_sketches(mart: DataFrame, company: str = "company_name") -> DataFrame:
    """One row per industry and day: a sketch of its companies, and its mentions.

    Sketches are merged over any choice of days and industries, so a distinct count over
    years reads these rows and not the mart.
    """
    return mart.groupBy("industry", "event_date").agg(
        F.hll_sketch_agg(company, F.lit(SKETCH_BITS)).alias("companies"),
        F.sum("mention_count").alias("mention_count"),
    )
