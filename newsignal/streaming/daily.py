"""Company-day sentiment from a stream, with late rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from newsignal.functions import numeric
from newsignal.sources import sinks, tables


def daily_stream(
    rows: DataFrame, event_time: str = "published_ts", lateness: str = "2 days"
) -> DataFrame:
    """Count, shares and mean score per ticker and day.

    Rows older than the watermark are dropped.  Each task aggregates its rows before
    the shuffle, so a ticker with many rows is no hot spot.
    """
    label = F.col("sentiment_label")
    return (
        rows.withWatermark(event_time, lateness)
        .groupBy(F.window(event_time, "1 day"), "ticker")
        .agg(
            F.count(F.lit(1)).alias("mention_count"),
            numeric.share(label == "positive").alias("pct_positive"),
            numeric.share(label == "negative").alias("pct_negative"),
            numeric.mean_half_up(F.col("sentiment_score")).alias("sentiment_score"),
        )
        .select(
            F.col("window.start").cast("date").alias("event_date"), "ticker", "mention_count",
            "pct_positive", "pct_negative", "sentiment_score",
        )
    )


def store_updates(
    daily: DataFrame, path: str, checkpoint: str, keys: list[str] | None = None
) -> StreamingQuery:
    """Keeps the current state of every company-day, one set of files per date.

    A batch rewrites the dates it changes, so nothing grows with the number of batches,
    and a batch that is retried writes the same rows.
    """
    keys = keys or ["event_date", "ticker"]

    def write(batch: DataFrame, batch_id: int) -> None:
        sinks.merge_dates(batch, path, keys)

    return (
        daily.writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(write)
        .start()
    )


def current_state(spark: SparkSession, path: str) -> DataFrame:
    """What ``store_updates`` holds."""
    rows = tables.read_partitioned(spark, path)
    return rows.withColumn("event_date", F.col("event_date").cast("date"))
