"""Keys of stored articles in buckets, so that a batch meets history without shuffling it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from newsignal.operators.clean import not_stored
from newsignal.sources.sinks import dynamic_overwrite

KEY_TABLE = "article_keys"
BUCKETS = 8


def create_keys(spark: SparkSession, database: str, buckets: int = BUCKETS, table: str = KEY_TABLE) -> str:
    """The key table of a database, made where it does not exist yet; returns its name.

    ``buckets`` is the number of tasks a comparison with history is worth; it stays with the
    table.
    """
    name = f"{database}.{table}"
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} (dedup_key STRING, date STRING) USING PARQUET "
        f"PARTITIONED BY (date) CLUSTERED BY (dedup_key) SORTED BY (dedup_key) INTO {buckets} BUCKETS"
    )
    return name


def bucket_count(spark: SparkSession, name: str) -> int:
    rows = spark.sql(f"DESCRIBE EXTENDED {name}").filter("col_name = 'Num Buckets'").collect()
    return int(rows[0]["data_type"])


def replace_keys(keys: DataFrame, name: str, dates: list[str]) -> None:
    """Makes the table hold exactly the keys of ``keys`` on the given dates, one file per bucket and date."""
    spark = keys.sparkSession
    rows = keys.filter(F.col("date").cast("string").isin(dates)).select(
        "dedup_key", F.col("date").cast("string").alias("date")
    )
    found = {r["date"] for r in rows.select("date").distinct().collect()}
    for date in sorted(set(dates) - found):
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION (date = '{date}')")
    with dynamic_overwrite(spark):
        rows.repartition(bucket_count(spark, name), "dedup_key").write.insertInto(name, overwrite=True)


def unseen(batch: DataFrame, name: str, dates: list[str]) -> DataFrame:
    """Rows of the batch whose key no other date than ``dates`` holds.

    Only the batch is shuffled, into the buckets of the table; history is read bucket by
    bucket, its key column alone.
    """
    known = batch.sparkSession.table(name).filter(~F.col("date").isin(dates))
    return not_stored(batch, known, ["dedup_key"])
