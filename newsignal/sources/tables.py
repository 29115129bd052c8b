"""Parquet datasets, price partitions and mart tables."""

from __future__ import annotations

from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from newsignal import schemas
from newsignal.functions import text
from newsignal.sources import files


def read_parquet(spark: SparkSession, *paths: str) -> DataFrame:
    """All parquet files below the paths as one frame.

    Files may differ in columns; those a file lacks are null.
    """
    return spark.read.option("mergeSchema", True).parquet(*paths)


def local_table(spark: SparkSession, rows: list[tuple], schema: T.StructType) -> DataFrame:
    """A small table from Python rows.

    Passed as Arrow data, it has a size that Spark knows, so joins can broadcast it.
    """
    columns = {
        f.name: pa.array([r[i] for r in rows], to_arrow_type(f.dataType))
        for i, f in enumerate(schema)
    }
    return spark.createDataFrame(pa.table(columns), schema)


def union_all(frames: list[DataFrame]) -> DataFrame:
    """Rows of all frames by column name; columns a frame lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def read_partitioned(spark: SparkSession, path: str, date: str = "event_date") -> DataFrame:
    """A dataset partitioned by date, the date as text.  Filters on it prune folders."""
    df = spark.read.parquet(path)
    return df.withColumn(date, F.col(date).cast("string"))


def read_dates(spark: SparkSession, path: str, dates: list[str], date: str = "date") -> DataFrame:
    """The given dates of a dataset partitioned by date; only their folders are listed and read."""
    kept = sorted(set(dates) & set(files.partitions(spark, path, date)))
    if not kept:
        return read_partitioned(spark, path, date).filter(F.col(date).isin(dates))
    df = spark.read.option("basePath", path).parquet(*[f"{path}/{date}={day}" for day in kept])
    return df.withColumn(date, F.col(date).cast("string"))


def with_path_date(df: DataFrame, date: str = "event_date") -> DataFrame:
    """Sets the date from the ``<date>=YYYY-MM-DD`` part of each row's file path."""
    return df.withColumn(date, text.path_date(F.col("_metadata.file_path"), f"{date}="))


def normalize_closes(history: DataFrame, entities: DataFrame) -> DataFrame:
    """Price history -> price rows with the industry of each ticker."""
    dim = entities.select("ticker", F.col("industry").alias("_industry"))
    return (
        history.join(dim, "ticker", "left")
        .withColumn("industry", F.coalesce("_industry", F.lit("Unknown")))
        .drop("_industry")
    )


def read_mart(spark: SparkSession, database: str, table: str) -> DataFrame:
    return spark.table(f"{database}.{table}")


def mart_ddl(database: str, table: str) -> str:
    """CREATE TABLE of a mart: ORC with Snappy, partitioned by date.

    Bloom filters on the lookup columns let a reader pass over row groups without a company
    that lies between their least and largest value.
    """
    schema, partition = schemas.MARTS[table]
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema)
    by = f" PARTITIONED BY ({partition})" if partition else ""
    options = {"orc.compress": "SNAPPY"}
    if table in schemas.LOOKUPS:
        options["orc.bloom.filter.columns"] = ",".join(schemas.LOOKUPS[table])
        options["orc.bloom.filter.fpp"] = "0.01"
    listed = ", ".join(f"'{k}' '{v}'" for k, v in options.items())
    return f"CREATE TABLE IF NOT EXISTS {database}.{table} ({columns}) USING ORC OPTIONS ({listed}){by}"


def create_marts(spark: SparkSession, database: str, location: str | None = None) -> None:
    """Database and mart tables, where they do not exist yet."""
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{where}")
    for table in schemas.MARTS:
        spark.sql(mart_ddl(database, table))


def collect_statistics(spark: SparkSession, database: str) -> None:
    """Stores row counts, and distinct counts and ranges of lookup and date columns, for the optimizer.

    Reads these columns of all dates, so it belongs after large changes, not into every run.
    Row and distinct counts are used where ``spark.sql.cbo.enabled`` is set.
    """
    for table, lookups in schemas.LOOKUPS.items():
        columns = ", ".join([*lookups, schemas.MARTS[table][1]])
        spark.sql(f"ANALYZE TABLE {database}.{table} COMPUTE STATISTICS FOR COLUMNS {columns}")
