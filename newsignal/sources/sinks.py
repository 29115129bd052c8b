"""Writers.  Each one gives the same table when it runs twice on the same input."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, Row, SparkSession, functions as F
from pyspark.sql import types as T

from newsignal import schemas
from newsignal.operators.clean import first_per_key, not_stored


def replace_dataset(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)


def write_partitions(df: DataFrame, path: str, by: str = "event_date") -> None:
    """Replaces the dates in ``df`` and leaves all others.

    Rows are rebalanced by date: small dates share a task, a large one is split.
    """
    (
        df.hint("rebalance", by).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(by)
        .parquet(path)
    )


def counted(df: DataFrame, by: str) -> tuple[DataFrame, Observation]:
    """The frame with its row count and its dates observed while it is written."""
    seen = Observation()
    dates = F.collect_set(F.col(by).cast("string"))
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), dates.alias("dates")), seen


def observed(seen: Observation) -> tuple[int, list[str]]:
    """Rows and dates of a frame that was written.

    Spark drops the observation with the rest of a plan that it knows to be empty, and
    has no metrics to give then.
    """
    try:
        metrics = seen.get
    except Py4JJavaError:
        return 0, []
    return metrics["rows"], metrics["dates"]


def replace_dates(
    df: DataFrame, path: str, dates: list[str], by: str = "date", rebalance: bool = True
) -> int:
    """Makes the dataset hold exactly the rows of ``df`` on the given dates.

    Other dates stay.  A date without rows is replaced by an empty folder, so what an
    earlier run wrote there goes.  Returns the rows written, observed by the write itself.
    """
    wanted, seen = counted(df.filter(F.col(by).cast("string").isin(dates)), by)
    writer = wanted.hint("rebalance", by) if rebalance else wanted
    (
        writer.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(by).parquet(path)
    )
    empty = df.sparkSession.createDataFrame([], T.StructType([f for f in df.schema if f.name != by]))
    rows, found = observed(seen)
    for date in sorted(set(dates) - set(found)):
        empty.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(
            f"{path}/{by}={date}"
        )
    return rows


def stored_or_none(spark: SparkSession, path: str) -> DataFrame | None:
    """The dataset at the path, or None where nothing was written yet."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def append_new(
    df: DataFrame, path: str, key: str = "dedup_key", by: str = "date",
    dates: list[str] | None = None,
) -> None:
    """Adds rows whose key no other date holds, replacing the dates of ``df``.

    ``df`` has one row per key.  A second run of the same day writes the same rows.
    ``dates`` names the dates of ``df`` where they are known; the history of those
    dates is then not even listed.  A date that ends up without rows is not replaced.
    """
    stored = stored_or_none(df.sparkSession, path)
    if stored is not None:
        history = stored.select(key, F.col(by).cast("string").alias(by))
        if dates is None:
            history = history.join(df.select(by).distinct(), by, "left_anti")
        else:
            history = history.filter(~F.col(by).isin(dates))
        df = not_stored(df, history, [key])
    write_partitions(df, path, by)


def merge_dates(
    batch: DataFrame, path: str, keys: list[str], by: str = "event_date",
    order: list[str] | None = None,
) -> DataFrame:
    """Brings a batch into a dataset partitioned by date, rewriting the dates it touches.

    Without ``order`` the batch has one row per key, which replaces the stored one.  With
    it the stored row of a key stays, and of several new rows the first in the order is
    taken.  A batch that is retried gives the same dataset.  Returns the touched dates.
    """
    spark = batch.sparkSession
    batch = batch.withColumn(by, F.col(by).cast("string")).persist()
    try:
        touched = batch.select(by).distinct()
        dates = spark.createDataFrame([(r[by],) for r in touched.collect()], f"{by} string")
        rows = batch if order is None else first_per_key(batch, list(dict.fromkeys([by, *keys])), order)
        stored = stored_or_none(spark, path)
        if stored is not None:
            stored = stored.withColumn(by, F.col(by).cast("string")).join(dates, by, "left_semi")
            one = list(dict.fromkeys([by, *keys]))
            if order is None:
                rows = rows.unionByName(stored.join(rows.select(*one), one, "left_anti"))
            else:
                rows = stored.unionByName(not_stored(rows, stored, one))
        write_partitions(rows, path, by)
    finally:
        batch.unpersist()
    return dates


def append_scores(scored: DataFrame, path: str, key: str = "dedup_key") -> None:
    """Adds scores of articles that ``pending_articles`` found unscored.

    Scores are kept by model version and article date.  The partitions that get rows are
    rewritten with one row per key, whatever they held: a repeated or overlapping run
    leaves no second score.
    """
    parts = ["model_version", "date"]
    stored = stored_or_none(scored.sparkSession, path)
    rows = scored.withColumn("_old", F.lit(1))
    if stored is not None:
        touched = scored.select(*parts).distinct()
        old = stored.withColumn("date", F.col("date").cast("string")).join(touched, parts, "left_semi")
        rows = rows.unionByName(old.withColumn("_old", F.lit(0)))
    values = [c for c in scored.columns if c not in (key, *parts)]
    one = first_per_key(rows, [*parts, key], ["_old", *values]).drop("_old")
    (
        one.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(*parts).parquet(path)
    )


@contextmanager
def dynamic_overwrite(spark: SparkSession) -> Iterator[None]:
    """Replaces only partitions that are written; tables take this from the session."""
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    spark.conf.set(key, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def overwrite_mart(
    df: DataFrame, database: str, table: str, dates: list[str] | None = None
) -> int:
    """Replaces the mart's dates that are in ``df``; columns are matched by name.

    With ``dates`` exactly these are replaced: one of them without rows loses its
    partition.  Files are sorted by the mart's first lookup column, so a company's rows lie
    in few row groups.  Returns the rows written.
    """
    schema, partition = schemas.MARTS[table]
    rows = schemas.align_to(df, schema)
    if not partition:
        rows.write.insertInto(f"{database}.{table}", overwrite=True)
        return -1
    if dates is not None:
        rows = rows.filter(F.col(partition).isin(dates))
    rows, seen = counted(rows, partition)
    with dynamic_overwrite(df.sparkSession):
        ordered = rows.hint("rebalance", partition).sortWithinPartitions(partition, *schemas.LOOKUPS[table])
        ordered.write.insertInto(f"{database}.{table}", overwrite=True)
    written, found = observed(seen)
    for date in sorted(set(dates or []) - set(found)):
        df.sparkSession.sql(
            f"ALTER TABLE {database}.{table} DROP IF EXISTS PARTITION ({partition} = '{date}')"
        )
    return written


def log_run(
    spark: SparkSession, database: str, run_date: str, status: str = "success",
    articles_processed: int = 0, zero_coverage_tickers: list[str] | None = None,
    errors: str = "",
) -> None:
    """Adds one row to the run log."""
    row = Row(run_date, status, int(articles_processed), zero_coverage_tickers or [], errors)
    append_runs(spark.createDataFrame([row], schemas.RUN), database)


def append_runs(runs: DataFrame, database: str) -> None:
    """Adds runs to the log, each as the next attempt of its date."""
    before = runs.sparkSession.table(f"{database}.pipeline_runs").groupBy("run_date").agg(
        F.max("attempt").alias("_last")
    )
    numbered = runs.join(before, "run_date", "left").withColumn(
        "attempt", F.coalesce("_last", F.lit(0)) + 1
    )
    schemas.align_to(numbered, schemas.PIPELINE_RUNS).write.insertInto(f"{database}.pipeline_runs")


def write_day_files(
    articles: DataFrame, path: str, rebalance: bool = True, compression: str = "none",
) -> None:
    """Articles as JSON, one record per line so that large days can be split.

    A day has a folder ``date=<date>`` that ``read_day_files`` finds.  Days in ``articles``
    are replaced as a whole; other days stay.  ``rebalance=False`` is for articles that lie
    by date already.  With a compression such as gzip a file is read by one task, so large
    days are split by their writers alone.
    """
    rows = articles.hint("rebalance", "date") if rebalance else articles
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic").option("ignoreNullFields", "false")
        .partitionBy("date").json(path, compression=compression)
    )


def write_manifests(documents: DataFrame, path: str) -> None:
    """One folder of JSON per day, replacing the days in ``documents``."""
    (
        documents.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("ignoreNullFields", "false")
        .partitionBy("date")
        .json(path)
    )
