"""Raw article files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql import types as T

from newsignal import schemas
from newsignal.functions import text
from newsignal.sources.tables import union_all

NEWS_FILES = "news_*.json"
CORRUPT = "_corrupt_record"
WITH_CORRUPT = T.StructType([*schemas.ARTICLE.fields, T.StructField(CORRUPT, T.StringType())])


def read_articles(
    spark: SparkSession, paths: str | list[str], pattern: str = NEWS_FILES,
    multi_line: bool = True,
) -> DataFrame:
    """Daily files holding one JSON array each; manifests in the same folder are skipped.

    A broken record keeps its text in ``_corrupt_record``.  Such an array cannot be
    split; ``multi_line=False`` reads files with one record per line, which can.
    """
    return (
        spark.read.schema(WITH_CORRUPT)
        .option("multiLine", multi_line)
        .option("mode", "PERMISSIVE")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .json(paths)
    )


def read_day_files(spark: SparkSession, path: str, dates: list[str] | None = None) -> DataFrame:
    """Articles below ``date=<date>`` folders; only the folders of ``dates`` are read.

    A broken record keeps its text in ``_corrupt_record``.
    """
    fields = [f for f in WITH_CORRUPT if f.name != "date"]
    rows = spark.read.schema(T.StructType([*fields, T.StructField("date", T.StringType())])).option(
        "mode", "PERMISSIVE"
    ).json(path)
    if dates is not None:
        rows = rows.filter(F.col("date").isin(dates))
    return rows.select(*WITH_CORRUPT.names)


def good_articles(rows: DataFrame) -> DataFrame:
    """Rows that could be parsed."""
    return rows.filter(F.col(CORRUPT).isNull()).drop(CORRUPT) if CORRUPT in rows.columns else rows


def with_file(rows: DataFrame) -> DataFrame:
    """Adds ``_file``, the file of each row, to the answer of a reader of this module."""
    return rows.withColumn("_file", F.col("_metadata.file_path"))


def broken_records(rows: DataFrame, run: str = "") -> DataFrame:
    """Records of ``with_file`` rows that could not be parsed: date, path, text, run.

    The date is the one in the path where the record has none.
    """
    name = F.col("_file")
    date = F.coalesce(
        F.col("date"), text.path_date(name, "/date="), text.path_date(name, "/news_"), F.lit("unknown")
    )
    return rows.filter(F.col(CORRUPT).isNotNull()).select(
        date.alias("date"),
        name.alias("path"), F.col(CORRUPT).alias("text"), F.lit(run).alias("run"),
    )


def landing_files(
    spark: SparkSession, folders: list[str], pattern: str = NEWS_FILES, prefix: str = "/news_"
) -> DataFrame:
    """The files of each date over several folders; the folder listed first wins.

    The date is the one behind ``prefix`` in the path.  Reads no file content.
    """
    listings = [
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", True)
        .load(folder)
        .select("path", F.col("_metadata.file_path").alias("file"), F.lit(rank).alias("folder_rank"))
        for rank, folder in enumerate(folders)
    ]
    dated = (
        union_all(listings)
        .withColumn("date", text.path_date(F.col("path"), prefix))
        .filter("date is not null")
    )
    first = F.rank().over(Window.partitionBy("date").orderBy("folder_rank"))
    return dated.withColumn("_r", first).filter("_r = 1").drop("_r")


def new_landing_files(files: DataFrame, loaded: DataFrame) -> DataFrame:
    """Files of dates that are not loaded yet."""
    return files.join(loaded.select("date").distinct(), "date", "left_anti")


def read_landed(spark: SparkSession, files: DataFrame, **reading) -> DataFrame:
    """Articles of the listed files, with the text of broken records.

    Their folders are what passes the driver; of other files in them no row is kept.
    """
    folder = F.regexp_replace("path", "/[^/]*$", "").alias("folder")
    paths = sorted(r["folder"] for r in files.select(folder).distinct().collect())
    if not paths:
        return spark.createDataFrame([], T.StructType([*WITH_CORRUPT.fields, T.StructField("_file", T.StringType())]))
    rows = with_file(read_articles(spark, paths, **reading))
    return rows.join(files.select(F.col("file").alias("_file")), "_file", "left_semi")


def normalize_payload(
    payload: DataFrame, date: Column, ticker: Column, company: Column, article_type: Column
) -> DataFrame:
    """Nested answer of a news service -> the flat ten-column article."""
    flat = payload.select(
        date.alias("date"), ticker.alias("ticker"), company.alias("company"),
        article_type.alias("article_type"), "publishedAt", F.col("source.name").alias("source"),
        "title", "description", "content", "url",
    )
    return schemas.align_to(flat, schemas.ARTICLE)
