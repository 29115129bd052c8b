"""Article files into a date-partitioned store, each file once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from newsignal.functions import text
from newsignal.sources import files
from newsignal.sources.articles import (
    NEWS_FILES, WITH_CORRUPT, broken_records, good_articles, with_file,
)

FILE_BYTES, TASK_BYTES = 32 << 20, 32 << 20


def article_stream(
    spark: SparkSession, folder: str, pattern: str = NEWS_FILES, multi_line: bool = True,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Articles as their files arrive; broken records keep their text (see ``store_articles``).

    Records without a date have that of their ``date=<date>`` folder.
    """
    reader = (
        spark.readStream.schema(WITH_CORRUPT)
        .option("multiLine", multi_line)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
    )
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    rows = with_file(reader.json(folder))
    return rows.withColumn("date", F.coalesce("date", text.path_date(F.col("_file"), "/date=")))


def worth(spark: SparkSession, folder: str, dates: int = 30) -> dict[str, int]:
    """``files`` and ``tasks`` of ``store_stream`` for what lies in a folder, of about so many dates.

    A file is worth ``FILE_BYTES`` and a task ``TASK_BYTES`` of the input, whatever its size.
    """
    size = files.size(spark, folder)
    return {"files": 1 + size // (FILE_BYTES * dates), "tasks": 1 + size // TASK_BYTES}


def store_articles(
    rows: DataFrame, path: str, quarantine: str, checkpoint: str, files: int = 1, tasks: int = 1,
) -> list[StreamingQuery]:
    """Stores an ``article_stream`` by date, and its broken records by their own.

    Two queries with a checkpoint each, so both sets hold every record exactly once.
    ``files`` and ``tasks`` are those of ``store_stream``.
    """
    good = good_articles(rows).drop("_file")
    broken = broken_records(rows)
    return [
        store_stream(good, path, f"{checkpoint}/articles", files=files, tasks=tasks),
        store_stream(broken, quarantine, f"{checkpoint}/quarantine", files=files, tasks=tasks),
    ]


def store_stream(
    rows: DataFrame, path: str, checkpoint: str, by: str | None = "date", files: int = 1, tasks: int = 1,
) -> StreamingQuery:
    """Appends what has arrived and stops; the checkpoint remembers the files read.

    A batch writes at most ``files`` files per date; set it to the tasks that a day is
    worth.  A batch is shuffled into ``tasks`` tasks, and no fewer than the session's
    shuffle partitions: without a number Spark may read a whole batch in one task.
    Copies of a row that were read by several tasks are dealt apart.
    """
    if by:
        spark = rows.sparkSession
        tasks = max(tasks, int(spark.conf.get("spark.sql.shuffle.partitions")))
        slot = F.pmod(F.xxhash64("_task", *rows.columns), F.lit(files))
        placed = rows.withColumn("_task", F.spark_partition_id()).withColumn("_slot", slot)
        rows = placed.repartition(tasks, by, "_slot").select(*rows.columns)
    writer = (
        rows.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
    )
    if by:
        writer = writer.partitionBy(by)
    return writer.start(path)
