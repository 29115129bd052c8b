"""Shared helpers: tables, written steps, row keys, Arrow slices."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from newsignal.session import scratch_dir

# Fixed values of the contracts: the six white space characters and the words between them.
SPACE_CHARS = " \t\n\x0b\x0c\r"
SPACES = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SLICE_BYTES = 4 << 20
# Removes the shuffle files of a query when it ends, not when the driver collects its garbage.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Queries run inside leave no shuffle files behind."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


def written(df: DataFrame, name: str, codec: str | None = None) -> DataFrame:
    """The rows, written once to the shared folder and read back.

    Cuts the lineage: a lost executor repeats nothing that lies before this point, so the
    shuffles that made the rows go when they are written.  ``codec``: of the files, if not
    the session's.
    """
    path = scratch_dir(df.sparkSession, name)
    with shuffles_removed(df.sparkSession):
        df.write.parquet(path, compression=codec)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_of(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def text_key(column: str = "text") -> Column:
    """Tells rows apart that share a doc_id, or have none: 128 bits of the whole text."""
    return F.unhex(F.md5(text_of(column)))


def keyed(docs: DataFrame) -> DataFrame:
    """The three columns most operators work on; all other columns are left behind."""
    return docs.select("doc_id", text_key().alias("row_hash"), text_of().alias("text"))


def same_row(a: DataFrame, b: DataFrame) -> Column:
    """Join condition on (doc_id, row_hash) that also holds for a null doc_id."""
    return a["doc_id"].eqNullSafe(b["doc_id"]) & (a["row_hash"] == b["row_hash"])


def fresh(df: DataFrame, name: str) -> str:
    """A column name that the frame does not have yet."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def keep_rows(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose (doc_id, row_hash) stands in ``kept``, with all their columns."""
    name = fresh(docs, "row_hash")
    rows = docs.withColumn(name, text_key())
    ids = kept.select(F.col("doc_id").alias("kept_id"), F.col("row_hash").alias("kept_hash"))
    same = rows["doc_id"].eqNullSafe(ids["kept_id"]) & (rows[name] == ids["kept_hash"])
    return rows.join(ids.distinct(), same, "left_semi").drop(name)


def slices(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about ``limit`` bytes of text each, a longer text alone."""
    texts = batch.column(column)
    sizes = np.asarray(pc.fill_null(pc.binary_length(texts), 0), np.int64)
    total = np.cumsum(sizes)
    at = 0
    while at < len(sizes):
        before = total[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(total, before + limit, side="right")))
        yield batch.slice(at, end - at)
        at = end
