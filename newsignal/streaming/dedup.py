"""Duplicate removal across files and batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def dedup_stream(
    rows: DataFrame, key: str, event_time: str, horizon: str, spread: Column | None = None,
    salts: int = 32,
) -> DataFrame:
    """Keeps the first row of each key among copies at most ``horizon`` apart.

    A streaming dedup shuffles every copy to the task of its key.  Where one key may
    hold much of a batch, ``spread`` (a column that differs between its copies) deals
    the copies over ``salts`` tasks, which drop most of them before the final pass.
    """
    marked = rows.withWatermark(event_time, horizon)
    if spread is not None:
        marked = (
            marked.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(salts)))
            .dropDuplicatesWithinWatermark([key, "_salt"])
            .drop("_salt")
        )
    return marked.dropDuplicatesWithinWatermark([key])
