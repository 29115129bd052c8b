"""Mart refresh by recomputing the dates a batch touches."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from newsignal.sources import sinks, tables


def refresh_stream(
    rows: DataFrame, store: str, mart: str, checkpoint: str,
    aggregate: Callable[[DataFrame], DataFrame], key: str, order: list[str],
) -> StreamingQuery:
    """Adds each batch to a deduplicated store and rewrites the mart's touched dates.

    Rows may be late by any time: a date is always recomputed from all its stored rows.
    ``rows`` and the output of ``aggregate`` have an ``event_date`` column; of several
    rows with one key the first in ``order`` is kept.
    """

    def refresh(batch: DataFrame, batch_id: int) -> None:
        touched = sinks.merge_dates(batch, store, [key], order=order)
        stored = tables.read_partitioned(batch.sparkSession, store)
        fresh = stored.join(touched, "event_date", "left_semi")
        sinks.write_partitions(aggregate(fresh), mart)

    return (
        rows.writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(refresh)
        .start()
    )
