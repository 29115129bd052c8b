"""First wins in a stream, by the order of the rows and not of their arrival."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, Row, SparkSession, functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
CLOSES = "closes_ms_"


def rank(values: Iterable) -> tuple:
    """Sorts like a row of ascending columns with nulls last."""
    return tuple((v is None, 0 if v is None else v) for v in values)


class FirstWins(StatefulProcessor):
    """Holds one row per key and gives it out when the key's time is over."""

    def __init__(self, schema: T.StructType, order: list[str]):
        self.schema, self.places = schema, [schema.names.index(c) for c in order]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.best = handle.getValueState("best", self.schema)

    def place(self, row: Iterable) -> tuple:
        values = tuple(row)
        return rank(values[i] for i in self.places)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        first = min(rows, key=self.place)
        if not self.best.exists():
            self.best.update(tuple(first))
            self.handle.registerTimer(tuple(first)[-1])
        elif self.place(first) < self.place(self.best.get()):
            self.best.update(tuple(first))
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        out = Row(*self.schema.names)(*tuple(self.best.get()))
        self.best.clear()
        yield out

    def close(self) -> None:
        pass


@contextmanager
def rocksdb(spark: SparkSession) -> Iterator[None]:
    """The state store that timers need, for streams that start within."""
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key, None)
    spark.conf.set(key, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def first_wins_stream(
    rows: DataFrame, keys: list[str], order: list[str], period: str, horizon: str = "1 day",
) -> DataFrame:
    """The first row of each key in ``order`` (ascending, nulls last), whatever arrives first.

    ``period`` is the timestamp of the key's period, the same in all rows of a key: a key
    is closed, and its row given out, once the stream has passed the period by
    ``horizon``; rows that come later than that are dropped.  ``order`` must tell all rows
    of a key apart.  Each Arrow batch is reduced to one row per key before the shuffle, so
    a key that holds much of the input sends few rows; its task holds one of them at a time.
    """
    closing = F.unix_millis(F.col(period) + F.expr(f"INTERVAL {horizon}"))
    marked = rows.withColumn(CLOSES, closing)
    schema = marked.schema

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = zip(*[batch.column(c).to_pylist() for c in keys])
            places = zip(*[batch.column(c).to_pylist() for c in order])
            best: dict[tuple, tuple] = {}
            for i, (name, place) in enumerate(zip(names, places)):
                found = (rank(place), i)
                if name not in best or found < best[name]:
                    best[name] = found
            yield batch.take(pa.array([i for _, i in best.values()], pa.int64()))

    few = marked.mapInArrow(reduce, schema).withWatermark(period, horizon)
    out = few.groupBy(*keys).transformWithState(FirstWins(schema, order), schema, "Append", "EventTime")
    return out.drop(CLOSES)
