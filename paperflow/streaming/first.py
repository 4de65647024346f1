"""Exact first wins across polls in keyed state.

The state store holds one entry per key that has been seen, in RocksDB on the executors, so a micro-batch looks up the keys it brings
and reads nothing that was written earlier.  Within a micro-batch the row that comes first in ``order`` wins whole.  Every task first
reduces its own rows to one per key, so a key with any share of a batch sends one row per task.  With ``forget_after`` a timer
per key, in event time, drops the entry once the watermark is so far beyond the first row; then a key may win anew.

Rows with a null or empty key drop out, as in the batch operator.  Equal rows in ``order`` are told apart by all columns as text.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
KEYS_HELD = 50_000
"""Keys of which a task holds the first row before it sends them on."""


@contextmanager
def rocksdb_state(spark: SparkSession):
    """Streams started inside keep their state in RocksDB; the session's own setting comes back."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.unset(PROVIDER) if before is None else spark.conf.set(PROVIDER, before)


def _place(values: tuple) -> tuple:
    """Nulls first, then by value."""
    return tuple((v is not None, v) if v is not None else (False,) for v in values)


class FirstRow(StatefulProcessor):
    """Emits the first row of a key and remembers that it has."""

    def __init__(self, order: list[str], ts: str | None = None, forget_after_ms: int | None = None):
        self.order, self.ts, self.forget_after_ms = order, ts, forget_after_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getValueState("seen", "seen boolean")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        if self.seen.exists():
            for _ in rows:
                pass
            return
        first = min(rows, key=lambda r: (_place(tuple(r[c] for c in self.order)), str(r)))
        self.seen.update((True,))
        if self.forget_after_ms is not None:
            self.handle.registerTimer(int(first[self.ts].timestamp() * 1000) + self.forget_after_ms)
        yield first

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.seen.clear()
        return iter(())

    def close(self) -> None:
        pass


def _one_per_task(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The first row of each key that a task meets, as long as it can hold them."""
    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, tuple] = {}
        schema = None
        for batch in batches:
            schema = batch.schema
            for row in batch.to_pylist():
                place = (_place(tuple(row[c] for c in order)), json.dumps(row, default=str))
                if row[key] not in held or place < held[row[key]][0]:
                    held[row[key]] = (place, row)
            if len(held) > KEYS_HELD:
                yield pa.RecordBatch.from_pylist([r for _, r in held.values()], schema=schema)
                held = {}
        if held:
            yield pa.RecordBatch.from_pylist([r for _, r in held.values()], schema=schema)

    return rows.mapInArrow(reduce, rows.schema)


def first_arrivals(stream: DataFrame, key: Column, order: list[str], ts: str | None = None, forget_after: str | None = None) -> DataFrame:
    """A stream of the rows whose key no earlier row had, with the key as ``dedup_key``.  Start it inside ``rocksdb_state``.

    ``forget_after`` (such as ``"90 days"``, with the event time column ``ts``) bounds the state; without it keys are kept for good.
    """
    keyed = stream.withColumn("dedup_key", key).where("dedup_key <> ''")
    wait = None if forget_after is None else int(pd.Timedelta(forget_after).total_seconds() * 1000)
    reduced = _one_per_task(keyed, "dedup_key", order)
    if wait is not None:
        reduced = reduced.withWatermark(ts, "0 seconds")
    return reduced.groupBy("dedup_key").transformWithState(
        FirstRow(order, ts, wait), keyed.schema, "Append", "EventTime" if wait is not None else "None")
