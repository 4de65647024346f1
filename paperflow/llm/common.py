"""What the corpus operators share: reading tables, Arrow batches, cutting lineage, numbering rows in key order.

Texts cross to Python as UTF-8 bytes.  Words are what lies between the bytes 0x20 and 0x09-0x0D, and only
A-Z is lower-cased, which is exactly ``bytes.lower().split()``.
"""

from __future__ import annotations

import contextlib
import ctypes
import os
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paperflow.session import scratch_path

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
BATCH_ROWS = 500
"""Rows of one Arrow batch; long texts make the default of 10,000 rows too large for a Python worker."""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def staged(df: DataFrame, label: str) -> DataFrame:
    """Writes the rows to the shared folder and reads them back, which cuts the lineage for lost executors.

    The shuffle files of the write go when it ends, not when the driver happens to collect its garbage.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    before = spark.conf.get(SHUFFLE_CLEANUP)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def dropped(*tables: DataFrame) -> None:
    """Removes the files of staged rows that nothing reads any more, so that they do not count against the disk until the session ends."""
    for rows in tables:
        hadoop = rows.sparkSession.sparkContext._jvm.org.apache.hadoop.fs
        for folder in {name.rsplit("/", 1)[0] for name in rows.inputFiles()}:
            path = hadoop.Path(folder)
            path.getFileSystem(rows.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def raw(text: str | Column) -> Column:
    """A text as UTF-8 bytes; null counts as empty."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")).cast("binary")


def small_batches(df: DataFrame) -> DataFrame:
    """Lets the session send few rows at a time to Python, where this package can be imported; both settings stay."""
    df.sparkSession.sparkContext.environment.setdefault("PYTHONPATH", ROOT)
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return df


def give_back() -> None:
    """Returns what the allocators of Arrow and C hold free.  An idle Python worker would keep it, and an executor has several that serve in turn."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(AttributeError, OSError):
        ctypes.CDLL(None).malloc_trim(0)


def in_batches(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``mapInArrow`` with batches of few rows; a task gives its worker's free memory back when it ends."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from fn(batches)
        finally:
            give_back()

    return small_batches(df).mapInArrow(task, schema)


def free_names(df: DataFrame, *wanted: str) -> list[str]:
    """The wanted column names, with underscores appended where the rows have such a column already."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def hashed_sample(df: DataFrame, key: str, rows: int) -> DataFrame:
    """At most ``rows`` rows, the first by hash of the key.

    A hash bound that about twice as many rows pass comes before the sort, so that tasks send few rows however many tasks there are.
    """
    share = min(1.0, 2 * rows / max(1, df.count()))
    h = F.xxhash64(key)
    return df.where(h <= min(2**63 - 1, int(share * 2**64) - 2**63)).orderBy(h, *df.columns).limit(rows)


_TABLES: dict[str, tuple[object, object, object]] = {}


def worker_table(kind: str, key: object, make: Callable[[], object]) -> object:
    """A table that a Python worker keeps from batch to batch and task to task, one of a kind.

    Workers serve the operators of a session in turn.  When one of them makes its table, those that the task at hand has not used go, so that a worker
    holds what one operator needs and not the sum over all of them.
    """
    context = TaskContext.get()
    task = context.taskAttemptId() if context else None
    _, known, table = _TABLES.get(kind, (None, None, None))
    if table is None or known != key:
        table = None
        for other in [k for k, (used, _, _) in _TABLES.items() if k == kind or used != task]:
            del _TABLES[other]
        table = make()
    _TABLES[kind] = task, key, table
    return table


def words(text: bytes) -> list[bytes]:
    return text.lower().split()
