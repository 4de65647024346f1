"""Lookup of open-index works by DOI and what it fills in."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import blank_to_null, strip_ws, text_or_empty
from .dedup import first_wins


def lookup(papers: DataFrame, works: DataFrame, key: Column, work_key: str, work_order: list[str],
           row_id: str) -> DataFrame:
    """Left join, n:1.  ``matched`` tells whether a work was found.

    The works side keeps one row per key.  Papers without a key get a key of their own
    that matches nothing (from ``row_id``), so they spread over all tasks instead of meeting in one.
    A key shared by very many papers is split by adaptive skew-join handling, which
    copies only the one matching work row.
    """
    right = first_wins(works, F.col(work_key), work_order).withColumnRenamed(work_key, "_lookup")
    alone = F.concat(F.lit("\x00"), F.col(row_id).cast("string"))
    left = papers.withColumn("_lookup", F.coalesce(blank_to_null(key), alone))
    right = right.withColumn("_hit", F.lit(True))
    return left.join(right, "_lookup", "left").withColumn("matched", F.coalesce("_hit", F.lit(False))).drop("_lookup", "_hit")


def store_by_key(rows: DataFrame, table: str, path: str, key: Column, buckets: int, row_id: str | None = None, add: bool = False) -> None:
    """Keeps rows in a table that is bucketed and sorted by the lookup key, so that joins on it need no shuffle of the table.

    ``row_id`` gives rows without a key one of their own, as ``lookup`` does; without it such rows are left out.  ``add`` appends a day's rows.
    Both tables of a join must have the same number of buckets; a bucket should fit a task.
    """
    alone = F.concat(F.lit("\x00"), F.col(row_id).cast("string")) if row_id else F.lit(None)
    keyed = rows.withColumn("_lookup", F.coalesce(blank_to_null(key), alone)).where("_lookup is not null")
    spread = keyed.repartition(buckets, "_lookup")  # one file for each bucket, not one for each bucket and task
    spread.write.mode("append" if add else "overwrite").bucketBy(buckets, "_lookup").sortBy("_lookup").option("path", path).format("parquet").saveAsTable(table)


def store_works(works: DataFrame, table: str, path: str, work_key: str, work_order: list[str], buckets: int) -> None:
    """The lookup side of a bucketed join: one row per key."""
    store_by_key(first_wins(works, F.col(work_key), work_order), table, path, F.col(work_key), buckets)


def lookup_bucketed(papers: DataFrame, works: DataFrame) -> DataFrame:
    """``lookup`` between tables kept by ``store_by_key`` and ``store_works``: the history of papers is read where it lies."""
    right = works.withColumn("_hit", F.lit(True))
    return papers.join(right, "_lookup", "left").withColumn("matched", F.coalesce("_hit", F.lit(False))).drop("_lookup", "_hit")


def backfill(current: Column, candidate: Column) -> Column:
    """The candidate replaces a value only if that is blank and the candidate is not."""
    blank = strip_ws(text_or_empty(current)) == ""
    return F.when(blank & (text_or_empty(candidate) != ""), candidate).otherwise(current)


def append_concepts(subjects: Column, concepts: Column) -> Column:
    """Concepts join the subjects, blanks skipped, stray separators trimmed at both ends."""
    joined = F.concat_ws("; ", blank_to_null(subjects), blank_to_null(F.array_join(concepts, "; ")))
    trimmed = F.regexp_replace(joined, "^[; ]+|[; ]+$", "")
    return F.when(F.coalesce(F.size(concepts), F.lit(0)) > 0, trimmed).otherwise(subjects)


def coverage(enriched: DataFrame, key: str) -> DataFrame:
    """How many papers got a work, out of how many papers and distinct keys."""
    return enriched.agg(
        F.count_if("matched").alias("enriched"),
        F.count("*").alias("papers"),
        F.count_distinct(F.nullif(F.col(key), F.lit(""))).alias("dois"),
    )
