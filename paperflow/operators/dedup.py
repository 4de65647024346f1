"""First-wins dedup."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import first_nonempty, text_or_empty


def first_wins(df: DataFrame, key: Column, order: list[str | Column]) -> DataFrame:
    """Per non-empty key the first row in ``order`` survives whole; empty keys drop out.

    ``row_number() = 1`` becomes a group limit on both sides of the shuffle, so every
    task sends at most one row per key: a key held by a third of all rows costs no more.
    """
    keyed = df.withColumn("_key", text_or_empty(key)).where(F.col("_key") != "")
    ranked = keyed.withColumn("_n", F.row_number().over(W.partitionBy("_key").orderBy(*order)))
    return ranked.where(F.col("_n") == 1).drop("_n", "_key")


def union_ranked(sources: list[DataFrame], rank: str = "source_rank") -> DataFrame:
    """All sources in listed order; the rank carries the order, absent columns become null."""
    ranked = [df.withColumn(rank, F.lit(i)) for i, df in enumerate(sources)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), ranked)


def merge_ranked(rows: DataFrame, order: list[str | Column], rank: str = "query_rank") -> DataFrame:
    """Rows found by several queries: key is id, else url, else title; the lowest rank wins.

    Rows with none of the three share the empty key, of which one survives.
    """
    key = first_nonempty(F.col("id"), F.col("url"), F.col("title"))
    return first_wins(rows, F.concat(F.lit("k:"), key), [rank, *order])


def merge_queries(results: list[DataFrame], order: list[str | Column]) -> DataFrame:
    """The same for separate result tables, in the order of their queries."""
    return merge_ranked(union_ranked(results, "query_rank"), order)
