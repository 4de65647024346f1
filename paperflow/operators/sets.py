"""Set comparisons between sources, days and buckets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import fixed_values as V
from .calendar import previous_day


def contrast(rows: DataFrame, item: str, side: Column, left: str, right: str) -> DataFrame:
    """Each item as shared, or only on one side: one aggregation instead of three set operations."""
    flags = rows.withColumn("_side", side).where(F.col("_side").isin(left, right)).groupBy(item).agg(
        F.bool_or(F.col("_side") == left).alias("_l"), F.bool_or(F.col("_side") == right).alias("_r"))
    kind = F.when(F.col("_l") & F.col("_r"), "shared").when(F.col("_l"), left).otherwise(right)
    return flags.select(item, kind.alias("kind"))


def watch_candidates(counts: DataFrame, name: str, value: str, rank: str, watched: tuple[str, ...],
                     leading: int = 3, at_least: int = 2) -> DataFrame:
    """Watched buckets with enough papers that are not among the ``leading`` ones.

    ``counts`` is one row per dictionary bucket.
    """
    place = F.row_number().over(W.orderBy(F.desc(value), F.asc(rank)))
    return counts.withColumn("_place", place).where(
        F.col(name).isin(*watched) & (F.col(value) >= at_least) & (F.col("_place") > leading)).drop("_place")


def crossover_pairs(df: DataFrame, hits: Column, names: list[str]) -> DataFrame:
    """How many rows hit both buckets of each pair of dictionary buckets.

    One counter per pair of the fixed dictionary in a single aggregate: rows are never
    turned into pairs.
    """
    pairs = [(i, j) for i in range(len(names)) for j in range(i + 1, len(names))]
    staged = df.select(F.inline(F.array(F.struct(hits.alias("_h")))))
    counters = [F.count_if((F.get("_h", i) > 0) & (F.get("_h", j) > 0)).alias(f"p{i}_{j}") for i, j in pairs]
    wide = staged.agg(*counters)
    rows = F.array(*[F.struct(F.lit(names[i]).alias("bucket_a"), F.lit(names[j]).alias("bucket_b"),
                              F.col(f"p{i}_{j}").alias("n")) for i, j in pairs])
    return wide.select(F.inline(rows)).where(F.col("n") > 0)


def _calendar_side(days: DataFrame, keys: list[str]) -> DataFrame:
    # Without further keys there is at most one row per calendar day: small for certain.
    return days if keys else F.broadcast(days)


def _own_and_carried(distinct: DataFrame, days: DataFrame, keys: list[str], day: str, items: list[str]) -> DataFrame:
    """Per key, day and item whether the day has the item and whether the day before had it.

    Every row speaks for its own day and for the next existing one, so one aggregation
    on (day, item) replaces a join of the days with each other; a crowded day spreads by item.
    """
    following = days.where(F.col("prev_day").isNotNull()).select(
        *keys, F.col("prev_day").alias(day), F.col(day).alias("_next"))
    rows = distinct.join(_calendar_side(following, keys), [*keys, day], "left")
    both = F.array(F.struct(F.col(day).alias(day), F.lit(1).alias("own"), F.lit(0).alias("carried")),
                   F.struct(F.col("_next").alias(day), F.lit(0).alias("own"), F.lit(1).alias("carried")))
    spoken = rows.select(*keys, *items, F.inline(both)).where(F.col(day).isNotNull())
    return spoken.groupBy(*keys, day, *items).agg(F.max("own").alias("own"), F.max("carried").alias("carried"))


def overlap_with_previous(items: DataFrame, keys: list[str], day: str, item: str,
                          days: DataFrame | None = None) -> DataFrame:
    """Per day: how many distinct items, how many the previous existing day had, how many they share.

    ``days`` (keys, day, ``prev_day``) says which days exist; without it, the days that have items.
    Items are never collected into sets, so a day may hold any number of them.
    """
    distinct = items.select(*keys, day, item).distinct()
    days = previous_day(distinct, keys, day) if days is None else days
    counted = _own_and_carried(distinct, days, keys, day, [item]).groupBy(*keys, day).agg(
        F.sum("own").alias("items"), F.sum("carried").alias("prev_items"), F.sum(F.col("own") * F.col("carried")).alias("shared"))
    return days.join(_calendar_side(counted, keys), [*keys, day], "left").select(*keys, day, "prev_day", *[
        F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("items", "prev_items", "shared")])


def turnover_under_title(rows: DataFrame, day: str, title: str, item: str) -> DataFrame:
    """Titles a day shares with the previous day, and how many of their ids are new.

    ``rename`` is true when at most three titles are shared but at least half of the
    ids under this title are new.
    """
    distinct = rows.select(day, title, item).distinct()
    counted = _own_and_carried(distinct, previous_day(distinct, [], day), [], day, [title, item]).groupBy(day, title).agg(
        F.sum("own").alias("ids"), F.sum("carried").alias("_before"), F.sum(F.col("own") * F.col("carried")).alias("_kept"))
    shared = counted.where((F.col("ids") > 0) & (F.col("_before") > 0))
    per_day = shared.groupBy(day).agg(F.count("*").alias("shared_titles"))  # one row per calendar day
    out = shared.join(F.broadcast(per_day), day).withColumn("changed", F.col("ids") - F.col("_kept"))
    few = F.col("shared_titles") < V.MAX_REUSED_TITLES
    return out.select(day, title, "ids", "changed", "shared_titles",
                      (few & (F.col("changed") * 2 >= F.col("ids"))).alias("rename"))


def identical_batches(counts: DataFrame, ids: DataFrame, keys: list[str], day: str,
                      category: str, value: str, item: str) -> DataFrame:
    """Whether a day equals the previous existing day in all counts by category and in its set of ids.

    Counts are few per day and are compared as one text; ids are compared by how many
    the two days share.
    """
    pairs = F.sort_array(F.collect_list(F.concat_ws(":", category, F.col(value).cast("string"))))
    prints = counts.groupBy(*keys, day).agg(F.array_join(pairs, " ").alias("_print"))
    before = F.lag("_print").over(W.partitionBy(*keys).orderBy(day))
    same_counts = prints.withColumn("same_counts", F.coalesce(F.col("_print") == before, F.lit(False))).drop("_print")
    overlap = overlap_with_previous(ids, keys, day, item)
    same_ids = (F.col("items") == F.col("prev_items")) & (F.col("items") == F.col("shared"))
    joined = same_counts.join(overlap.withColumn("same_ids", same_ids), [*keys, day])
    return joined.select(*keys, day, "same_counts", "same_ids", (F.col("same_counts") & F.col("same_ids")).alias("identical"))
