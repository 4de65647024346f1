"""Counts over time and by group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import fixed_values as V
from ..functions.dates import is_weekend


def map_total(counts: Column) -> Column:
    """Sum of a map's values, null values counting as zero."""
    return F.aggregate(F.map_values(counts), F.lit(0).cast("bigint"),
                       lambda a, v: a + F.coalesce(v.cast("bigint"), F.lit(0).cast("bigint")))


def whole_counts(counts: Column) -> Column:
    """Map of texts to whole numbers: ``"7"`` and ``"7.9"`` both give 7, absent or unreadable gives 0."""
    def whole(k: Column, v: Column) -> Column:
        return F.coalesce(v.try_cast("double").try_cast("bigint"), F.lit(0).cast("bigint"))
    return F.transform_values(counts, whole)


def daily_series(trends: DataFrame, day: str = "day", counts: str = "by_cat", scope: str = "scope") -> DataFrame:
    """One row per weekday with total, default scope and weekday name; an empty map stays with total 0."""
    return (
        trends.where(F.col(counts).isNotNull() & ~is_weekend(F.col(day)))
        .withColumn("total", map_total(F.col(counts)))
        .withColumn("scope", F.coalesce(F.nullif(F.col(scope), F.lit("")), F.lit(V.LISTING_SCOPE)))
        .withColumn("weekday", F.date_format(day, "EEE"))
    )


def new_counts(papers: DataFrame, day: str, category: str, section: str = "section") -> DataFrame:
    """New and cross-listed rows per day and category, before any dedup across categories."""
    return (
        papers.where(F.col(section).isin("new", "cross"))
        .groupBy(day, category).agg(F.count("*").alias("n"))
    )


def weekly_rollup(daily: DataFrame, category: str, value: str = "n", day: str = "day") -> DataFrame:
    """Monday-to-Friday sums by category, with the number of days that week covers.

    The days are counted as bits of a mask, so the week needs no second pass over its days.
    """
    week = F.date_trunc("week", day).cast("date")
    rows = daily.where(~is_weekend(F.col(day))).withColumn("week_start", week)
    by_week = W.partitionBy("week_start")
    grouped = rows.groupBy("week_start", category).agg(
        F.sum(value).cast("bigint").alias(value),
        F.bit_or(F.call_function("shiftleft", F.lit(1), F.weekday(day))).alias("_mask"),
    )
    return (
        grouped.withColumn("days_covered", F.bit_count(F.bit_or("_mask").over(by_week)).cast("bigint"))
        .withColumn("week_total", F.sum(value).over(by_week).cast("bigint"))
        .drop("_mask")
    )


def listing_vote(shown: DataFrame, group: list[str], category: str, day: str) -> DataFrame:
    """The date most categories show; ``publish`` is false when half or more disagree.

    A tie goes to the earlier date.  Votes are counted first, so a group holds one row per date.
    """
    votes = shown.select(*group, category, day).distinct().groupBy(*group, day).agg(F.count("*").alias("_votes"))
    best = votes.groupBy(*group).agg(
        F.max_by(day, F.struct("_votes", -F.unix_date(day))).alias("listing_date"),
        F.max("_votes").alias("agreeing"),
        F.sum("_votes").alias("voting"),
    )
    return best.withColumn("publish", (F.col("voting") - F.col("agreeing")) * 2 < F.col("voting"))


def score_card(reviews: DataFrame, label: str) -> DataFrame:
    return reviews.groupBy(label).agg(F.count("*").alias("n"))


def evidence_grade(rows: DataFrame, group: list[str], paper: str, author_group: str) -> DataFrame:
    """High: three papers or more from different author groups; Medium: two or more; else Low."""
    counted = rows.groupBy(*group).agg(
        F.count_distinct(paper).alias("papers"), F.count_distinct(author_group).alias("author_groups"))
    grade = (
        F.when((F.col("papers") >= 3) & (F.col("author_groups") >= 2), "High")
        .when(F.col("papers") >= 2, "Medium")
        .otherwise("Low")
    )
    return counted.withColumn("grade", grade)


def running_best(results: DataFrame, keys: list[str], day: str, value: str, higher_is_better: bool = True) -> DataFrame:
    """Best value so far per benchmark in date order; null values are ignored.

    Each day is first reduced to its own best, so a window holds one row per day.
    """
    pick, f = (F.max, "max") if higher_is_better else (F.min, "min")
    daily = results.where(F.col(value).isNotNull()).groupBy(*keys, day).agg(pick(value).alias("day_best"))
    w = W.partitionBy(*keys).orderBy(day).rowsBetween(W.unboundedPreceding, W.currentRow)
    return daily.withColumn("best", pick("day_best").over(w))


def hot_cold(weekly: DataFrame, group: str, week: str = "week_start", value: str = "n") -> DataFrame:
    """Change against the previous calendar week and its rank within the week, hottest first.

    A group absent in one of the two weeks counts as zero there, so it can still turn hot or cold.
    """
    counts = weekly.groupBy(group, week).agg(F.sum(value).cast("bigint").alias("n"))
    zero = F.lit(0).cast("bigint")
    # every count serves twice: in its own week and as the past of the week after
    both = F.array(F.struct(F.col(week).alias(week), F.col("n").alias("n"), zero.alias("prev_n")),
                   F.struct(F.date_add(week, 7).alias(week), zero.alias("n"), F.col("n").alias("prev_n")))
    merged = (
        counts.withColumn("_last", weekly.agg(F.max(week)).scalar())
        .select(group, "_last", F.inline(both)).where(F.col(week) <= F.col("_last"))
        .groupBy(group, week).agg(F.sum("n").alias("n"), F.sum("prev_n").alias("prev_n"))
    )
    merged = merged.withColumn("delta", F.col("n") - F.col("prev_n"))
    return merged.withColumn("heat_rank", F.rank().over(W.partitionBy(week).orderBy(F.desc("delta"))).cast("bigint"))
