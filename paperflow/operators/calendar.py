"""Calendar work: gaps, completeness, previous day, provisional days, trailing windows, run mode."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import fixed_values as V
from ..functions.dates import is_weekend


def previous_day(days: DataFrame, keys: list[str], day: str = "day") -> DataFrame:
    """The greatest existing day strictly before each day, per key: not simply the day before.

    Days are made distinct first, so a window holds at most one row per calendar day.
    """
    distinct = days.select(*keys, day).distinct()
    return distinct.withColumn("prev_day", F.lag(day).over(W.partitionBy(*keys).orderBy(day)))


def weekday_gaps(days: DataFrame, keys: list[str], until: Column, day: str = "day") -> DataFrame:
    """Weekdays missing between a key's first day and ``until``, oldest first within a key.

    Each day opens a gap that ends at the key's next day, so the calendar is never
    multiplied with the keys.
    """
    distinct = days.select(*keys, day).distinct()
    following = F.lead(day).over(W.partitionBy(*keys).orderBy(day))
    stop = F.coalesce(following, F.date_add(until, 1))
    spans = distinct.withColumn("_stop", stop).where(F.datediff("_stop", F.col(day)) > 1)
    missing = spans.select(*keys, F.explode(F.sequence(F.date_add(day, 1), F.date_sub("_stop", 1))).alias("missing_day"))
    return missing.where(~is_weekend(F.col("missing_day")))


def missing_kinds(artefacts: DataFrame, keys: list[str], kind: str, required: tuple[str, ...]) -> DataFrame:
    """Per key the required kinds that it lacks: one shuffle, one bit per kind."""
    bit = F.lit(0)
    for i, name in enumerate(required):
        bit = F.when(F.col(kind) == name, F.lit(1 << i)).otherwise(bit)
    masks = artefacts.groupBy(*keys).agg(F.bit_or(bit).alias("_mask"))
    wanted = F.array(*[F.struct(F.lit(1 << i).alias("bit"), F.lit(n).alias("kind")) for i, n in enumerate(required)])
    absent = F.filter(wanted, lambda w: F.col("_mask").bitwiseAND(w["bit"]) == 0)
    return masks.select(*keys, F.explode(absent).alias("_w")).select(*keys, F.col("_w.kind").alias("missing_kind"))


def provisional_days(stored: DataFrame, listed: DataFrame, keys: list[str], mode: str = "source_mode") -> DataFrame:
    """Days stored without a listing for which the listing has arrived since."""
    waiting = stored.where(F.col(mode) == "journal-only")
    return waiting.join(listed.select(*keys).distinct(), keys, "left_semi")


def trailing_windows(daily: DataFrame, keys: list[str], value: str, day: str = "day",
                     windows: tuple[tuple[str, int], ...] = V.TRAILING_WINDOWS) -> DataFrame:
    """Sums over the days within N days of the latest one, for every window.

    ``daily`` is one row per day and key.  The latest day is a scalar subquery, which
    reads the day column alone and gathers nothing in one task, however many keys there are.
    """
    latest = daily.agg(F.max(day)).scalar()
    defs = F.array(*[F.struct(F.lit(label).alias("label"), F.lit(n).alias("days")) for label, n in windows])
    inside = F.filter(defs, lambda w: F.col(day) > F.date_sub(F.col("_latest"), w["days"]))
    rows = daily.withColumn("_latest", latest).select(*keys, value, F.explode(inside).alias("_w"))
    return (
        rows.groupBy(F.col("_w.label").alias("window_label"), F.col("_w.days").alias("window_days"), *keys)
        .agg(F.sum(value).alias(value))
    )


def run_mode(post: Column, listing: Column, journal_clusters: Column, has_gaps: Column) -> Column:
    """What to publish for a day, given the date the listing shows.

    Weekend without gaps: nothing.  Same date: the new listing.  Listing already
    further on: the dated section.  Listing not there yet: registry rows alone if they
    form enough clusters, else nothing.
    """
    return (
        F.when(is_weekend(post) & ~has_gaps, F.lit("none"))
        .when(post == listing, F.lit("new"))
        .when(post < listing, F.lit("pastweek-date-section"))
        .when(journal_clusters >= V.MIN_CLUSTERS, F.lit("journal-only"))
        .otherwise(F.lit("none"))
    )
