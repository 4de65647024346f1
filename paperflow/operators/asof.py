"""Joins on order: the last earlier row of another table, and rows within many windows.

Neither compares rows by nested loops, and no key has to fit in one task: time is cut into buckets, and only buckets of a key are sorted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def micros(at: Column) -> Column:
    """A date or timestamp as a whole number, in microseconds; a date is its midnight."""
    return F.unix_micros(at.cast("timestamp"))


def asof_join(left: DataFrame, right: DataFrame, by: list[str], left_on: Column, right_on: Column, carry: list[str], width: int,
              strict: bool = True, ties: list[str] | None = None) -> DataFrame:
    """``left`` with the columns ``carry`` of the last row of ``right`` with the same ``by`` that comes before it; null where there is none.

    ``left_on`` and ``right_on`` are whole numbers (see ``micros``), ``width`` the length of a bucket in the same unit.  ``strict`` asks for an
    earlier row, else one at the same place counts too.  Of rows of ``right`` at one place the last by ``ties`` (``carry`` if not
    given) counts.  Keys compare null-safe, rows of ``left`` without a place stay without a match, those of ``right`` are no match for any.

    Both sides are stacked and ordered within (key, bucket); the last value of each bucket is handed on over the buckets of the key, of which
    there are as many as the time span has, and met again by (key, bucket).
    """
    names = [f"__by{i}" for i in range(len(by))]
    order = [c for c in (carry if ties is None else ties)]
    value = F.struct(*[F.col(c).alias(c) for c in dict.fromkeys([*order, *carry])])
    lefts = left.select(*[F.col(b).alias(n) for b, n in zip(by, names)], left_on.cast("bigint").alias("__at"), F.lit(not strict).alias("__side"),
                        F.struct(*[F.col(c) for c in left.columns]).alias("__row"), F.lit(None).cast(right.select(value.alias("v")).schema["v"].dataType).alias("__value"))
    rights = right.select(*[F.col(b).alias(n) for b, n in zip(by, names)], right_on.cast("bigint").alias("__at"), F.lit(strict).alias("__side"),
                          F.lit(None).cast(lefts.schema["__row"].dataType).alias("__row"), value.alias("__value")).where("__at is not null")
    both = lefts.unionByName(rights).withColumn("__bucket", F.floor(F.col("__at") / F.lit(width)).cast("bigint"))
    buckets = both.groupBy(*names, "__bucket").agg(F.max(F.when(F.col("__value").isNotNull(), F.struct("__at", "__value"))).alias("__last"))
    before = W.partitionBy(*names).orderBy("__bucket").rowsBetween(W.unboundedPreceding, -1)
    handed = buckets.select(*[F.col(n).alias(f"{n}_b") for n in names], F.col("__bucket").alias("__bucket_b"),
                            F.last("__last.__value", ignorenulls=True).over(before).alias("__handed")).where("__handed is not null")
    within = W.partitionBy(*names, "__bucket").orderBy("__at", "__side", "__value").rowsBetween(W.unboundedPreceding, W.currentRow)
    placed = both.withColumn("__near", F.last("__value", ignorenulls=True).over(within)).where("__row is not null")
    placed = placed.withColumn("__near", F.when(F.col("__at").isNotNull(), F.col("__near")))
    same = F.col("__bucket") == F.col("__bucket_b")
    for n in names:
        same &= F.col(n).eqNullSafe(F.col(f"{n}_b"))
    found = placed.join(handed, same, "left").withColumn("__found", F.coalesce("__near", "__handed"))
    return found.select("__row.*", *[F.col(f"__found.{c}").alias(f"asof_{c}") for c in carry])


def bins(start: Column, end: Column, width: int) -> Column:
    """The bins that a window from ``start`` up to but without ``end`` touches; none if it is empty."""
    return F.when(end > start, F.sequence(F.floor(start / F.lit(width)).cast("bigint"), F.floor((end - 1) / F.lit(width)).cast("bigint")))


def range_join(points: DataFrame, windows: DataFrame, at: Column, start: Column, end: Column, width: int, by: list[str] | None = None) -> DataFrame:
    """Every row of ``points`` with every row of ``windows`` in which it lies: ``start <= at < end`` and equal ``by``.

    Windows are cut at bins of ``width``, points are put into theirs, and both meet by bin and key: an equi-join, in which rows are only compared
    with windows that touch their bin, and whose hot bins adaptive execution splits.  The best width is about the usual length of a
    window.  The result has the columns ``point`` and ``window`` as structs; points and windows with a null bound or key do not meet.
    """
    by = by or []
    names = [f"__by{i}" for i in range(len(by))]
    cut = windows.select(*[F.col(b).alias(n) for b, n in zip(by, names)], start.cast("bigint").alias("__start"), end.cast("bigint").alias("__end"),
                         F.struct(*windows.columns).alias("window"))
    cut = cut.select("*", F.explode(bins(F.col("__start"), F.col("__end"), width)).alias("__bin"))
    placed = points.select(*[F.col(b).alias(n) for b, n in zip(by, names)], at.cast("bigint").alias("__at"), F.struct(*points.columns).alias("point")).withColumn(
        "__bin", F.floor(F.col("__at") / F.lit(width)).cast("bigint"))
    met = placed.join(cut, ["__bin", *names])
    return met.where((F.col("__at") >= F.col("__start")) & (F.col("__at") < F.col("__end"))).select("point", "window")
