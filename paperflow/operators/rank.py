"""Top-k reports and ordered lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import fixed_values as V
from ..functions.text import once


def newest_items(posts: DataFrame, day: str, weekly: str, tie: str, n: int = V.FEED_ITEMS) -> DataFrame:
    """The ``n`` newest posts; on the same date the weekly one comes first.

    Every task keeps its ``n`` best rows.  The generator on top keeps later projections
    from moving below the limit, where an Arrow function among them would turn the
    top-n into a full sort of all posts.
    """
    newest = posts.orderBy(F.desc(day), F.desc(weekly), F.asc(tie)).limit(n)
    return once(newest, _kept=F.lit(True)).drop("_kept")


def merged_list(posts: DataFrame, linked: DataFrame, key: str, day: str, weekly: str, tie: str) -> DataFrame:
    """All posts, newest first, with ``was_linked``: one pass over the posts and one lookup."""
    known = linked.select(key).distinct().withColumn("was_linked", F.lit(True))
    flagged = posts.join(known, key, "left").withColumn("was_linked", F.coalesce("was_linked", F.lit(False)))
    return flagged.orderBy(F.desc(day), F.desc(weekly), F.asc(tie))


def missing_links(posts: DataFrame, linked: DataFrame, name: str, prefix: str = r"^\d{4}-\d{2}-\d{2}") -> DataFrame:
    """Posts that no entry links yet; a name that does not begin like a post's is none."""
    return posts.where(F.col(name).rlike(prefix)).join(linked.select(name).distinct(), name, "left_anti")


def leaders(papers: DataFrame, group: str, order: list[Column], per_group: int = 3,
            capped: dict[str, int] | None = None) -> DataFrame:
    """Leading rows per group; ``capped`` names groups with a smaller limit.

    The constant limit is what the engine pushes below the shuffle: every task sends
    at most that many rows per group, however large the group.
    """
    ranked = papers.withColumn("rank", F.row_number().over(W.partitionBy(group).orderBy(*order)))
    ranked = ranked.where(F.col("rank") <= per_group)
    for name, limit in (capped or {}).items():
        ranked = ranked.where((F.col(group) != name) | (F.col("rank") <= limit))
    return ranked


def top_and_bottom(counts: DataFrame, value: str, rank: str, top: int = 3, bottom: int = 2) -> DataFrame:
    """The largest and smallest groups; ties follow the dictionary order.

    ``counts`` is one row per dictionary bucket, so ranking it twice over all rows is
    cheaper than computing it twice.
    """
    down = F.row_number().over(W.orderBy(F.desc(value), F.asc(rank)))
    up = F.row_number().over(W.orderBy(F.asc(value), F.asc(rank)))
    ranked = counts.withColumn("_down", down).withColumn("_up", up)
    sides = F.array_compact(F.array(F.when(F.col("_down") <= top, F.lit("top")), F.when(F.col("_up") <= bottom, F.lit("bottom"))))
    return ranked.withColumn("side", F.explode(sides)).drop("_down", "_up")


def bar_widths(counts: DataFrame, name: str, value: str, catch_all: str = V.CATCH_ALL_BUCKET) -> DataFrame:
    """Percent of the largest bucket other than the catch-all, which is always 100; zero stays zero.

    ``counts`` is one row per dictionary bucket.
    """
    largest = F.max(F.when(F.col(name) != catch_all, F.col(value))).over(W.partitionBy())
    share = F.when(F.col("_max") > 0, F.floor((F.col(value) * 200 + F.col("_max")) / (2 * F.col("_max")))).otherwise(0)
    width = F.when(F.col(name) == catch_all, F.lit(100)).otherwise(share)
    return counts.withColumn("_max", largest).withColumn("width", width.cast("bigint")).drop("_max")
