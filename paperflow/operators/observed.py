"""Release checks from the job that writes the day documents, without reading them a second time.

Each rule that a single row decides is watched while the rows pass to the sink: an observed metric holds the days that fail it as a bitmap, 4 KiB
a rule however many rows and days pass.  When the writes are done the verdict is made from the bitmaps alone.

A bitmap has one bit per day from 1970-01-01 to 2059-09-18; the first and the last day are watched too, and a day outside fails the job.
Rules that compare days, count over rows or look at whether other artefacts exist need the stored documents: ``gates.release_gates``.
"""

from __future__ import annotations

import datetime
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions import fixed_values as V
from ..functions.text import strip_markup, text_or_empty
from .gates import Artefacts, _whole

EPOCH = datetime.date(1970, 1, 1)
DAYS = 32_768


def _place(day: Column) -> Column:
    return F.bitmap_bit_position(F.datediff(day, F.lit(EPOCH)) + 1)


def days_where(test: Column, day: str = "day") -> Column:
    """The days of rows for which ``test`` holds, as a bitmap."""
    return F.bitmap_construct_agg(F.when(test, _place(F.col(day))))


def unpacked(bitmap: bytes | None) -> set[datetime.date]:
    if bitmap is None:
        return set()
    return {EPOCH + datetime.timedelta(days=8 * i + j) for i, byte in enumerate(bitmap) if byte for j in range(8) if byte >> j & 1}


def watched(rows: DataFrame, tests: dict[str, Column], day: str = "day") -> tuple[DataFrame, Observation]:
    """The rows, and the metrics of whatever job runs over them: the days of each test, all days, the first and the last one."""
    seen = Observation()
    metrics = [days_where(F.coalesce(test, F.lit(False)), day).alias(name) for name, test in tests.items()]
    return rows.observe(seen, *metrics, days_where(F.col(day).isNotNull(), day).alias("days"), F.min(day).alias("first"), F.max(day).alias("last")), seen


def days_of(seen: Observation) -> dict[str, set[datetime.date]]:
    found = seen.get
    for bound in (found["first"], found["last"]):
        if bound is not None and not 0 <= (bound - EPOCH).days < DAYS:
            raise ValueError(f"{bound} is outside of the days that can be watched")
    return {name: unpacked(value) for name, value in found.items() if name not in ("first", "last")}


def trend_tests(min_share: float = V.MIN_SELECTED_SHARE) -> dict[str, Column]:
    iso = F.date_format("day", "yyyy-MM-dd")
    scanned, selected = F.col("total_scanned").try_cast("bigint"), F.col("selected").try_cast("bigint")
    listed = F.aggregate(F.map_values("by_cat"), F.lit(0).cast("bigint"), lambda t, v: t + F.coalesce(v.try_cast("bigint"), F.lit(0).cast("bigint")))
    return {
        "G03_date": F.col("doc_date") == iso,
        "G04_listing_date": F.col("listing_date") == iso,
        "G05_mode": F.col("source_mode").isin(*V.SOURCE_MODES),
        "G06_scope": F.col("scope") == V.RELEASE_SCOPE,
        "G07_counts_present": F.size("by_cat") > 0,
        "G08_counts_whole": F.forall(F.map_values("by_cat"), lambda v: F.coalesce(_whole(v), F.lit(False))),
        "G09_totals": _whole(F.col("total_scanned")) & _whole(F.col("selected")) & (scanned >= selected) & (selected >= 0),
        "G18_enough_listed": listed >= V.MIN_LISTED,
        "G19_selected_share": selected >= scanned * F.lit(min_share),
        "G21_shown_is_parsed": F.col("shown") == F.col("parsed"),
        "G21_unknown": F.col("shown").isNull() | F.col("parsed").isNull(),
    }


def post_tests(markers: tuple[str, ...] = V.POST_MARKERS, banned: tuple[str, ...] = V.BANNED_PHRASES) -> dict[str, Column]:
    html = text_or_empty(F.col("html"))
    return {
        "G10_post_markers": F.contains(html, F.lit("<h1")) & F.contains(html, F.date_format("day", "yyyy-MM-dd"))
        & reduce(and_, [F.contains(html, F.lit(m)) for m in markers]),
        "has_banned": reduce(or_, [F.contains(F.col("_plain"), F.lit(p)) for p in banned]),
    }


def row_tests() -> dict[str, dict[str, Column]]:
    """Rows that break a rule on their own."""
    first = F.col("pos") < V.CHECKED_CLUSTERS
    return {"clusters": {"few_papers": first & (F.col("papers") < V.MIN_CLUSTER_PAPERS), "short_why": first & (F.char_length("why") < V.MIN_WHY_CHARS)},
            "ids": {"stray": F.substring("id", 1, 4) != F.date_format("day", "yyMM")}}


def write_watched(a: Artefacts, path: str, fmt: str = "parquet") -> DataFrame:
    """Writes posts, trends, clusters and ids, one folder each, and returns ``day, rule, ok`` for the rules that their rows decide."""
    plain = a.posts.withColumn("_plain", strip_markup(F.col("html"), " ", "all"))
    inputs = {"posts": (plain, post_tests()), "trends": (a.trends, trend_tests()), "clusters": (a.clusters, row_tests()["clusters"]), "ids": (a.ids, row_tests()["ids"])}
    found = {}
    for name, (rows, tests) in inputs.items():
        passing, seen = watched(rows, tests)
        passing.drop("_plain").write.mode("overwrite").format(fmt).save(f"{path}/{name}")
        found[name] = days_of(seen)
    posts, trends = found["posts"], found["trends"]
    rules = {name: trends[name] for name in trend_tests() if name != "G21_unknown"} | {"G10_post_markers": posts["G10_post_markers"]}
    broken = {"G16_cluster_papers": found["clusters"]["few_papers"], "G17_cluster_why": found["clusters"]["short_why"], "G20_id_month": found["ids"]["stray"],
              "G24_no_banned_phrase": posts["has_banned"]}
    rows = []
    for day in sorted(posts["days"] | trends["days"]):
        for rule, days in rules.items():
            rows.append((day, rule, None if rule.startswith("G21") and day in trends["G21_unknown"] else day in days))
        rows += [(day, rule, day not in days) for rule, days in broken.items()]
    return a.posts.sparkSession.createDataFrame(rows, "day date, rule string, ok boolean")


OBSERVED = ("G03_date", "G04_listing_date", "G05_mode", "G06_scope", "G07_counts_present", "G08_counts_whole", "G09_totals", "G10_post_markers",
            "G16_cluster_papers", "G17_cluster_why", "G18_enough_listed", "G19_selected_share", "G20_id_month", "G21_shown_is_parsed",
            "G24_no_banned_phrase")
