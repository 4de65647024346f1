"""Release checks as a table: one row per day and rule."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import fixed_values as V
from ..functions.text import once, strip_markup, text_or_empty
from .calendar import previous_day
from .sets import overlap_with_previous


@dataclass(frozen=True)
class Artefacts:
    """The day documents under check, all keyed by ``day DATE``.

    posts       day, html
    trends      day, readable, doc_date, listing_date, source_mode, scope,
                by_cat MAP<STRING,STRING>, total_scanned STRING, selected STRING: JSON tokens, so that
                the string "7" is no number; counts_object: the whole counts as canonical JSON;
                shown, parsed, geometry_papers, geometry_named (counts, null where not known)
    insights    day, readable
    clusters    day, pos, title, papers (count), why; null papers or why means not held to the rule
    ids         day, id
    benchmarks  day, readable
    feed        day
    series      day, by_cat MAP<STRING,BIGINT>
    """

    posts: DataFrame
    trends: DataFrame
    insights: DataFrame
    clusters: DataFrame
    ids: DataFrame
    benchmarks: DataFrame
    feed: DataFrame
    series: DataFrame


def _sorted_counts(by_cat: Column) -> Column:
    # maps have no equality; their sorted entries do
    return F.to_json(F.sort_array(F.map_entries(F.transform_values(by_cat, lambda k, v: v.cast("string")))))


def _whole(text: Column) -> Column:
    return text.rlike(r"^-?\d+$")


def banned_phrase_counts(posts: DataFrame, phrases: tuple[str, ...] = V.BANNED_PHRASES,
                         html: str = "html") -> DataFrame:
    """Occurrences of each banned phrase over all posts: one counter per phrase, one pass."""
    text = once(posts.select(strip_markup(F.col(html), " ", "all").alias("_plain")), _t=F.col("_plain")).select("_t")
    sums = [F.sum(F.char_length("_t") - F.char_length(F.replace("_t", F.lit(p), F.lit("")))).alias(f"p{i}")
            for i, p in enumerate(phrases)]
    rows = F.array(*[
        F.struct(F.lit(p).alias("phrase"), F.floor(F.coalesce(F.col(f"p{i}"), F.lit(0)) / len(p)).cast("bigint").alias("n"))
        for i, p in enumerate(phrases)])
    return text.agg(*sums).select(F.inline(rows))


def release_gates(a: Artefacts, markers: tuple[str, ...] = V.POST_MARKERS,
                  banned: tuple[str, ...] = V.BANNED_PHRASES,
                  geometry: str = "(?i)geometry|slam|recon",
                  min_share: float = V.MIN_SELECTED_SHARE) -> DataFrame:
    """``day, rule, ok``: every rule for every day that has any artefact; a null ``ok`` means not checkable.

    Days are compared with the day before only if that has both its trends and its insights.

    Each input shrinks to one row per day first, so what follows is as small as the
    calendar whatever the number of papers behind a day.
    """
    first = F.col("pos") < V.CHECKED_CLUSTERS
    clusters = a.clusters.groupBy("day").agg(
        F.count("title").alias("titles"),
        F.count_distinct("title").alias("distinct_titles"),
        F.min(F.when(first, F.col("papers"))).alias("fewest_papers"),
        F.min(F.when(first, F.char_length("why"))).alias("shortest_why"),
        F.max(F.col("title").rlike(geometry)).alias("geometry_row"),
    )
    prev = previous_day(a.posts.select("day"), [])
    title_overlap = overlap_with_previous(a.clusters, [], "day", "title", prev).select(
        "day", F.col("shared").alias("shared_titles"))
    id_overlap = overlap_with_previous(a.ids, [], "day", "id", prev).select(
        "day", ((F.col("items") == F.col("prev_items")) & (F.col("items") == F.col("shared"))).alias("same_ids"))
    strays = a.ids.groupBy("day").agg(
        F.count_if(F.substring("id", 1, 4) != F.date_format("day", "yyMM")).alias("stray_ids"))
    html, plain = text_or_empty(F.col("html")), F.col("_plain")
    posts = a.posts.withColumn("_plain", strip_markup(F.col("html"), " ", "all")).select(
        "day",
        F.lit(True).alias("has_post"),
        (F.contains(html, F.lit("<h1")) & F.contains(html, F.date_format("day", "yyyy-MM-dd"))).alias("has_heading"),
        reduce(and_, [F.contains(html, F.lit(m)) for m in markers]).alias("has_markers"),
        reduce(or_, [F.contains(plain, F.lit(p)) for p in banned]).alias("has_banned"),
        plain.rlike(geometry).alias("geometry_note"),
    )
    counts = _sorted_counts(F.col("by_cat"))
    trends = a.trends.withColumn("has_trends", F.lit(True)).withColumn("counts", counts).withColumn(
        "fingerprint", F.to_json(F.array("counts_object", "total_scanned", "selected")))
    facts = [
        posts, trends, clusters, title_overlap, id_overlap, strays,
        a.insights.select("day", F.col("readable").alias("insights_ok")),
        a.benchmarks.select("day", F.col("readable").alias("benchmarks_ok")),
        a.feed.select("day", F.lit(True).alias("in_feed")),
        a.series.select("day", _sorted_counts(F.col("by_cat")).alias("series_counts")),
    ]
    # Each input brings its own columns; stacking them and taking what each day has is
    # one small shuffle where a join per input would be ten.
    stacked = reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), facts)
    names = [c for c in stacked.columns if c != "day"]
    wide = stacked.groupBy("day").agg(*[F.any_value(c, True).alias(c) for c in names])
    wide = wide.where(F.col("has_post") | F.col("has_trends") | F.col("insights_ok").isNotNull())
    # the last earlier day that has a post; a day is one row here
    earlier = W.orderBy("day").rowsBetween(W.unboundedPreceding, -1)
    complete = (F.col("has_trends") & F.col("insights_ok").isNotNull()).alias("complete")
    before = F.last(F.when(F.col("has_post"), F.struct("fingerprint", complete)), True).over(earlier)
    wide = wide.withColumn("prev_fingerprint", before["fingerprint"]).withColumn("comparable", F.coalesce(before["complete"], F.lit(False)))
    iso = F.date_format("day", "yyyy-MM-dd")
    scanned, selected = F.col("total_scanned").try_cast("bigint"), F.col("selected").try_cast("bigint")
    listed = F.aggregate(F.map_values("by_cat"), F.lit(0).cast("bigint"),
                         lambda t, v: t + F.coalesce(v.try_cast("bigint"), F.lit(0).cast("bigint")))
    geometry_due = (F.coalesce("geometry_papers", F.lit(0)) >= 10) | (F.coalesce("geometry_named", F.lit(0)) >= 2)
    geometry_shown = F.coalesce("geometry_row", F.lit(False)) | F.coalesce("geometry_note", F.lit(False))
    rules = {
        "G01_artefacts_exist": F.col("has_post") & F.col("has_trends") & F.col("insights_ok").isNotNull()
        & F.col("benchmarks_ok").isNotNull() & F.col("in_feed"),
        "G02_json_readable": F.col("readable") & F.col("insights_ok") & F.col("benchmarks_ok"),
        "G03_date": F.col("doc_date") == iso,
        "G04_listing_date": F.col("listing_date") == iso,
        "G05_mode": F.col("source_mode").isin(*V.SOURCE_MODES),
        "G06_scope": F.col("scope") == V.RELEASE_SCOPE,
        "G07_counts_present": F.size("by_cat") > 0,
        "G08_counts_whole": F.forall(F.map_values("by_cat"), lambda v: F.coalesce(_whole(v), F.lit(False))),
        "G09_totals": _whole(F.col("total_scanned")) & _whole(F.col("selected")) & (scanned >= selected) & (selected >= 0),
        "G10_post_markers": F.col("has_heading") & F.col("has_markers"),
        "G11_feed_link": F.col("in_feed"),
        "G12_enough_clusters": F.col("titles") >= V.MIN_CLUSTERS,
        "G13_titles_unique": F.coalesce(F.col("titles") == F.col("distinct_titles"), F.lit(True)),
        "G14_title_overlap": ~F.col("comparable") | (F.coalesce("shared_titles", F.lit(0)) < V.MAX_REUSED_TITLES),
        "G15_not_identical": ~F.col("comparable") | ~(F.coalesce(F.col("fingerprint") == F.col("prev_fingerprint"), F.lit(False))
                               & F.coalesce("same_ids", F.lit(False))),
        "G16_cluster_papers": F.coalesce(F.col("fewest_papers") >= V.MIN_CLUSTER_PAPERS, F.lit(True)),
        "G17_cluster_why": F.coalesce(F.col("shortest_why") >= V.MIN_WHY_CHARS, F.lit(True)),
        "G18_enough_listed": listed >= V.MIN_LISTED,
        "G19_selected_share": selected >= scanned * F.lit(min_share),
        "G20_id_month": F.coalesce("stray_ids", F.lit(0)) == 0,
        "G21_shown_is_parsed": F.col("shown") == F.col("parsed"),
        "G22_series_row": F.col("counts") == F.col("series_counts"),
        "G23_geometry_row": ~geometry_due | geometry_shown,
        "G24_no_banned_phrase": ~F.coalesce("has_banned", F.lit(False)),
    }
    unknown = {
        "G21_shown_is_parsed": F.col("shown").isNull() | F.col("parsed").isNull(),
        "G23_geometry_row": F.col("geometry_papers").isNull() & F.col("geometry_named").isNull(),
    }

    def outcome(name: str, ok: Column) -> Column:
        failed = F.coalesce(ok, F.lit(False))
        return F.when(~(F.coalesce("has_trends", F.lit(False)) & unknown[name]), failed) if name in unknown else failed

    rows = F.array(*[F.struct(F.lit(name).alias("rule"), outcome(name, ok).alias("ok")) for name, ok in rules.items()])
    return wide.select("day", F.inline(rows))


def release_verdict(checks: DataFrame, warnings: tuple[str, ...] = ("G19_selected_share",)) -> DataFrame:
    """Per day how many rules fail and whether it may be published; a failed warning does not hold it back."""
    failing, warned = ~F.coalesce("ok", F.lit(True)), F.col("rule").isin(*warnings)
    counted = checks.groupBy("day").agg(
        F.count_if(failing & ~warned).alias("failures"), F.count_if(failing & warned).alias("warnings"))
    return counted.withColumn("publish", F.col("failures") == 0)
