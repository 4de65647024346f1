"""Scans and sinks, with what is written read back from the shared folder."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import feed_stamp
from ..operators.classify import bucket_summary
from ..operators.rollup import daily_series, map_total
from ..schemas import BENCHMARK_DAY, INSIGHTS_DAY, PAPER, WEEKLY
from ..session import scratch_path
from ..sources import landed, sinks
from ..sources.feed import FIELDS, Channel, channel_options, feed_document, read_feed_items, register, write_feed_document
from ..sources.tables import table
from .catalog import SQL, job
from .enrichment import SITE, feed
from .rollups import count_text, daily_maps
from .standins import BUCKETS, classified, papers


def mounted(path: str) -> str:
    """A path of the shared folder as the machines' own file system knows it."""
    return path.removeprefix("file://") if path.startswith("file:///") else path.removeprefix("file:")


@job("scan_pages", "SELECT page_id, url, CAST(length(html) AS BIGINT) AS chars, md5(html) AS html_md5 FROM pages")
def _(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages")
    return pages.select("page_id", "url", F.char_length("html").cast("bigint").alias("chars"), F.md5("html").alias("html_md5"))


def _paper_json(nested: bool):
    paper = F.struct("title", "abstract", "arxiv_id", F.col("h").alias("doi"))
    second = F.to_json(F.struct(F.concat("title", F.lit(" II")).alias("title"), F.col("h").alias("doi")))
    if not nested:
        return F.concat(F.lit("[1, "), F.to_json(paper), F.lit(', "text", null, '), second, F.lit("]"))
    return F.concat(F.lit('{"total": 1, "buckets": {"a": null, "b": {"papers": ['), F.to_json(paper), F.lit(', 7]}, "c": {"total": 0}, "d": {"papers": ['),
                    second, F.lit("]}}}"))


@job("flatten_buckets", """WITH @PAPERS@ SELECT doc_id, CAST(0 AS BIGINT) AS pos, title, md5(abstract) AS abstract_md5, h AS doi FROM papers
UNION ALL SELECT doc_id, 1, title || ' II', NULL, h FROM papers""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    """Two papers in one of the two document shapes, among entries that are no papers; ``pos`` counts papers only."""
    nested = F.col("source") == ""
    texts = papers(spark, folder).select("doc_id", F.when(nested, _paper_json(True)).otherwise(_paper_json(False)).alias("text"))
    return landed.papers_from(texts).select(
        "doc_id", F.col("pos").cast("bigint"), "title", F.md5("abstract").alias("abstract_md5"), "doi")


@job("scan_tolerant_json", """WITH c AS (SELECT strftime(ts, '%Y-%m-%d') AS day, CAST(json_extract(props, '$.k') AS BIGINT) AS k, event_type FROM events
  WHERE event_type NOT IN ('error', 'signup'))
SELECT day, count(*) AS docs, CAST(sum(k) AS BIGINT) AS total FROM c GROUP BY day""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return days_per_date(landed.trends_from(trend_texts(spark, folder)))


def days_per_date(days: DataFrame) -> DataFrame:
    totals = days.withColumn("total", map_total(F.col("by_cat")))
    return totals.groupBy(F.date_format("day", "yyyy-MM-dd").alias("day")).agg(F.count("*").alias("docs"), F.sum("total").alias("total"))


@job("scan_landed_json", SQL["scan_tolerant_json"])
def _(spark: SparkSession, folder: str) -> DataFrame:
    """The same from documents that were parsed once, when they landed."""
    path = scratch_path(spark, "landed-documents")
    landed.land_documents(trend_texts(spark, folder), path)
    return days_per_date(landed.trends_of(spark.read.parquet(path)))


def trend_texts(spark: SparkSession, folder: str) -> DataFrame:
    """A day document per event, some of them unreadable or without counts."""
    k = F.get_json_object("props", "$.k")
    counts = F.when(F.col("event_type") == "view", F.concat(F.lit('{"a": "'), k, F.lit('.9", "b": null, "c": "?"}'))).when(
        F.col("event_type") == "signup", F.concat(F.lit("["), k, F.lit("]"))).otherwise(F.concat(F.lit('{"a": '), k, F.lit("}")))
    text = F.concat(F.lit('{"daily_new_counts": {"by_cat": '), counts, F.when(F.col("event_type") == "error", "").otherwise("}}"))
    name = F.concat(F.date_format("ts", "yyyy-MM-dd"), F.lit(".json"))
    return table(spark, folder, "events").select(name.alias("file_name"), text.alias("text"))


@job("scan_strict_json", """SELECT strftime(ts, '%Y-%m-%d') AS day, event_type AS benchmark, count(*) AS results, max(value) AS best FROM events GROUP BY ALL""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").select("ts", "event_type", "value")
    doc = F.to_json(F.struct(F.date_format("ts", "yyyy-MM-dd").alias("date"), F.array(F.struct(
        F.col("event_type").alias("benchmark"), F.lit("value").alias("metric"), F.col("value"))).alias("results")))
    docs = landed.strict_documents(events.select(doc.alias("text")), BENCHMARK_DAY)
    rows = docs.select(F.col("doc.date").alias("day"), F.inline("doc.results"))
    return rows.groupBy("day", "benchmark").agg(F.count("*").alias("results"), F.max("value").alias("best"))


@job("scan_weekly", """WITH e AS (SELECT strftime(ts, '%G-%V') AS iso_week, event_type, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events)
SELECT iso_week, 'hot' AS kind, event_type AS name, count(*) AS n FROM e GROUP BY ALL
UNION ALL SELECT iso_week, 'cold', 'no ' || event_type, count(*) FROM e WHERE event_type <> 'view' GROUP BY ALL
UNION ALL SELECT iso_week, 'label', CASE WHEN k % 2 = 0 THEN 'hit' ELSE 'miss' END, count(*) FROM e WHERE event_type <> 'error' GROUP BY ALL""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    """Weekly documents: hot and cold clusters, and the labels of reviewed predictions."""
    kind, k = F.col("event_type"), F.get_json_object("props", "$.k").cast("bigint")
    monday = F.date_trunc("week", F.col("ts"))
    year = F.year(F.date_add(monday.cast("date"), 3))  # the year of the week's Thursday
    doc = F.to_json(F.struct(
        F.format_string("%d-%02d", year, F.weekofyear("ts")).alias("iso_week"),
        F.struct(F.array(F.struct(kind.alias("cluster"), F.array(k.cast("string")).alias("papers"))).alias("hot"),
                 F.when(kind != "view", F.array(F.struct(F.concat(F.lit("no "), kind).alias("cluster")))).alias("cold")).alias("hot_vs_cold"),
        F.when(kind != "error", F.array(F.struct(F.lit("t").alias("title"), F.when(k % 2 == 0, "hit").otherwise("miss").alias("label")))).alias("prediction_review")))
    weekly = landed.strict_documents(table(spark, folder, "events").select(doc.alias("text")), WEEKLY)
    heat = landed.weekly_heat(weekly).select("iso_week", F.col("side").alias("kind"), F.col("cluster").alias("name"))
    labels = landed.weekly_reviews(weekly).select("iso_week", F.lit("label").alias("kind"), F.col("label").alias("name"))
    return heat.unionByName(labels).groupBy("iso_week", "kind", "name").agg(F.count("*").alias("n"))


@job("scan_insights", """WITH e AS (SELECT strftime(ts, '%Y-%m-%d') AS day, event_type FROM events)
SELECT day, event_type AS title, count(*) AS clusters, CAST(sum(CASE WHEN event_type = 'view' THEN 2 ELSE 0 END) AS BIGINT) AS papers FROM e GROUP BY ALL""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    """Insight documents in both shapes; untitled clusters do not count."""
    kind = F.col("event_type")
    clusters = F.to_json(F.struct(F.array(
        F.struct(kind.alias("cluster"), F.expr("array(named_struct('arxiv', 'a'), named_struct('arxiv', 'b'))").alias("papers"), F.lit("w").alias("why")),
        F.struct(F.lit(" ").alias("cluster"), F.expr("array(named_struct('arxiv', 'c'), named_struct('arxiv', 'd'))").alias("papers"), F.lit("").alias("why"))
    ).alias("clusters")))
    insights = F.to_json(F.struct(F.array(F.struct(kind.alias("title"))).alias("insights")))
    texts = table(spark, folder, "events").select(
        F.concat(F.date_format("ts", "yyyy-MM-dd"), F.lit(".json")).alias("file_name"), F.when(kind == "view", clusters).otherwise(insights).alias("text"))
    rows = landed.cluster_rows(landed.strict_documents(texts, INSIGHTS_DAY))
    return rows.groupBy(F.date_format("day", "yyyy-MM-dd").alias("day"), "title").agg(
        F.count("*").alias("clusters"), F.sum(F.coalesce(F.size("papers"), F.lit(0))).cast("bigint").alias("papers"))


@job("scan_json_array", "WITH @PAPERS@ SELECT arxiv_id, doi, title, md5(abstract) AS abstract_md5, len(authors) AS authors FROM papers")
def _(spark: SparkSession, folder: str) -> DataFrame:
    """Papers written as files that each hold one JSON array, and read back as records under the fixed schema."""
    path = scratch_path(spark, "papers-json")
    names = [f.split(" ")[0] for f in PAPER.split(", ")]
    rows = papers(spark, folder)
    sinks.write_paper_arrays(rows.select(*[n for n in names if n in rows.columns], F.floor(F.col("doc_id") / 250).alias("_file")), "_file", path)
    back = landed.read_paper_arrays(spark, path)
    return back.select("arxiv_id", "doi", "title", F.md5("abstract").alias("abstract_md5"), F.size("authors").cast("bigint").alias("authors"))


@job("sink_classified", """WITH @SUMMARY@ SELECT s.bucket, s.total, s.by_badge, count(c.doc_id) AS stored FROM summary s LEFT JOIN classified c USING (bucket) GROUP BY ALL""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    """The classified document as summary rows plus paper files per bucket, read back."""
    path = scratch_path(spark, "classified")
    rows = classified(spark, folder, title=True).select("doc_id", "title", "bucket", "badge")
    sinks.write_classified(rows, bucket_summary(rows, BUCKETS), path)
    stored = spark.read.schema("doc_id BIGINT, title STRING, badge STRING, bucket STRING").json(f"{path}/papers")
    counts = stored.groupBy("bucket").agg(F.count("*").alias("stored"))
    summary = spark.read.schema("bucket STRING, total BIGINT, by_badge STRING").json(f"{path}/summary")
    return summary.join(counts, "bucket", "left").select("bucket", "total", "by_badge", F.coalesce("stored", F.lit(0)).cast("bigint").alias("stored"))


@job("sink_series", """WITH c AS (SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS n FROM events GROUP BY ALL)
SELECT strftime(day, '%Y-%m-%d') AS day, CAST(sum(n) AS BIGINT) AS total, string_agg(event_type || ':' || n, ' ' ORDER BY event_type) AS by_cat
FROM c WHERE isodow(day) < 6 GROUP BY day""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    """Written twice: the second run replaces exactly its own days."""
    path = scratch_path(spark, "series")
    series = daily_series(daily_maps(spark, folder).withColumn("scope", F.lit("")))
    rows = series.select("day", "total", count_text(F.map_entries("by_cat")).alias("by_cat"))
    sinks.write_series(rows, path)
    sinks.write_series(rows.where(F.col("day") >= F.lit("2024-01-15")), path)
    return spark.read.parquet(path).select(F.date_format("day", "yyyy-MM-dd").alias("day"), "total", "by_cat")


@job("sink_feed", """WITH @FEED_POSTS@,
@FEED_NEWEST@ SELECT * FROM items""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "feed-xml")
    sinks.write_feed(feed(spark, folder), path)
    items = spark.read.schema("title STRING, link STRING, guid STRING, pubDate STRING, description STRING").option("rowTag", "item").format("xml").load(path)
    return items


@job("sink_feed_document", SQL["sink_feed"])
def _(spark: SparkSession, folder: str) -> DataFrame:
    """The feed as one document with its channel's header, read back."""
    path = scratch_path(spark, "feed-document")
    channel = Channel("Briefing", SITE, "Daily briefing")
    items = feed(spark, folder)
    write_feed_document(feed_document(items, channel, feed_stamp(F.current_date()), [F.col("link")], False), path)
    return read_feed_items(spark, path)


@job("feed_source", SQL["sink_feed"])
def _(spark: SparkSession, folder: str) -> DataFrame:
    """The feed written and read as a data source."""
    register(spark)
    path = mounted(scratch_path(spark, "feed-source"))
    os.makedirs(path, exist_ok=True)
    items = feed(spark, folder).select(F.hash("link").alias("place"), *FIELDS)
    items.write.format("paper_feed").mode("overwrite").options(**channel_options(Channel("Briefing", SITE, "Daily briefing"), "")).save(f"{path}/feed.xml")
    return spark.read.format("paper_feed").load(f"{path}/feed.xml").drop("place")
