"""Lookup join against the open index, links and lists."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import papers as P
from ..functions.dates import feed_stamp
from ..functions.text import first_nonempty, heading, summary_after
from ..operators import enrich, rank
from ..session import scratch_path
from ..sources.landed import posts_from
from ..sources.tables import table
from . import markup  # noqa: F401  (its SQL fragments are used here)
from .catalog import SQL, define, job, sql_markup
from .standins import papers


def works(spark: SparkSession, folder: str) -> DataFrame:
    """One work per labelled document; copies of a text give several works of one DOI."""
    labels = table(spark, folder, "labels")
    docs = table(spark, folder, "documents").select("doc_id", "lang", F.md5("text").alias("h"))
    good, bad = F.col("quality") == 1, F.col("toxic") == 1
    concepts = F.array_compact(F.array(F.when(good, F.col("lang")), F.when(bad, F.lit("flagged"))))
    return docs.join(labels, "doc_id").select(
        F.col("doc_id").alias("work_pos"), F.concat(F.lit("10.5555/"), F.substring("h", 1, 12)).alias("work_doi"),
        (F.col("quality") * 10 + F.col("toxic")).cast("bigint").alias("cited_by_count"),
        concepts.alias("concepts"), F.concat(F.lit("rebuilt "), F.col("lang")).alias("rebuilt"))


def enriched(spark: SparkSession, folder: str) -> DataFrame:
    rows = papers(spark, folder)
    doi = P.lookup_doi(F.col("doi"), F.col("id"))
    return enrich.lookup(rows.withColumn("bare_doi", doi), works(spark, folder), F.col("bare_doi"), "work_doi", ["work_pos"], "doc_id")


define(ENRICHED="""@PAPERS@,
works AS (
  SELECT '10.5555/' || substr(md5(d.text), 1, 12) AS work_doi, 10 * quality + toxic AS cited, rank_in, rebuilt, concepts FROM (
    SELECT d.doc_id, d.text, l.quality, l.toxic, 'rebuilt ' || d.lang AS rebuilt,
      concat_ws('; ', CASE WHEN quality = 1 THEN lang END, CASE WHEN toxic = 1 THEN 'flagged' END) AS concepts,
      row_number() OVER (PARTITION BY md5(d.text) ORDER BY d.doc_id) AS rank_in
    FROM documents d JOIN labels l USING (doc_id)) d),
enriched AS (
  SELECT p.*, lower(doi) AS bare_doi, w.work_doi IS NOT NULL AS matched, w.cited, w.concepts, w.rebuilt
  FROM papers p LEFT JOIN works w ON lower(p.doi) = w.work_doi AND w.rank_in = 1 AND p.doi <> '')""")


@job("enrich_join", """WITH @ENRICHED@ SELECT doc_id, matched, CAST(cited AS BIGINT) AS cited_by_count,
  CASE WHEN concepts <> '' THEN concat_ws('; ', nullif(subjects, ''), concepts) ELSE subjects END AS subjects FROM enriched""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return enriched(spark, folder).select(
        "doc_id", "matched", "cited_by_count", enrich.append_concepts(F.col("subjects"), F.col("concepts")).alias("subjects"))


BUCKETS = 8


def history(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Papers of two days and their works as bucketed tables."""
    rows = papers(spark, folder).withColumn("bare_doi", P.lookup_doi(F.col("doi"), F.col("id")))
    kept, known = (f"paperflow_{name}_{uuid.uuid4().hex}" for name in ("papers", "works"))
    place = scratch_path(spark, kept)
    for day in (0, 1):
        enrich.store_by_key(rows.where(F.pmod("doc_id", F.lit(2)) == day), kept, place, F.col("bare_doi"), BUCKETS, "doc_id", add=day > 0)
    enrich.store_works(works(spark, folder), known, scratch_path(spark, known), "work_doi", ["work_pos"], BUCKETS)
    return spark.table(kept), spark.table(known)


@job("enrich_bucketed", SQL["enrich_join"])
def _(spark: SparkSession, folder: str) -> DataFrame:
    """The same enrichment from tables that are kept by DOI from day to day."""
    return enrich.lookup_bucketed(*history(spark, folder)).select(
        "doc_id", "matched", "cited_by_count", enrich.append_concepts(F.col("subjects"), F.col("concepts")).alias("subjects"))


@job("backfill_blank", """WITH @ENRICHED@ SELECT doc_id, regexp_replace(abstract, '@WS@+', '', 'g') = '' AND matched AS filled,
  md5(CASE WHEN regexp_replace(abstract, '@WS@+', '', 'g') = '' AND matched THEN rebuilt ELSE abstract END) AS abstract_md5 FROM enriched""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    after = enrich.backfill(F.col("abstract"), F.col("rebuilt"))
    return enriched(spark, folder).select(
        "doc_id", F.md5(after).alias("abstract_md5"), (F.equal_null(after, F.col("rebuilt")) & F.col("matched")).alias("filled"))


@job("enrich_coverage", """WITH @ENRICHED@ SELECT count(*) FILTER (matched) AS enriched, count(*) AS papers,
  count(DISTINCT bare_doi) FILTER (bare_doi <> '') AS dois FROM enriched""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return enrich.coverage(enriched(spark, folder), "bare_doi")


_NAME = "strftime(DATE '2020-01-01' + CAST(doc_id AS INT), '%Y-%m-%d') || CASE WHEN lang = 'es' THEN '-weekly' ELSE '' END || '.html'"


def post_names(spark: SparkSession, folder: str) -> DataFrame:
    day = F.expr("date_add(date'2020-01-01', cast(doc_id as int))")
    name = F.concat(F.date_format(day, "yyyy-MM-dd"), F.when(F.col("lang") == "es", "-weekly").otherwise(""), F.lit(".html"))
    return table(spark, folder, "documents").select("doc_id", "lang", name.alias("name"), day.alias("day"),
                                                    (F.col("lang") == "es").alias("weekly"))


def linked_names(spark: SparkSession, folder: str) -> DataFrame:
    return post_names(spark, folder).join(table(spark, folder, "labels").select("doc_id"), "doc_id", "left_semi")


@job("missing_links", f"SELECT {_NAME} AS name FROM documents WHERE lang <> 'de' AND doc_id NOT IN (SELECT doc_id FROM labels)")
def _(spark: SparkSession, folder: str) -> DataFrame:
    draft = F.when(F.col("lang") == "de", F.concat(F.lit("draft-"), "name")).otherwise(F.col("name"))
    return rank.missing_links(post_names(spark, folder).withColumn("name", draft), linked_names(spark, folder), "name").select("name")


@job("merged_list", f"""SELECT {_NAME} AS name, lang = 'es' AS weekly,
  doc_id IN (SELECT doc_id FROM labels) AS was_linked FROM documents""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    linked = table(spark, folder, "labels").select("doc_id")
    return rank.merged_list(post_names(spark, folder), linked, "doc_id", "day", "weekly", "name").select("name", "weekly", "was_linked")


_POST = """posts AS (SELECT page_id, CASE WHEN page_id % 7 = 0 THEN replace(html, '<h1', '<h9') ELSE html END AS html, strftime(DATE '2022-01-01' + CAST(length(html) % 900 AS INT), '%Y-%m-%d') AS day,
  contains(url, '#top') AS weekly, contains(url, '?') AS odd FROM pages)"""


def named_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Pages under post file names; some names are not a post's."""
    day = F.expr("date_format(date_add(date'2022-01-01', cast(char_length(html) % 900 as int)), 'yyyy-MM-dd')")
    suffix = F.when(F.contains("url", F.lit("?")), ".htm").when(F.contains("url", F.lit("#top")), "-weekly.html").otherwise(".html")
    html = F.when(F.col("page_id") % 7 == 0, F.replace("html", F.lit("<h1"), F.lit("<h9"))).otherwise(F.col("html"))  # some without a heading
    return table(spark, folder, "pages").select("page_id", F.concat(day, suffix).alias("file_name"), html.alias("html"))


@job("scan_posts", f"""WITH {_POST} SELECT day, weekly, count(*) AS posts, CAST(sum(length(html)) AS BIGINT) AS chars
FROM posts WHERE NOT odd GROUP BY day, weekly""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    posts = posts_from(named_pages(spark, folder), "file_name", "html")
    return posts.groupBy("day", "weekly").agg(F.count("*").alias("posts"), F.sum(F.char_length("html")).alias("chars"))


define(FEED_H1=sql_markup("regexp_extract(html, '(?s)<h1[^>]*>(.*?)</h1>', 1)"))


SITE = "https://example.org"
define(FEED_POSTS=_POST, FEED_NEWEST="""newest AS (SELECT *, @FEED_H1@ AS h1,
  CASE WHEN length(@LEAD@) > 380 THEN regexp_replace(substr(@LEAD@, 1, 379), '@WS@+$', '') || '…' ELSE @LEAD@ END AS lead
  FROM posts WHERE NOT odd ORDER BY day DESC, weekly DESC, md5(html) LIMIT 60),
items AS (SELECT CASE WHEN h1 = '' THEN 'Briefing — ' || day ELSE h1 END AS title,
  'https://example.org/posts/' || day || CASE WHEN weekly THEN '-weekly' ELSE '' END || '.html' AS link,
  'https://example.org/posts/' || day || CASE WHEN weekly THEN '-weekly' ELSE '' END || '.html' AS guid,
  strftime(CAST(day AS DATE), '%a, %d %b %Y') || ' 09:00:00 +0900' AS "pubDate",
  CASE WHEN lead = '' THEN 'Briefing ' || day ELSE lead END AS description FROM newest)""")


@job("feed_items", "WITH @FEED_POSTS@, @FEED_NEWEST@ SELECT * FROM items")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return feed(spark, folder)


def feed(spark: SparkSession, folder: str, site: str = SITE, title: str = "Briefing — {day}", description: str = "Briefing {day}") -> DataFrame:
    """The newest posts as feed items; a post without heading or lead gets ``title`` or ``description`` with its day."""
    def dated(pattern: str):
        return F.replace(F.lit(pattern), F.lit("{day}"), F.col("day"))

    posts = posts_from(named_pages(spark, folder), "file_name", "html").withColumn("tie", F.md5("html"))
    newest = rank.newest_items(posts, "day", "weekly", "tie")
    suffix = F.when(F.col("weekly"), "-weekly.html").otherwise(".html")
    link = F.concat(F.lit(f"{site}/posts/"), F.col("day"), suffix)
    return newest.select(
        first_nonempty(heading(F.col("html")), dated(title)).alias("title"), link.alias("link"), link.alias("guid"),
        feed_stamp(F.col("day").cast("date")).alias("pubDate"),
        first_nonempty(summary_after(F.col("html"), marker="", tag="h1"), dated(description)).alias("description"))
