"""Pages: sections, chunks, fields, markup, headings, summaries, ids."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.dates import listing_label
from ..functions.papers import first_author
from ..operators import listing
from ..operators.json_walk import harvested_ids
from ..sources.tables import table
from .catalog import SQL, define, job, sql_collapse, sql_markup, sql_unescape
from .standins import papers

BLOCKS = "<(nav|article|footer)>"
define(CUT="'(<(?:nav|article|footer)>)', chr(1) || '\\1', 'gis'")


def pages(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "pages")


@job("section_split", r"""WITH s AS (SELECT page_id, string_split(regexp_replace(html, @CUT@), chr(1)) AS p FROM pages),
b AS (SELECT page_id, unnest(p[2:]) AS block, unnest(range(len(p) - 1)) AS section_pos FROM s)
SELECT page_id, section_pos, regexp_extract(block, '<(nav|article|footer)>', 1) AS header,
  CAST(length(block) AS BIGINT) AS chars, md5(block) AS block_md5 FROM b""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    cut = listing.split_sections(pages(spark, folder).select("page_id", "html"), "html", BLOCKS, F.lower)
    return cut.select("page_id", F.col("section_pos").cast("bigint"), "header",
                      F.char_length("block").cast("bigint").alias("chars"), F.md5("block").alias("block_md5"))


define(H1=sql_markup("regexp_extract(html, '(?s)<h1[^>]*>(.*?)</h1>', 1)"))


@job("section_label", r"""WITH t AS (SELECT page_id, lower(CASE WHEN contains(url, '#top')
    THEN strftime(DATE '2026-01-01' + CAST(length(html) % 365 AS INT), '%a, %-d %b %Y') ELSE @H1@ END) AS t FROM pages)
SELECT page_id, CASE WHEN contains(t, 'tion') THEN 'cross' WHEN contains(t, 'the') THEN 'replace' WHEN contains(t, 'ch') THEN 'new'
  WHEN regexp_matches(t, '^(mon|tue|wed|thu|fri|sat|sun),@WS@+\d') THEN 'new' ELSE 'other' END AS section FROM t""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    day = F.expr("date_add(date'2026-01-01', cast(char_length(html) % 365 as int))")
    header = F.when(F.contains("url", F.lit("#top")), listing_label(day)).otherwise(T.heading(F.col("html")))
    return pages(spark, folder).select("page_id", listing.section_label(header, "tion", "the", "ch").alias("section"))


@job("chunk_explode", r"""WITH s AS (SELECT page_id, regexp_split_to_array(html, '<li>@WS@*<a@WS@+') AS p FROM pages),
c AS (SELECT page_id, unnest(p[2:]) AS chunk, unnest(range(1, len(p))) AS chunk_pos FROM s)
SELECT page_id, chunk_pos, regexp_extract(chunk, 'href="/([^"]+)"', 1) AS id FROM c WHERE regexp_extract(chunk, 'href="/([^"]+)"', 1) <> ''""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    chunks = listing.explode_chunks(pages(spark, folder).select("page_id", "html"), "html", r"<li>\s*<a\s+", 'href="/([^"]+)"')
    return chunks.select("page_id", F.col("chunk_pos").cast("bigint"), F.col("arxiv_id").alias("id"))


def _escaped(name: str):
    out = F.col(name)
    for char, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        out = F.replace(out, F.lit(char), F.lit(entity))
    return out


def listing_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Every document as a landed listing page: a banner, its section, its entry."""
    header = F.when(F.col("section") == "cross", "Cross submissions").when(
        F.col("section") == "replace", "Replacement submissions").otherwise("New submissions (showing 1 of 1)")
    people = F.array_join(F.transform("authors", lambda a: F.concat(
        F.lit('<a href="/a/x">'), F.replace(F.replace(F.replace(a, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;")),
        F.lit("</a>"))), ", ")
    html = F.concat(
        F.lit("<h1>Listing</h1><h3>Showing all listings</h3>\n<h3>"), header, F.lit('</h3>\n<dl><dt>\n<a name="item1">[1]</a>\n<a href ="/abs/'),
        F.col("h"), F.lit('" title="Abstract">x</a></dt><dd><div class="list-title mathjax"><span class="descriptor">Title:</span>\n '),
        _escaped("title"), F.lit('\n</div><div class="list-authors"><span class="descriptor">Authors:</span> '), people,
        F.lit('</div><div class="list-subjects"><span class="descriptor">Subjects:</span>\n<span class="primary-subject">'),
        F.col("subjects"), F.lit('</span>\n</div>\n<p class="mathjax">\n'), _escaped("abstract"), F.lit("\n</p></dd></dl>"))
    return papers(spark, folder).select("doc_id", html.alias("html"))


define(TITLE_WS=sql_collapse("title"), ABSTRACT_WS2=sql_collapse("abstract"))
_SECTION = "CASE section WHEN 'cross' THEN 'cross' WHEN 'replace' THEN 'replace' ELSE 'new' END"
_AUTHORS = "array_to_string(list_transform(authors, lambda a: " + sql_collapse("a") + "), '|')"


@job("field_extract", f"""WITH @PAPERS@ SELECT doc_id, {_SECTION} AS section, h AS arxiv_id, @TITLE_WS@ AS title, subjects,
  {_AUTHORS} AS authors, {sql_collapse("authors[1]")} AS first_author,
  regexp_extract(subjects, '([a-z\\-]+\\.[A-Z]{{2}})', 1) AS primary_cat, md5(@ABSTRACT_WS2@) AS abstract_md5 FROM papers""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    parsed = listing.parse_listing(listing_pages(spark, folder))
    return parsed.select("doc_id", "section", "arxiv_id", "title", "subjects", F.array_join("authors", "|").alias("authors"),
                         "first_author", "primary_cat", F.md5("abstract").alias("abstract_md5"))


@job("listing_week_page", f"""WITH @PAPERS@ SELECT doc_id, {_SECTION} AS section, h AS arxiv_id, @TITLE_WS@ AS title FROM papers
WHERE coalesce(section, '') <> 'replace'""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    parsed = listing.parse_listing(listing_pages(spark, folder), include_abstract=False)
    return listing.drop_replaced(parsed).select("doc_id", "section", "arxiv_id", "title")


@job("author_list", r"""WITH u AS (SELECT page_id, regexp_extract_all(regexp_extract(html, '(?s)<ul>(.*?)</ul>', 1), '<a[^>]*>(.*?)</a>', 1) AS a FROM pages)
SELECT page_id, array_to_string(a, '|') AS names, coalesce(a[1], '') AS first_name, CAST(len(a) AS BIGINT) AS n FROM u""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    names = listing.author_list(T.regex_first(F.col("html"), "<ul>(.*?)</ul>", "s"))
    out = pages(spark, folder).select("page_id", names.alias("a"))
    return out.select("page_id", F.array_join("a", "|").alias("names"), first_author(F.col("a")).alias("first_name"),
                      F.size("a").cast("bigint").alias("n"))


@job("primary_cat", r"WITH @PAPERS@ SELECT doc_id, regexp_extract(subjects, '([a-z\-]+\.[A-Z]{2})', 1) AS primary_cat FROM papers")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return papers(spark, folder, texts=False).select("doc_id", listing.primary_category(F.col("subjects")).alias("primary_cat"))


@job("date_section", """SELECT page_id, page_id % 5 <> 0 AS found, md5(CASE WHEN page_id % 5 = 0 THEN '' ELSE
  '<h3 class="d">' || strftime(d, '%a, %-d %b %Y') || ' <b>(showing)</b></h3>' || body END) AS block_md5 FROM (
  SELECT page_id, DATE '2026-01-01' + CAST(length(html) % 365 AS INT) AS d,
    CASE WHEN contains(url, 'https') THEN html ELSE url END AS body FROM pages)""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    day = F.expr("date_add(date'2026-01-01', cast(char_length(html) % 365 as int))")
    body = F.when(F.contains("url", F.lit("https")), F.col("html")).otherwise(F.col("url"))
    part = lambda d: F.concat(F.lit('<h3 class="d">'), listing_label(d), F.lit(" <b>(showing)</b></h3>"), body)
    week = pages(spark, folder).withColumn("day", day)
    own = F.when(F.col("page_id") % 5 == 0, F.lit("")).otherwise(part(F.col("day")))  # some weeks lack the day
    week = week.select("page_id", "day", F.concat(F.col("url"), part(F.date_add("day", 1)), own, part(F.date_sub("day", 1))).alias("html"))
    cut = listing.date_section(week, F.col("day"))
    return cut.select("page_id", "found", F.md5("block").alias("block_md5"))


@job("strip_markup", f"""SELECT page_id, md5({sql_markup('html', '')}) AS joined, md5({sql_markup('html')}) AS spaced,
  md5({sql_markup('html', ' ', False)}) AS raw FROM pages""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    h = F.col("html")
    return pages(spark, folder).select(
        "page_id", F.md5(T.strip_markup(h, "", "common")).alias("joined"),
        F.md5(T.strip_markup(h, " ", "common")).alias("spaced"), F.md5(T.strip_markup(h, " ", None)).alias("raw"))


@job("unescape_udf", f"""SELECT page_id, md5({sql_unescape('html')} || CASE WHEN page_id % 3 = 0 THEN '♥Aé&hearts;' ELSE '' END) AS plain_md5 FROM pages""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    """Every third page also has entities that only the Arrow function knows."""
    rare = F.when(F.col("page_id") % 3 == 0, F.concat("html", F.lit("&hearts;&#x41;&eacute;&amp;hearts;"))).otherwise(F.col("html"))
    return pages(spark, folder).select("page_id", F.md5(T.unescape(rare)).alias("plain_md5"))


@job("unescape_native", f"SELECT page_id, md5({sql_unescape('html')}) AS plain_md5 FROM pages")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return pages(spark, folder).select("page_id", F.md5(T.unescape_common(F.col("html"))).alias("plain_md5"))


@job("heading_extract", "SELECT page_id, @H1@ AS title FROM pages")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return pages(spark, folder).select("page_id", T.heading(F.col("html")).alias("title"))


define(
    LEAD=sql_markup("regexp_extract(regexp_extract(html, '(?s)<h1[^>]*>.*?.*?</h1>(.*?)(?:<h1|$)', 1), '(?s)<p[^>]*>(.*?)</p>', 1)"),
)


@job("summary_extract", """SELECT page_id, CASE WHEN length(@LEAD@) > 380
  THEN regexp_replace(substr(@LEAD@, 1, 379), '@WS@+$', '') || '…' ELSE @LEAD@ END AS summary FROM pages""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return pages(spark, folder).select("page_id", T.summary_after(F.col("html"), marker="", tag="h1").alias("summary"))


PAGE_PATTERNS = (
    r"tion[^<]*</h1>\s*<[^>]*>(.*?)</(?:div|p)",
    r"<p>\s*<i>(.*?)</i>",
    r'class="ad"[^>]*>(.*?)</div',
    r"<h1>.*?</h1>\s*<p[^>]*>(.*?)</p>",
)
_tries = ", ".join("nullif(" + sql_markup("regexp_extract(html, '(?s)" + T.ws(p) + "', 1)", " ", False) + ", '')" for p in PAGE_PATTERNS)


@job("summary_patterns", f"SELECT page_id, substr(coalesce({_tries}, ''), 1, 300) AS summary FROM pages")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return pages(spark, folder).select("page_id", T.summary_by_patterns(F.col("html"), PAGE_PATTERNS).alias("summary"))


@job("id_harvest", r"""WITH l AS (SELECT page_id, unnest(list_append(
    list_transform(regexp_extract_all(html, 'href="/([^"]*)"', 1), lambda x: url || x), url)) AS leaf FROM pages),
i AS (SELECT DISTINCT page_id, regexp_extract(leaf, 'example\.(?:com|org|net)/([a-z0-9]+)', 1) AS id FROM l)
SELECT page_id, coalesce(string_agg(id, '|' ORDER BY id) FILTER (id <> ''), '') AS ids FROM i GROUP BY page_id""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    ids = listing.harvest_ids(deep_payload(), r"example\.(?:com|org|net)/([a-z0-9]+)")
    return pages(spark, folder).select("page_id", F.array_join(F.sort_array(ids), "|").alias("ids"))


def deep_payload():
    """A page's links as JSON five levels deep, every slash of an address escaped in one of JSON's ways."""
    links = F.transform(F.regexp_extract_all("html", F.lit('href="/([^"]*)"'), 1), lambda x: F.struct(F.array(F.struct(F.concat(F.col("url"), x).alias("arxiv"))).alias("refs")))
    text = F.to_json(F.struct(F.struct(F.col("url"), F.lit(7).alias("n"), F.array(F.struct(links.alias("papers"))).alias("clusters")).alias("day")))
    return F.replace(F.replace(text, F.lit(".org/"), F.lit(r".org\u002f")), F.lit(".com/"), F.lit(r".com\/"))


@job("id_walk", SQL["id_harvest"])
def _(spark: SparkSession, folder: str) -> DataFrame:
    """The same ids by walking the parsed documents."""
    found = harvested_ids(pages(spark, folder).select("page_id", deep_payload().alias("payload")), "payload", r"example\.(?:com|org|net)/([a-z0-9]+)")
    every = pages(spark, folder).select("page_id").distinct()
    return every.join(found.groupBy("page_id").agg(F.array_join(F.sort_array(F.collect_set("id")), "|").alias("ids")), "page_id", "left").select(
        "page_id", F.coalesce("ids", F.lit("")).alias("ids"))