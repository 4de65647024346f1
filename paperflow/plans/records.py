"""Columns of a paper record: keys, badges, links, digests, names, dates, registry and index mapping."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates, papers as P
from ..functions.text import bare_doi, collapse_ws
from ..operators import registry
from ..operators.index_text import index_to_text, text_to_index
from ..sources.tables import table
from .catalog import define, job, sql_collapse, sql_strip
from .standins import papers


@job("source_badge", "WITH @PAPERS@ SELECT doc_id, @BADGE@ AS badge FROM papers")
def _(spark: SparkSession, folder: str) -> DataFrame:
    badge = P.source_badge(F.col("source"), F.col("primary_cat"), F.col("subjects"))
    return papers(spark, folder, texts=False).select("doc_id", badge.alias("badge"))


@job("unified_key", """WITH @PAPERS@ SELECT doc_id,
  CASE WHEN arxiv_id <> '' THEN arxiv_id ELSE lower(id) END AS key,
  CASE WHEN arxiv_id <> '' THEN arxiv_id WHEN id <> '' THEN id ELSE doi END AS literal_key FROM papers""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    ids = [F.col("arxiv_id"), F.col("id"), F.col("doi")]
    return papers(spark, folder).select(
        "doc_id", P.unified_key(*ids).alias("key"), P.unified_key(*ids, normalise_doi=False).alias("literal_key"))


@job("paper_link", """WITH @PAPERS@ SELECT doc_id,
  CASE WHEN source IN ('crossref', 'openalex') THEN CASE WHEN url <> '' THEN url WHEN doi <> '' THEN 'https://doi.org/' || doi ELSE '#' END
    WHEN arxiv_id <> '' THEN 'https://arxiv.org/abs/' || arxiv_id ELSE '#' END AS link,
  CASE WHEN source = 'crossref' THEN CASE WHEN url <> '' THEN url WHEN doi <> '' THEN 'https://doi.org/' || doi ELSE '#' END
    WHEN arxiv_id <> '' THEN 'https://arxiv.org/abs/' || arxiv_id ELSE '#' END AS literal_link FROM papers""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    cols = [F.col("source"), F.col("url"), F.col("doi"), F.col("arxiv_id")]
    return papers(spark, folder).select(
        "doc_id", P.paper_link(*cols).alias("link"), P.paper_link(*cols, index_branch=False).alias("literal_link"))


@job("author_digest", """WITH @PAPERS@ SELECT doc_id, authors[1] AS first_author,
  authors[1] || CASE WHEN len(authors) > 1 THEN ' 외 ' || (len(authors) - 1) || '명' ELSE '' END AS who FROM papers""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return papers(spark, folder).select("doc_id", P.first_author(F.col("authors")).alias("first_author"),
                                        P.author_digest(F.col("authors")).alias("who"))


define(BODY=sql_strip("abstract"))


@job("meta_digest", """WITH @PAPERS@ SELECT doc_id,
  CASE WHEN source = 'crossref' THEN journal || ' · 등록 ' || created
    ELSE substr(@BODY@, 1, 200) || CASE WHEN length(@BODY@) > 200 THEN '…' ELSE '' END END AS meta FROM papers""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    meta = P.meta_digest(F.col("source"), F.col("journal"), F.col("created"), F.col("abstract"))
    return papers(spark, folder).select("doc_id", meta.alias("meta"))


@job("date_parts", """SELECT o_orderkey, CASE o_orderstatus
  WHEN 'F' THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 'O' THEN strftime(o_orderdate, '%Y-%m') || '-01'
  ELSE CASE WHEN o_totalprice > 400000 THEN '' ELSE strftime(o_orderdate, '%Y') || '-01-01' END END AS published FROM orders""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    status, d = F.col("o_orderstatus"), F.col("o_orderdate")
    y, m, day = F.year(d), F.month(d), F.dayofmonth(d)
    empty = F.array(F.array().cast("array<int>"))
    published = F.when(status == "F", F.array(F.array(y, m, day))).when(status == "O", empty)
    issued = F.when(status == "O", F.array(F.array(y, m)))
    online = F.array().cast("array<array<int>>")
    in_print = F.when((status == "P") & (F.col("o_totalprice") <= 400000), F.array(F.array(y)))
    parts = P.parts_date(published, issued, online, in_print)
    return table(spark, folder, "orders").select("o_orderkey", parts.alias("published"))


@job("name_assembly", """SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN c_name WHEN 'MACHINERY' THEN c_mktsegment || ' ' || c_name
  WHEN 'FURNITURE' THEN c_mktsegment WHEN 'HOUSEHOLD' THEN 'Team ' || c_nationkey ELSE '' END AS names,
  CAST(CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY', 'FURNITURE', 'HOUSEHOLD') THEN 1 ELSE 0 END AS BIGINT) AS n FROM customer""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    seg, name = F.col("c_mktsegment"), F.col("c_name")
    person = F.struct(
        F.when(seg.isin("MACHINERY", "FURNITURE"), seg).when(seg == "BUILDING", F.lit("")).alias("given"),
        F.when(seg.isin("BUILDING", "MACHINERY"), name).when(seg == "FURNITURE", F.lit(" ")).alias("family"),
        F.when(seg == "HOUSEHOLD", F.concat(F.lit("Team "), F.col("c_nationkey").cast("string"))).alias("name"))
    names = P.person_names(F.array(person))
    return table(spark, folder, "customer").select(
        "c_custkey", F.array_join(names, "|").alias("names"), F.size(names).cast("bigint").alias("n"))


@job("registry_map", """SELECT p_partkey, '10.1/' || p_brand || '.' || p_partkey AS doi, 'doi:10.1/' || p_brand || '.' || p_partkey AS id,
  CASE WHEN p_size > 25 THEN 'http://x/' || p_partkey ELSE 'https://doi.org/10.1/' || p_brand || '.' || p_partkey END AS url,
  p_name || ' & co' AS title, 'A. ' || p_name || '|' || p_type AS authors, 'A. ' || p_name AS first_author,
  CASE WHEN p_size > 40 THEN '' ELSE p_type END AS journal, p_type || '; ' || p_brand AS subjects, 'new' AS section,
  'Abstract ' || p_name AS abstract, CAST(1950 + p_size AS VARCHAR) || '-05-01' AS published, '2026-06-0' || (1 + p_size % 9) AS created FROM part""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    parts = table(spark, folder, "part")
    doi = F.concat_ws("", F.lit("10.1/"), F.col("p_brand"), F.lit("."), F.col("p_partkey"))
    item = F.struct(
        doi.alias("DOI"),
        F.array(F.concat(F.lit("<b>"), F.col("p_name"), F.lit("</b> &amp; co"))).alias("title"),
        F.array(F.struct(F.lit("A.").alias("given"), F.col("p_name").alias("family"), F.lit(None).cast("string").alias("name")),
                F.struct(F.lit(None).cast("string").alias("given"), F.lit("").alias("family"), F.col("p_type").alias("name"))).alias("author"),
        F.when(F.col("p_size") <= 40, F.array("p_type")).alias("container-title"),
        F.concat(F.lit("<jats:title>Abstract</jats:title>\n<jats:p>"), F.col("p_name"), F.lit("</jats:p>")).alias("abstract"),
        F.struct(F.array(F.array(F.col("p_size") + 1950, F.lit(5))).alias("date-parts")).alias("issued"),
        F.struct(F.array(F.array(F.lit(2026), F.lit(6), F.lit(1) + F.col("p_size") % 9)).alias("date-parts")).alias("created"),
        F.array("p_type", "p_brand").alias("subject"),
        F.when(F.col("p_size") > 25, F.concat_ws("", F.lit("http://x/"), F.col("p_partkey"))).alias("URL"))
    body = F.to_json(F.struct(F.struct(F.array(item).alias("items")).alias("message")))
    items = registry.registry_items(parts.select("p_partkey", body.alias("body")))
    mapped = items.select("p_partkey", *registry.registry_paper(F.col("item")))
    return mapped.withColumn("authors", F.array_join("authors", "|")).drop("source", "primary_cat")


@job("registry_items", """SELECT event_id, CAST(0 AS BIGINT) AS pos, CAST(json_extract(props, '$.k') AS VARCHAR) AS doi
FROM events WHERE event_type NOT IN ('error', 'signup')
UNION ALL SELECT event_id, 2, '10.2/' || event_id FROM events WHERE event_type NOT IN ('error', 'signup')""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    key = F.get_json_object("props", "$.k")
    item = F.concat(F.lit('{"message": {"items": [{"DOI": "'), key, F.lit('"}, null, {"DOI": "10.2/'), F.col("event_id").cast("string"), F.lit('"}]}}'))
    body = F.when(F.col("event_type") == "error", "{}").when(F.col("event_type") == "signup", '{"message": {}}').otherwise(item)
    events = table(spark, folder, "events").select("event_id", body.alias("body"))
    return registry.registry_items(events).select("event_id", F.col("pos").cast("bigint"), F.col("item.DOI").alias("doi"))


@job("index_items", """SELECT event_id, CAST(0 AS BIGINT) AS pos, 'W' || event_id AS id, 'b a' AS abstract, CAST(json_extract(props, '$.k') AS BIGINT) AS cited
FROM events WHERE event_type <> 'error'
UNION ALL SELECT event_id, 1, NULL, '', 7 FROM events WHERE event_type <> 'error'""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    """Open-index responses parsed under the fixed schema; an error page has no results."""
    body = F.when(F.col("event_type") != "error", F.concat(
        F.lit('{"results": [{"id": "W'), F.col("event_id").cast("string"), F.lit('", "abstract_inverted_index": {"a": [1], "b": [0]}, "cited_by_count": '),
        F.get_json_object("props", "$.k"), F.lit('}, {"cited_by_count": 7, "abstract_inverted_index": null}]}'))).otherwise('{"error": "x"}')
    works = registry.index_works(table(spark, folder, "events").select("event_id", body.alias("body")))
    return works.select("event_id", F.col("pos").cast("bigint"), "item.id", index_to_text(F.col("item.abstract_inverted_index")).alias("abstract"),
                        F.col("item.cited_by_count").alias("cited"))


define(ABSTRACT_WS=sql_collapse("abstract"))


@job("work_map", """WITH @PAPERS@ SELECT doc_id, doi_b AS doi, CASE WHEN doi_b <> '' THEN 'doi:' || doi_b ELSE 'https://openalex.org/W' || doc_id END AS id,
  CASE WHEN doi <> '' THEN 'https://doi.org/' || doi ELSE 'https://openalex.org/W' || doc_id END AS url, title, first_author,
  journal, concepts AS subjects, md5(@ABSTRACT_WS@) AS abstract_md5, created, cited_by_count FROM (
  SELECT p.*, lower(doi) AS doi_b, authors[1] AS first_author, coalesce(quality, -1) AS q,
    coalesce(10 * quality + toxic, 0) AS cited_by_count,
    CASE WHEN quality IS NULL THEN 'unlabelled' ELSE concat_ws('; ', lang, CASE WHEN quality = 1 THEN 'good' END) END AS concepts
  FROM papers p LEFT JOIN labels USING (doc_id))""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    labels = table(spark, folder, "labels")
    rows = text_to_index(papers(spark, folder), "abstract").join(labels, "doc_id", "left")
    quality = F.col("quality")
    concept = lambda name, score: F.struct(name.alias("display_name"), score.cast("double").alias("score"))
    native = F.concat(F.lit("https://openalex.org/W"), F.col("doc_id").cast("string"))
    work = F.struct(
        native.alias("id"),
        F.when(F.col("doi") != "", F.concat(F.lit("https://doi.org/"), F.col("doi"))).alias("doi"),
        F.when(quality == 1, F.col("title")).alias("title"), F.col("title").alias("display_name"),
        F.transform("authors", lambda a: F.struct(F.struct(a.alias("display_name")).alias("author"))).alias("authorships"),
        F.struct(F.struct(F.col("journal").alias("display_name")).alias("source")).alias("primary_location"),
        F.array(concept(F.lit("unlabelled"), F.when(quality.isNull(), F.lit(0.3))),
                concept(F.col("lang"), F.when(quality.isNotNull(), F.lit(0.9))),
                concept(F.lit("weak"), F.lit(0.29)), concept(F.lit(""), F.lit(0.9)),
                concept(F.lit("good"), quality)).alias("concepts"),
        F.col("inv").alias("abstract_inverted_index"), F.lit("").alias("publication_date"),
        F.concat(F.col("created"), F.lit("T10:00:00")).alias("created_date"),
        (quality * 10 + F.col("toxic")).cast("bigint").alias("cited_by_count"))
    mapped = rows.withColumn("work", work)
    mapped = mapped.select("doc_id", *registry.index_paper(F.col("work")))
    return mapped.select("doc_id", "doi", "id", "url", "title", "first_author", "journal", "subjects",
                         F.md5("abstract").alias("abstract_md5"), "created", "cited_by_count")


@job("doi_normalise", r"""SELECT page_id, lower(regexp_replace(url, '^https?://', '')) AS doi FROM pages""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    tail = F.regexp_replace("url", "^https?://", "")
    prefix = F.when(F.startswith("url", F.lit("https")), "https://doi.org/").otherwise("http://dx.doi.org/")
    raw = F.concat(F.lit(" "), prefix, F.initcap(tail), F.lit(" "))
    return table(spark, folder, "pages").select("page_id", bare_doi(raw).alias("doi"))


@job("concept_pick", """WITH e AS (SELECT vec_id, i, CAST(embedding[i] AS DOUBLE) AS s FROM (
  SELECT vec_id, embedding, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings)),
kept AS (SELECT vec_id, i, row_number() OVER (PARTITION BY vec_id ORDER BY i) AS r FROM e WHERE s >= 0.1 AND s < 0.25)
SELECT v.vec_id, coalesce(string_agg('c' || i, '|' ORDER BY i) FILTER (r <= 5), '') AS picked
FROM embeddings v LEFT JOIN kept USING (vec_id) GROUP BY v.vec_id""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    def concept(x, i):
        score = x.cast("double")
        name = F.when(score < 0.25, F.concat(F.lit("c"), (i + 1).cast("string"))).otherwise("")
        return F.struct(name.alias("display_name"), score.alias("score"))
    picked = P.concept_names(F.transform("embedding", concept), 5, 0.1)
    return table(spark, folder, "embeddings").select("vec_id", F.array_join(picked, "|").alias("picked"))


define(TEXT_WS=sql_collapse("text"))


@job("inv_to_text", "SELECT doc_id, md5(@TEXT_WS@) AS text_md5, CAST(length(@TEXT_WS@) AS BIGINT) AS chars FROM documents")
def _(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    rebuilt = text_to_index(docs, "text").select("doc_id", index_to_text(F.col("inv")).alias("t"))
    return rebuilt.select("doc_id", F.md5("t").alias("text_md5"), F.char_length("t").cast("bigint").alias("chars"))


@job("text_to_inv", """WITH w AS (SELECT doc_id, unnest(string_split(@TEXT_WS@, ' ')) AS word,
  unnest(range(len(string_split(@TEXT_WS@, ' ')))) AS pos FROM documents),
g AS (SELECT doc_id, word, count(*) AS n, string_agg(pos, ',' ORDER BY pos) AS places FROM w WHERE word <> '' GROUP BY ALL)
SELECT doc_id, count(*) AS words, CAST(sum(n) AS BIGINT) AS positions, md5(string_agg(word || ':' || places, ';' ORDER BY word)) AS index_md5
FROM g GROUP BY doc_id""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    entries = F.map_entries("inv")
    line = F.transform(entries, lambda e: F.concat_ws(":", e["key"], F.array_join(e["value"].cast("array<string>"), ",")))
    return text_to_index(docs, "text").select(
        "doc_id", F.size("inv").cast("bigint").alias("words"),
        F.size(F.flatten(F.map_values("inv"))).cast("bigint").alias("positions"),
        F.md5(F.array_join(line, ";")).alias("index_md5"))


@job("date_labels", """SELECT o_orderkey, strftime(o_orderdate, '%a, %-d %b %Y') AS listing_label,
  strftime(o_orderdate, '%a, %d %b %Y') || ' 09:00:00 +0900' AS feed_stamp,
  strftime(o_orderdate, '%Y-%m-%d') || ' (' || (['월','화','수','목','금','토','일'])[isodow(o_orderdate)] || ')' AS day_label,
  printf('%d-W%02d', isoyear(o_orderdate - INTERVAL 7 DAY), weekofyear(o_orderdate - INTERVAL 7 DAY)) || ' · '
    || strftime(o_orderdate - INTERVAL 7 DAY, '%m-%d') || ' ~ ' || strftime(o_orderdate - INTERVAL 3 DAY, '%m-%d') AS week_label FROM orders""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    d = F.col("o_orderdate").cast("date")
    return table(spark, folder, "orders").select(
        "o_orderkey", dates.listing_label(d).alias("listing_label"), dates.feed_stamp(d).alias("feed_stamp"),
        dates.day_label(d).alias("day_label"), dates.review_week_label(d).alias("week_label"))


for _name, _column, _sql in (
    ("date_label", dates.listing_label, "strftime(o_orderdate, '%a, %-d %b %Y')"),
    ("rfc822", dates.feed_stamp, "strftime(o_orderdate, '%a, %d %b %Y') || ' 09:00:00 +0900'"),
    ("day_label", dates.day_label,
     "strftime(o_orderdate, '%Y-%m-%d') || ' (' || (['월','화','수','목','금','토','일'])[isodow(o_orderdate)] || ')'"),
    ("week_label", dates.review_week_label,
     "printf('%d-W%02d', isoyear(o_orderdate - INTERVAL 7 DAY), weekofyear(o_orderdate - INTERVAL 7 DAY)) || ' · ' "
     "|| strftime(o_orderdate - INTERVAL 7 DAY, '%m-%d') || ' ~ ' || strftime(o_orderdate - INTERVAL 3 DAY, '%m-%d')"),
):
    def _one(spark: SparkSession, folder: str, column=_column) -> DataFrame:
        return table(spark, folder, "orders").select(
            "o_orderkey", column(F.col("o_orderdate").cast("date")).alias("label"))
    job(_name, f"SELECT o_orderkey, {_sql} AS label FROM orders")(_one)


@job("lookback", """SELECT event_id FROM events WHERE event_type IN ('view', 'purchase')
  AND CAST(ts AS DATE) BETWEEN DATE '2024-01-17' AND DATE '2024-01-24'""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").where(F.col("event_type").isin("view", "purchase"))
    kept = registry.look_back(events, F.col("ts"), F.lit("2024-01-24").cast("date"), 7)
    return kept.select("event_id")
