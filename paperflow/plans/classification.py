"""Dedup, buckets, counts by bucket."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed_values as V
from ..operators import classify, dedup, rank, sets
from ..operators.listing import drop_replaced
from ..sources.tables import table
from .catalog import job
from .standins import BUCKET_NAMES, BUCKETS, classified, papers, sql_bucket, sql_hits, unique_papers


@job("drop_replaced", "WITH @PAPERS@ SELECT doc_id, section FROM papers WHERE coalesce(section, '') <> 'replace'")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return drop_replaced(papers(spark, folder)).select("doc_id", "section")


@job("source_union", """
SELECT CAST(source_rank AS BIGINT) AS source_rank, pos, chars, lang FROM (
  SELECT 0 AS source_rank, doc_id AS pos, CAST(length(text) AS BIGINT) AS chars, lang FROM documents
  UNION ALL SELECT 1, item_id, length(text), NULL FROM benchmark)""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    chars = F.char_length("text").cast("bigint").alias("chars")
    main = table(spark, folder, "documents").select(F.col("doc_id").alias("pos"), chars, "lang")
    second = table(spark, folder, "benchmark").select(F.col("item_id").alias("pos"), chars)
    return dedup.union_ranked([main, second]).withColumn("source_rank", F.col("source_rank").cast("bigint"))


@job("dedup_first", """
SELECT CAST(source_rank AS BIGINT) AS source_rank, pos, h FROM (
  SELECT 0 AS source_rank, doc_id AS pos, text, md5(text) AS h FROM documents
  UNION ALL SELECT 1, item_id, text, md5(text) FROM benchmark)
WHERE text <> '' QUALIFY row_number() OVER (PARTITION BY text ORDER BY source_rank, pos) = 1""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    main = table(spark, folder, "documents").select(F.col("doc_id").alias("pos"), "text")
    second = table(spark, folder, "benchmark").select(F.col("item_id").alias("pos"), "text")
    # the key is a digest, so that neither the shuffle nor the sort carries a text
    rows = dedup.union_ranked([main, second]).select("source_rank", "pos", F.when(F.col("text") != "", F.md5("text")).alias("h"))
    kept = dedup.first_wins(rows, F.col("h"), ["source_rank", "pos"])
    return kept.select(F.col("source_rank").cast("bigint"), "pos", "h")


@job("dedup_papers", "WITH @UNIQUE@ SELECT doc_id, key, source FROM unique_papers")
def _(spark: SparkSession, folder: str) -> DataFrame:
    key = F.when(F.col("arxiv_id") != "", F.col("arxiv_id")).otherwise(F.lower("id"))
    return unique_papers(spark, folder).select("doc_id", key.alias("key"), "source")


QUERY_TERMS = ("ones", "ansh", "eror", "onea")


@job("merge_queries", """WITH @PAPERS@, results AS (
  SELECT 0 AS q, doc_id, id, url, title FROM papers WHERE contains(lower(title), 'ones')
  UNION ALL SELECT 1, doc_id, id, url, title FROM papers WHERE contains(lower(title), 'ansh')
  UNION ALL SELECT 2, doc_id, id, url, title FROM papers WHERE contains(lower(title), 'eror')
  UNION ALL SELECT 3, doc_id, id, url, title FROM papers WHERE contains(lower(title), 'onea'))
SELECT CAST(q AS BIGINT) AS query_rank, doc_id FROM results
QUALIFY row_number() OVER (PARTITION BY CASE WHEN id <> '' THEN id WHEN url <> '' THEN url ELSE title END ORDER BY q, doc_id) = 1""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    # all queries run over the same table, so one scan serves them
    found = F.array_compact(F.array(*[
        F.when(F.contains(F.lower("title"), F.lit(t)), F.lit(i)) for i, t in enumerate(QUERY_TERMS)]))
    rows = papers(spark, folder).select("doc_id", "id", "url", "title", F.explode(found).alias("query_rank"))
    return dedup.merge_ranked(rows, ["doc_id"]).select(F.col("query_rank").cast("bigint"), "doc_id")


def _hits_sql(text: str, buckets, source: str) -> str:
    cols = ", ".join(f"{e} AS hit{i}" for i, e in enumerate(sql_hits(text, buckets)))
    return f"SELECT doc_id, {cols} FROM {source}"


def _hits(df: DataFrame, buckets, batches: bool = True) -> DataFrame:
    out = classify.with_hits(df, F.lower("text"), buckets, batches=batches)
    return out.select("doc_id", *[F.get("hits", i).alias(f"hit{i}") for i in range(len(buckets))])


@job("keyword_hits", _hits_sql("t", BUCKETS, "(SELECT doc_id, lower(text) AS t FROM documents)"))
def _(spark: SparkSession, folder: str) -> DataFrame:
    return _hits(table(spark, folder, "documents").select("doc_id", "text"), BUCKETS)


@job("keyword_hits_inline", _hits_sql("t", BUCKETS, "(SELECT doc_id, lower(text) AS t FROM documents)"))
def _(spark: SparkSession, folder: str) -> DataFrame:
    return _hits(table(spark, folder, "documents").select("doc_id", "text"), BUCKETS, batches=False)


# each document gets two of the real keywords, as the texts have none
_REAL = [k for _, words in V.BUCKETS for k in words]
_REAL_SQL = "[" + ", ".join("'" + k.replace("'", "''") + "'" for k in _REAL) + "]"


@job("keyword_hits_fixed", _hits_sql("t", V.BUCKETS, f"""(SELECT doc_id, lower(text || ' ' || k[1 + doc_id % len(k)] || ' ' || k[1 + doc_id * 7 % len(k)]) AS t
  FROM documents, (SELECT {_REAL_SQL} AS k))"""))
def _(spark: SparkSession, folder: str) -> DataFrame:
    words = F.array(*[F.lit(k) for k in _REAL])
    picked = [F.get(words, (F.col("doc_id") * n % len(_REAL)).cast("int")) for n in (1, 7)]
    docs = table(spark, folder, "documents").select("doc_id", F.concat_ws(" ", "text", *picked).alias("text"))
    return _hits(docs, V.BUCKETS)


@job("assign_bucket", f"""WITH h AS ({_hits_sql("t", BUCKETS, "(SELECT doc_id, lower(text) AS t FROM documents)")})
SELECT doc_id, {sql_bucket()} AS bucket FROM h""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return classify.assign_bucket(docs, F.lower("text"), BUCKETS).select("doc_id", "bucket")


@job("assign_bucket_join", f"""WITH h AS ({_hits_sql("t", BUCKETS, "(SELECT doc_id, lower(text) AS t FROM documents)")})
SELECT doc_id, {sql_bucket()} AS bucket FROM h""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    words = classify.keyword_table(spark, BUCKETS)
    return classify.assign_bucket_large(docs, F.lower("text"), words).select("doc_id", "bucket")


@job("totals", """WITH @CLASSIFIED@
SELECT count(*) AS total, count(*) FILTER (bucket <> '') AS selected,
  round(count(*) FILTER (bucket <> '') / count(*), 6) AS selected_share FROM classified""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return classify.totals(classified(spark, folder)).withColumn(
        "selected_share", F.round(F.col("selected") / F.col("total"), 6))


@job("bucket_badge_counts", """WITH @SUMMARY@
SELECT CAST(s.bucket_rank AS BIGINT) AS bucket_rank, s.bucket, c.badge, coalesce(c.n, 0) AS n
FROM summary s LEFT JOIN counts c USING (bucket)""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    counts = classify.bucket_badge_counts(classified(spark, folder))
    dimension = classify.bucket_table(spark, BUCKETS)
    return dimension.join(counts, "bucket", "left").select(
        F.col("bucket_rank").cast("bigint"), "bucket", "badge", F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))


@job("badge_string", "WITH @SUMMARY@ SELECT CAST(bucket_rank AS BIGINT) AS bucket_rank, bucket, total, by_badge FROM summary")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return _summary(spark, folder)


@job("bucket_digest", "WITH @SUMMARY@ SELECT bucket, total, by_badge FROM summary WHERE total > 0")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return _summary(spark, folder).where(F.col("total") > 0).drop("bucket_rank")


def _summary(spark: SparkSession, folder: str) -> DataFrame:
    return classify.bucket_summary(classified(spark, folder), BUCKETS).withColumn(
        "bucket_rank", F.col("bucket_rank").cast("bigint"))


@job("top_bottom", """WITH @SUMMARY@
SELECT * FROM (SELECT bucket, total, 'top' AS side FROM summary ORDER BY total DESC, bucket_rank LIMIT 3)
UNION ALL SELECT * FROM (SELECT bucket, total, 'bottom' FROM summary ORDER BY total, bucket_rank LIMIT 2)""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return rank.top_and_bottom(_summary(spark, folder), "total", "bucket_rank").select("bucket", "total", "side")


@job("bar_width", """WITH @SUMMARY@, m AS (SELECT max(total) AS mx FROM summary WHERE bucket <> 'Deep Learning Methods')
SELECT bucket, total, CAST(CASE WHEN bucket = 'Deep Learning Methods' THEN 100 WHEN mx > 0
  THEN (total * 200 + mx) // (2 * mx) ELSE 0 END AS BIGINT) AS width FROM summary, m""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return rank.bar_widths(_summary(spark, folder), "bucket", "total").select("bucket", "total", "width")


@job("bucket_leaders", """WITH @CLASSIFIED@, tiers AS (
  SELECT c.doc_id, c.bucket, c.n_chars, coalesce(l.quality, -1) AS tier FROM classified c LEFT JOIN labels l USING (doc_id) WHERE bucket <> '')
SELECT bucket, CAST(r AS BIGINT) AS rank, doc_id FROM (
  SELECT *, row_number() OVER (PARTITION BY bucket ORDER BY tier DESC, n_chars DESC, doc_id) AS r FROM tiers)
WHERE r <= CASE WHEN bucket = 'Deep Learning Methods' THEN 2 ELSE 3 END""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    tiers = table(spark, folder, "labels").select("doc_id", F.col("quality").alias("tier"))
    rows = classified(spark, folder).where(F.col("bucket") != "").select("doc_id", "bucket", "n_chars")
    rows = rows.join(tiers, "doc_id", "left").withColumn("tier", F.coalesce("tier", F.lit(-1)))
    order = [F.desc("tier"), F.desc("n_chars"), F.asc("doc_id")]
    best = rank.leaders(rows, "bucket", order, 3, {V.CATCH_ALL_BUCKET: 2})
    return best.select("bucket", F.col("rank").cast("bigint"), "doc_id")


@job("watch_lens", """WITH @SUMMARY@, lead AS (SELECT bucket FROM summary ORDER BY total DESC, bucket_rank LIMIT 3)
SELECT bucket, total FROM summary WHERE total >= 2 AND bucket NOT IN (SELECT bucket FROM lead)
  AND bucket IN ('Lensless/Coded Imaging', 'Virtual Staining/Pathology', 'Light-Field/Novel Sensors', 'Meta-Optics/Diffractive')""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    counts = _summary(spark, folder)
    return sets.watch_candidates(counts, "bucket", "total", "bucket_rank", V.WATCHED_BUCKETS).select("bucket", "total")


_pairs = " UNION ALL ".join(
    f"SELECT '{BUCKET_NAMES[i]}' AS bucket_a, '{BUCKET_NAMES[j]}' AS bucket_b, count(*) AS n FROM h WHERE hit{i} > 0 AND hit{j} > 0"
    for i in range(9) for j in range(i + 1, 9))


@job("crossover_pairs", f"""WITH h AS ({_hits_sql("t", BUCKETS, "(SELECT doc_id, lower(text) AS t FROM documents)")})
SELECT * FROM ({_pairs}) WHERE n > 0""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("text")
    return sets.crossover_pairs(classify.with_hits(docs, F.lower("text"), BUCKETS), F.col("hits"), BUCKET_NAMES)


@job("keyword_contrast", """WITH w AS (
  SELECT CAST(substr(source, 4) AS INT) < 10 AS preprint, unnest(string_split(lower(text), ' ')) AS word FROM documents)
SELECT word, CASE WHEN bool_or(preprint) AND bool_or(NOT preprint) THEN 'shared'
  WHEN bool_or(preprint) THEN 'preprint' ELSE 'journal' END AS kind FROM w WHERE word <> '' GROUP BY word""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    side = F.when(F.substring("source", 4, 10).cast("int") < 10, "preprint").otherwise("journal").alias("side")
    words = table(spark, folder, "documents").select(side, F.explode(F.split(F.lower("text"), " ")).alias("word")).where(F.col("word") != "")
    return sets.contrast(words, "word", F.col("side"), "preprint", "journal")


@job("query_topk", """WITH @PAPERS@, q AS (SELECT unnest(['ones', 'ansh', 'eror', 'onea']) AS term),
m AS (SELECT term, doc_id, day, contains(lower(title), term)::INT + contains(lower(abstract), term)::INT AS hits FROM papers, q)
SELECT term, CAST(r AS BIGINT) AS rank, doc_id FROM (
  SELECT *, row_number() OVER (PARTITION BY term ORDER BY hits DESC, day DESC, doc_id) AS r FROM m WHERE hits > 0) WHERE r <= 60""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    title, body = F.lower("title"), F.lower("abstract")
    scored = F.array(*[
        F.struct(F.lit(t).alias("term"), (F.contains(title, F.lit(t)).cast("int")
                                          + F.contains(body, F.lit(t)).cast("int")).alias("hits"))
        for t in QUERY_TERMS])
    rows = papers(spark, folder).select("doc_id", "day", F.inline(scored)).where(F.col("hits") > 0)
    best = rank.leaders(rows, "term", [F.desc("hits"), F.desc("day"), F.asc("doc_id")], 60)
    return best.select("term", F.col("rank").cast("bigint"), "doc_id")


@job("classified_doc", """WITH @SUMMARY@, t AS (SELECT count(*) AS doc_total, count(*) FILTER (bucket <> '') AS doc_selected FROM classified)
SELECT bucket, total, by_badge, doc_total, doc_selected FROM summary, t""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return classify.document_summary(classified(spark, folder), BUCKETS).select(
        "bucket", "total", "by_badge", "doc_total", "doc_selected")


@job("newest_topk", """WITH @PAPERS@ SELECT source, CAST(r AS BIGINT) AS rank, doc_id FROM (
  SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY day DESC, doc_id) AS r FROM papers) WHERE r <= 60""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    """Rows per query without a keyword: newest first."""
    best = rank.leaders(papers(spark, folder, texts=False).select("source", "day", "doc_id"), "source", [F.desc("day"), F.asc("doc_id")], 60)
    return best.select("source", F.col("rank").cast("bigint"), "doc_id")
