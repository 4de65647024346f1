"""Landed pages, posts and JSON documents.

Each of these files is one page or one day, so reading it as one text is bounded
by the feed's own file size; Spark spreads the files over the cluster.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed_values as V
from ..functions.text import once, text_or_empty
from ..operators.rollup import whole_counts
from ..schemas import BENCHMARK_DAY, HEAT, INSIGHTS_DAY, PAPER, WEEKLY

DAY_IN_NAME = r"(20\d{2}-\d{2}-\d{2})"


def read_texts(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """``file_name, text``: one row per file, bad bytes replaced.  A missing path gives no rows."""
    empty = spark.createDataFrame([], "file_name STRING, text STRING")
    try:
        raw = spark.read.option("pathGlobFilter", glob).text(path, wholetext=True)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return empty
        raise
    return raw.select(F.col("_metadata.file_name").alias("file_name"), F.make_valid_utf8("value").alias("text"))


def read_listing_pages(spark: SparkSession, path: str) -> DataFrame:
    return read_texts(spark, path).select(F.col("file_name").alias("url"), F.col("text").alias("html"))


def posts_from(texts: DataFrame, name: str = "file_name", html: str = "text") -> DataFrame:
    """Rows whose name is a post's, with ``day`` and ``weekly``; every other file is ignored."""
    day = F.regexp_extract(name, V.POST_NAME, 1)
    return texts.where(F.col(name).rlike(V.POST_NAME)).select(
        F.col(name).alias("file_name"), day.alias("day"),
        (F.regexp_extract(name, V.POST_NAME, 2) != "").alias("weekly"), F.col(html).alias("html"))


def read_posts(spark: SparkSession, path: str) -> DataFrame:
    return posts_from(read_texts(spark, path, "*.html"))


def paper_elements(text: Column) -> Column:
    """JSON texts of the papers in a flat array or in ``buckets.*.papers``; anything but objects is dropped."""
    nested = F.from_json(text, "STRUCT<buckets: MAP<STRING, STRUCT<papers: ARRAY<STRING>>>>")
    grouped = F.flatten(F.transform(F.map_values(nested["buckets"]),
                                    lambda b: F.coalesce(b["papers"], F.array().cast("array<string>"))))
    flat = F.when(F.ltrim(text).startswith("["), F.from_json(text, "ARRAY<STRING>"))
    return F.filter(F.coalesce(flat, grouped), lambda e: F.ltrim(e).startswith("{"))


def papers_from(texts: DataFrame, text: str = "text") -> DataFrame:
    """Paper rows with their position in the document, from either document shape."""
    rows = texts.select(*[c for c in texts.columns if c != text],
                        F.posexplode(paper_elements(F.col(text))).alias("pos", "_element"))
    return rows.withColumn("_p", F.from_json("_element", f"STRUCT<{_struct(PAPER)}>")).select(
        *[c for c in rows.columns if c != "_element"], "_p.*")


def _struct(ddl: str) -> str:
    return ", ".join(f"{n}: {t}" for n, t in (field.split(" ", 1) for field in ddl.split(", ")))


def read_paper_arrays(spark: SparkSession, path: str) -> DataFrame:
    """Files that hold one JSON array of papers each, as records; a malformed file fails the job."""
    return spark.read.schema(PAPER).option("multiLine", "true").option("mode", "FAILFAST").json(path)


def checked_json(texts: DataFrame, text: str = "text") -> DataFrame:
    """The same rows; the first text that is no JSON fails the job."""
    return texts.where(F.parse_json(F.col(text)).isNotNull() | F.col(text).isNull())


def read_ranked_papers(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Sources in listed order, ``source_rank`` carrying it; a missing file is skipped, a malformed one fails the job."""
    out = None
    for rank, path in enumerate(paths):
        part = papers_from(checked_json(read_texts(spark, path))).withColumn("source_rank", F.lit(rank))
        out = part if out is None else out.unionByName(part)
    return out


def parsed_documents(texts: DataFrame, text: str = "text") -> DataFrame:
    """Each text parsed once: ``doc`` as VARIANT, and ``corrupt`` with the text where it is no JSON.  A null text has neither."""
    parsed = once(texts, doc=F.try_parse_json(text))
    return parsed.withColumn("corrupt", F.when(F.col("doc").isNull(), F.col(text))).drop(text)


def land_documents(texts: DataFrame, path: str, text: str = "text") -> None:
    """Documents at rest in parsed form, the unreadable ones beside them; every later read takes the paths it needs."""
    parsed_documents(texts, text).write.mode("append").parquet(path)


def landed_documents(spark: SparkSession, path: str, schema: str, strict: bool = False) -> DataFrame:
    """Landed documents as ``doc`` of the given type.  Fields of another type are null; ``strict`` fails at the first unreadable text, else it is skipped."""
    rows = spark.read.parquet(path)
    return typed_documents(rows, schema, strict)


def typed_documents(rows: DataFrame, schema: str, strict: bool) -> DataFrame:
    doc = F.try_variant_get("doc", "$", schema)
    if strict:
        doc = F.when(F.assert_true(F.col("corrupt").isNull(), F.concat(F.lit("no JSON: "), F.left("corrupt", F.lit(80)))).isNull(), doc)
        return rows.withColumn("doc", doc).drop("corrupt")
    return rows.where("corrupt is null").withColumn("doc", doc).drop("corrupt")


def trends_from(texts: DataFrame, name: str = "file_name", text: str = "text") -> DataFrame:
    """Day documents, tolerantly: an unreadable file or a ``by_cat`` that is no object is skipped."""
    return trends_of(parsed_documents(texts.where(F.col(name).rlike(f"^{DAY_IN_NAME}\\.json$")).select(name, text), text), name)


def trends_of(documents: DataFrame, name: str = "file_name") -> DataFrame:
    """The same from documents that are parsed already."""
    counts = F.try_variant_get("doc", "$.daily_new_counts.by_cat", "map<string,string>")
    rows = documents.where(F.col(name).rlike(f"^{DAY_IN_NAME}\\.json$")).select(
        F.to_date(F.regexp_extract(name, DAY_IN_NAME, 1)).alias("day"), F.col(name).alias("source"), counts.alias("by_cat"),
        text_or_empty(F.try_variant_get("doc", "$.daily_new_counts.scope", "string")).alias("scope"))
    return rows.where("by_cat is not null").withColumn("by_cat", whole_counts(F.col("by_cat")))


def read_trends(spark: SparkSession, path: str) -> DataFrame:
    return trends_from(read_texts(spark, path, "*.json"))


def strict_documents(texts: DataFrame, schema: str, text: str = "text") -> DataFrame:
    """Day documents, strictly: the first unreadable one fails the job."""
    doc = F.try_variant_get(F.parse_json(text), "$", schema)  # the parser raises on malformed text
    return texts.withColumn("doc", doc).drop(text)


def read_insights(spark: SparkSession, path: str) -> DataFrame:
    return strict_documents(read_texts(spark, path, "*.json"), INSIGHTS_DAY)


def read_benchmarks(spark: SparkSession, path: str) -> DataFrame:
    """One row per result, listed as ``results`` or as ``benchmarks``; documents with neither give none."""
    docs = strict_documents(read_texts(spark, path, "*.json"), BENCHMARK_DAY)
    return docs.select(F.to_date(F.regexp_extract("file_name", DAY_IN_NAME, 1)).alias("day"),
                       F.inline(F.coalesce("doc.results", "doc.benchmarks")))


def read_weekly(spark: SparkSession, path: str) -> DataFrame:
    return strict_documents(read_texts(spark, path, "*.json"), WEEKLY)


def weekly_heat(weekly: DataFrame) -> DataFrame:
    """``iso_week, side, pos, cluster, papers``: the hot and the cold clusters of each week."""
    def side(name: str) -> Column:
        rows = F.coalesce(F.col(f"doc.hot_vs_cold.{name}"), F.array().cast(HEAT))
        return F.transform(rows, lambda r, i: F.struct(F.lit(name).alias("side"), i.alias("pos"), r["cluster"].alias("cluster"), r["papers"].alias("papers")))

    return weekly.select("doc.iso_week", F.inline(F.concat(side("hot"), side("cold"))))


def weekly_reviews(weekly: DataFrame) -> DataFrame:
    """``iso_week, title, label``: how last week's predictions were judged."""
    return weekly.select("doc.iso_week", F.inline("doc.prediction_review")).select("iso_week", "title", "label")


def cluster_rows(insights: DataFrame) -> DataFrame:
    """One row per titled cluster: ``clusters`` if present, else ``insights``; the name is ``cluster`` or ``title``."""
    dated = insights.select(F.to_date(F.regexp_extract("file_name", DAY_IN_NAME, 1)).alias("day"), "doc")
    return all_clusters(dated).select("day", "pos", "title", "papers", "why").where("title is not null")


def all_clusters(documents: DataFrame) -> DataFrame:
    """``day, pos, title, papers, why, checked``: rows of ``clusters``, else of ``insights``; a blank title is null."""
    rows = documents.select("day", F.col("doc.clusters").isNotNull().alias("checked"),
                            F.posexplode(F.coalesce("doc.clusters", "doc.insights")).alias("pos", "row"))

    def filled(name: str) -> Column:
        return F.nullif(F.trim(f"row.{name}"), F.lit(""))

    return rows.select("day", "pos", F.coalesce(filled("cluster"), filled("title")).alias("title"), "row.papers", "row.why", "checked")
