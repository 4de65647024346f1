"""The artefacts of a release folder, ready for the release checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.gates import Artefacts
from ..operators.listing import harvest_ids
from ..operators.rollup import whole_counts
from ..schemas import INSIGHTS_DAY, TRENDS_DAY
from .landed import DAY_IN_NAME, all_clusters, read_posts, read_texts

SERIES = "STRUCT<daily: ARRAY<STRUCT<date: STRING, by_cat: MAP<STRING, STRING>>>>"


def _documents(spark: SparkSession, path: str) -> DataFrame:
    """Day documents with ``day`` from the name and whether the text is JSON at all."""
    texts = read_texts(spark, path, "*.json").where(F.col("file_name").rlike(f"^{DAY_IN_NAME}\\.json$"))
    return texts.select(F.to_date(F.regexp_extract("file_name", DAY_IN_NAME, 1)).alias("day"), "text",
                        F.try_parse_json("text").isNotNull().alias("readable"))


def _clusters(documents: DataFrame) -> DataFrame:
    """Only the rows of ``clusters`` are held to papers and a reason."""
    rows = all_clusters(documents.select("day", F.from_json("text", INSIGHTS_DAY).alias("doc")))
    return rows.select(
        "day", "pos", "title", F.when(F.col("checked"), F.coalesce(F.size("papers"), F.lit(0))).alias("papers"),
        F.when(F.col("checked"), F.coalesce("why", F.lit(""))).alias("why"))


def _token(text: Column, path: str) -> Column:
    """A JSON value as its own JSON text, so that the string "7" differs from the number 7."""
    value = F.try_variant_get(F.try_parse_json(text), path, "variant")
    return F.when(F.schema_of_variant(value) != "VOID", F.to_json(value))


def read_release(spark: SparkSession, root: str) -> Artefacts:
    """``posts/``, ``trends/``, ``insights/``, ``benchmarks/``, ``feed.xml`` and ``stats/*.json`` under one folder."""
    posts = read_posts(spark, f"{root}/posts").where(~F.col("weekly")).select(F.to_date("day").alias("day"), "html")
    trends = _documents(spark, f"{root}/trends").withColumn("doc", F.from_json("text", TRENDS_DAY)).select(
        "day", "readable", F.col("doc.date").alias("doc_date"), F.col("doc.source_listing_date").alias("listing_date"),
        "doc.source_mode", "doc.daily_new_counts.scope",
        F.transform_values(F.try_variant_get(F.try_parse_json("text"), "$.daily_new_counts.by_cat", "map<string,variant>"),
                           lambda k, v: F.to_json(v)).alias("by_cat"),
        _token(F.col("text"), "$.totals.total_scanned").alias("total_scanned"), _token(F.col("text"), "$.totals.selected").alias("selected"),
        _token(F.col("text"), "$.daily_new_counts").alias("counts_object"),
        # what a page showed and what was parsed of it are known to the collecting run only: those rules report that they cannot be checked
        *[F.lit(None).cast("int").alias(c) for c in ("shown", "parsed", "geometry_papers", "geometry_named")])
    insights = _documents(spark, f"{root}/insights")
    ids = insights.select("day", F.explode(harvest_ids(F.col("text"))).alias("id"))
    feed = read_texts(spark, f"{root}/feed.xml").select(
        F.explode(F.regexp_extract_all("text", F.lit(r"posts/(\d{4}-\d{2}-\d{2})\.html"), 1)).alias("d"))
    series = read_texts(spark, f"{root}/stats", "*.json").select(F.inline(F.from_json("text", SERIES)["daily"]))
    return Artefacts(
        posts=posts, trends=trends, insights=insights.select("day", "readable"), clusters=_clusters(insights),
        ids=ids, benchmarks=_documents(spark, f"{root}/benchmarks").select("day", "readable"),
        feed=feed.select(F.to_date("d").alias("day")).distinct(),
        series=series.select(F.to_date("date").alias("day"), whole_counts(F.col("by_cat")).alias("by_cat")))
