"""Registry items and open-index works to paper rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as V
from ..functions.papers import concept_names, first_author, parts_date, person_names
from ..functions.text import bare_doi, blank_to_null, first_nonempty, strip_markup, text_or_empty
from ..schemas import INDEX_RESPONSE, REGISTRY_RESPONSE
from .index_text import index_to_text

PUBLISHED_KEYS = ("published", "issued", "published-online", "published-print")


def explode_response(df: DataFrame, body: str, schema: str, items: str) -> DataFrame:
    """One row per item of a landed JSON response; a missing path gives no rows."""
    parsed = df.withColumn("_r", F.from_json(F.col(body), schema))
    return parsed.select(
        *[F.col(c) for c in df.columns if c != body],
        F.posexplode(F.col(f"_r.{items}")).alias("pos", "item"),
    ).where(F.col("item").isNotNull())


def registry_items(df: DataFrame, body: str = "body") -> DataFrame:
    return explode_response(df, body, REGISTRY_RESPONSE, "message.items")


def index_works(df: DataFrame, body: str = "body") -> DataFrame:
    return explode_response(df, body, INDEX_RESPONSE, "results")


def registry_paper(item: Column, entities: str | None = "all") -> list[Column]:
    """Columns of the paper schema for one registry item."""
    doi = text_or_empty(item["DOI"])
    names = person_names(item["author"])
    return [
        F.lit("crossref").alias("source"),
        doi.alias("doi"),
        F.coalesce(F.concat(F.lit("doi:"), blank_to_null(doi)), F.lit("")).alias("id"),
        first_nonempty(item["URL"], F.concat(F.lit(V.DOI_URL), blank_to_null(doi))).alias("url"),
        strip_markup(F.get(item["title"], 0), " ", entities).alias("title"),
        names.alias("authors"),
        first_author(names).alias("first_author"),
        F.coalesce(F.get(item["container-title"], 0), F.lit("")).alias("journal"),
        F.coalesce(F.array_join(item["subject"], "; "), F.lit("")).alias("subjects"),
        F.lit("").alias("primary_cat"),
        F.lit("new").alias("section"),
        strip_markup(item["abstract"], " ", entities).alias("abstract"),
        parts_date(*[item[k]["date-parts"] for k in PUBLISHED_KEYS]).alias("published"),
        parts_date(item["created"]["date-parts"]).alias("created"),
    ]


def index_paper(work: Column) -> list[Column]:
    """Columns of the paper schema for one open-index work; concepts also serve as subjects."""
    doi = bare_doi(work["doi"])
    named = F.filter(F.transform(F.coalesce(work["authorships"], F.array()),
                                 lambda a: text_or_empty(a["author"]["display_name"])), lambda n: n != "")
    concepts = concept_names(work["concepts"])
    return [
        F.lit("openalex").alias("source"),
        doi.alias("doi"),
        first_nonempty(F.concat(F.lit("doi:"), blank_to_null(doi)), work["id"]).alias("id"),
        first_nonempty(work["doi"], work["id"]).alias("url"),
        first_nonempty(work["title"], work["display_name"]).alias("title"),
        named.alias("authors"),
        first_author(named).alias("first_author"),
        text_or_empty(work["primary_location"]["source"]["display_name"]).alias("journal"),
        F.array_join(concepts, "; ").alias("subjects"),
        F.lit("").alias("primary_cat"),
        F.lit("new").alias("section"),
        index_to_text(work["abstract_inverted_index"]).alias("abstract"),
        text_or_empty(work["publication_date"]).alias("published"),
        F.substring(text_or_empty(work["created_date"]), 1, 10).alias("created"),
        F.coalesce(work["cited_by_count"], F.lit(0)).cast("bigint").alias("cited_by_count"),
        concepts.alias("concepts"),
    ]


def look_back(df: DataFrame, day: Column, today: Column, days: int) -> DataFrame:
    """Rows dated between ``today - days`` and ``today``, both days included.

    ``day`` may be a timestamp: bounds on the bare column reach the scan.
    """
    return df.where((day >= F.date_sub(today, days)) & (day < F.date_add(today, 1)))
