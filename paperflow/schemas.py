"""Input shapes.  Everything is nullable and nothing is inferred."""

PAPER = (
    "source STRING, arxiv_id STRING, id STRING, doi STRING, url STRING, title STRING, "
    "authors ARRAY<STRING>, first_author STRING, journal STRING, subjects STRING, "
    "primary_cat STRING, section STRING, abstract STRING, published STRING, created STRING, "
    "cited_by_count BIGINT, concepts ARRAY<STRING>"
)

_PARTS = "STRUCT<`date-parts`: ARRAY<ARRAY<INT>>>"
REGISTRY_ITEM = (
    "STRUCT<DOI: STRING, title: ARRAY<STRING>, "
    "author: ARRAY<STRUCT<given: STRING, family: STRING, name: STRING>>, "
    "`container-title`: ARRAY<STRING>, abstract: STRING, subject: ARRAY<STRING>, URL: STRING, "
    f"published: {_PARTS}, issued: {_PARTS}, `published-online`: {_PARTS}, "
    f"`published-print`: {_PARTS}, created: {_PARTS}>"
)
REGISTRY_RESPONSE = f"STRUCT<message: STRUCT<items: ARRAY<{REGISTRY_ITEM}>>>"

WORK = (
    "STRUCT<id: STRING, doi: STRING, title: STRING, display_name: STRING, "
    "authorships: ARRAY<STRUCT<author: STRUCT<display_name: STRING>>>, "
    "primary_location: STRUCT<source: STRUCT<display_name: STRING>>, "
    "concepts: ARRAY<STRUCT<display_name: STRING, score: DOUBLE>>, "
    "abstract_inverted_index: MAP<STRING, ARRAY<INT>>, "
    "publication_date: STRING, created_date: STRING, cited_by_count: BIGINT>"
)
INDEX_RESPONSE = f"STRUCT<results: ARRAY<{WORK}>>"

TRENDS_DAY = (
    "STRUCT<date: STRING, source_listing_date: STRING, source_mode: STRING, note: STRING, "
    "daily_new_counts: STRUCT<by_cat: MAP<STRING, STRING>, scope: STRING, journal_count: INT>, "
    "totals: STRUCT<total_scanned: STRING, selected: STRING>, "
    "classified: STRUCT<by_bucket: MAP<STRING, INT>>>"
)
PAPER_REF = "STRUCT<title: STRING, arxiv: STRING, arxiv_id: STRING, doi: STRING>"
INSIGHTS_DAY = (
    "STRUCT<date: STRING, "
    f"clusters: ARRAY<STRUCT<cluster: STRING, title: STRING, papers: ARRAY<{PAPER_REF}>, why: STRING>>, "
    f"insights: ARRAY<STRUCT<cluster: STRING, title: STRING, papers: ARRAY<{PAPER_REF}>, why: STRING>>>"
)
_RESULT = "STRUCT<benchmark: STRING, metric: STRING, value: DOUBLE, value_str: STRING, paper: STRING, paper_title: STRING>"
BENCHMARK_DAY = f"STRUCT<date: STRING, results: ARRAY<{_RESULT}>, benchmarks: ARRAY<{_RESULT}>>"
HEAT = "ARRAY<STRUCT<cluster: STRING, why: STRING, papers: ARRAY<STRING>>>"
WEEKLY = (
    "STRUCT<date: STRING, iso_week: STRING, week_start: STRING, week_end: STRING, "
    f"hot_vs_cold: STRUCT<hot: {HEAT}, cold: {HEAT}>, "
    "prediction_review: ARRAY<STRUCT<title: STRING, label: STRING, reason: STRING>>>"
)
