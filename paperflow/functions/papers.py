"""Columns of one paper record: keys, badges, links, digests, name and date assembly."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed_values as V
from .text import bare_doi, blank_to_null, first_nonempty, strip_ws, text_or_empty


def unified_key(arxiv_id: Column, id_: Column, doi: Column, normalise_doi: bool = True) -> Column:
    """First non-empty of the three ids.

    A registry keeps the DOI's case while an index lowers it.  ``normalise_doi``
    makes both spellings one key; switch it off for the literal rule.
    """
    key = first_nonempty(arxiv_id, id_, doi)
    if not normalise_doi:
        return key
    is_doi = F.nullif(text_or_empty(arxiv_id), F.lit("")).isNull()
    return F.when(is_doi & (key != ""), F.lower(key)).otherwise(key)


def lookup_doi(doi: Column, id_: Column) -> Column:
    """Bare DOI used for enrichment: the doi field, else what follows ``doi:`` in the id."""
    from_id = F.when(F.startswith(text_or_empty(id_), F.lit("doi:")), F.substring(id_, 5, 2**31 - 1))
    return bare_doi(first_nonempty(doi, from_id))


def source_badge(source: Column, primary_cat: Column, subjects: Column,
                 badges: dict[str, str] = V.BADGES,
                 source_badges: dict[str, str] = V.SOURCE_BADGES) -> Column:
    """Source badge, else the primary category's, else the first tracked category named in subjects."""
    primary, subjects = text_or_empty(primary_cat), text_or_empty(subjects)
    rules = [(source == name, F.lit(badge)) for name, badge in source_badges.items()]
    rules += [(primary == cat, F.lit(badge)) for cat, badge in badges.items()]
    rules += [(F.contains(subjects, F.lit(cat)), F.lit(badge)) for cat, badge in badges.items()]
    out = F.when(*rules[0])
    for condition, badge in rules[1:]:
        out = out.when(condition, badge)
    return out.otherwise(first_nonempty(primary, F.lit(V.UNKNOWN_BADGE)))


def paper_link(source: Column, url: Column, doi: Column, arxiv_id: Column,
               index_branch: bool = True) -> Column:
    """Registry rows link by url, then DOI; the rest by listing id; ``#`` when there is nothing.

    ``index_branch`` also lets open-index rows link by url; off gives the literal rule.
    """
    by_doi = F.concat(F.lit(V.DOI_URL), blank_to_null(doi))
    by_abs = F.concat(F.lit(V.ABS_URL), blank_to_null(arxiv_id))
    registry = F.coalesce(blank_to_null(url), by_doi, F.lit("#"))
    linked = ["crossref", "openalex"] if index_branch else ["crossref"]
    return F.when(source.isin(linked), registry).otherwise(F.coalesce(by_abs, F.lit("#")))


def first_author(authors: Column) -> Column:
    return F.coalesce(F.get(authors, 0), F.lit(""))


def author_digest(authors: Column, more: str = " 외 {n}명") -> Column:
    """First name, and how many more there are."""
    before, after = more.split("{n}")
    n = F.coalesce(F.size(authors), F.lit(0))
    rest = F.concat(F.lit(before), (n - 1).cast("string"), F.lit(after))
    return F.when(n < 1, F.lit("")).otherwise(
        F.concat(first_author(authors), F.when(n > 1, rest).otherwise(F.lit(""))))


def meta_digest(source: Column, journal: Column, created: Column, abstract: Column,
                created_label: str = "등록 ", limit: int = V.META_CHARS) -> Column:
    """Registry rows: venue and registration date.  Others: the start of the abstract."""
    dated = F.concat(F.lit(created_label), blank_to_null(created))
    registry = F.concat_ws(" · ", blank_to_null(journal), dated)
    body = strip_ws(text_or_empty(abstract))
    lead = F.concat(F.substring(body, 1, limit),
                    F.when(F.char_length(body) > limit, F.lit("…")).otherwise(F.lit("")))
    return F.when(source == "crossref", registry).otherwise(lead)


def person_names(people: Column) -> Column:
    """Array of {given, family, name} to display names; people without any name drop out."""
    def one(p: Column) -> Column:
        joined = strip_ws(F.concat_ws(" ", blank_to_null(p["given"]), blank_to_null(p["family"])))
        return first_nonempty(joined, p["name"])
    return F.filter(F.transform(F.coalesce(people, F.array()), one), lambda n: n != "")


def parts_date(*date_parts: Column) -> Column:
    """First year/month/day list that has a year, as YYYY-MM-DD; a missing month or day is 1."""
    def one(nested: Column) -> Column:
        p = F.get(nested, 0)
        padded = F.format_string("%04d-%02d-%02d", F.get(p, 0),
                                 F.coalesce(F.get(p, 1), F.lit(1)), F.coalesce(F.get(p, 2), F.lit(1)))
        return F.when((F.size(p) > 0) & F.get(p, 0).isNotNull(), padded)
    return F.coalesce(*[one(d) for d in date_parts], F.lit(""))


def concept_names(concepts: Column, limit: int = V.CONCEPT_LIMIT,
                  min_score: float = V.CONCEPT_MIN_SCORE) -> Column:
    """Names scoring at least ``min_score``: the first ``limit`` in the given order, not by score."""
    def kept(c: Column) -> Column:
        return (F.coalesce(c["score"], F.lit(0.0)) >= min_score) & (text_or_empty(c["display_name"]) != "")
    good = F.filter(F.coalesce(concepts, F.array()), kept)
    return F.transform(F.slice(good, 1, limit), lambda c: c["display_name"])
