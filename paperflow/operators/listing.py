"""Landed listing pages: sections, paper chunks, fields."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as V
from ..functions.dates import listing_label
from ..functions.papers import first_author
from ..functions.text import once, regex_first, strip_markup, text_or_empty, ws

# Marks a cut in the text.  HTML does not allow this character; a page that has it all the same loses it first.
_CUT = "\x00"


@dataclass(frozen=True)
class ListingMarkup:
    """The patterns of one kind of page; the defaults are those of a landed listing page."""

    header: str = V.LISTING_HEADER
    chunk: str = V.LISTING_CHUNK
    id: str = V.LISTING_ID
    title: str = V.LISTING_TITLE
    authors: str = V.LISTING_AUTHORS
    authors_prefix: str = V.LISTING_AUTHORS_PREFIX
    author: str = V.LISTING_AUTHOR
    subjects: str = V.LISTING_SUBJECTS
    abstract: str = V.LISTING_ABSTRACT


def cut_before(col: Column, pattern: str, flags: str = "") -> Column:
    """Split a text in front of every match; element 0 is what precedes the first match."""
    head = f"(?{flags})" if flags else ""
    marked = F.regexp_replace(F.replace(text_or_empty(col), F.lit(_CUT), F.lit("")), f"{head}({ws(pattern)})", _CUT + "$1")
    return F.split(marked, _CUT)


def section_label(header: Column, cross: str = "cross", replaced: str = "replac",
                  new: str = "new submission") -> Column:
    """Section kind from the header text; the order of the tests matters."""
    t = F.lower(text_or_empty(header))
    return (
        F.when(F.contains(t, F.lit(cross)), F.lit("cross"))
        .when(F.contains(t, F.lit(replaced)), F.lit("replace"))
        .when(F.contains(t, F.lit(new)), F.lit("new"))
        .when(t.rlike(ws(V.DATED_SECTION)), F.lit("new"))
        .otherwise(F.lit("other"))
    )


def split_sections(pages: DataFrame, html: str = "html", header: str = V.LISTING_HEADER,
                   label=section_label) -> DataFrame:
    """One row per section: ``section_pos``, ``header``, ``section``, ``block``.

    Text before the first header is dropped; a page without any header is one
    ``new`` section.  ``label`` maps the header text to the section kind.
    """
    pieces = pages.withColumn("_pieces", cut_before(F.col(html), header, "is"))
    headed = F.slice(F.col("_pieces"), 2, F.size("_pieces"))
    blocks = F.when(F.size("_pieces") > 1, headed).otherwise(F.array(text_or_empty(F.col(html))))
    out = (
        pieces.withColumn("_headed", F.size("_pieces") > 1)
        .select("*", F.posexplode(blocks).alias("section_pos", "block"))
        .withColumn("header", F.when(F.col("_headed"), regex_first(F.col("block"), header, "is")))
    )
    return out.withColumn(
        "section", F.when(F.col("_headed"), label(F.col("header"))).otherwise(F.lit("new"))
    ).drop("_pieces", "_headed", html)


def explode_chunks(blocks: DataFrame, block: str = "block", chunk: str = V.LISTING_CHUNK,
                   id_pattern: str = V.LISTING_ID) -> DataFrame:
    """One row per paper chunk that holds an id: ``chunk_pos``, ``chunk``, ``arxiv_id``."""
    pieces = F.split(text_or_empty(F.col(block)), ws(chunk))
    return (
        blocks.select("*", F.posexplode(pieces).alias("chunk_pos", "chunk"))
        .where(F.col("chunk_pos") > 0)
        .drop(block)
        .withColumn("arxiv_id", regex_first(F.col("chunk"), id_pattern, "i"))
        .where(F.col("arxiv_id") != "")
    )


def author_list(raw: Column, prefix: str = V.LISTING_AUTHORS_PREFIX, item: str = V.LISTING_AUTHOR,
                entities: str | None = "all") -> Column:
    """Author names in order, cut out of their markup.

    Entities are resolved on the whole author block before it is split into names,
    so that one Arrow call serves the row instead of one per name.
    """
    block = F.regexp_replace(F.replace(text_or_empty(raw), F.lit(_CUT), F.lit("")), "(?i)" + ws(prefix), "")
    names = F.regexp_extract_all(block, F.lit("(?d)" + ws(item)), 1)
    joined = F.array_join(F.transform(names, lambda n: F.regexp_replace(n, "<[^>]+>", "")), _CUT)
    cleaned = strip_markup_keep_cuts(joined, entities)
    return F.when(F.size(names) > 0, F.split(cleaned, _CUT)).otherwise(F.array().cast("array<string>"))


def strip_markup_keep_cuts(joined: Column, entities: str | None) -> Column:
    """Whitespace is collapsed around and inside each part, the cut marks stay."""
    one_space = strip_markup(joined, "", entities)
    return F.regexp_replace(one_space, f" ?{_CUT} ?", _CUT)


def primary_category(subjects: Column) -> Column:
    """First ``archive.XX`` in the subjects; lower-case archives do not count."""
    return regex_first(subjects, V.PRIMARY_CATEGORY)


def parse_listing(pages: DataFrame, html: str = "html", include_abstract: bool = True,
                  markup: ListingMarkup = ListingMarkup(), entities: str | None = "all") -> DataFrame:
    """Page rows to paper rows.  Narrow throughout: no shuffle at any size."""
    sections = split_sections(pages, html, markup.header).where(F.col("section") != "other")
    chunks = explode_chunks(sections, "block", markup.chunk, markup.id)
    c = F.col("chunk")
    # The raw fields come first, as columns of their own: the cleaning below reads each of them twice.
    raw = {
        "_title": regex_first(c, markup.title, "s"),
        "_subjects": regex_first(c, markup.subjects, "s"),
        "_authors": regex_first(c, markup.authors, "s"),
    }
    if include_abstract:
        raw["_abstract"] = regex_first(c, markup.abstract, "s")
    fields = once(chunks, **raw).drop("chunk", "header")
    clean = {name[1:]: strip_markup(F.col(name), "", entities) for name in raw if name != "_authors"}
    clean["authors"] = author_list(F.col("_authors"), markup.authors_prefix, markup.author, entities)
    papers = fields.withColumns(clean).drop(*raw)
    return papers.withColumns({
        "first_author": first_author(F.col("authors")), "primary_cat": primary_category(F.col("subjects"))})


def drop_replaced(papers: DataFrame, section: str = "section", replaced: str = "replace") -> DataFrame:
    """Updates of older papers go; a row without a section stays."""
    return papers.where(F.coalesce(F.col(section), F.lit("")) != replaced)


def date_section(pages: DataFrame, day: Column, html: str = "html",
                 header: str = V.DATE_HEADER, required: bool = False) -> DataFrame:
    """The block under the first header that names the day; ``found`` is false when none does, and with ``required`` the job fails.

    Header text may hold tags; they are dropped before the comparison.
    """
    def title(piece: Column) -> Column:
        return strip_markup(F.regexp_extract(piece, "(?is)" + ws(header), 1), " ", None)

    label = listing_label(day)
    pieces = pages.withColumn("_pieces", cut_before(F.col(html), header, "is"))
    headed = F.slice(F.col("_pieces"), 2, F.size("_pieces"))
    hits = F.filter(headed, lambda piece: F.contains(title(piece), label))
    if required:
        hits = F.when(F.size(hits) > 0, hits).otherwise(F.raise_error(F.concat(F.lit("no section for "), label)))
    return (
        pieces.withColumn("block", F.coalesce(F.get(hits, 0), F.lit("")))
        .withColumn("found", F.size(hits) > 0)
        .drop("_pieces", html)
    )


def harvest_ids(payload: Column, id_pattern: str = V.ABS_ID) -> Column:
    """Distinct ids in a JSON text of any shape: one match per string value, keys ignored, escapes resolved.

    The strings alone are parsed again, as one flat array, so no schema is needed; ``json_walk.harvested_ids`` is the variant that
    checks the whole text.
    """
    literal = r'("(?:[^"\\]|\\.)*+")(\s*:)?'
    values = F.regexp_extract_all(payload, F.lit(literal), 1)
    colons = F.regexp_extract_all(payload, F.lit(literal), 2)
    leaves = F.filter(F.arrays_zip(values.alias("v"), colons.alias("k")), lambda x: x["k"] == "")
    flat = F.concat(F.lit("["), F.array_join(F.transform(leaves, lambda x: x["v"]), ","), F.lit("]"))
    strings = F.from_json(flat, "array<string>")
    ids = F.transform(strings, lambda x: F.regexp_extract(x, id_pattern, 1))
    return F.array_distinct(F.filter(ids, lambda i: i != ""))
