"""Whitespace, markup and entity handling."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import fixed_values as V

# Every character Unicode calls whitespace, plus the four ASCII separators.
# Written as one class because a plain \s covers ASCII only.
WS = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"

# Entities handled without leaving the JVM; `&amp;` comes last so that one pass stays one pass.
COMMON_ENTITIES = (
    ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", "\u00a0"),
    ("&middot;", "·"), ("&copy;", "©"), ("&amp;", "&"),
)
_COMMON_NAMES = "|".join(name[1:-1] for name, _ in COMMON_ENTITIES)
_OTHER_ENTITY = rf"&(?!(?:{_COMMON_NAMES});)[^\t\n\f <&;]"


def ws(pattern: str) -> str:
    """Spell out ``\\s`` in a pattern as the full Unicode class."""
    return pattern.replace(r"\s", WS)


# The same characters as one string, for trimming without a regular expression.
WS_CHARS = "".join(chr(c) for c in (
    *range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000))


def bind(col: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` applied to ``col``, which is computed once however often ``body`` reads it.

    Inside array lambdas Spark would compute a repeated expression again for each use.
    """
    return F.get(F.transform(F.array(col), body), 0)


def once(df: DataFrame, **columns: Column) -> DataFrame:
    """Adds columns that many later expressions read, computed once per row.

    A one-element generator stays inside whole-stage code, and it keeps the optimizer
    from copying a long definition into every filter and projection above it, which
    would outgrow the size limit of generated code.
    """
    row = F.struct(*[c.alias(name) for name, c in columns.items()])
    return df.select("*", F.inline(F.array(row)))


def text_or_empty(col: Column) -> Column:
    return F.coalesce(col, F.lit(""))


def blank_to_null(col: Column) -> Column:
    return F.nullif(col, F.lit(""))


def first_nonempty(*cols: Column) -> Column:
    return F.coalesce(*[blank_to_null(c) for c in cols], F.lit(""))


def strip_ws(col: Column) -> Column:
    return F.btrim(col, F.lit(WS_CHARS))


def collapse_ws(col: Column) -> Column:
    """Runs of whitespace become one space; none at either end.

    Splitting at plain spaces takes Spark's short path and costs about half of a regular expression here.
    """
    spaced = F.translate(col, WS_CHARS, " " * len(WS_CHARS))
    return F.array_join(F.array_remove(F.split(spaced, " "), ""), " ")


def regex_first(col: Column, pattern: str, flags: str = "", group: int = 1) -> Column:
    """First match only, empty string when there is none."""
    head = f"(?{flags})" if flags else ""
    return F.regexp_extract(text_or_empty(col), head + ws(pattern), group)


def unescape_common(col: Column) -> Column:
    for name, value in COMMON_ENTITIES:
        col = F.replace(col, F.lit(name), F.lit(value))
    return col


def _unescape_rare(col: Column) -> Column:
    # Defined inside so that it travels to the executors by value, without this package.
    def resolve(texts: pd.Series) -> pd.Series:
        from html import unescape as resolve_one
        return texts.map(resolve_one, na_action="ignore")
    return F.pandas_udf(resolve, T.StringType())(col)


def unescape(col: Column) -> Column:
    """All named and numeric entities in a single pass.

    Rows holding only the common entities are finished in the JVM; the Arrow
    function receives null for them, so the transfer carries just the rare rows.
    """
    rare = F.when(col.rlike(_OTHER_ENTITY), col)
    return F.coalesce(_unescape_rare(rare), unescape_common(col))


def strip_markup(col: Column, tag_sep: str = " ", entities: str | None = "all") -> Column:
    """Drop tags, optionally resolve entities, collapse whitespace.

    ``entities`` is "all", "common" (JVM only) or None (left as they are).
    """
    out = F.regexp_replace(text_or_empty(col), "<[^>]+>", tag_sep)
    if entities == "all":
        out = unescape(out)
    elif entities == "common":
        out = unescape_common(out)
    return collapse_ws(out)


def bare_doi(col: Column) -> Column:
    out = text_or_empty(col)
    for prefix in V.DOI_PREFIXES:
        out = F.replace(out, F.lit(prefix), F.lit(""))
    return F.lower(strip_ws(out))


def clip(col: Column, limit: int, ellipsis: bool = True) -> Column:
    """Keep ``limit`` characters; with ``ellipsis`` the mark counts as one of them."""
    if not ellipsis:
        return F.substring(col, 1, limit)
    short = F.rtrim(F.substring(col, 1, limit - 1), F.lit(WS_CHARS))
    return F.when(F.char_length(col) > limit, F.concat(short, F.lit("…"))).otherwise(col)


def heading(col: Column, tag: str = "h1", entities: str | None = "all") -> Column:
    return strip_markup(regex_first(col, rf"<{tag}[^>]*>(.*?)</{tag}>", "s"), " ", entities)


def summary_after(col: Column, marker: str = V.SUMMARY_HEADING, limit: int = V.FEED_SUMMARY_CHARS,
                  tag: str = "h2", entities: str | None = "all") -> Column:
    """First paragraph in the block that follows the marked heading, up to the next one."""
    block = regex_first(col, rf"<{tag}[^>]*>.*?{marker}.*?</{tag}>(.*?)(?:<{tag}|$)", "s")
    return clip(strip_markup(regex_first(block, r"<p[^>]*>(.*?)</p>", "s"), " ", entities), limit)


def summary_by_patterns(col: Column, patterns: tuple[str, ...] = V.ENTRY_SUMMARY_PATTERNS,
                        limit: int = V.ENTRY_SUMMARY_CHARS) -> Column:
    """First pattern, in order, that leaves any text; cut without a mark."""
    found = [strip_markup(regex_first(col, p, "s"), " ", None) for p in patterns]
    return clip(first_nonempty(*found), limit, ellipsis=False)
