import html

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from paperflow.functions import dates, fixed_values as V, papers as P, text as T
from paperflow.operators.index_text import index_to_text, text_to_index


@pytest.mark.parametrize("raw", [
    "&amp;lt; a", "&eacute;&#233;&#xe9; &hellip;", "&notit; &ampfoo &lt", "&nbsp;x&copy;&middot;", "AT&T & co; &#39;q&#39;", "plain", "",
])
def test_unescape_matches_the_standard(one, raw):
    assert one(T.unescape(F.col("x")), "x STRING", raw) == html.unescape(raw)


@pytest.mark.parametrize("raw", ["&amp;lt; a", "&quot;x&quot;", "&nbsp;x&copy;&middot;", "&&lt;"])
def test_common_entities_stay_single_pass(one, raw):
    assert one(T.unescape_common(F.col("x")), "x STRING", raw) == html.unescape(raw)


def test_whitespace_is_unicode(one):
    assert one(T.collapse_ws(F.col("x")), "x STRING", "\u00a0 a\u2003\n\x1cb\u3000") == "a b"
    assert one(T.strip_ws(F.col("x")), "x STRING", "\u00a0 a\u2003b \x85") == "a\u2003b"


def test_ws_class_and_string_agree():
    import re
    pattern = re.sub(r"\\x\{([0-9a-f]+)\}", lambda m: "\\u%04x" % int(m.group(1), 16), T.WS)
    every = "".join(chr(c) for c in range(0x3100))
    assert "".join(re.findall(pattern, every)) == "".join(c for c in every if c.isspace()) == T.WS_CHARS


def test_markup_variants(one):
    raw = "<b>A</b>B &lt;c&gt;\n<i>d</i>"
    assert one(T.strip_markup(F.col("x"), ""), "x STRING", raw) == "AB <c> d"
    assert one(T.strip_markup(F.col("x"), " "), "x STRING", raw) == "A B <c> d"
    assert one(T.strip_markup(F.col("x"), " ", None), "x STRING", raw) == "A B &lt;c&gt; d"
    assert one(T.strip_markup(F.col("x")), "x STRING", None) == ""


@pytest.mark.parametrize("raw, bare", [
    ("https://doi.org/10.1/AB ", "10.1/ab"), ("http://dx.doi.org/10.1/x", "10.1/x"),
    ("HTTPS://DOI.ORG/10.1/x", "https://doi.org/10.1/x"), (None, ""), ("", ""),
])
def test_bare_doi(one, raw, bare):
    assert one(T.bare_doi(F.col("x")), "x STRING", raw) == bare


@pytest.mark.parametrize("n, size, tail", [(380, 380, "a"), (381, 380, "…")])
def test_feed_summary_limit(one, n, size, tail):
    page = f"<h1>t</h1><h2>🔭 주간 동향</h2><div><p class=x>{'a' * n}</p><p>second</p></div><h2>next</h2><p>no</p>"
    got = one(T.summary_after(F.col("x")), "x STRING", page)
    assert len(got) == size and got[-1] == tail


def test_feed_summary_trims_before_the_mark(one):
    page = "<h2>주간 동향</h2><p>" + "a" * 378 + " bcd</p>"
    assert one(T.summary_after(F.col("x")), "x STRING", page) == "a" * 378 + "…"
    assert one(T.summary_after(F.col("x")), "x STRING", "<h2>other</h2><p>x</p>") == ""


def test_entry_summary_takes_the_first_filled_pattern(one):
    page = "<h2>결론</h2><div> <b></b> </div><h2>Executive Summary</h2><p>Second &amp; kept</p><div class=thesis>third</div>"
    assert one(T.summary_by_patterns(F.col("x")), "x STRING", page) == "Second &amp; kept"
    assert len(one(T.summary_by_patterns(F.col("x")), "x STRING", f"<div class=thesis>{'b' * 400}</div>")) == 300


def test_heading_and_fallback(one):
    assert one(T.heading(F.col("x")), "x STRING", "<h1 class=a>A <b>b</b>\n c</h1><h1>z</h1>") == "A b c"
    assert one(T.heading(F.col("x")), "x STRING", "<p>none</p>") == ""


@pytest.mark.parametrize("day, label", [("2026-06-01", "Mon, 1 Jun 2026"), ("2026-04-24", "Fri, 24 Apr 2026")])
def test_listing_label(one, day, label):
    assert one(dates.listing_label(F.to_date("x")), "x STRING", day) == label


def test_date_labels(one):
    day = F.to_date("x")
    assert one(dates.feed_stamp(day), "x STRING", "2026-06-05") == "Fri, 05 Jun 2026 09:00:00 +0900"
    assert one(dates.day_label(day), "x STRING", "2026-06-15") == "2026-06-15 (월)"
    assert one(dates.review_week_label(day), "x STRING", "2027-01-08") == "2026-W53 · 01-01 ~ 01-05"
    assert one(dates.is_weekend(day), "x STRING", "2026-06-13") is True


PAPER = "source STRING, arxiv_id STRING, id STRING, doi STRING, url STRING, primary_cat STRING, subjects STRING"


@pytest.mark.parametrize("source, primary, subjects, badge", [
    ("crossref", "cs.LG", "", "JNL"), ("openalex", "", "", "OAX"), ("", "eess.IV", "", "IV"),
    ("", "math.OC", "AI (cs.AI); CV (cs.CV)", "CV"), ("", "math.OC", "none", "math.OC"), (None, None, None, "?"), ("", "", "", "?"),
])
def test_badge(one, source, primary, subjects, badge):
    col = P.source_badge(F.col("source"), F.col("primary_cat"), F.col("subjects"))
    assert one(col, PAPER, source, "", "", "", "", primary, subjects) == badge


@pytest.mark.parametrize("source, url, doi, arxiv_id, link, literal", [
    ("crossref", "http://u", "10.1/a", "", "http://u", "http://u"),
    ("crossref", "", "10.1/a", "", "https://doi.org/10.1/a", "https://doi.org/10.1/a"),
    ("crossref", None, None, "2401.1", "#", "#"),
    ("", "", "", "2401.1", "https://arxiv.org/abs/2401.1", "https://arxiv.org/abs/2401.1"),
    (None, "", "", "", "#", "#"),
    ("openalex", "http://w", "", "", "http://w", "#"),
])
def test_link(one, source, url, doi, arxiv_id, link, literal):
    cols = [F.col("source"), F.col("url"), F.col("doi"), F.col("arxiv_id")]
    row = (source, arxiv_id, "", doi, url, "", "")
    assert one(P.paper_link(*cols), PAPER, *row) == link
    assert one(P.paper_link(*cols, index_branch=False), PAPER, *row) == literal


def test_author_digest(one):
    for authors, text in ((None, ""), ([], ""), (["A"], "A"), (["A", "B", "C"], "A 외 2명")):
        assert one(P.author_digest(F.col("x")), "x ARRAY<STRING>", authors) == text


def test_meta_digest(one):
    col = P.meta_digest(F.col("s"), F.col("j"), F.col("c"), F.col("a"))
    schema = "s STRING, j STRING, c STRING, a STRING"
    assert one(col, schema, "crossref", "J", "2026-01-02", "x") == "J · 등록 2026-01-02"
    assert one(col, schema, "crossref", "", "2026-01-02", "x") == "등록 2026-01-02"
    assert one(col, schema, "crossref", None, "", "x") == ""
    assert one(col, schema, "", "J", "", "  " + "a" * 200 + " ") == "a" * 200
    assert one(col, schema, None, "J", "", "a" * 201) == "a" * 200 + "…"


def test_names(one):
    schema = "x ARRAY<STRUCT<given: STRING, family: STRING, name: STRING>>"
    people = [("A", "B", None), (None, "F", None), (None, None, "Group"), (None, None, None), ("", "", ""), (" ", None, "G2")]
    assert one(P.person_names(F.col("x")), schema, people) == ["A B", "F", "Group", "G2"]
    assert one(P.person_names(F.col("x")), schema, None) == []


def test_date_parts(one):
    schema = "x ARRAY<ARRAY<INT>>, y ARRAY<ARRAY<INT>>"
    col = P.parts_date(F.col("x"), F.col("y"))
    assert one(col, schema, [[2026]], None) == "2026-01-01"
    assert one(col, schema, [[2026, 5]], None) == "2026-05-01"
    assert one(col, schema, [[]], [[2025, 12, 31]]) == "2025-12-31"
    assert one(col, schema, None, [[]]) == ""
    assert one(col, schema, [[None]], [[2025]]) == "2025-01-01"
    assert one(col, schema, [[None]], None) == ""


def test_concepts_keep_input_order(one):
    schema = "x ARRAY<STRUCT<display_name: STRING, score: DOUBLE>>"
    scored = [("a", 0.9), ("b", 0.2), ("c", 0.4), ("d", None), ("e", 0.3), ("", 0.9)]
    assert one(P.concept_names(F.col("x")), schema, scored) == ["a", "c", "e"]
    assert one(P.concept_names(F.col("x")), schema, [(str(i), 0.5) for i in range(7)]) == list("01234")


def test_index_to_text(one):
    schema = "x MAP<STRING, ARRAY<INT>>"
    col = index_to_text(F.col("x"))
    assert one(col, schema, {"b": [1], "a": [0, 2]}) == "a b a"
    assert one(col, schema, {"b": [5], "a": [0]}) == "a b"
    assert one(col, schema, {"a": [0], "b": [0]}) == "b"
    assert one(col, schema, {"a": [0, 1], "b": [1], "c": [1]}) == "a c"
    assert one(col, schema, None) == "" and one(col, schema, {}) == ""


@settings(max_examples=8, deadline=None)
@given(st.lists(st.text(alphabet="ab c\n\té\u00a0\x00", max_size=30), min_size=1, max_size=20))
def test_index_round_trip(spark, texts):
    df = text_to_index(spark.createDataFrame([(t,) for t in texts], "t STRING"), "t")
    for row in df.select("t", "inv", index_to_text(F.col("inv")).alias("back")).collect():
        words = row["t"].split()
        assert row["back"] == " ".join(words)
        assert row["inv"] == {w: [i for i, x in enumerate(words) if x == w] for w in words}


def test_unified_key(one):
    cols = [F.col("arxiv_id"), F.col("id"), F.col("doi")]
    assert one(P.unified_key(*cols), PAPER, "", "", "doi:10.1/AB", "x", "", "", "") == "doi:10.1/ab"
    assert one(P.unified_key(*cols, normalise_doi=False), PAPER, "", "", "doi:10.1/AB", "x", "", "", "") == "doi:10.1/AB"
    assert one(P.unified_key(*cols), PAPER, "", "2401.A", "doi:1", "", "", "", "") == "2401.A"
    assert one(P.unified_key(*cols), PAPER, "", None, None, None, "", "", "") == ""


def test_lookup_doi(one):
    col = P.lookup_doi(F.col("doi"), F.col("id"))
    assert one(col, PAPER, "", "", "doi:10.1/AB", "", "", "", "") == "10.1/ab"
    assert one(col, PAPER, "", "", "W1", None, "", "", "") == ""
    assert one(col, PAPER, "", "", "doi:10.1/AB", "https://doi.org/10.2/C", "", "", "") == "10.2/c"


def test_fixed_values_are_whole():
    assert len(V.BUCKETS) == 9 and sum(len(k) for _, k in V.BUCKETS) == len({k for _, ks in V.BUCKETS for k in ks})


def test_nul_in_a_page_changes_nothing_else(spark):
    from paperflow.operators.listing import author_list, cut_before

    df = spark.createDataFrame([("a\x00b<h3>x\x00</h3>c<h3>y</h3>d",)], "t STRING")
    assert df.select(cut_before(F.col("t"), "<h3>").alias("p")).head()["p"] == ["ab", "<h3>x</h3>c", "<h3>y</h3>d"]
    names = df.select(author_list(F.lit("<a>A\x00da</a>, <a>Bob</a>"), "x:", "<a>(.*?)</a>", "common").alias("n")).head()["n"]
    assert names == ["Ada", "Bob"]
