"""Listing pages, registry responses, dedup, classification, enrichment."""

import random

import pytest
from pyspark.sql import functions as F

from paperflow.functions import fixed_values as V
from paperflow.operators import classify, dedup, enrich, listing, rank, registry

ENTRY = """<dt>
<a name="item{n}">[{n}]</a> <a href ="/abs/{id}" title="Abstract">arXiv</a></dt>
<dd><div class='list-title mathjax'><span class='descriptor'>Title:</span>
  {title}
</div><div class='list-authors'><span class="d">Authors:</span> <a href="/a">Ann <b>A</b></a>, <a href="/b">B&eacute;la  B</a>, <a href="/c">Cut
Over</a></div>
<div class='list-subjects'><span class='descriptor'>Subjects:</span> <span>{subjects}</span></div>
<p class='mathjax'>
Text &amp; more
</p></dd>"""


def entry(n, id_, title="T", subjects="Vision (cs.CV)"):
    return ENTRY.format(n=n, id=id_, title=title, subjects=subjects)


def parse(spark, html, **options):
    df = spark.createDataFrame([("u", html)], "url STRING, html STRING")
    return listing.parse_listing(df, **options).orderBy("section_pos", "chunk_pos").collect()


def test_listing_sections(spark):
    page = ("ignored " + entry(9, "before") + "<h3>Showing new listings for Monday</h3>" + entry(8, "banner")
            + "<H3>New submissions (1 of 1)</H3>" + entry(1, "2401.1", "A &lt; <i>b</i>\n c", "Optics (physics.optics); IV (eess.IV)")
            + "<h3>Cross-lists</h3>" + entry(2, "2401.2") + "<h3>Replacements</h3>" + entry(3, "2401.3")
            + "<h3>Fri, 24 Apr 2026 (showing 1)</h3>" + entry(4, "2401.4") + '<dt><a name="item5">no id</a></dt>')
    rows = parse(spark, page)
    assert [(r["arxiv_id"], r["section"]) for r in rows] == [
        ("2401.1", "new"), ("2401.2", "cross"), ("2401.3", "replace"), ("2401.4", "new")]
    first = rows[0]  # a name broken over two lines is not a name to the pattern
    assert first["title"] == "A < b c" and first["authors"] == ["Ann A", "Béla B"] and first["first_author"] == "Ann A"
    assert first["primary_cat"] == "eess.IV" and first["abstract"] == "Text & more"


def test_listing_without_header_is_new(spark):
    rows = parse(spark, "<h3><b>nested</b></h3>" + entry(1, "2401.1"), include_abstract=False)
    assert [(r["arxiv_id"], r["section"]) for r in rows] == [("2401.1", "new")] and "abstract" not in rows[0]


def test_missing_fields_are_empty(spark):
    (row,) = parse(spark, '<dt><a name="item1"></a><a href="/abs/x1"></a></dt>')
    assert (row["title"], row["authors"], row["first_author"], row["subjects"], row["abstract"]) == ("", [], "", "", "")


@pytest.mark.parametrize("header, label", [
    ("Cross submissions", "cross"), ("Replacement submissions", "replace"), ("New submissions", "new"),
    ("Fri, 24 Apr 2026", "new"), ("Friday, 24 Apr", "other"), ("Showing new listings", "other"), ("New cross-lists", "cross"), (None, "other")])
def test_section_label(one, header, label):
    assert one(listing.section_label(F.col("x")), "x STRING", header) == label


def test_date_section(spark):
    page = "x<h3>Mon, 11 May 2026 (a)</h3>one<h3>Fri, <b>1 May 2026</b></h3>two<h3>Thu, 30 Apr 2026</h3>three"
    df = spark.createDataFrame([(page, "2026-05-01"), (page, "2026-05-02")], "html STRING, d STRING")
    rows = listing.date_section(df, F.to_date("d")).orderBy("d").collect()
    assert rows[0]["found"] and rows[0]["block"] == "<h3>Fri, <b>1 May 2026</b></h3>two"
    assert not rows[1]["found"] and rows[1]["block"] == ""


def test_drop_replaced_keeps_missing_sections(spark):
    df = spark.createDataFrame([("replace",), (None,), ("new",)], "section STRING")
    assert {r[0] for r in listing.drop_replaced(df).collect()} == {None, "new"}


def test_harvest_ids(one):
    doc = ('{"a": ["see https://arxiv.org/abs/2401.1 and https://arxiv.org/abs/9", {"https://arxiv.org/abs/5": "x"}],'
           ' "b": {"c": "q\\"https:\\/\\/arxiv.org/abs/2402.2."}, "arxiv_id": "7", "d": "arxiv.org/abs/2401.1"}')
    assert sorted(one(listing.harvest_ids(F.col("x")), "x STRING", doc)) == ["2401.1", "2402.2."]


def test_registry_response(spark):
    body = """{"message": {"items": [
      {"DOI": "10.1/AB", "title": ["<b>T</b> &amp; x"], "author": [{"given": "A", "family": "B"}, {"name": "G"}, {}],
       "container-title": ["J"], "subject": ["s1", "s2"], "abstract": "<jats:p>x</jats:p>y",
       "issued": {"date-parts": [[2026, 5]]}, "published": {"date-parts": [[]]}, "created": {"date-parts": [[2026, 5, 9]]}},
      {"title": [], "URL": ""}]}}"""
    df = spark.createDataFrame([(body,), ("{}",), ('{"message": {}}',)], "body STRING")
    rows = registry.registry_items(df).select("pos", *registry.registry_paper(F.col("item"))).orderBy("pos").collect()
    assert len(rows) == 2
    a, b = rows
    assert (a["id"], a["doi"], a["url"], a["title"]) == ("doi:10.1/AB", "10.1/AB", "https://doi.org/10.1/AB", "T & x")
    assert (a["authors"], a["journal"], a["subjects"], a["abstract"]) == (["A B", "G"], "J", "s1; s2", "x y")
    assert (a["published"], a["created"], a["section"]) == ("2026-05-01", "2026-05-09", "new")
    assert (b["id"], b["url"], b["title"], b["authors"], b["journal"], b["subjects"], b["published"]) == ("", "", "", [], "", "", "")


def test_index_response(spark):
    body = """{"results": [{"id": "W1", "doi": "https://doi.org/10.1/AB", "title": null, "display_name": "N",
      "authorships": [{"author": {"display_name": "A"}}, {"author": null}, {"author": {"display_name": ""}}],
      "primary_location": {"source": {"display_name": "J"}}, "concepts": [{"display_name": "c", "score": 0.5}],
      "abstract_inverted_index": {"b": [1], "a": [0]}, "created_date": "2026-01-02T03:04"}, {"id": "W2"}]}"""
    works = registry.index_works(spark.createDataFrame([(body,), ("{}",)], "body STRING"))
    a, b = works.select("pos", *registry.index_paper(F.col("item"))).orderBy("pos").collect()
    assert (a["doi"], a["id"], a["url"], a["title"], a["authors"]) == ("10.1/ab", "doi:10.1/ab", "https://doi.org/10.1/AB", "N", ["A"])
    assert (a["journal"], a["subjects"], a["abstract"], a["created"], a["cited_by_count"]) == ("J", "c", "a b", "2026-01-02", 0)
    assert (b["id"], b["url"], b["title"], b["subjects"], b["abstract"], b["concepts"]) == ("W2", "W2", "", "", "", [])


def test_first_wins_keeps_the_whole_row_under_a_hot_key(spark):
    rows = [("hot", 1 + i % 3, i, f"v{i}") for i in range(300)] + [("hot", 0, 999, "winner"), ("", 0, 0, "x"), (None, 0, 1, "y"), ("b", 2, 5, "only")]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "k STRING, source_rank INT, pos INT, v STRING").repartition(7)
    kept = dedup.first_wins(df, F.col("k"), ["source_rank", "pos"])
    assert {tuple(r) for r in kept.collect()} == {("hot", 0, 999, "winner"), ("b", 2, 5, "only")}
    again = dedup.first_wins(kept, F.col("k"), ["source_rank", "pos"])
    assert {tuple(r) for r in again.collect()} == {tuple(r) for r in kept.collect()}


def test_merge_queries_share_one_empty_key(spark):
    schema = "id STRING, url STRING, title STRING, pos INT"
    a = spark.createDataFrame([("i1", "", "", 0), ("", "", "", 1)], schema)
    b = spark.createDataFrame([("i1", "u", "late", 0), ("", "", "", 1), ("", "u2", "t", 2)], schema)
    kept = dedup.merge_queries([a, b], ["pos"]).select("query_rank", "pos").collect()
    assert sorted(map(tuple, kept)) == [(0, 0), (0, 1), (1, 2)]


CASES = [
    ("a sustained effort", "Virtual Staining/Pathology"), ("Fourier ptychography", "Fourier Ptychography/Microscopy"),
    ("lensless lensless", "Lensless/Coded Imaging"), ("graph colouring", ""), ("diffuser and denoising", "Lensless/Coded Imaging"),
    ("H&E whole slide transformer", "Virtual Staining/Pathology"), ("", ""), (None, ""),
]


@pytest.mark.parametrize("batches", [True, False])
def test_buckets(spark, batches):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(CASES)], "i INT, t STRING")
    text = classify.paper_text(F.col("t"), F.lit(None).cast("string"), F.lit(""))
    out = classify.with_hits(df, text, batches=batches).withColumn("bucket", classify.best_bucket(F.col("hits")))
    rows = {r["i"]: r for r in out.collect()}
    assert [rows[i]["bucket"] for i in range(len(CASES))] == [b for _, b in CASES]
    assert rows[1]["hits"][0] == 2 and rows[2]["hits"][1] == 1


@pytest.mark.parametrize("batches", [True, False])
def test_hits_of_a_null_text(spark, batches):
    df = spark.createDataFrame([(None,), ("ones",)], "t STRING")
    out = [r["hits"] for r in classify.with_hits(df, F.col("t"), (("a", ("ones", "ne")), ("b", ("x",))), batches=batches).collect()]
    assert out == [None, [2, 0]]


def test_no_abstract_is_shuffled(spark):
    from paperflow.plans import jobs

    for name in ("bucket_badge_counts", "bucket_leaders", "dedup_first"):
        plan = jobs()[name](spark, "/root/testdata/sf0.001")
        text = plan._jdf.queryExecution().optimizedPlan().toString()
        window = text[text.index("Window"):text.index("\n", text.index("Window"))]
        assert "abstract" not in window and "text" not in window
    for name in ("primary_cat", "source_badge", "newest_topk"):
        plan = jobs()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        assert "text:string" not in plan


def test_large_dictionary_equals_brute_force(spark):
    rng = random.Random(7)
    alphabet = "abcdeé "
    words = sorted({"".join(rng.choice(alphabet) for _ in range(rng.randint(1, 7))).strip() or "a" for _ in range(60)})
    buckets = tuple((f"b{i}", tuple(words[i::5])) for i in range(5))
    texts = [(i, "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60)))) for i in range(80)]
    df = spark.createDataFrame(texts, "id INT, t STRING")
    words = classify.keyword_table(spark, buckets)
    expected = {}
    for i, t in texts:
        hits = [sum(k in t for k in ks) for _, ks in buckets]
        expected[i] = buckets[hits.index(max(hits))][0] if max(hits) else ""
    for size in (1 << 20, 200):
        got = classify.assign_bucket_large(df, F.col("t"), words, dictionary_bytes=size)
        assert {r["id"]: r["bucket"] for r in got.collect()} == expected


def test_summary_lists_every_bucket(spark):
    rows = [("Lensless/Coded Imaging", "CV")] * 3 + [("Lensless/Coded Imaging", "AI"), ("", "LG")]
    papers = spark.createDataFrame(rows, "bucket STRING, badge STRING")
    out = {r["bucket"]: r for r in classify.document_summary(papers).collect()}
    assert len(out) == 9 and out["Lensless/Coded Imaging"]["by_badge"] == "AI:1 CV:3"
    assert out["Deep Learning Methods"]["total"] == 0 and out["Deep Learning Methods"]["by_badge"] == ""
    assert {(r["doc_total"], r["doc_selected"]) for r in out.values()} == {(5, 4)}


def test_enrichment(spark):
    papers = spark.createDataFrame(
        [(1, "10.1/a", "s", " "), (2, "10.1/a", "", "kept"), (3, "", "s", ""), (4, "10.1/z", "s", ""), (5, None, "s", "")],
        "i INT, doi STRING, subjects STRING, abstract STRING")
    works = spark.createDataFrame([("10.1/a", 1, 7, ["c1", "c2"], "rebuilt"), ("10.1/a", 2, 9, ["late"], "late")],
                                  "work_doi STRING, work_pos INT, cited_by_count INT, concepts ARRAY<STRING>, rebuilt STRING")
    joined = enrich.lookup(papers, works, F.col("doi"), "work_doi", ["work_pos"], "i")
    out = joined.select("i", "matched", "cited_by_count", enrich.append_concepts(F.col("subjects"), F.col("concepts")).alias("s"),
                        enrich.backfill(F.col("abstract"), F.col("rebuilt")).alias("a")).orderBy("i").collect()
    assert [tuple(r) for r in out] == [
        (1, True, 7, "s; c1; c2", "rebuilt"), (2, True, 7, "c1; c2", "kept"),
        (3, False, None, "s", ""), (4, False, None, "s", ""), (5, False, None, "s", "")]
    assert tuple(enrich.coverage(joined, "doi").first()) == (2, 5, 2)


def test_leaders_and_bars(spark):
    papers = spark.createDataFrame([("a", i) for i in range(5)] + [(V.CATCH_ALL_BUCKET, i) for i in range(5)], "bucket STRING, score INT")
    best = rank.leaders(papers, "bucket", [F.desc("score")], 3, {V.CATCH_ALL_BUCKET: 2}).collect()
    assert sorted((r["bucket"], r["score"]) for r in best) == [(V.CATCH_ALL_BUCKET, 3), (V.CATCH_ALL_BUCKET, 4), ("a", 2), ("a", 3), ("a", 4)]
    counts = spark.createDataFrame([("a", 11), ("b", 10), ("c", 8), ("d", 3), ("e", 2), ("z", 0), (V.CATCH_ALL_BUCKET, 90)], "bucket STRING, n INT")
    widths = {r["bucket"]: r["width"] for r in rank.bar_widths(counts, "bucket", "n").collect()}
    assert widths == {"a": 100, "b": 91, "c": 73, "d": 27, "e": 18, "z": 0, V.CATCH_ALL_BUCKET: 100}


def test_newest_items_put_weekly_first(spark):
    posts = spark.createDataFrame([("2026-06-15", False, "a"), ("2026-06-15", True, "b"), ("2026-06-16", False, "c")], "day STRING, weekly BOOLEAN, name STRING")
    assert [r["name"] for r in rank.newest_items(posts, "day", "weekly", "name", 2).collect()] == ["c", "b"]
