import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from paperflow.llm import decontamination, jaccard
from tests.sql_twin import compare, sql_session

from .helpers import docs, sf_docs
from .test_jaccard import brute, near_copies

SF = "/root/testdata/sf0.001"


def test_registered():
    names = queries()
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)) and "pipeline" in names


@pytest.mark.parametrize("name", ["op1_sharding", "op3_jaccard", "op7_line_dedup", "op11_minhash", "op13_divergence"])
def test_sql_twins(spark, name):
    folder = "/root/testdata/sf0.01"
    assert compare(queries()[name](spark, folder), sql_session(folder), oracle_sql()[name]) is None


def test_stages_take_effect(spark):
    frames = {"documents": sf_docs(spark)}
    now = frames["documents"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = corpus_pipeline.staged(stage(spark, now, SF), name)
        assert now.columns == list(corpus_pipeline.COLUMNS) and now.schema == frames["documents"].schema
        frames[name] = now
    ids = {k: {r["doc_id"] for r in v.select("doc_id").collect()} for k, v in frames.items()}
    order = list(ids)
    assert all(ids[b] <= ids[a] for a, b in zip(order, order[1:]))
    labels = {r["doc_id"]: r for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    good = {d for d in ids["documents"] if d in labels and labels[d]["quality"] == 1 and labels[d]["toxic"] == 0}
    assert len(good & ids["quality_classifier"]) > 0.97 * len(good)
    groups = jaccard.similar_components(frames["line_dedup"], 5, 80).collect()
    assert ids["ngram_jaccard_join"] == {r["component_id"] for r in groups}
    leaked = {r["doc_id"] for r in decontamination.find_leaks(frames["ngram_jaccard_join"], spark.read.parquet(f"{SF}/benchmark.parquet")).collect()}
    assert ids["benchmark_decontamination"] == ids["ngram_jaccard_join"] - leaked
    packed = corpus_pipeline.run(spark, SF)
    assert {r["doc_id"] for r in packed.select("doc_id").distinct().collect()} == ids["benchmark_decontamination"]


def test_line_stage_drops_what_it_emptied(spark):
    rows = [(k, "same line" if k % 2 else f"same line\nown {k}", f"s{k}") for k in range(1, 31)] + [(90, None, "s1"), (91, "", "s2"), (92, " \n", "s3")]
    got = {r["doc_id"]: r for r in corpus_pipeline.dedup_lines(spark, docs(spark, rows), SF).collect()}
    assert set(got) == {1, 90, 91, 92} | set(range(2, 31, 2))
    assert got[1]["text"] == "same line" and got[2]["text"] == "own 2" and got[2]["n_chars"] == 5 and got[90]["text"] is None


def test_line_stage_takes_long_lines_of_two_sites(spark):
    long = " ".join(f"passage{k}" for k in range(55))
    hot = " ".join(f"notice{k}" for k in range(8))
    rows = [(1, f"{long}\nfirst", "a"), (2, f"second\n{long}", "b"), (3, f"{hot}\nthird", "c"), (4, f"own line of one site only, but a long one {long}\nhome", "d"), (5, "home\nfifth", "e"),
            *[(k, f"{hot}\nown {k}", "d") for k in range(10, 40)], (50, f"{long} without a site\nx", None), (51, f"{long} without a site\ny", "f")]
    got = {r["doc_id"]: r["text"] for r in corpus_pipeline.dedup_lines(spark, docs(spark, rows), SF).collect()}
    assert got == {**{d: t for d, t, _ in rows}, 2: "second", **{k: f"own {k}" for k in range(10, 40)}}


def test_near_copies_go_by_row(spark):
    """Repeated rows, rows without an id and different texts of one id, as they may come."""
    t = "the quick brown fox jumps over the lazy dog and runs away from all the others in the yard again"
    other = "a text of its own that has nothing to do with any of the other ones and has to stay where it is"
    rows = [(1, t), (1, t), (None, t + " x"), (None, t + " x y"), (7, t + " z"), (7, other), (8, None), (8, None), (None, ""), (None, other + " with a long tail of words behind it that sets it apart")]
    got = sorted(((r["doc_id"], r["text"]) for r in corpus_pipeline.drop_near_copies(spark, docs(spark, rows), SF).collect()), key=str)
    assert got == sorted([(1, t), (7, other), (8, None), (8, None), (None, ""), rows[-1]], key=str)
    frame = docs(spark, [(None, t), (None, t), (None, t + " w")]).withColumn("source", F.monotonically_increasing_id().cast("string"))
    kept = corpus_pipeline.drop_near_copies(spark, frame, SF).collect()
    assert len(kept) == 1


def test_near_copies_against_brute_force(spark):
    rows = near_copies(3) + [(900 + k, None) for k in range(3)]
    want = sorted({c for _, _, c in brute(rows, 5, 80)})
    assert sorted(r["doc_id"] for r in corpus_pipeline.drop_near_copies(spark, docs(spark, rows), SF).collect()) == want


def test_empty_documents(spark, tmp_path):
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs(spark, []), SF).count() == 0


def test_near_copies_with_clashing_columns(spark):
    text = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen"
    frame = docs(spark, [(2, text), (1, text), (1, text), (3, "something else altogether that is of no interest")])
    for name in ("id", "hash", "n", "mark", "component", "text_hash", "name", "signature"):
        frame = frame.withColumn(name, F.lit("x"))
    got = jaccard.drop_near_copies(frame)
    assert got.columns == frame.columns and sorted(r["doc_id"] for r in got.collect()) == [1, 3]
