"""Days, roll-ups, comparisons, gates, sources, sinks and streams."""

import datetime as dt
import json
from xml.etree import ElementTree

import pytest
from pyspark.sql import functions as F

from paperflow.functions import fixed_values as V
from paperflow.operators import calendar, gates, rollup, sets
from paperflow.plans import jobs
from paperflow.session import scratch_path
from paperflow.sources import landed, sinks
from paperflow.streaming import arrivals as A

D = dt.date


def days(spark, values, extra="", schema=""):
    return spark.createDataFrame(values, "day DATE" + schema)


def test_previous_existing_day(spark):
    df = days(spark, [(D(2026, 6, 12),), (D(2026, 6, 15),), (D(2026, 6, 12),)])
    got = {(r["day"], r["prev_day"]) for r in calendar.previous_day(df, []).collect()}
    assert got == {(D(2026, 6, 12), None), (D(2026, 6, 15), D(2026, 6, 12))}


def test_weekday_gaps(spark):
    df = spark.createDataFrame([("u", D(2026, 6, 11)), ("u", D(2026, 6, 16)), ("v", D(2026, 6, 17))], "k STRING, day DATE")
    gaps = calendar.weekday_gaps(df, ["k"], F.lit("2026-06-18").cast("date")).collect()
    assert sorted((r["k"], r["missing_day"].day) for r in gaps) == [("u", 12), ("u", 15), ("u", 17), ("u", 18), ("v", 18)]


def test_missing_kinds(spark):
    df = spark.createDataFrame([("d1", "a"), ("d1", "b"), ("d1", "c"), ("d2", "b"), ("d2", "other")], "d STRING, kind STRING")
    got = calendar.missing_kinds(df, ["d"], "kind", ("a", "b", "c")).collect()
    assert sorted(map(tuple, got)) == [("d2", "a"), ("d2", "c")]


def test_trailing_windows_bounds(spark):
    latest = D(2026, 8, 21)
    daily = spark.createDataFrame([(latest, 1), (latest - dt.timedelta(30), 10), (latest - dt.timedelta(31), 100)], "day DATE, n BIGINT")
    got = {r["window_days"]: r["n"] for r in calendar.trailing_windows(daily, [], "n").collect()}
    assert got == {31: 11, 92: 111, 183: 111, 366: 111, 731: 111, 1096: 111}


@pytest.mark.parametrize("post, listing, clusters, gaps, mode", [
    ("2026-06-15", "2026-06-15", 0, False, "new"), ("2026-06-12", "2026-06-15", 0, False, "pastweek-date-section"),
    ("2026-06-16", "2026-06-15", 3, False, "journal-only"), ("2026-06-16", "2026-06-15", 2, False, "none"),
    ("2026-06-13", "2026-06-13", 5, False, "none"), ("2026-06-13", "2026-06-15", 5, True, "pastweek-date-section")])
def test_run_mode(one, post, listing, clusters, gaps, mode):
    col = calendar.run_mode(F.to_date("p"), F.to_date("l"), F.col("c"), F.col("g"))
    assert one(col, "p STRING, l STRING, c INT, g BOOLEAN", post, listing, clusters, gaps) == mode


def test_listing_vote_needs_a_majority(spark):
    rows = [("r1", c, D(2026, 6, 15)) for c in "abc"] + [("r1", "d", D(2026, 6, 12)), ("r2", "a", D(2026, 6, 15)), ("r2", "b", D(2026, 6, 12))]
    got = {r["run"]: r for r in rollup.listing_vote(spark.createDataFrame(rows, "run STRING, cat STRING, day DATE"), ["run"], "cat", "day").collect()}
    assert got["r1"]["listing_date"] == D(2026, 6, 15) and got["r1"]["publish"]
    assert got["r2"]["listing_date"] == D(2026, 6, 12) and not got["r2"]["publish"]


def test_evidence_grade(spark):
    rows = [("h", "p1", "a"), ("h", "p2", "b"), ("h", "p3", "a"), ("m", "p1", "a"), ("m", "p2", "a"), ("m", "p3", "a"), ("l", "p1", "a"), ("l", "p1", "b")]
    got = rollup.evidence_grade(spark.createDataFrame(rows, "g STRING, p STRING, a STRING"), ["g"], "p", "a").collect()
    assert {r["g"]: r["grade"] for r in got} == {"h": "High", "m": "Medium", "l": "Low"}


def test_running_best_direction_and_nulls(spark):
    df = spark.createDataFrame([("b", 1, 5.0), ("b", 2, None), ("b", 3, 4.0), ("b", 4, 6.0)], "k STRING, day INT, v DOUBLE")
    up = [r["best"] for r in rollup.running_best(df, ["k"], "day", "v").orderBy("day").collect()]
    down = [r["best"] for r in rollup.running_best(df, ["k"], "day", "v", False).orderBy("day").collect()]
    assert up == [5.0, 5.0, 6.0] and down == [5.0, 4.0, 4.0]


def test_hot_cold_counts_absent_weeks_as_zero(spark):
    w1, w2 = D(2026, 6, 8), D(2026, 6, 15)
    df = spark.createDataFrame([("a", w1, 5), ("b", w2, 2)], "g STRING, week_start DATE, n BIGINT")
    got = {(r["g"], r["week_start"]): (r["delta"], r["heat_rank"]) for r in rollup.hot_cold(df, "g").collect()}
    assert got == {("a", w1): (5, 1), ("a", w2): (-5, 2), ("b", w2): (2, 1)}


def test_contrast(spark):
    df = spark.createDataFrame([("x", "a"), ("x", "b"), ("y", "a"), ("z", "b"), ("q", "c")], "w STRING, s STRING")
    got = {r["w"]: r["kind"] for r in sets.contrast(df, "w", F.col("s"), "a", "b").collect()}
    assert got == {"x": "shared", "y": "a", "z": "b"}


def test_id_turnover(spark):
    a, b = D(2026, 6, 15), D(2026, 6, 16)
    rows = [(a, "t", i) for i in "123"] + [(b, "t", i) for i in "145"] + [(a, "u", "1"), (b, "u", "1"), (b, "new", "1")]
    got = {r["title"]: (r["ids"], r["changed"], r["shared_titles"], r["rename"]) for r in sets.turnover_under_title(
        spark.createDataFrame(rows, "day DATE, title STRING, id STRING"), "day", "title", "id").collect()}
    assert got == {"t": (3, 2, 2, True), "u": (1, 0, 2, False)}


SCHEMAS = {
    "posts": "day DATE, html STRING",
    "trends": "day DATE, readable BOOLEAN, doc_date STRING, listing_date STRING, source_mode STRING, scope STRING, by_cat MAP<STRING,STRING>, "
              "total_scanned STRING, selected STRING, shown BIGINT, parsed BIGINT, geometry_papers INT, geometry_named INT",
    "insights": "day DATE, readable BOOLEAN",
    "clusters": "day DATE, pos INT, title STRING, papers INT, why STRING",
    "ids": "day DATE, id STRING",
    "benchmarks": "day DATE, readable BOOLEAN",
    "feed": "day DATE",
    "series": "day DATE, by_cat MAP<STRING,BIGINT>",
}


def good_days(prev, day):
    """Two days that pass every rule; the second one is what a case changes."""
    both = (prev, day)
    return {
        "posts": [(d, f"<h1>{d}</h1><th>Cluster</th>대표 논문 왜 중요?") for d in both],
        "trends": [(d, True, str(d), str(d), "new", V.RELEASE_SCOPE, {"cs.LG": n}, "100", "50", 3, 3, 0, 0) for d, n in ((prev, "60"), (day, "61"))],
        "insights": [(d, True) for d in both],
        "clusters": [(d, i, f"{d} {i}", 2, "w" * 80) for d in both for i in range(3)],
        "ids": [(prev, f"{prev:%y%m}.1"), (day, f"{day:%y%m}.2")],
        "benchmarks": [(d, True) for d in both],
        "feed": [(d,) for d in both],
        "series": [(prev, {"cs.LG": 60}), (day, {"cs.LG": 61})],
    }


def put(index, value, rows_from=1):
    return lambda rows: rows[:rows_from] + [r[:index] + (value,) + r[index + 1:] for r in rows[rows_from:]]


def like_before(rows):
    return [rows[0], (rows[1][0], *rows[0][1:])]


def titles(n):
    return lambda rows: [(d, i, f"t{i}", 2, "w" * 80) for d in (rows[0][0], rows[-1][0]) for i in range(n)]


GATE_CASES = [
    ({}, []),
    ({"benchmarks": lambda r: r[:1]}, ["G01", "G02"]),
    ({"insights": put(1, False)}, ["G02"]),
    ({"trends": put(2, "1999-01-01")}, ["G03"]),
    ({"trends": put(3, "1999-01-01")}, ["G04"]),
    ({"trends": put(4, "weekly")}, ["G05"]),
    ({"trends": put(5, "new+cross")}, ["G06"]),
    ({"trends": put(6, {}), "series": put(1, {})}, ["G07", "G18"]),
    ({"trends": put(6, {"cs.LG": "61.5"}), "series": lambda r: r[:1]}, ["G08", "G18", "G22"]),
    ({"trends": put(8, "101")}, ["G09"]),
    ({"trends": put(8, "39")}, ["G19"]),
    ({"posts": put(1, "<h1>undated</h1><th>Cluster</th>대표 논문 왜 중요?")}, ["G10"]),
    ({"feed": lambda r: r[:1]}, ["G01", "G11"]),
    ({"clusters": lambda r: r[:5]}, ["G12"]),
    ({"clusters": put(2, "same", 4)}, ["G13"]),
    ({"clusters": titles(4)}, ["G14"]),
    ({"clusters": titles(3)}, []),
    ({"clusters": put(3, 1, 5)}, ["G16"]),
    ({"clusters": put(4, "short", 5)}, ["G17"]),
    ({"ids": put(1, "0001.9")}, ["G20"]),
    ({"trends": put(9, 4)}, ["G21"]),
    ({"trends": put(11, 10)}, ["G23"]),
    ({"posts": lambda r: [r[0], (r[1][0], r[1][1] + " a batch")]}, ["G24"]),
    ({"trends": put(6, {"cs.LG": "60"}), "series": put(1, {"cs.LG": 60}), "ids": like_before}, ["G15"]),
    ({"trends": put(6, {"cs.LG": "60"}), "series": put(1, {"cs.LG": 60})}, []),
]


def test_each_gate(spark):
    stacked = {name: [] for name in SCHEMAS}
    expected = {}
    for i, (changes, rules) in enumerate(GATE_CASES):
        prev, day = (D(2020 + i // 12, i % 12 + 1, n) for n in (14, 15))
        expected[day] = rules
        for name, rows in good_days(prev, day).items():
            stacked[name] += changes.get(name, lambda r: r)(rows)
    frames = {n: spark.createDataFrame(r, SCHEMAS[n]) for n, r in stacked.items()}
    frames["trends"] = frames["trends"].withColumn("counts_object", F.to_json(F.struct("by_cat", "scope")))
    out = gates.release_gates(gates.Artefacts(**frames)).collect()
    assert len(out) == 24 * 2 * len(GATE_CASES)
    failed = {d: sorted(r["rule"][:3] for r in out if r["day"] == d and not r["ok"]) for d in expected}
    assert failed == expected


def test_tolerant_day_documents(spark, tmp_path):
    files = {
        "2026-06-15.json": {"daily_new_counts": {"by_cat": {"a": 7, "b": None, "c": "3", "d": 2.9}, "scope": "s"}},
        "2026-06-16.json": {"daily_new_counts": {"by_cat": [1]}},
        "2026-06-17.json": {"note": "none"},
        "2026-06-13.json": {"daily_new_counts": {"by_cat": {"a": 1}}},
        "2026-06-19.json": {"daily_new_counts": {"by_cat": {}}},
        "other.json": {"daily_new_counts": {"by_cat": {"a": 1}}},
    }
    for name, doc in files.items():
        (tmp_path / name).write_text(json.dumps(doc))
    (tmp_path / "2026-06-18.json").write_text("{broken")
    series = rollup.daily_series(landed.read_trends(spark, str(tmp_path))).orderBy("day").collect()
    assert [(r["day"].day, r["total"], r["scope"], r["weekday"]) for r in series] == [(15, 12, "s", "Mon"), (19, 0, "new+cross", "Fri")]
    assert series[0]["by_cat"] == {"a": 7, "b": 0, "c": 3, "d": 2}
    with pytest.raises(Exception):
        landed.read_insights(spark, str(tmp_path)).collect()


def test_posts_and_missing_folder(spark, tmp_path):
    (tmp_path / "2026-06-13-weekly.html").write_bytes(b"<h1>W\xff</h1>")
    (tmp_path / "2026-06-13.html").write_text("<h1>D</h1>")
    (tmp_path / "2026-06-13-extra.html").write_text("x")
    (tmp_path / "note.txt").write_text("x")
    got = sorted((r["day"], r["weekly"], r["html"]) for r in landed.read_posts(spark, str(tmp_path)).collect())
    assert got == [("2026-06-13", False, "<h1>D</h1>"), ("2026-06-13", True, "<h1>W\ufffd</h1>")]
    assert landed.read_posts(spark, str(tmp_path / "absent")).count() == 0


def test_ranked_sources_skip_missing_files(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([{"arxiv_id": "1", "authors": ["A"]}, "junk", {"arxiv_id": "2"}]))
    (tmp_path / "c.json").write_text(json.dumps({"buckets": {"x": None, "y": {"papers": [{"arxiv_id": "3", "title": "é"}]}}}))
    rows = landed.read_ranked_papers(spark, [str(tmp_path / f) for f in ("a.json", "b.json", "c.json")])
    got = [(r["source_rank"], r["pos"], r["arxiv_id"]) for r in rows.orderBy("source_rank", "pos").collect()]
    assert got == [(0, 0, "1"), (0, 1, "2"), (2, 0, "3")]


def test_malformed_source_fails(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"arxiv_id": "1"}, ')
    with pytest.raises(Exception, match="MALFORMED|parse"):
        landed.read_ranked_papers(spark, [str(tmp_path / "a.json")]).collect()


def test_both_benchmark_shapes(spark, tmp_path):
    (tmp_path / "2026-06-15.json").write_text(json.dumps({"results": [{"benchmark": "A", "value": 1.5}]}))
    (tmp_path / "2026-06-16.json").write_text(json.dumps({"benchmarks": [{"benchmark": "B", "value": 2.5}, {"benchmark": "C"}]}))
    (tmp_path / "2026-06-17.json").write_text(json.dumps({"date": "2026-06-17"}))
    got = landed.read_benchmarks(spark, str(tmp_path)).orderBy("benchmark").collect()
    assert [(str(r["day"]), r["benchmark"], r["value"]) for r in got] == [("2026-06-15", "A", 1.5), ("2026-06-16", "B", 2.5), ("2026-06-16", "C", None)]


def test_all_rows_land(spark, tmp_path):
    from paperflow.plans.streams import land

    df = spark.createDataFrame([(k, p) for k, p in enumerate((None, -3, 0, 1, 2, 3, 4, 99))], "k INT, poll INT")
    land(df, str(tmp_path / "x"), "poll")
    assert sorted(r["k"] for r in spark.read.parquet(str(tmp_path / "x")).collect()) == list(range(8))


def test_backfill_is_idempotent(spark, tmp_path):
    path = str(tmp_path / "counts")
    early = spark.createDataFrame([("2026-01-02", "a", 1)], "day STRING, kind STRING, n BIGINT").withColumn("day", F.to_date("day"))
    A.write_counts(path)(early, 0)
    landed_rows = spark.createDataFrame([("2026-01-02 01:00:00", "a")] * 3 + [("2026-01-01 01:00:00", "b")], "ts STRING, kind STRING").withColumn("ts", F.to_timestamp("ts"))
    for _ in range(2):
        A.backfill_counts(landed_rows, "ts", "kind", path)
        assert sorted((str(r["day"]), r["kind"], r["n"]) for r in A.read_counts(spark, path, "kind").collect()) == [("2026-01-01", "b", 1), ("2026-01-02", "a", 3)]


def test_cluster_rows(spark, tmp_path):
    (tmp_path / "2026-06-15.json").write_text(json.dumps({"clusters": [{"cluster": "A", "why": "w"}, {"title": "B"}, {"why": "untitled"}], "insights": [{"title": "no"}]}))
    (tmp_path / "2026-06-16.json").write_text(json.dumps({"insights": [{"title": "C"}]}))
    rows = landed.cluster_rows(landed.read_insights(spark, str(tmp_path))).orderBy("day", "pos").collect()
    assert [r["title"] for r in rows] == ["A", "B", "C"]


def test_feed_sink_escapes(spark):
    path = scratch_path(spark, "feed")
    sinks.write_feed(spark.createDataFrame([("a <b> & c", "l")], "title STRING, link STRING"), path)
    text = "".join(r[0] for r in spark.read.text(path, wholetext=True).collect())
    channel = ElementTree.fromstring(text)
    assert channel.tag == "channel" and [i.findtext("title") for i in channel.findall("item")] == ["a <b> & c"]


def test_series_sink_replaces_only_its_days(spark):
    path = scratch_path(spark, "series")
    both = spark.createDataFrame([(D(2026, 6, 15), 1), (D(2026, 6, 16), 2)], "day DATE, n INT")
    sinks.write_series(both, path)
    sinks.write_series(both.where("n = 2").withColumn("n", F.lit(5)), path)
    assert sorted((r["day"].day, r["n"]) for r in spark.read.parquet(path).collect()) == [(15, 1), (16, 5)]


def test_resolve_days_prefers_final(spark):
    rows = [("d", 0, 9, "journal-only", 0), ("d", 40, 0, "pastweek-date-section", 1), ("d", 0, 9, "journal-only", 2), ("e", 0, 3, "journal-only", 0)]
    df = spark.createDataFrame(rows, "day STRING, listing_count INT, journal_count INT, source_mode STRING, batch_id INT")
    got = {r["day"]: (r["listing_count"], r["journal_count"], r["source_mode"]) for r in A.resolve_days(df, ["day"]).collect()}
    assert got == {"d": (40, 9, "pastweek-date-section"), "e": (0, 3, "journal-only")}


def test_results_do_not_depend_on_partitions(spark):
    def rows(name):
        return sorted(map(str, jobs()[name](spark, "/root/testdata/sf0.001").collect()))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    for name in ("dedup_papers", "bucket_leaders", "query_topk"):
        spark.conf.set("spark.sql.shuffle.partitions", "1")
        single = rows(name)
        spark.conf.set("spark.sql.shuffle.partitions", before)
        assert rows(name) == single


def test_group_limit_reaches_below_the_shuffle(spark):
    for name in ("dedup_first", "bucket_leaders", "query_topk"):
        plan = jobs()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        assert plan.count("WindowGroupLimit") >= 2 and "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


@pytest.mark.parametrize("zone", ["America/New_York", "Asia/Seoul"])
def test_days_do_not_depend_on_the_session_zone(spark, zone):
    def rows(name):
        return sorted(map(str, jobs()[name](spark, "/root/testdata/sf0.001").collect()))
    names = ("stream_counts", "daily_counts")
    expected = [rows(n) for n in names]
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        assert [rows(n) for n in names] == expected
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_expensive_steps_run_once(spark):
    def plan(name):
        return jobs()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan("bucket_badge_counts").count("ArrowEvalPython") == 1
    assert plan("bucket_leaders").count("ArrowEvalPython") == 1
    assert "TakeOrderedAndProject" in plan("feed_items")
