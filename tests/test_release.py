"""A release folder on disk, read and checked as a whole."""

import json

from paperflow.functions import fixed_values as V
from paperflow.operators.gates import release_gates, release_verdict
from paperflow.sources.release import read_release


def write_day(root, day, count, clusters):
    (root / "posts" / f"{day}.html").write_text(f"<h1>{day}</h1><table><th>Cluster</th><th>대표 논문</th><th>왜 중요?</th></table>")
    (root / "trends" / f"{day}.json").write_text(json.dumps({
        "date": day, "source_listing_date": day, "source_mode": "new",
        "daily_new_counts": {"by_cat": {"cs.LG": count}, "scope": V.RELEASE_SCOPE}, "totals": {"total_scanned": count, "selected": count // 2}}))
    (root / "insights" / f"{day}.json").write_text(json.dumps(clusters))
    (root / "benchmarks" / f"{day}.json").write_text(json.dumps({"date": day, "results": []}))


def cluster(day, i, papers=2):
    return {"cluster": f"{day} topic {i}", "why": "w" * 80, "papers": [{"arxiv": f"https://arxiv.org/abs/2606.{i}{n}"} for n in range(papers)]}


def test_release_folder(spark, tmp_path):
    for name in ("posts", "trends", "insights", "benchmarks", "stats"):
        (tmp_path / name).mkdir()
    days = ("2026-06-15", "2026-06-16", "2026-06-17", "2026-06-18")
    write_day(tmp_path, days[0], 60, {"clusters": [cluster(days[0], i) for i in range(3)]})
    write_day(tmp_path, days[1], 61, {"clusters": [cluster(days[1], i) for i in range(2)] + [cluster(days[1], 2, papers=1)]})
    write_day(tmp_path, days[2], 62, {"insights": [{"title": f"i{i}"} for i in range(3)]})
    write_day(tmp_path, days[3], 20, {"clusters": "none"})
    (tmp_path / "benchmarks" / f"{days[3]}.json").write_text("{broken")
    (tmp_path / "posts" / "2026-06-15-weekly.html").write_text("weekly")
    (tmp_path / "feed.xml").write_text("".join(f"<link>https://x/posts/{d}.html</link>" for d in days[:3]))
    (tmp_path / "stats" / "counts.json").write_text(json.dumps(
        {"daily": [{"date": d, "by_cat": {"cs.LG": n}} for d, n in zip(days, (60, 61, 62, 99))]}))
    checks = release_gates(read_release(spark, str(tmp_path))).cache()
    failed = {}
    for row in checks.where("not ok").collect():
        failed.setdefault(str(row["day"]), set()).add(row["rule"][:3])
    assert failed == {
        days[1]: {"G16"},
        days[3]: {"G01", "G02", "G11", "G12", "G18", "G22"},
    }
    verdict = {str(r["day"]): r["publish"] for r in release_verdict(checks).collect()}
    assert verdict == {days[0]: True, days[1]: False, days[2]: True, days[3]: False}


def test_counts_must_be_numbers_and_days_differ(spark, tmp_path):
    for name in ("posts", "trends", "insights", "benchmarks", "stats"):
        (tmp_path / name).mkdir()
    days = ("2026-06-15", "2026-06-16", "2026-06-17", "2026-06-18")
    clusters = {"clusters": [cluster("same", i) for i in range(5)]}
    for d in days:
        write_day(tmp_path, d, 60, clusters)
    trends = json.loads((tmp_path / "trends" / f"{days[0]}.json").read_text())

    def put(day, counts, totals):
        (tmp_path / "trends" / f"{day}.json").write_text(json.dumps(trends | {"date": day, "source_listing_date": day, "daily_new_counts": counts, "totals": totals}))

    whole = {"by_cat": {"cs.LG": 60}, "scope": V.RELEASE_SCOPE, "journal_count": 1}
    put(days[1], whole, {"total_scanned": 60, "selected": 30})
    put(days[2], whole, {"total_scanned": 60, "selected": 30})
    put(days[3], {"by_cat": {"cs.LG": "60", "cs.CV": 1.5}, "scope": V.RELEASE_SCOPE}, {"total_scanned": "60", "selected": 30})
    (tmp_path / "insights" / f"{days[0]}.json").unlink()
    (tmp_path / "feed.xml").write_text("".join(f"posts/{d}.html" for d in days))
    (tmp_path / "stats" / "counts.json").write_text(json.dumps({"daily": []}))
    rows = {(str(r["day"]), r["rule"][:3]): r["ok"] for r in release_gates(read_release(spark, str(tmp_path))).collect()}
    assert [rows[d, "G08"] for d in days] == [True, True, True, False]
    assert [rows[d, "G09"] for d in days] == [True, True, True, False]
    assert [rows[d, "G14"] for d in days] == [True, True, False, False]  # the first day has no insights to compare with
    assert [rows[d, "G15"] for d in days] == [True, True, False, True]
    assert {rows[d, g] for d in days for g in ("G21", "G23")} == {None}
