from collections import defaultdict

from pyspark.sql import functions as F

from paperflow.llm import lines

from .helpers import docs


def brute(rows, min_sites):
    sites, keeper = defaultdict(set), {}
    for key, text, site in rows:
        for line in (text or "").split("\n"):
            if line.strip(" "):
                if site is not None:
                    sites[line].add(site)
                if key is not None:
                    keeper[line] = min(keeper.get(line, key), key)
    out = []
    for key, text, _ in rows:
        if text is None:
            out.append((key, None, 0, 0))
            continue
        gone = [bool(x.strip(" ")) and len(sites[x]) >= min_sites and keeper.get(x) != key for x in text.split("\n")]
        out.append((key, "\n".join(x for x, g in zip(text.split("\n"), gone) if not g), len(gone), sum(gone)))
    return out


def same(spark, rows, min_sites):
    got = lines.remove_boilerplate(docs(spark, rows), min_sites=min_sites).select("doc_id", "text", "n_lines", "n_removed").collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, brute(rows, min_sites)))


def test_lines_around_the_threshold(spark):
    rows = []
    for spread in (8, 9, 10, 11, 12, 40):
        rows += [(100 * spread + k, f"own {spread} {k}\nshared by {spread}\n\nend {k}", f"s{k}") for k in range(spread)]
        rows += [(100 * spread + 50 + k, f"shared by {spread}", "s0") for k in range(20)]  # one site more often
    same(spark, rows, 10)


def test_edges(spark):
    rows = [(1, None, "a"), (2, "", "b"), (3, "x\ny", None), (4, "x\nx\n ", "a"), (5, "x", "b"), (6, "x", "c"), (6, "x", "c"), (7, "\n\n", "c")]
    same(spark, rows, 2)
    assert lines.remove_boilerplate(docs(spark, [])).count() == 0
    extra = docs(spark, rows).withColumnRenamed("lang", "n_lines").withColumnRenamed("n_chars", "gone")
    assert lines.remove_boilerplate(extra, min_sites=2).count() == len(rows)


def test_very_long_text(spark):
    long = "\n".join(["common"] * 30_000)
    rows = [(k, f"{long}\nown {k}", f"s{k}") for k in range(4)]
    got = {r["doc_id"]: r for r in lines.remove_boilerplate(docs(spark, rows), min_sites=3).collect()}
    assert got[0]["n_removed"] == 0 and got[3]["text"] == "own 3" and got[3]["n_removed"] == 30_000


def test_columns_of_any_name_pass_through(spark):
    frame = docs(spark, [(k, f"the same\nown {k}", f"s{k}") for k in range(12)])
    for name in ("gone", "Gone_", "key", "text_hash", "h1", "h2", "__gone", "__key", "__text_hash", "site", "line", "pos"):
        frame = frame.withColumn(name, F.lit(name))
    got = lines.remove_boilerplate(frame).collect()
    assert {r["doc_id"]: r["text"] for r in got} == {0: "the same\nown 0", **{k: f"own {k}" for k in range(1, 12)}}
    assert all(r["gone"] == "gone" and r["Gone_"] == "Gone_" and r["__key"] == "__key" for r in got)
