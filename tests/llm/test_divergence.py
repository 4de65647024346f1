import re
from collections import Counter

import numpy as np

from paperflow.llm import divergence
from tests.llm.helpers import DOC

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = {c: c + 32 for c in range(65, 91)}


def brute(rows, min_docs=3, top=200):
    docs = [(lang or "", source or "", TERM.findall((text or "").translate(UPPER))) for _, text, lang, source, _ in rows]
    out = set()
    for lang in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == lang]
        df = Counter(t for d in mine for t in set(d[2]))
        kept = sorted(t for t in df if df[t] >= min_docs)
        v, sources = len(kept), sorted({d[1] for d in mine}, key=lambda s: s.encode())
        counts = {s: Counter(t for d in mine if d[1] == s for t in d[2] if df[t] >= min_docs) for s in sources}
        counts[None] = sum(counts.values(), Counter())
        share = {s: {t: 1 + 10**9 * (c[t] + 1) // (sum(c.values()) + v) for t in kept} for s, c in counts.items()}

        def far(a, b, t):
            return (share[a][t] - share[b][t])**2 // share[b][t]

        for s in sources:
            parts = {"pair": [(o, sum(far(s, o, t) for t in kept)) for o in sources if o != s],
                     "term": [(t, far(s, None, t)) for t in kept if counts[s][t] and share[s][t] > share[None][t]]}
            for part, items in parts.items():
                ranked = sorted(items, key=lambda x: (-x[1], x[0].encode()))
                out |= {(lang, s, part, item, value, k + 1) for k, (item, value) in enumerate(ranked) if part == "pair" or k < top}
    return out


def run(spark, rows, **options):
    got = divergence.source_divergences(spark.createDataFrame(rows, DOC), **options).collect()
    assert len(set(got)) == len(got)
    return {tuple(r[c] for c in ("lang", "source", "part", "item", "value", "rank")) for r in got}


def random_rows(n=300, seed=3):
    rng = np.random.default_rng(seed)
    pool = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(120)] + ["Ünder", "ÄB", "x-y", "Z1z", "的字", "_"]
    rows = []
    for k in range(n):
        hot = rng.random() < 0.35
        text = " ".join(pool[int(i)] for i in (rng.zipf(1.4, int(rng.integers(0, 60))) - 1) % len(pool))
        rows.append((k, text if rng.random() > 0.05 else None, ["en", "de", None, ""][int(rng.integers(0, 4))],
                     "s0" if hot else [f"s{int(rng.integers(0, 9))}", None, "ß", "s"][int(rng.integers(0, 4))], 0))
    return rows


def test_against_brute_force(spark):
    rows = random_rows()
    assert run(spark, rows) == brute(rows)
    assert run(spark, rows, min_docs=10, top=4) == brute(rows, 10, 4)


def test_spills_change_nothing(spark, monkeypatch):
    rows = random_rows(120, 5)
    docs = spark.createDataFrame(rows, DOC).repartition(3)
    stripes = divergence.partial_stripes(docs, "text", "lang", "source", entries=20)
    kept = divergence.merged_stripes(stripes, 3)
    got = {(r["lang"], bytes(r["term"]).decode()): (r["df"], dict(zip(r["sources"], r["counts"]))) for r in kept.collect()}
    expected = {}
    for _, text, lang, source, _ in rows:
        for t, n in Counter(TERM.findall((text or "").translate(UPPER))).items():
            entry = expected.setdefault((lang or "", t), [0, Counter()])
            entry[0] += 1
            entry[1][source or ""] += n
    assert got == {k: (df, dict(c)) for k, (df, c) in expected.items() if df >= 3}
    assert stripes.count() > kept.count()


def test_blocks_of_pairs_change_nothing(monkeypatch):
    rng = np.random.default_rng(2)
    row = np.repeat(np.arange(40), 6)
    site = np.concatenate([rng.permutation(9)[:6] for _ in range(40)])
    count = rng.integers(1, 50, len(row))
    totals = np.bincount(site, count, 9).astype(np.int64)
    whole, small = divergence.PairSums(totals, 40), divergence.PairSums(totals, 40)
    p = divergence.share(count, (totals + 40)[site])
    whole.add(row, site, p, count)
    monkeypatch.setattr(divergence, "CELLS", 20)
    small.add(row, site, p, count)
    assert (whole.sums == small.sums).all() and whole.sums.any()


def test_shares_stay_exact():
    count, total = np.array([0, 7 * 10**15, 10**15]), np.array([9 * 10**15, 9 * 10**15, 10**15 + 1])
    assert divergence.share(count, total).tolist() == [1 + 10**9 * (int(c) + 1) // int(t) for c, t in zip(count, total)]


def test_edges(spark):
    rows = [(1, None, None, None, 0), (1, None, None, None, 0), (None, "", "en", "a", 0), (2, "12 34 !", "en", "b", 0),
            (3, "One two ONE", "de", "x", 0), (3, "One two ONE", "de", "x", 0), (4, "one", "de", "y", 0), (5, "z" * 200_000 + " one", "de", None, 0)]
    assert run(spark, rows) == brute(rows)
    assert run(spark, []) == set()


def test_clashing_columns(spark):
    rows = random_rows(60, 9)
    docs = spark.createDataFrame(rows, DOC)
    for name in ("term", "df", "sources", "rank", "value", "g", "v", "names"):
        docs = docs.selectExpr("*", f"'{name}' AS {name}")
    got = {tuple(r) for r in divergence.source_divergences(docs).select("lang", "source", "part", "item", "value", "rank").collect()}
    assert got == brute(rows)
