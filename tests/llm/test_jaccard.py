import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from paperflow.llm import jaccard as J
from paperflow.llm import linking as L
from paperflow.llm.components import components

from .helpers import docs, sf_docs


def brute(rows, k, percent):
    sets = []
    for _, t in rows:
        w = (t or "").encode().lower().split()
        sets.append(frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else []))
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    index = defaultdict(list)
    for i, s in enumerate(sets):
        shared = Counter(e for x in s for e in index[x])
        for e, n in shared.items():
            if 100 * n >= percent * (len(s) + len(sets[e]) - n):
                root[find(i)] = find(e)
        for x in s:
            index[x].append(i)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), d), d)
    return Counter((d, len(sets[i]), least[find(i)]) for i, (d, _) in enumerate(rows))


def same(spark, rows, k, percent):
    got = Counter(map(tuple, J.similar_components(docs(spark, rows), k, percent).collect()))
    assert got == brute(rows, k, percent)


def near_copies(seed):
    rng = random.Random(seed)
    rows = []
    for n in (12, 40, 90, 200):
        base = [rng.choice("abcdefghijkl") * rng.randrange(1, 5) for _ in range(n)]
        for _ in range(25):
            w = list(base)
            for _ in range(rng.randrange(0, 1 + n // 25)):
                w[rng.randrange(len(w))] = f"z{rng.randrange(500)}"
            if rng.random() < 0.3:
                w = w[rng.randrange(3):]
            rows.append(" ".join(w))
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("k, percent", [(3, 90), (5, 80), (1, 60)])
def test_near_copies(spark, k, percent, monkeypatch):
    monkeypatch.setattr(L, "BLOCK_ROWS", 4)
    monkeypatch.setattr(L, "SPLIT_ROWS", 5)
    same(spark, near_copies(k), k, percent)


def test_one_deletion_neighbourhoods(spark, monkeypatch):
    monkeypatch.setattr(J, "PAIR_COST", 1e12)
    starts = J.band_starts(80, 300)
    assert any(J.allocation(b, starts, 80, 100)[1] for b in range(len(starts) - 1))
    same(spark, near_copies(9), 3, 80)


def test_edges(spark):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "a"), (5, "A"), (6, "a b"), (7, "a b c"), (7, "a b c"), (8, "b c"), (9, "x " * 3000), (10, "x " * 3001), (-4, "a b c d e"), (11, "a b c d e")]
    same(spark, rows, 3, 90)
    assert J.similar_components(docs(spark, [])).count() == 0
    assert J.similar_components(docs(spark, [(1, None), (None, "a b c")])).count() == 2


def test_whole_table(spark):
    rows = [(r["doc_id"], r["text"]) for r in sf_docs(spark, "0.01").collect()]
    same(spark, rows, 3, 90)


def test_allocation_keeps_every_link():
    for percent in (60, 80, 90, 95):
        starts = J.band_starts(percent, 3000)
        for size in (1, 2, 5, 9, 37, 450, 2900):
            band = int(np.searchsorted(starts, size, side="right")) - 1
            for n_sets in (10, 10**6, 10**10):
                m, q = J.allocation(band, starts, percent, n_sets)
                for other in range(size, 100 * size // percent + 1):
                    assert m + q > L.most_different(size + other, percent) + J.SHARED and q <= m


def test_sketch_is_a_lower_bound():
    rng = np.random.default_rng(3)
    for n in (1, 7, 60, 500):
        a = np.unique(rng.integers(1, 1 << 62, n).astype(np.uint64))
        b = np.unique(np.concatenate([a[n // 8:], rng.integers(1, 1 << 62, n // 10 + 1).astype(np.uint64)]))
        x, y = L.sketch(a), L.sketch(b)
        size = min(len(x), len(y))
        assert np.bitwise_count(L.folded(x, size) ^ L.folded(y, size)).sum() <= len(np.setxor1d(a, b))


def test_components(spark):
    edges = [(i, i + 1) for i in range(100, 140)] + [(7, 300 + i) for i in range(50)] + [(5, 5), (9, 8), (8, 9), (301, 3)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    want = {i: 100 for i in range(101, 141)} | {300 + i: 3 for i in range(50)} | {7: 3, 9: 8}
    assert got == want
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0
