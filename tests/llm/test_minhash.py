from collections import Counter

import numpy as np
import pytest

from paperflow.llm import linking as L
from paperflow.llm import minhash as M
from paperflow.llm.common import staged
from tests.llm.test_jaccard import brute, near_copies

from .helpers import docs, sf_docs


def same(spark, rows, k=5, percent=85, **options):
    got = M.near_duplicates(docs(spark, rows), k, percent, **options).collect()
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == brute(rows, k, percent)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


@pytest.mark.parametrize("seed", [1, 2])
def test_near_copies(spark, seed, monkeypatch):
    monkeypatch.setattr(L, "BLOCK_ROWS", 4)
    monkeypatch.setattr(L, "SPLIT_ROWS", 5)
    same(spark, near_copies(seed), 3)


def test_whole_table(spark):
    same(spark, [(r["doc_id"], r["text"]) for r in sf_docs(spark, "0.01").collect()])


def test_edges(spark):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "a"), (5, "A"), (6, "a b"), (7, "a b c d e f"), (7, "a b c d e f"), (8, "b c"), (9, "x " * 3000),
            (10, "x " * 3001), (-4, "p q r s t"), (11, "P q r s t")]
    same(spark, rows)
    assert M.near_duplicates(docs(spark, [])).count() == 0
    got = {(r["doc_id"], r["component_id"]) for r in M.near_duplicates(docs(spark, [(None, "a b c d e"), (4, "a b c d e"), (None, None)])).collect()}
    assert got == {(None, 4), (4, 4), (None, None)}
    clash = docs(spark, rows).selectExpr("*", "1 AS name", "2 AS signature", "3 AS component_id", "4 AS text_hash", "5 AS kept")
    assert M.near_duplicates(clash).count() == len(rows)


def test_shifted_coordinates_estimate_the_index():
    rng = np.random.default_rng(5)
    for share in (0.3, 0.6, 0.85):
        agree = []
        for _ in range(60):
            n = 400
            both = int(round(2 * n * share / (1 + share)))
            pool = rng.integers(1, 1 << 62, 2 * n - both).astype(np.uint64)
            agree.append(np.mean(M.coordinates(pool[:n]) == M.coordinates(pool[n - both:])))
        assert abs(np.mean(agree) - share) < 0.02


def test_permutations_are_one_to_one_and_shifted():
    x = np.arange(1 << 20, dtype=np.uint32) * np.uint32(4096)
    assert len(np.unique(M.second_permutation(x.copy()))) == len(x)
    s = np.unique(np.random.default_rng(1).integers(1, 1 << 62, 3000).astype(np.uint64))
    places = M.first_permutation(s)
    for j, value in enumerate(M.coordinates(s, 40)):
        assert value == M.second_permutation(places - np.uint32(j)).min()


def test_linked_sets_share_two_signatures():
    rng = np.random.default_rng(9)
    for _ in range(300):
        n = int(rng.integers(10, 300))
        pool = rng.integers(1, 1 << 62, n).astype(np.uint64)
        drop = int(0.15 * n)
        a, b = M.band_signatures(pool), M.band_signatures(pool[drop:])
        assert (n - drop) / n < 0.85 or (a == b).sum() >= 2


def test_many_copies_and_unlinked_sets_of_one_signature(spark):
    """Thousands of copies make one class; thousands of unlinked sets under one signature are parted by their other signatures."""
    copies = [(k, "one two three four five six") for k in range(5000)]
    same(spark, copies + [(9000 + k, f"w{k} two three four five six") for k in range(20)])
    rng = np.random.default_rng(2)
    rows = [(7, name, name) for name in range(5000)] + [(100 + int(s), name, name) for name in range(5000) for s in set(rng.integers(0, 4000, 3))]
    rows += [(9, 5000, 5000), (9, 5001, 5001), (7, 5000, 5000), (7, 5001, 5001)]
    named = staged(spark.createDataFrame(rows, "signature long, name long, label long"), "test-members")
    groups = Counter()
    held = {}
    for r in L.mixed_groups(named, 128).collect():
        groups[r["signature"]] += 1
        held.setdefault(r["signature"], set()).add(r["name"])
    assert max(groups.values()) <= 128 and {5000, 5001} in held.values()


@pytest.mark.parametrize("split", [1 << 16, 5])
def test_one_shared_signature_is_enough_at_every_size(spark, split, monkeypatch):
    """All sets share the one signature there is; linked ones that are not the first's are found whether it is split or not."""
    monkeypatch.setattr(L, "SPLIT_ROWS", split)
    least = min((f"c{i}" for i in range(20_000)), key=lambda w: M.coordinates(L.ShingleSets(1)(w.encode()), 1)[0])
    rows = []
    for i in range(12):
        own = [least] + [f"d{i}x{j}" for j in range(24)]
        rows += [(2 * i, " ".join(own)), (2 * i + 1, " ".join(own[:-1] + [f"e{i}"]))]
    got = M.near_duplicates(docs(spark, rows), 1, 85, bands=1, rows=1).collect()
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == brute(rows, 1, 85)
    assert {r["component_id"] for r in got} == set(range(0, 24, 2))
