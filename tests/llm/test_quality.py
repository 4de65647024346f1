import math

import numpy as np
import pytest

from paperflow.llm import quality

from .helpers import docs, sf_docs


def test_held_out_accuracy(spark):
    frame = sf_docs(spark, "0.1").select("doc_id", "text")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    train, rest = labels.where("doc_id % 4 <> 0"), labels.where("doc_id % 4 = 0")
    model = quality.fit(*quality.labelled_sample(frame, train))
    assert np.all(np.diff(model.thresholds) > 0)
    got = quality.score(frame.join(rest, "doc_id"), model).select("quality", "toxic", "grade.tail", "grade.expected").toPandas()
    toxic, low, good = got[got.toxic == 1], got[(got.toxic == 0) & (got.quality == 0)], got[(got.toxic == 0) & (got.quality == 1)]
    assert (good['tail'] >= 0.5).mean() > 0.97
    assert (toxic['tail'] < 0.5).mean() > 0.85
    assert (low['tail'] < 0.5).mean() > 0.75
    assert toxic.expected.mean() < low.expected.mean() < good.expected.mean()


def test_thresholds_give_a_distribution():
    model = quality.OrdinalModel(np.zeros(0), np.array([-1.0, 2.0]))
    below = model.at_most(np.array([-800.0, 0.0, 800.0]))
    assert np.all(below[:, 0] <= below[:, 1]) and np.allclose(below[[0, 2]], [[1, 1], [0, 0]])
    expected, tail = model.expected_and_tail(np.array([0.0]))
    assert np.isclose(expected[0], (1 - below[1]).sum()) and np.isclose(tail[0], 1 - below[1, 1])


def test_edges(spark):
    rows = [(1, None), (2, ""), (3, "some words"), (3, "some words"), (None, "x")]
    none = spark.createDataFrame([(3, None, 0)], "doc_id long, quality int, toxic int")
    kept = quality.select_good(docs(spark, rows), none)
    assert kept.count() == len(rows)  # nothing was learnt, nothing is rejected
    assert {r["grade"]["tail"] for r in kept.collect()} == {1.0}
    assert quality.select_good(docs(spark, []), none).count() == 0
    labels = spark.createDataFrame([(k, k % 2, 0) for k in range(40)], "doc_id long, quality int, toxic int")
    frame = docs(spark, [(k, "good text here" if k % 2 else "bad junk here") for k in range(40)] + [(90, "x " * 60_000)])
    scores = {r["doc_id"]: r["grade"]["tail"] for r in quality.score(frame, quality.fit(*quality.labelled_sample(frame, labels))).collect()}
    assert scores[1] > 0.5 > scores[2] and 90 in scores


def likelihood(weights, thresholds, rows, grades, penalty):
    """Sum over rows of log P(grade) by the definition, less the penalty."""
    total = 0.0
    for row, y in zip(rows, grades):
        s = sum(weights.get(int(b), 0.0) for b in row)
        below = [0.0, *(1 / (1 + math.exp(s - t)) for t in thresholds), 1.0]
        total += math.log(max(1e-12, below[y + 1] - below[y]))
    return total / len(rows) - penalty / 2 * sum(w * w for w in weights.values())


def small_sample(n=400, seed=3):
    """Rows whose grade follows from few features, with noise."""
    rng = np.random.default_rng(seed)
    rows, grades = [], []
    for _ in range(n):
        row = np.sort(rng.choice(12, int(rng.integers(1, 6)), replace=False)).astype("<i4")
        s = 1.5 * (0 in row) + 1.0 * (1 in row) - 1.5 * (2 in row) - 0.8 * (3 in row) + rng.logistic(0, 0.6)
        rows.append(row)
        grades.append(int(s > -0.6) + int(s > 0.7))
    return rows, np.array(grades)


def test_fit_reaches_the_likelihood_of_a_plain_optimiser():
    rows, grades = small_sample()
    model = quality.fit(rows, grades)
    used = {int(b) for r in rows for b in r}
    ours = {b: float(model.weights[b]) for b in used}
    got = likelihood(ours, model.thresholds, rows, grades, quality.PENALTY)
    x, names = np.zeros(len(used) + 2), sorted(used)
    x[-2:] = -0.5, 0.5

    def value(x):
        return likelihood(dict(zip(names, x[:-2])), np.sort(x[-2:]), rows, grades, quality.PENALTY)

    best, step = value(x), 0.5
    while step > 0.02:  # one coordinate after the other, as far as it helps
        before = best
        for i in range(len(x)):
            for d in (step, -step):
                y = x.copy()
                y[i] += d
                if (v := value(y)) > best + 1e-9:
                    x, best = y, v
        if best - before < 1e-4:
            step /= 2
    assert got > best - 0.02 and abs(got) < 0.9 * math.log(3)
    assert model.thresholds[0] < model.thresholds[1]


def test_slopes_are_those_of_the_likelihood():
    """The slope used for a row's score against a finite difference."""
    model = quality.OrdinalModel(np.zeros(4), np.array([-0.7, 0.9]))
    for s in (-2.0, 0.1, 1.7):
        for y in range(3):
            edges = [0.0, *model.at_most(np.array([s]))[0], 1.0]

            def log_p(t):
                below = [0.0, *model.at_most(np.array([t]))[0], 1.0]
                return math.log(below[y + 1] - below[y])

            assert edges[y + 1] + edges[y] - 1 == pytest.approx((log_p(s + 1e-5) - log_p(s - 1e-5)) / 2e-5, abs=1e-5)


def test_scores_by_the_formula(spark):
    rng = np.random.default_rng(1)
    model = quality.OrdinalModel(rng.normal(0, 0.05, quality.BUCKETS), np.array([-1.0, 0.4]))
    texts = ["Some words, some WORDS again!!", "", None, "a | b | c", "Ünïcode wörds ... here", "x " * 500, "one"]
    rows = [(k, t) for k, t in enumerate(texts)]
    got = {r["doc_id"]: r["grade"] for r in quality.score(docs(spark, rows), model).collect()}
    for k, t in rows:
        s = sum(float(model.weights[b]) for b in quality.feature_buckets((t or "").encode()))
        below = [1 / (1 + math.exp(s - x)) for x in model.thresholds]
        assert got[k]["expected"] == pytest.approx(sum(1 - b for b in below), abs=1e-9)
        assert got[k]["tail"] == pytest.approx(1 - below[-1], abs=1e-9)
