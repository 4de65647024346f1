"""Quality grades by cumulative-link (proportional-odds) regression over hashed text.

A document's features are its different words, lower-cased and without outer punctuation, their beginnings, runs of marks at
their ends, and a few binned shares (capitals,
repetition, marks after words, the commonest word), all hashed to one table of weights that the grades share.  The weights' sum
is a latent score s; with ordered thresholds, P(grade <= k) = 1 / (1 + exp(s - threshold_k)).  That gives the expected grade and the
tail probability of reaching the top grade, on which documents are selected.

Grades from the labels: 0 toxic, 1 not toxic but of low quality, 2 good.  Weights are fitted on at most ``sample_rows`` labelled
rows, the first by hash of the id, of at most ``sample_bytes`` bytes of text each; scores cover all rows.

Null texts count as empty.  Labels with a null are not used.  Without labelled rows nothing can be rejected: every grade is the
top one.  Repeated rows are scored alike, and repeated labels weigh as often as they occur.  An empty table gives no rows.
Other columns pass through.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import hashed_sample, small_batches, worker_table

BUCKETS = 1 << 20
SAMPLE_ROWS, SAMPLE_BYTES = 8_000, 256 << 10
EPOCHS, BATCH, RATE, PENALTY, LEAST_DOCS = 16, 64, 0.2, 1e-3, 10
GRADES = 3
KEEP_TAIL = 0.5
OUTER = b".,;:!?|$%&*#\"'()[]{}<>-_=+~/\\@"
_TAIL_MARKS = re.compile(rb"[^\w\s\x80-\xff]{2,}(?=\s|$)")


def bucket(feature: bytes) -> int:
    return zlib.crc32(feature) % BUCKETS


def word_buckets(word: bytes) -> list[int]:
    """The bare word, its first four and six bytes, and marks at its end if there are two or more."""
    bare = word.strip(OUTER)
    found = [bucket(bare), bucket(b"\1" + bare[:4]), bucket(b"\2" + bare[:6])]
    marks = word[len(word.rstrip(OUTER)):] if len(word) > 1 else b""
    return [*found, bucket(b"\3" + marks)] if len(marks) > 1 else found


def share_features(text: bytes, words: list[bytes]) -> list[bytes]:
    """Binned shares; a leading NUL keeps them apart from words.  Each counts as three features, since a text has so few of them."""
    n = len(words)
    if not n:
        return [b"\0none"]
    counts = Counter(words)
    marks = _TAIL_MARKS.findall(text)
    letters = max(1, len(text))
    shares = {
        b"caps": sum(text.count(c) for c in (b"A", b"E", b"I", b"N", b"O", b"R", b"S", b"T")) / letters,
        b"same": 1 - len(counts) / n,
        b"top": counts.most_common(1)[0][1] / n,
        b"marks": len(marks) / n,
        b"bar": counts.get(b"|", 0) / n,
    }
    return [b"\0%s%d.%d" % (k, min(9, int(20 * v)), again) for k, v in shares.items() for again in range(3)]


def feature_buckets(text: bytes) -> list[int]:
    words = text.lower().split()
    return [b for w in set(words) for b in word_buckets(w)] + [bucket(f) for f in share_features(text, words)]


@dataclass
class OrdinalModel:
    weights: np.ndarray
    thresholds: np.ndarray

    def at_most(self, s: np.ndarray) -> np.ndarray:
        """P(grade <= k) for all but the top grade, one column for each k."""
        return 1 / (1 + np.exp(np.clip(s[:, None] - self.thresholds[None, :], -500, 500)))

    def expected_and_tail(self, s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        below = self.at_most(s)
        return (1 - below).sum(axis=1), 1 - below[:, -1]


def fit(rows: list[np.ndarray], grades: np.ndarray, n_grades: int = GRADES, epochs: int = EPOCHS, seed: int = 7) -> OrdinalModel:
    """Adaptive gradient ascent of the penalized likelihood; the gap between thresholds is an exponential, so they stay in order.

    Buckets seen in fewer than ``LEAST_DOCS`` rows keep the weight 0.
    """
    weights = np.zeros(BUCKETS)
    if not len(rows):
        return OrdinalModel(weights, np.full(n_grades - 1, -np.inf))
    docs = np.bincount(np.concatenate([np.unique(r) for r in rows]), minlength=BUCKETS)
    rows = [r[docs[r] >= LEAST_DOCS] for r in rows]
    share = np.clip(np.cumsum(np.bincount(grades, minlength=n_grades))[:-1] / len(grades), 1e-3, 1 - 1e-3)
    first = np.log(share / (1 - share))
    free = np.concatenate([first[:1], np.log(np.maximum(np.diff(first), 1e-2))])
    seen, seen_free, order = np.full(BUCKETS, 1e-8), np.full(n_grades - 1, 1e-8), np.random.default_rng(seed)
    for _ in range(epochs):
        mixed = order.permutation(len(rows))
        for at in range(0, len(mixed), BATCH):
            picked = mixed[at:at + BATCH]
            index = np.concatenate([rows[i] for i in picked])
            owner = np.repeat(np.arange(len(picked)), [len(rows[i]) for i in picked])
            s = np.bincount(owner, weights[index], minlength=len(picked))
            y = grades[picked]
            thresholds = np.cumsum(np.concatenate([free[:1], np.exp(free[1:])]))
            edges = np.concatenate([np.zeros((len(picked), 1)), OrdinalModel(weights, thresholds).at_most(s), np.ones((len(picked), 1))], axis=1)
            lane = np.arange(len(picked))
            upper, lower = edges[lane, y + 1], edges[lane, y]
            slope = upper + lower - 1
            touched, inverse = np.unique(index, return_inverse=True)
            g = np.bincount(inverse, slope[owner]) / len(picked) - PENALTY * weights[touched]
            seen[touched] += g * g
            weights[touched] += RATE * g / np.sqrt(seen[touched])
            mass = np.maximum(upper - lower, 1e-9)
            gt = np.zeros(n_grades + 1)
            np.add.at(gt, y + 1, upper * (1 - upper) / mass)
            np.add.at(gt, y, -lower * (1 - lower) / mass)
            gt = gt[1:-1] / len(picked)
            gf = np.cumsum(gt[::-1])[::-1] * np.concatenate([[1.0], np.exp(free[1:])])
            seen_free += gf * gf
            free += RATE * gf / np.sqrt(seen_free)
    return OrdinalModel(weights, np.cumsum(np.concatenate([free[:1], np.exp(free[1:])])))


def labelled_sample(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", sample_rows: int = SAMPLE_ROWS,
                    sample_bytes: int = SAMPLE_BYTES) -> tuple[list[np.ndarray], np.ndarray]:
    """Features and grades of the sample, in a fixed order; only hashed features leave the executors."""
    graded = labels.where("quality is not null and toxic is not null").select(
        F.col(key).alias("label_key"), F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1).otherwise(2).alias("grade"))
    chosen = F.broadcast(hashed_sample(graded, "label_key", sample_rows))
    few = docs.select(F.col(key).alias("label_key"), F.col(text).alias("text")).where(F.octet_length("text") <= sample_bytes).join(chosen, "label_key")

    @F.pandas_udf("binary")
    def buckets(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: np.sort(np.array(feature_buckets(t.encode()), dtype="<i4")).tobytes())

    found = small_batches(few).select("label_key", "grade", buckets("text").alias("f")).collect()
    found.sort(key=lambda r: (r["label_key"], r["grade"], r["f"]))
    return [np.frombuffer(r["f"], "<i4") for r in found], np.array([r["grade"] for r in found], dtype="int64")


class _Scorer:
    """Latent scores with a bounded table of words already seen."""

    def __init__(self, weights: np.ndarray, entries: int = 200_000):
        self.weights, self.entries, self.known = weights, entries, {}

    def __call__(self, text: bytes) -> float:
        words = text.lower().split()
        if len(self.known) > self.entries:
            self.known = {}
        different = set(words)
        for w in different.difference(self.known):
            self.known[w] = float(self.weights[word_buckets(w)].sum())
        return sum(sorted(map(self.known.__getitem__, different))) + sum(float(self.weights[bucket(f)]) for f in share_features(text, words))


def _scorer(sent) -> _Scorer:
    def make() -> _Scorer:
        index, values = sent.value
        weights = np.zeros(BUCKETS)
        weights[index] = values
        return _Scorer(weights)

    return worker_table("scorer", sent, make)


def score(docs: DataFrame, model: OrdinalModel, text: str = "text", into: str = "grade") -> DataFrame:
    """Adds the struct ``into`` with ``expected`` and ``tail``."""
    used = np.flatnonzero(model.weights)
    sent = docs.sparkSession.sparkContext.broadcast((used, model.weights[used]))
    bare = OrdinalModel(np.zeros(0), model.thresholds)

    @F.pandas_udf("expected double, tail double")
    def graded(texts: pd.Series) -> pd.DataFrame:
        scorer = _scorer(sent)
        s = np.array([scorer((t or "").encode()) for t in texts])
        expected, tail = bare.expected_and_tail(s)
        return pd.DataFrame({"expected": expected, "tail": tail})

    return small_batches(docs).withColumn(into, graded(F.col(text)))


def select_good(docs: DataFrame, labels: DataFrame, keep_tail: float = KEEP_TAIL, key: str = "doc_id", text: str = "text", into: str = "grade") -> DataFrame:
    """The documents whose probability of the top grade is at least ``keep_tail``, with the struct ``into``."""
    model = fit(*labelled_sample(docs, labels, key, text))
    return score(docs, model, text, into).where(F.col(into)["tail"] >= keep_tail)
