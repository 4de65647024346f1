import math
import pickle
import zlib
from collections import Counter

import numpy as np
import pytest

from paperflow.llm import filters
from paperflow.llm import suffix_tree as P

from .helpers import docs, sf_docs


def symbols(text):
    return (text or "").encode().lower().split() + [P.END]


def is_held_out(key):
    return zlib.crc32(("" if key is None else str(key)).encode()) % 5 == 1


def brute(rows, least, depth, divergence, prior):
    """The same tree with dictionaries over word tuples."""
    train = [symbols(t) for k, t in rows if not is_held_out(k)]
    counts = Counter(x for s in train for x in s)
    total, different = sum(counts.values()), len(counts)
    whole = total + 0.5 * (different + 1)
    root = lambda x: math.log10((counts.get(x, 0) + 0.5) / whole)
    frequent = {1: {(x,): c for x, c in counts.items() if c >= least}}
    for n in range(2, depth + 2):
        seen = Counter()
        for s in train:
            line = [P.END, *s]
            for i in range(len(line) - n + 1):
                g = tuple(line[i:i + n])
                if g[:-1] in frequent[n - 1] and g[1:] in frequent[n - 1]:
                    seen[g] += 1
        frequent[n] = {g: c for g, c in seen.items() if c >= least}
    kept, kids = {}, {}
    for n in range(1, depth + 1):
        for g, c in frequent[n + 1].items():
            kids.setdefault(g[:-1], {})[g[-1]] = c

    def p(x, context):
        for n in range(len(context), 0, -1):
            if context[-n:] in kept:
                k, r = kept[context[-n:]]
                return (kids[context[-n:]].get(x, 0) + r * p(x, context[len(context) - n + 1:])) / (k + r)
        return 10 ** root(x)

    for n in range(1, depth + 1):
        for context, c in frequent[n].items():
            children = kids.get(context)
            if not children:
                continue
            k = sum(children.values())
            r = max(c - k, 0) + prior
            shorter = {x: p(x, context[1:]) for x in children}
            mine = {x: (m + r * shorter[x]) / (k + r) for x, m in children.items()}
            gain = sum(m * math.log(mine[x] / shorter[x]) for x, m in children.items())
            gain += max(c - k, 0) * math.log(max(1e-12, 1 - sum(mine.values())) / max(1e-12, 1 - sum(shorter.values())))
            if gain >= divergence * len(children):
                kept[context] = (k, r)

    def score(text):
        line = [P.END, *symbols(text)]
        return sum(math.log10(p(line[i], tuple(line[max(0, i - depth):i]))) for i in range(1, len(line)))

    return counts, total, root, score, p, kept


@pytest.mark.parametrize("sent, bits", [(1 << 19, 1 << 26), (40, 1 << 20), (0, 64)])
def test_scores_equal_brute_force(spark, sent, bits, monkeypatch):
    """All of the tree broadcast, most of it looked up by joins, and filters that let everything through."""
    monkeypatch.setattr(filters, "FILTER_BITS", bits)
    frame = sf_docs(spark).limit(1000)
    rows = [(r["doc_id"], r["text"]) for r in frame.collect()][:120]
    rows += [(9001, "to be or not to be " * 40), (9002, "to be or not to be " * 40), (9003, None), (9004, ""), (None, "unheard zzqq"), (9002, "to be or not")]
    counts, total, root, score, p, kept = brute(rows, 3, 3, 2.0, 3.0)
    assert {len(c) for c in kept} == {1, 2, 3}
    out = P.score_documents(docs(spark, rows), least_count=3, depth=3, divergence=2.0, prior=3.0, sent=sent).collect()
    assert len(out) == len(rows)
    want = Counter()
    for k, t in rows:
        s = symbols(t)
        want[str((k, is_held_out(k), len(s), sum(x in counts for x in s), total, f"{sum(map(root, s)):.6f}", f"{score(t):.6f}"))] += 1
    got = Counter(str((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], f"{r['base_score']:.6f}", f"{r['score']:.6f}")) for r in out)
    assert got == want
    words = [*counts, b"never seen"]
    for context in list(kept)[::7]:
        assert sum(p(x, context) for x in words) == pytest.approx(1)


def test_tree_helps_on_held_out_texts(spark):
    got = P.score_documents(sf_docs(spark, "0.01")).where("held_out").toPandas()
    assert got.score.sum() > 0.97 * got.base_score.sum()  # logarithms: nearer to 0 is better
    assert (got.score > got.base_score).mean() > 0.75


def test_a_repeated_text_is_told_apart_at_every_size(spark):
    """What occurs ``LEAST_COUNT`` times is learnt, however much else there is."""
    new = " ".join(f"only{k} here{k % 7}" for k in range(60))
    ids = [k for k in range(10_000, 10_040) if not is_held_out(k)][:P.LEAST_COUNT]
    for others in (0, 800):
        rows = [(r["doc_id"], r["text"]) for r in sf_docs(spark, "0.01").limit(1000).collect()][:others] + [(k, new) for k in ids]
        got = {r["doc_id"]: r for r in P.score_documents(docs(spark, rows)).collect()}
        assert all(got[k]["score"] > 0.3 * got[k]["base_score"] for k in ids)


def test_without_training_rows(spark):
    held = next(k for k in range(100) if is_held_out(k))
    out = P.score_documents(docs(spark, [(held, "a b")])).collect()[0]
    assert (out["train_tokens"], out["n_known"], out["n_tokens"], out["score"]) == (0, 0, 3, 0.0)
    assert P.score_documents(docs(spark, [])).count() == 0


def test_sent_tables_carry_keys_and_values_only():
    rng = np.random.default_rng(4)
    for n in (0, 1, 5000):
        keys, values = rng.integers(1, 1 << 62, n).astype(np.uint64), rng.random(n)
        sent = pickle.dumps(P.Keys(keys, values))
        assert len(sent) < 16 * n + 1000
        there, found = pickle.loads(sent).find(np.concatenate([keys, keys + np.uint64(1)]))
        assert there.tolist() == [True] * n + [False] * n and found[:n].tolist() == values.tolist()


def test_rare_words_are_looked_up_at_every_size(spark, monkeypatch):
    """A table that fits the broadcast is no other case than one that does not: words too rare for the tree are never sent."""
    sent, gathered = {}, P._gathered
    monkeypatch.setattr(P, "_gathered", lambda rows, key, value: sent.setdefault(key, gathered(rows, key, value)))
    learnt = [k for k in range(100) if not is_held_out(k)][:4]
    rows = [(k, f"often only{k}" + " twice" * (n < 2)) for n, k in enumerate(learnt)]
    out = P.score_documents(docs(spark, rows)).collect()
    assert len(sent["symbol"].keys) == 2  # "often" and the end
    counts = Counter(x for _, t in rows for x in symbols(t))
    whole = sum(counts.values()) + 0.5 * (len(counts) + 1)
    base = {k: sum(math.log10((counts[x] + 0.5) / whole) for x in symbols(t)) for k, t in rows}
    assert all(r["base_score"] == pytest.approx(base[r["doc_id"]]) and r["n_known"] == r["n_tokens"] for r in out)


def test_lines_are_the_words_of_their_texts():
    rng = np.random.default_rng(5)
    bodies = [b"", b"  A b\tcC\x0bdd\x0c\x1c e", "É ünï".encode(), b"x" * 64 + b" " + b"x" * 65 + b" " + b"y" * 200, b"abcdefgh abcdefgh\x00 a a\x00", b"\n"]
    bodies += [rng.integers(0, 256, 50).astype(np.uint8).tobytes() for _ in range(200)]
    lines, found = P.Lines(bodies), [b.lower().split() for b in bodies]
    flat = [w for f in found for w in f]
    assert lines.sizes.tolist() == [len(f) for f in found] and [lines.word(k) for k in range(len(flat))] == flat
    own = lines.symbols[lines.word_places].tolist()
    assert own == P.symbols_of(P.pa.array(flat, P.pa.binary())).tolist() and len(set(zip(own, flat))) == len(set(own)) == len(set(flat))
    counted = lines.counted()
    assert dict(zip(counted["word"].to_pylist(), counted["c"].to_pylist())) == Counter(flat) + Counter({P.END: len(bodies)})


def test_sequences_are_packed_for_the_shuffle():
    rng = np.random.default_rng(6)
    words = rng.integers(1, 1 << 63, 5000).astype(np.uint64)
    columns = [words[np.minimum(rng.zipf(1.3, 30_000), 5000) - 1] for _ in range(2)]
    data = P.packed([np.ones(30_000, np.uint64), *columns])
    assert len(data) < 8 * 30_000  # 24 bytes a sequence before
    assert all((a == b).all() for a, b in zip(columns, P.unpacked(data)[1:]))


def test_sequences_cross_the_shuffle_as_ranks():
    """Per-piece dictionaries of 64-bit symbols grow shorter pieces: a piece of a larger corpus took more bytes a sequence."""
    rng = np.random.default_rng(7)
    for rows in (500, 30_000):
        ranks = [(np.minimum(rng.zipf(1.2, rows), 1 << 20) - 1).astype("<u4") for _ in range(3)]
        data = P.planes([np.ones(rows, "<u4"), *ranks])
        assert len(data) < 8 * rows + 100
        assert all((a == b).all() for a, b in zip(ranks, P.from_planes(data)[1:]))
    for rows in (0, 1):
        assert [x.tolist() for x in P.from_planes(P.planes([np.full(rows, 3, "<u8"), np.full(rows, 4, "<u4")]))] == [[3] * rows, [4] * rows]


def test_asked_keys_go_packed_and_once_a_text():
    rng = np.random.default_rng(8)
    keys, owners = rng.integers(1, 1 << 63, 3000).astype(np.uint64)[rng.integers(0, 3000, 90_000)] * np.uint64(2), rng.integers(0, 50, 90_000)
    got, size = Counter(), 0
    for stripe, data in P.asked_parts(owners, keys, 3):
        size += len(data)
        steps, own, times = P.from_planes(data)
        found = np.cumsum(steps, dtype=np.uint64)
        assert ((found >> np.uint64(61)) == stripe).all()
        got.update(dict(zip(zip(found.tolist(), own.tolist()), times.tolist())))
    assert got == Counter(zip(keys.tolist(), owners.tolist())) and size < 4 * len(got)
    assert list(P.asked_parts(owners[:0], keys[:0], 0)) == []
