import hashlib
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from paperflow.llm import winnowing as W

from .helpers import docs, sf_docs


def xx(*values):
    seed = 42
    for v in values:
        seed = xxhash.xxh64(v if isinstance(v, bytes) else v.to_bytes(8, "little"), seed=seed).intdigest()
    return seed


def picks(text, k=W.K, w=W.W):
    words = [x for x in re.split(r"[ \t\n\x0b\f\r]+", re.sub(r"([一-鿿぀-ヿ])", r"\1 ", text)) if x]
    hashes = [xx(x.encode()) for x in words]
    runs = [xx(*hashes[i:i + k]) >> 32 for i in range(max(1, len(hashes) - k + 1))] if hashes else []
    out = []
    for i in range(max(1, len(runs) - w + 1) if runs else 0):
        window = runs[i:i + w]
        best = min(window)
        place = i + max(j for j, x in enumerate(window) if x == best)
        if (best, place) not in out[-1:]:
            out.append((best, place))
    return out


def like(a, b):
    a, b = {h for h, _ in a}, {h for h, _ in b}
    return len(a & b) / len(a | b) if a | b else 1.0


def written(found):
    return " ".join(f"{h:x}@{p}" for h, p in found)


def brute(rows):
    order = sorted({(k, t or "") for k, t in rows}, key=lambda r: -r[0])
    out = []
    for k, t in rows:
        t = t or ""
        nxt = order[(order.index((k, t)) + 1) % len(order)][1]
        half = len(t) // 2
        edited = t[:len(t) - half] + nxt[:half]
        a, b = picks(t), picks(edited)
        out.append((k, len(t), hashlib.sha256(edited.encode()).hexdigest(), written(a), written(b), round(like(a, b), 9), round(like(a, picks(nxt)), 9)))
    return sorted(out)


def result(frame):
    return sorted((r["doc_id"], r["n_chars"], r["edited_sha256"], r["fingerprint"], r["edited_fingerprint"], round(r["near_edited"], 9), round(r["near_next"], 9))
                  for r in W.edited_likeness(frame).collect())


def test_documents_equal_brute_force(spark):
    rows = [(r["doc_id"], r["text"]) for r in sf_docs(spark).collect()][:80]
    assert result(docs(spark, rows)) == brute(rows)


def test_edges(spark):
    rows = [(1, None), (2, ""), (3, "one"), (4, "one two three"), (5, "a " * 400), (6, "  x  \n"), (7, "漢字かな漢字 mixed 漢"), (8, "𝒳𝒴 é𝒵"), (8, "𝒳𝒴 é𝒵"), (9, "one")]
    got = result(docs(spark, rows))
    assert got == brute(rows)
    assert [r[3] for r in got if r[0] in (3, 9)] == [got[2][3]] * 2  # equal texts
    assert result(docs(spark, [])) == []
    assert result(docs(spark, [(4, "a b c d")])) == brute([(4, "a b c d")])
    lone = W.edited_likeness(docs(spark, [(None, "p q"), (2, "r s t")])).collect()
    assert {r["doc_id"] for r in lone} == {None, 2}


def test_match_guarantee(spark):
    common = " ".join(f"w{i}" for i in range(W.W + W.K - 1))
    frame = docs(spark, [(k, f"{' '.join(f'a{k}{i}' for i in range(7 * k))} {common} tail{k}") for k in range(1, 6)])
    sets = [set(r["hashes"]) for r in W.fingerprints(frame).collect()]
    assert set.intersection(*sets)


@pytest.mark.parametrize("w", [1, 2, 3, 7, 8])
def test_any_window(spark, w):
    text = " ".join(str(i * i % 17) for i in range(60))
    row = docs(spark, [(1, text)]).select(W.written(W.chosen(F.col("text"), 3, w)).alias("f")).head()
    assert row["f"] == written(picks(text, 3, w))


def test_native_plan(spark):
    plan = W.edited_likeness(sf_docs(spark))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
