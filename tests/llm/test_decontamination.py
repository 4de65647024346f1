import random

from hypothesis import given
from hypothesis import strategies as st

from paperflow.llm import decontamination as D

from .helpers import docs


def distance_in(pattern, text):
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        new = [i]
        for j, c in enumerate(text, 1):
            new.append(min(row[j - 1] + (p != c), row[j] + 1, new[j - 1] + 1))
        row = new
    return min(row)


@given(st.text("abc ", min_size=1, max_size=12), st.text("abc ", max_size=40))
def test_bit_parallel_distance(pattern, text):
    assert D.myers(pattern, text)[0] == min(len(pattern), distance_in(pattern, text))


@given(st.text("abcd", min_size=1, max_size=60), st.integers(0, 8))
def test_pieces_cover_the_passage(passage, errors):
    parts = D.pieces(passage, errors)
    assert len(parts) == errors + 1 and "".join(p for _, p in parts) == passage
    assert all(passage.startswith(p, at) for at, p in parts)


def edited(rng, text, n):
    chars = list(text)
    for _ in range(n):
        k = rng.randrange(len(chars))
        what = rng.randrange(3)
        if what == 0:
            chars[k] = rng.choice("xyz")
        elif what == 1:
            chars.insert(k, rng.choice("xyz"))
        else:
            del chars[k]
    return "".join(chars)


def fixture():
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("etaoinshr") for _ in range(rng.randrange(2, 8)))
    text = lambda n: " ".join(word() for _ in range(n))
    items = [(i, text(rng.randrange(8, 60))) for i in range(12)] + [(90, "Too short."), (91, None), (92, "")]
    rows = []
    for d in range(120):
        body = text(40)
        if d % 3:
            item = D.reduced(items[d % 12][1])
            part = item if d % 2 else " ".join(item.split()[-32:])
            body = f"{text(20)} {edited(rng, part, d % 20)} {text(20)}"
        rows.append((d, body))
    return items, rows + [(500, None), (501, ""), (502, "..."), (7, rows[7][1])]


def brute(items, rows):
    found = {}
    for d, body in rows:
        for i, item in items:
            for p in D.passages(item) if item else []:
                n = distance_in(p, D.reduced(body or ""))
                if n <= D.budget(len(p)) and (d, i) not in found or n < found.get((d, i), -1):
                    found[d, i] = n
    return found


def test_hits_equal_brute_force(spark):
    items, rows = fixture()
    frame, bench = docs(spark, rows), spark.createDataFrame(items, "item_id long, text string")
    want = brute(items, rows)
    assert len(want) > 30
    for chunk_bytes in (1 << 20, 700):
        got = {(r["doc_id"], r["item_id"]): r["distance"] for r in D.find_leaks(frame, bench, chunk_bytes=chunk_bytes).collect()}
        assert got == want
        left = sorted(r["doc_id"] for r in D.drop_leaked(frame, bench, chunk_bytes=chunk_bytes).collect())
        leaked = {d for d, _ in want}
        assert left == sorted(d for d, _ in rows if d not in leaked)


def test_empty_tables(spark):
    items, rows = fixture()
    none = spark.createDataFrame([], "item_id long, text string")
    assert D.find_leaks(docs(spark, rows), none).count() == 0
    assert D.drop_leaked(docs(spark, rows), none).count() == len(rows)
    assert D.find_leaks(docs(spark, []), spark.createDataFrame(items, "item_id long, text string")).count() == 0


def test_leaked_parts_and_short_items(spark):
    words = lambda name, n: " ".join(f"{name}{chr(97 + k // 26)}{chr(97 + k % 26)}" for k in range(n))
    items = {1: words("alpha", 59), 2: words("beta", 30), 3: "Gamma, delta!", 4: "eps", 5: words("zeta", 16)}
    part = lambda i, a, b: " ".join(items[i].split()[a:b])
    rows = [(10, f"before {part(1, 3, 45)} after"), (11, f"before {part(2, 2, 28)} after"), (12, "so gamma delta it is"), (13, "gamma deltas"), (14, "the steps"),
            (15, "eps"), (16, "an EPS."), (17, part(1, 0, 12)), (18, part(1, 20, 33)), (19, "agamma delta and gamma delta"), (20, f"x {items[5].replace('zetaad', 'xetaad')}")]
    want = {(10, 1), (11, 2), (12, 3), (15, 4), (16, 4), (18, 1), (19, 3), (20, 5)}
    frame, bench = docs(spark, rows), spark.createDataFrame(list(items.items()), "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): (r["distance"], r["start"]) for r in D.find_leaks(frame, bench).collect()}
    assert set(got) == want and got[19, 3] == (0, 17) and got[16, 4] == (0, 3)
    assert {r["doc_id"] for r in D.drop_leaked(frame, bench).collect()} == {13, 14, 17}
