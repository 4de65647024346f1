import hashlib
import itertools
import re
import zlib

import numpy as np
import pytest

from paperflow.llm import conversations as C

SCHEMA = "conv_id long, turn long, role string, text string"
GOOD = re.compile(r"(s?(ua)+)?\Z")


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        pick = zlib.crc32(":".join(" " if x is None else str(x) for x in (conv, turn)).encode()) % 20
        if pick:
            row = (conv, turn, "user" if pick == 4 else role, "" if pick == 1 else re.sub("[.!?]", "", text) if pick == 2 else text)
            out += [row] * (2 if pick == 3 else 1)
    return out


def faults(rows):
    seen, out = set(), []
    for _, _, role, text in rows:
        bare = re.sub(r"[\x20\x09-\x0D]+\Z", "", text)
        out.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def cheapest(rows):
    """Every edit script with at most two inserted rows in each gap."""
    best = None
    what = faults(rows)
    gaps = [["", "I", "II"]] * (len(rows) + 1)
    edits = ["D" if f in ("blank", "duplicate") else "KRD" for f in what]
    for inserts in itertools.product(*gaps):
        for chosen in itertools.product(*edits):
            audit = "".join(i + e for i, e in zip(inserts, [*chosen, ""]))
            roles, text, cost, ok, state = "", [], 0, True, 0
            k = 0
            for letter in audit:
                want = "a" if roles[-1:] == "u" else "u"
                if letter == "I":
                    roles, cost = roles + want, cost + 2
                    text.append(f"{C.ROLES[want]}:")
                    continue
                row, f = rows[k], what[k]
                k += 1
                if letter == "D":
                    cost += 3
                    continue
                cost += f == "truncated"
                if letter == "R":
                    roles, cost = roles + want, cost + 2
                    text.append(f"{C.ROLES[want]}:{row[3]}")
                else:
                    roles += row[2][:1] or "-"
                    text.append(f"{row[2]}:{row[3]}")
            if GOOD.match(roles) and (best is None or (cost, audit) < best[:2]):
                best = (cost, audit, hashlib.sha256("\n".join(text).encode()).hexdigest())
    return best


def expected(original):
    out = {}
    for conv in {r[0] for r in original}:
        rows = sorted(damage([r for r in original if r[0] == conv]), key=lambda r: (r[1] is not None, r[1] or 0))
        what, turns = faults(rows), [r[1] for r in rows if r[1] is not None]
        cost, audit, sha = cheapest(rows)
        initials = [r[2][:1] for r in rows]
        out[conv] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *(what.count(f) for f in ("blank", "duplicate", "truncated")),
                     sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit, sha)
    return out


def run(spark, rows, schema=SCHEMA, **options):
    got = C.repaired_digests(spark.createDataFrame(rows, schema).repartition(3), **options).collect()
    keys = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    out = {r["conv_id"]: tuple(r[k] for k in keys) for r in got}
    assert len(out) == len(got)
    return out


def random_rows(n=160, seed=1, longest=5):
    rng = np.random.default_rng(seed)
    rows = []
    for conv in range(n):
        turns = rng.permutation(12)[:int(rng.integers(1, longest + 1))].tolist()
        if rng.random() < 0.15:
            turns[0] = None
        for turn in turns:
            role = ["user", "assistant", "system", "tool", "", None, "ux"][rng.choice(7, p=[.35, .3, .15, .08, .04, .04, .04])]
            text = ["Yes.", "No!", "what", "", " \t", None, "a. ", "so?\n", "é", "b "][int(rng.integers(0, 10))]
            rows.append((conv if conv else None, turn, role, text))
    return rows


def test_against_brute_force(spark):
    rows = random_rows()
    assert run(spark, rows) == expected(rows)


def test_cut_conversations_and_few_rules_change_nothing(spark):
    rows = random_rows(60, 7)
    assert run(spark, rows, fragment_rows=2, max_rules=0) == expected(rows)
    assert run(spark, rows, fragment_rows=1, max_rules=3) == expected(rows)


def test_one_hot_conversation(spark):
    rng = np.random.default_rng(4)
    rows = [(1, t, ["user", "assistant"][int(rng.random() < 0.5)], f"say {t if rng.random() < .8 else 'again'}" + (". " if rng.random() < .7 else "")) for t in range(1500)]
    rows += [(k, t, ["user", "assistant"][t], "Hi.") for k in range(2, 400) for t in range(2)]
    whole = run(spark, rows)
    assert run(spark, rows, fragment_rows=7, max_rules=20) == whole
    gaps, blank, duplicate, truncated, illegal, cost, audit, _ = whole[1]
    plain = sorted(damage([r for r in rows if r[0] == 1]), key=lambda r: r[1])
    kinds, what = [r[2][0] for r in plain], faults(plain)
    best = {0: (0, "")}
    for kind, f in zip(kinds, what):
        now = {}
        for state, (c, a) in best.items():
            for i in range(3):
                moves = [("D", state, 3)]
                if f not in ("blank", "duplicate"):
                    step = C.NEXT[state]
                    moves.append(("R", C.STEPS[step, state], 2 + (f == "truncated")))
                    if (kind, state) in C.STEPS:
                        moves.append(("K", C.STEPS[kind, state], int(f == "truncated")))
                for e, to, extra in moves:
                    new = (c + extra + 2 * i, a + "I" * i + e)
                    now[to] = min(now.get(to, new), new)
                state = C.STEPS[C.NEXT[state], state]
        best = now
    assert (cost, audit) == min((c + 2 * {0: 0, 1: 2, 2: 1, 3: 0}[s], a + "I" * {0: 0, 1: 2, 2: 1, 3: 0}[s]) for s, (c, a) in best.items())
    assert (blank, duplicate, truncated) == tuple(what.count(f) for f in ("blank", "duplicate", "truncated"))


def test_rules_are_shared_and_exact():
    rng = np.random.default_rng(8)
    words = ["".join(chr(int(x)) for x in rng.integers(0, 9, int(rng.integers(0, 40)))) for _ in range(50)]
    plain, packed = C.Grammar([]), C.Grammar(["\x02\x04", "\x03\x03", "\x09\x0a", "\x0b\x0b"])
    for w in words + ["\x02\x04\x03\x03" * 30]:
        assert plain.repair(w) == packed.repair(w)
        a, b = plain.matrix(w), packed.matrix(w)
        assert {k: (c, str(r), n) for k, (c, r, n) in a.items()} == {k: (c, str(r), n) for k, (c, r, n) in b.items()}
    assert len(packed.compressed("\x02\x04\x03\x03" * 30)) == 15


def test_pairs_of_a_round_share_no_symbol():
    counts = [("ab", 9), ("bc", 8), ("cd", 7), ("ee", 3), ("fg", 1)]
    assert C.disjoint_pairs(counts, 10) == ["ab", "cd", "ee"] and C.disjoint_pairs(counts, 2) == ["ab", "cd"]


def test_ropes_compare_as_strings():
    rng = np.random.default_rng(0)
    ropes = [C.Rope()]
    for _ in range(300):
        a, b = rng.integers(0, len(ropes), 2)
        ropes.append(ropes[a] + ropes[b] if rng.random() < 0.6 and ropes[a].size + ropes[b].size < 200 else C.Rope("DIKR"[int(rng.integers(0, 4))] * int(rng.integers(0, 3))))
    for a in ropes[::3]:
        for b in ropes[::2]:
            assert (a < b) == (str(a) < str(b))


@pytest.mark.parametrize("rows", [
    [(1, None, None, None)], [(1, 5, "user", "Hi.")] * 40, [(1, 5, "user", "")] * 3, [(None, None, "assistant", "x" * 300_000)], [(9, 2, "system", "Rules.")]])
def test_edges(spark, rows):
    if len(rows) < 10:
        assert run(spark, rows) == expected(rows)
    else:
        got = run(spark, rows)[1]
        n = len(damage(rows))
        assert n in (0, 40, 80) and (n == 0 or got[2] == n - 1 and got[6] == "K" + "D" * (n - 1) + "I" or got[6].count("D") >= n - 1)


def test_empty_and_clashing_columns(spark):
    assert run(spark, []) == {}
    rows = random_rows(30, 3)
    frame = spark.createDataFrame(rows, SCHEMA)
    for name in ("conv", "part", "h1", "kind", "fault", "first", "rows", "audit", "c", "__pick"):
        frame = frame.selectExpr("*", f"'z' AS {name}")
    got = {r["conv_id"]: r["audit"] for r in C.repaired_digests(frame).collect()}
    assert got == {k: v[6] for k, v in expected(rows).items()}


def test_repaired_rows_keep_the_pattern(spark):
    rows = random_rows(80, 11)
    narrow = C._narrow(spark.createDataFrame(rows, SCHEMA), "conv_id", "turn", "role", "text")
    found, repaired = C.repair(spark.createDataFrame(rows, SCHEMA))
    by_conv = {}
    for r in repaired.collect():
        by_conv.setdefault(r["conv"], []).append(r)
    assert narrow.count() == len(rows)
    for r in found.collect():
        mine = sorted(by_conv.get(r["conv"], []), key=lambda x: x["place"])
        assert GOOD.match("".join(x["role"][0] for x in mine)) and "".join(x["edit"] for x in mine) == r["audit"].replace("D", "")
