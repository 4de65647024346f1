"""Cheapest repair of the structure of conversations, by dynamic programming over a grammar that all conversations share.

A repaired conversation has the role initials ``(s?(ua)+)?``.  A row may be kept (0), given the role user or assistant (2) or deleted (3, the only
choice for blank rows and repetitions); empty user or assistant rows may be inserted anywhere (2); a truncated row that stays costs 1.  The audit of a
conversation is the string of its edits, K R D I, in order: the cheapest one, of equally cheap ones the least by ASCII.

A row is one of nine symbols: role user, assistant, system or other, truncated or not, or bound to go.  Conversations are cut into fragments in
range order, so a conversation with any share of all rows spreads over tasks.  Re-Pair rules are made from pair counts over the different
fragments: in each round the most frequent pairs that have no symbol in common become rules, so that each count stays exact beside the others.
Each symbol has a min-plus matrix over the four states of the pattern (nothing yet, after s, after u, after a) whose entries are a cost and
an audit rope; a rule's matrix is the product of its two symbols' matrices, made once, bottom-up, and used in every conversation.
Inserted rows belong to the row that follows them, so no audit of a fragment is a prefix of another and the least one stays the least in
every product.  Fragments of a conversation that may go on in another task give their whole matrix, and these are multiplied in order.

Rows go by turn (nulls first), then role and a hash of the text.  Nulls of role and text count as one space; a null id is a
conversation of its own.  Repeated rows are repetitions.  A conversation without rows has no edits.  An empty table gives no rows.
Other columns are not read.  ``repaired_rows`` and the digest over it stream each conversation through one task, as a hash of a
whole text must; what a task holds is one audit and one batch.
"""

from __future__ import annotations

import functools
import hashlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from .common import in_batches, staged

SPACE = " \t\n\x0b\f\r"
FRAGMENT_ROWS = 4096
MAX_RULES = 256
MAX_ROUNDS = 16
CACHED = 50_000
GONE = 8
START, AFTER_S, AFTER_U, AFTER_A = range(4)
TAIL = {START: 0, AFTER_S: 2, AFTER_U: 1, AFTER_A: 0}
"""Rows to insert after the last one, so that the pattern can end."""
STEPS = {("s", START): AFTER_S, ("u", START): AFTER_U, ("u", AFTER_S): AFTER_U, ("u", AFTER_A): AFTER_U, ("a", AFTER_U): AFTER_A}
NEXT = {START: "u", AFTER_S: "u", AFTER_U: "a", AFTER_A: "u"}
ROLES = {"u": "user", "a": "assistant"}


class Rope:
    """A string as a tree of shared parts."""

    __slots__ = ("left", "right", "text", "size")

    def __init__(self, text: str = "", left: Rope | None = None, right: Rope | None = None):
        self.text, self.left, self.right = text, left, right
        self.size = len(text) if left is None else left.size + right.size

    def __add__(self, other: Rope) -> Rope:
        if not self.size:
            return other
        return Rope(left=self, right=other) if other.size else self

    def __str__(self) -> str:
        parts, todo = [], [self]
        while todo:
            node = todo.pop()
            if node.left is None:
                parts.append(node.text)
            else:
                todo += (node.right, node.left)
        return "".join(parts)

    def __lt__(self, other: Rope) -> bool:
        a, b = [self], [other]
        while a and b:
            x, y = a.pop(), b.pop()
            if x is y:
                continue
            if x.left is not None and (x.size >= y.size or y.left is None):
                a += (x.right, x.left)
                b.append(y)
            elif y.left is not None:
                b += (y.right, y.left)
                a.append(x)
            else:
                n = min(x.size, y.size)
                if x.text[:n] != y.text[:n]:
                    return x.text < y.text
                if x.size > n:
                    a.append(Rope(x.text[n:]))
                if y.size > n:
                    b.append(Rope(y.text[n:]))
        return bool(b)


Entry = tuple[int, Rope, int]
Matrix = dict[tuple[int, int], Entry]
"""The cheapest way from a state to another: cost, audit and the audit's rank among those from the same state.  Pairs of states without a way are left out.

Neither of two different audits of the same rows is a prefix of the other, so of audits that go on the ranks tell which is less, and ropes
are compared only where what came before is equal.
"""


def _ranked(p: int, best: dict[int, tuple[int, int, Rope, Rope]]) -> Iterator[tuple[tuple[int, int], Entry]]:
    """``best``: per state its cost, the rank of what came before, the rope added and the whole rope."""
    def order(r: int, t: int) -> int:
        (_, i, x, _), (_, j, y, _) = best[r], best[t]
        return i - j if i != j else -1 if x < y else int(y < x)

    place, last = 0, None
    for r in sorted(best, key=functools.cmp_to_key(order)):
        place += last is not None and order(last, r) != 0
        last = r
        yield (p, r), (best[r][0], best[r][3], place)


def product(a: Matrix, b: Matrix) -> Matrix:
    out: Matrix = {}
    for p in range(4):
        best: dict[int, tuple[int, int, Rope, Rope]] = {}
        for q in range(4):
            if (p, q) not in a:
                continue
            cost, audit, rank = a[p, q]
            for r in range(4):
                step = b.get((q, r))
                if step is None:
                    continue
                old, now = best.get(r), (cost + step[0], rank)
                if old is None or now < old[:2] or now == old[:2] and step[1] < old[2]:
                    best[r] = (*now, step[1], audit + step[1])
        out.update(_ranked(p, best))
    return out


def matrix_of(entries: dict[tuple[int, int], tuple[int, str]]) -> Matrix:
    """From costs and audits as plain strings."""
    out: Matrix = {}
    for p in range(4):
        mine = {q: e for (s, q), e in entries.items() if s == p}
        places = sorted({audit for _, audit in mine.values()})
        out |= {(p, q): (cost, Rope(audit), places.index(audit)) for q, (cost, audit) in mine.items()}
    return out


def symbol_matrix(symbol: int) -> Matrix:
    """Of one row, with the rows inserted before it."""
    out: dict[tuple[int, int], tuple[int, str]] = {}
    role, truncated = "suao"[symbol // 2] if symbol != GONE else "", symbol % 2
    for p in range(4):
        state = p
        for inserted in range(3):
            edits = [("D", state, 3)]
            if symbol != GONE:
                if (role, state) in STEPS:
                    edits.append(("K", STEPS[role, state], truncated))
                edits.append(("R", STEPS[NEXT[state], state], 2 + truncated))
            for letter, to, cost in edits:
                entry = (cost + 2 * inserted, "I" * inserted + letter)
                out[p, to] = min(entry, out.get((p, to), entry))
            state = STEPS[NEXT[state], state]
    return matrix_of(out)


IDENTITY = matrix_of({(p, p): (0, "") for p in range(4)})
BEGIN = matrix_of({(START, START): (0, "")})


def finished(row: Matrix) -> tuple[int, str]:
    """Cost and audit of a whole conversation from the entries of the starting state."""
    return min((cost + 2 * TAIL[q], str(audit) + "I" * TAIL[q]) for (_, q), (cost, audit, _) in row.items())


class Grammar:
    """Rules, each a pair of symbols known before it, and the matrix of every symbol.  A sequence is a string of symbols as characters."""

    def __init__(self, pairs: list[str]):
        self.rules = [(pair, chr(GONE + 1 + i)) for i, pair in enumerate(pairs)]
        self.matrices = {chr(s): symbol_matrix(s) for s in range(GONE + 1)}
        for pair, symbol in self.rules:
            self.matrices[symbol] = product(self.matrices[pair[0]], self.matrices[pair[1]])
        self.known: dict[str, tuple[int, str]] = {}

    def compressed(self, sequence: str) -> str:
        for pair, symbol in self.rules:
            sequence = sequence.replace(pair, symbol)
        return sequence

    def matrix(self, sequence: str) -> Matrix:
        out = IDENTITY
        for symbol in self.compressed(sequence):
            out = product(out, self.matrices[symbol])
        return out

    def repair(self, sequence: str) -> tuple[int, str]:
        """Cost and audit of a whole conversation."""
        found = self.known.get(sequence)
        if found is None:
            row = BEGIN
            for symbol in self.compressed(sequence):
                row = product(row, self.matrices[symbol])
            if len(self.known) >= CACHED:
                self.known = {}
            found = self.known[sequence] = finished(row)
        return found


def disjoint_pairs(counts: list[tuple[str, int]], room: int) -> list[str]:
    """The most frequent pairs that occur twice or more and have no symbol in common."""
    taken: set[str] = set()
    chosen: list[str] = []
    for pair, n in sorted(counts, key=lambda x: (-x[1], x[0])):
        if n >= 2 and len(chosen) < room and not taken & set(pair):
            chosen.append(pair)
            taken |= set(pair)
    return chosen


def shared_grammar(fragments: DataFrame, max_rules: int = MAX_RULES, max_rounds: int = MAX_ROUNDS) -> list[str]:
    """The pairs of the rules.  Only pair counts, at most (9 + max_rules)^2, and the rules themselves pass through the driver."""
    sequences = staged(fragments.groupBy("symbols").agg(F.count(F.lit(1)).alias("times")), "sequences")
    pairs: list[str] = []

    def count(rules: list[str]):
        def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            grammar, found = Grammar(rules), Counter()
            for batch in batches:
                for symbols, times in zip(*(c.to_pylist() for c in batch.columns)):
                    last = ""
                    now = grammar.compressed(symbols.decode("latin-1"))
                    for a, b in zip(now, now[1:]):
                        last = "" if a == b and last == a + b else a + b  # "aaa" holds one pair that can be replaced
                        if last:
                            found[last] += times
            yield pa.RecordBatch.from_arrays([pa.array([ord(c[i]) for c in found], pa.int32()) for i in (0, 1)] + [pa.array(found.values(), pa.int64())],
                                             names=["a", "b", "n"])
        return each

    for _ in range(max_rounds):
        counted = in_batches(sequences.select("symbols", "times"), count(list(pairs)), "a int, b int, n long").groupBy("a", "b").agg(F.sum("n").alias("n"))
        new = disjoint_pairs([(chr(r["a"]) + chr(r["b"]), r["n"]) for r in counted.where("n >= 2").collect()], max_rules - len(pairs))
        if not new:
            break
        pairs += new
    return pairs


def _places(rows: DataFrame) -> list[Column]:
    return [rows["turn"].asc_nulls_first(), rows["role"].asc(), rows["h1"].asc(), rows["h2"].asc()]


def _narrow(rows: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    full = rows.select(F.col(conv).alias("conv"), F.col(turn).cast("long").alias("turn"), F.coalesce(role, F.lit(" ")).alias("role"),
                       F.coalesce(text, F.lit(" ")).alias("text"))
    return full.withColumn("h1", F.xxhash64("text")).withColumn("h2", F.xxhash64(F.lit(1), "text"))


def row_symbols(rows: DataFrame) -> DataFrame:
    """``conv, turn, role, h1, h2, kind, symbol, first, rows`` of the different rows, ``rows`` times each: kind of role, symbol, whether seen nowhere earlier."""
    end = F.rtrim("text", F.lit(SPACE))
    initial = F.left("role", F.lit(1))
    kind = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    fault = F.when(end == "", 2).when(F.right(end, F.lit(1)).isin(".", "!", "?"), 0).otherwise(1)
    cells = staged(rows.select("conv", "turn", "role", "h1", "h2", kind.alias("kind"), fault.alias("fault")).groupBy(
        "conv", "turn", "role", "h1", "h2", "kind", "fault").agg(F.count(F.lit(1)).alias("rows")), "conversation-rows")
    firsts = cells.where("fault < 2").groupBy("conv", "role", "h1", "h2").agg(F.bool_or(F.col("turn").isNull()).alias("unknown"), F.min("turn").alias("turn"))
    firsts = firsts.select(F.col("conv").alias("c"), F.when(~F.col("unknown"), F.col("turn")).alias("t"), F.col("role").alias("r"), F.col("h1").alias("x"),
                           F.col("h2").alias("y"), F.lit(True).alias("first"))
    same = (F.col("conv").eqNullSafe(F.col("c")) & F.col("turn").eqNullSafe(F.col("t")) & (F.col("role") == F.col("r")) & (F.col("h1") == F.col("x"))
            & (F.col("h2") == F.col("y")))
    marked = cells.join(firsts, same, "left")
    return marked.select("conv", "turn", "role", "h1", "h2", F.col("kind").cast("byte"), F.col("fault").cast("byte"),
                         F.coalesce("first", F.lit(False)).alias("first"), "rows")


FRAGMENT = ("fragment long, whole boolean, symbols binary, kind_first int, kind_last int, illegal long, blank long, duplicate long, truncated long, "
            "turn_first long, turn_last long, turns long")


def fragments(symbols: DataFrame, most: int = FRAGMENT_ROWS) -> DataFrame:
    """Pieces of conversations of at most ``most`` rows, in order; ``whole`` where no other task can hold rows of the conversation."""
    schema = f"conv {symbols.schema['conv'].dataType.simpleString()}, {FRAGMENT}"
    arrow = to_arrow_schema(StructType.fromDDL(schema))
    rows = staged(symbols, "conversation-symbols")
    ordered = rows.repartitionByRange("conv", *_places(rows)).sortWithinPartitions("conv", *_places(rows))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, made = TaskContext.get().partitionId() << 40, 0
        conv, seen, cut = None, 0, False
        held: list[tuple] = []
        out: list[tuple] = []

        def piece(last: bool) -> None:
            nonlocal made, held, cut
            kinds, faults, turns = ([h[i] for h in held] for i in range(3))
            syms = bytes(GONE if f > 1 else 2 * k + f for k, f in zip(kinds, faults))
            known = [t for t in turns if t is not None]
            illegal = sum((a, b) not in ((0, 1), (1, 2), (2, 1)) for a, b in zip(kinds, kinds[1:]))
            out.append((conv, base + made, last and not cut and seen > 1, syms, kinds[0], kinds[-1], illegal, faults.count(2), faults.count(3), faults.count(1),
                        known[0] if known else None, known[-1] if known else None, len(set(known))))
            made, held, cut = made + 1, [], not last

        def rows_of() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), arrow)], schema=arrow)

        for batch in batches:
            for name, turn, kind, fault, first, n in zip(*(c.to_pylist() for c in batch.columns)):
                if not seen or name != conv:
                    if held:
                        piece(True)
                    conv, seen, cut = name, seen + 1, False
                while n:
                    room = min(n, most - len(held))
                    begins = (kind, fault if fault > 1 or first else 3, turn)
                    held += [begins] + [(kind, fault if fault > 1 else 3, turn)] * (room - 1)
                    first, n = False, n - room
                    if len(held) >= most:
                        piece(False)
                if len(out) >= 5_000:
                    yield rows_of()
                    out = []
        if held:  # the last conversation may go on in the next task
            cut = True
            piece(True)
        if out:
            yield rows_of()

    narrow = ordered.select("conv", "turn", "kind", "fault", "first", "rows")
    return staged(in_batches(narrow, build, schema), "conversation-fragments")


def audits(parts: DataFrame, pairs: list[str]) -> DataFrame:
    """``conv, gaps, blank, duplicate, truncated, illegal, cost, audit`` of every conversation with rows."""
    kind_of = parts.schema["conv"].dataType.simpleString()
    counts = ["illegal", "blank", "duplicate", "truncated"]

    def of_whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grammar = Grammar(pairs)
        for batch in batches:
            done = [grammar.repair(s.decode("latin-1")) for s in batch.column("symbols").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("conv"), batch.column("gaps"), *(batch.column(c) for c in counts), pa.array([c for c, _ in done], pa.int64()),
                                              pa.array([a for _, a in done], pa.string())], names=["conv", "gaps", *counts, "cost", "audit"])

    def matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grammar = Grammar(pairs)
        for batch in batches:
            made = [grammar.matrix(s.decode("latin-1")) for s in batch.column("symbols").to_pylist()]
            costs = [[m[p, q][0] if (p, q) in m else None for p in range(4) for q in range(4)] for m in made]
            edits = [[str(m[p, q][1]) if (p, q) in m else None for p in range(4) for q in range(4)] for m in made]
            kept = [c for c in batch.schema.names if c != "symbols"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(costs, pa.list_(pa.int64())), pa.array(edits, pa.list_(pa.string()))],
                                             names=[*kept, "costs", "edits"])

    def multiplied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict | None = None
        out: list[dict] = []

        def close() -> None:
            cost, audit = finished(held["row"])
            known = held["first"] is not None
            gaps = held["last"] - held["first"] + 1 - held["turns"] if known else 0
            out.append({"conv": held["conv"], "gaps": gaps, **{c: held[c] for c in counts}, "cost": cost, "audit": audit})

        def rows_of() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist(out, schema=arrow)

        for batch in batches:
            for r in batch.to_pylist():
                if held is None or held["conv"] != r["conv"]:
                    if held is not None:
                        close()
                    held = {"conv": r["conv"], "row": BEGIN, "kind": None, "first": None, "last": None, "turns": 0, **dict.fromkeys(counts, 0)}
                else:
                    held["illegal"] += (held["kind"], r["kind_first"]) not in ((0, 1), (1, 2), (2, 1))
                step = {divmod(i, 4): entry for i, entry in enumerate(zip(r["costs"], r["edits"])) if entry[0] is not None}
                held["row"] = product(held["row"], matrix_of(step))
                for c in counts:
                    held[c] += r[c]
                held["kind"] = r["kind_last"]
                held["turns"] += r["turns"] - (r["turn_first"] is not None and r["turn_first"] == held["last"])
                held["first"] = r["turn_first"] if held["first"] is None else held["first"]
                held["last"] = r["turn_last"] if r["turn_last"] is not None else held["last"]
            if len(out) >= 1_000:
                yield rows_of()
                out = []
        if held is not None:
            close()
            yield rows_of()

    schema = f"conv {kind_of}, gaps long, illegal long, blank long, duplicate long, truncated long, cost long, audit string"
    arrow = to_arrow_schema(StructType.fromDDL(schema))
    gaps = F.coalesce(F.col("turn_last") - F.col("turn_first") + 1 - F.col("turns"), F.lit(0)).alias("gaps")
    whole = in_batches(parts.where("whole").select("conv", "symbols", gaps, *counts), of_whole, schema)
    cut = parts.where("not whole").select("conv", "fragment", "symbols", "kind_first", "kind_last", *counts, "turn_first", "turn_last", "turns")
    made = in_batches(cut, matrices, StructType(cut.drop("symbols").schema.fields + StructType.fromDDL("costs array<long>, edits array<string>").fields))
    joined = made.repartition("conv").sortWithinPartitions("conv", "fragment").mapInArrow(multiplied, schema)
    return staged(whole.unionByName(joined), "audits")


def repaired_rows(rows: DataFrame, found: DataFrame) -> DataFrame:
    """``conv, place, turn, role, text, edit`` of what stays and what is inserted, each conversation in order within one partition."""
    kind_of = rows.schema["conv"].dataType.simpleString()
    schema = f"conv {kind_of}, place long, turn long, role string, text string, edit string"
    heads = found.select("conv", F.lit(0).alias("part"), F.lit(None).cast("long").alias("turn"), F.col("audit").alias("role"), F.lit("").alias("text"),
                         F.lit(0).cast("long").alias("h1"), F.lit(0).cast("long").alias("h2"))
    both = heads.unionByName(rows.select("conv", F.lit(1).alias("part"), "turn", "role", "text", "h1", "h2"))
    ordered = both.repartition("conv").sortWithinPartitions("conv", "part", *_places(both)).select("conv", "part", "turn", "role", "text")

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, audit, at, state, place = None, "", 0, START, 0

        def inserted(out: list) -> None:
            nonlocal at, state, place
            while at < len(audit) and audit[at] == "I":
                out.append((conv, place, None, ROLES[NEXT[state]], "", "I"))
                at, state, place = at + 1, STEPS[NEXT[state], state], place + 1

        for batch in batches:
            out: list[tuple] = []
            for name, part, turn, role, text in zip(*(c.to_pylist() for c in batch.columns)):
                if not part:
                    inserted(out)
                    conv, audit, at, state, place = name, role, 0, START, 0
                    continue
                inserted(out)
                letter, at = audit[at], at + 1
                if letter == "D":
                    continue
                now = NEXT[state] if letter == "R" else role[0]
                out.append((conv, place, turn, ROLES[now] if letter == "R" else role, text, letter))
                state, place = STEPS[now, state], place + 1
            yield _rows(out, batch.schema)
        out = []
        inserted(out)
        if out:
            yield _rows(out, batch.schema)

    def _rows(out: list[tuple], like: pa.Schema) -> pa.RecordBatch:
        types = [like.field(0).type, pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]
        columns = list(zip(*out)) or [()] * 6
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["conv", "place", "turn", "role", "text", "edit"])

    return in_batches(ordered, apply, schema)


def digests(repaired: DataFrame) -> DataFrame:
    """``conv, sha256`` over ``role:text`` of the rows of a conversation, joined by newlines; ``repaired`` in the order of ``repaired_rows``."""
    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, state = None, None
        for batch in batches:
            out = []
            for name, role, text in zip(*(c.to_pylist() for c in batch.columns)):
                line = f"{role}:{text}".encode()
                if state is None or name != conv:
                    if state is not None:
                        out.append((conv, state.hexdigest()))
                    conv, state = name, hashlib.sha256(line)
                else:
                    state.update(b"\n" + line)
            yield _ended(out, batch.schema)
        if state is not None:
            yield _ended([(conv, state.hexdigest())], batch.schema)

    def _ended(out: list[tuple], like: pa.Schema) -> pa.RecordBatch:
        convs, sums = zip(*out) if out else ((), ())
        return pa.RecordBatch.from_arrays([pa.array(convs, like.field(0).type), pa.array(sums, pa.string())], names=["conv", "sha256"])

    kind_of = repaired.schema["conv"].dataType.simpleString()
    return repaired.select("conv", "role", "text").mapInArrow(hashed, f"conv {kind_of}, sha256 string")


def repair(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
           fragment_rows: int = FRAGMENT_ROWS, max_rules: int = MAX_RULES) -> tuple[DataFrame, DataFrame]:
    """The audits of all conversations and the repaired rows."""
    narrow = _narrow(rows, conv, turn, role, text)
    parts = fragments(row_symbols(narrow), fragment_rows)
    found = audits(parts, shared_grammar(parts, max_rules))
    return found, repaired_rows(narrow, found)


def damaged(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The faults that ``op12`` plants, chosen by a checksum of conversation and turn."""
    name = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in (conv, turn)]
    pick = F.pmod(F.crc32(F.concat(name[0], F.lit(":"), name[1])), F.lit(20))
    full = rows.select(F.col(conv).alias(conv), F.col(turn).alias(turn), F.coalesce(role, F.lit(" ")).alias(role), F.coalesce(text, F.lit(" ")).alias(text), pick.alias("__pick"))
    copies = F.when(F.col("__pick") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return full.where("__pick <> 0").select(
        conv, turn, F.when(F.col("__pick") == 4, "user").otherwise(F.col(role)).alias(role),
        F.when(F.col("__pick") == 1, "").when(F.col("__pick") == 2, F.translate(text, ".!?", "")).otherwise(F.col(text)).alias(text), F.explode(copies).alias("__copy")).drop("__copy")


def repaired_digests(rows: DataFrame, fragment_rows: int = FRAGMENT_ROWS, max_rules: int = MAX_RULES) -> DataFrame:
    """What is asked of ``op12``: damage, repair and one row per conversation of the table as given."""
    found, repaired = repair(damaged(rows), fragment_rows=fragment_rows, max_rules=max_rules)
    sums = digests(repaired).select(F.col("conv").alias("c"), "sha256")
    every = rows.select("conv_id").distinct()
    met = every.join(found, F.col("conv_id").eqNullSafe(F.col("conv")), "left").join(sums, F.col("conv_id").eqNullSafe(F.col("c")), "left")
    zero = [F.coalesce(n, F.lit(0)).cast("long").alias(n) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return met.select("conv_id", *zero, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
