"""Connected components of documents whose shingle sets are similar, given signatures that similar sets share.

A method of candidate search gives each set some 64-bit signatures such that two linked sets share at least two of them (surely, or but for a
stated probability).  Equal sets are one class from the start, and only classes are linked.  Signatures are sorted, never gathered: of the classes
that share one, each is paired with the first (a star).  Pairs are first bounded from below by XOR sketches (a bit per hashed shingle,
parity), then verified on the whole sets.

Where a signature's classes still lie in several components, pairs across components are bounded too and verified: first the nearest of each
class, as often as that joins components, at last all that the bound allows.  A signature with more than ``SPLIT_ROWS`` classes is not compared
as a whole: linked classes that share it surely share a second one, so its classes are dealt by pairs of such signatures, and what came together by
chance parts.  A method that promises two signatures only with a probability gives such classes others that linked sets share for certain, so every link
within a frequent signature is found, as within a rare one.  Groups are compared in blocks of ``BLOCK_ROWS``, only across components.  So no link that could join two components is left
out, while the pairs within a component, of which a group of n copies has n squared, are never made.

A document's set: its different ``k``-word shingles as 64-bit hashes; with fewer words the whole sequence as one.  Null and empty texts
and texts without words have an empty set and no links.  Classes go by two 64-bit sums over their shingles, so two different sets among n share
a name with probability n^2 / 2^129.  Repeated rows are in one class.  Where ids repeat, the least id of a component still
names it.  An empty table gives no rows.  Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import free_names, in_batches, raw, small_batches, staged, words
from .components import components
from .filters import C1, C2, C3, KeyFilter, distinct, key_filter, mixed

BLOCK_ROWS = 8192
SPLIT_ROWS = 65_536
SKETCH_BITS = 1
"""Slots of a sketch for each shingle, at least.  With more of them sets just below the similarity asked for are told apart without a look at
them, but every row of a group that is compared carries its sketch."""
CLOSEST = 2
FLUSH_PAIRS = 20_000
NAMES_SEEN = 100_000
"""Classes of which a task remembers that it has sent their signatures."""
Signer = Callable[[np.ndarray], np.ndarray]
"""From the sorted shingle hashes of a set to its signatures as unsigned 64-bit numbers."""


class ShingleSets:
    """Sorted 64-bit shingle hashes of a text.  Hashing a word takes less time than looking it up in a table of words seen."""

    def __init__(self, k: int):
        self.k = k

    def __call__(self, body: bytes) -> np.ndarray:
        found = words(body)
        if not found:
            return np.zeros(0, np.uint64)
        h = np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found))
        k = min(self.k, len(h))
        out = h[:len(h) - k + 1]
        for j in range(1, k):
            out = mixed(out) + h[j:len(h) - k + 1 + j]
        return distinct(mixed(out))


def most_different(total: int, percent: int) -> int:
    """H: the largest symmetric difference of two linked sets with ``total`` shingles in all."""
    return total - 2 * -(-percent * total // (100 + percent))


def set_name(s: np.ndarray) -> tuple[int, int]:
    with np.errstate(over="ignore"):
        n = np.uint64(len(s))
        return tuple(int((mixed(s ^ c).sum(dtype=np.uint64) + n).view(np.int64)) for c in (C2, C1 ^ C3))


def sketch(s: np.ndarray, slots: int = SKETCH_BITS) -> bytes:
    """Parity of shingles in each of 2^b slots, at least ``slots`` (a power of two) for each shingle.  Halving it by XOR gives the shorter sketch."""
    bits = max(64, slots << (len(s) - 1).bit_length())
    odd = np.bincount((mixed(s ^ C3) & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def folded(data: bytes, size: int) -> np.ndarray:
    x = np.frombuffer(data, np.uint8)
    while len(x) > size:
        x = x[:len(x) // 2] ^ x[len(x) // 2:]
    return x


def _named(sets: list[np.ndarray]) -> list[pa.Array]:
    names = [set_name(s) if len(s) else (None, None) for s in sets]
    return [pa.array([n[i] for n in names], pa.int64()) for i in (0, 1)]


def document_sets(docs: DataFrame, k: int, key: str, text: str, sign: Signer | None = None, slots: int = SKETCH_BITS) -> DataFrame:
    """``doc_id, text_hash, n_shingles, n1, n2, sketch`` and, if ``sign`` is given, ``signed`` at rest."""
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), raw(text).alias("body"))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets = ShingleSets(k)
        for batch in batches:
            made = [sets(body) for body in batch.column(2).to_pylist()]
            columns = [batch.column(0), batch.column(1), pa.array([len(s) for s in made], pa.int64()), *_named(made),
                       pa.array([sketch(s, slots) if len(s) else None for s in made], pa.binary())]
            if sign is not None:
                columns.append(pa.array([sign(s).tobytes() if len(s) else None for s in made], pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, names=names)

    names = ["doc_id", "text_hash", "n_shingles", "n1", "n2", "sketch"] + ["signed"] * (sign is not None)
    schema = "doc_id long, text_hash long, n_shingles long, n1 long, n2 long, sketch binary" + ", signed binary" * (sign is not None)
    return staged(in_batches(rows, build, schema), "shingle-sets")


def set_classes(sets: DataFrame) -> DataFrame:
    """``name, n1, n2, least_id, owner, n_shingles, sketch`` (and ``signed``): one row per different set, its number and one row that has it."""
    most = [F.first(c).alias(c) for c in ("n_shingles", "sketch", "signed") if c in sets.columns]
    grouped = sets.where("n1 is not null").groupBy("n1", "n2").agg(
        F.min("doc_id").alias("least_id"), F.min(F.struct("doc_id", "text_hash")).alias("owner"), *most)
    return staged(grouped.withColumn("name", F.monotonically_increasing_id()), "set-classes")


def _signature_rows(found: list[np.ndarray], n1: list[int]) -> pa.RecordBatch:
    names = np.repeat(np.array(n1, np.int64), [len(f) for f in found])
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(found).view(np.int64)), pa.array(names)], names=["signature", "name"])


def signatures_of_classes(classes: DataFrame) -> DataFrame:
    """``signature, name`` (the first half of the class name) from what ``sign`` gave."""
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield _signature_rows([distinct(np.frombuffer(s, np.uint64)) for s in batch.column(1).to_pylist()], batch.column(0).to_pylist())

    return in_batches(classes.select("n1", "signed"), emit, "signature long, name long")


def signatures_of_texts(docs: DataFrame, k: int, sign: Signer, text: str) -> DataFrame:
    """The same from the texts; a task sends a class's signatures once, however many copies it meets."""
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets, seen = ShingleSets(k), set()
        for batch in batches:
            fresh = {}
            for s in map(sets, batch.column(0).to_pylist()):
                if len(s) and (name := set_name(s)[0]) not in seen:
                    seen.add(name)
                    fresh[name] = s
            if fresh:
                yield _signature_rows([distinct(sign(s)) for s in fresh.values()], list(fresh))
            if len(seen) > NAMES_SEEN:
                seen = set()

    return in_batches(docs.select(raw(text).alias("body")), emit, "signature long, name long")


def signatures_of_sets(sets: DataFrame, sign: Signer) -> DataFrame:
    """``signature, name`` of classes given as ``name, shingles``."""
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield _signature_rows([distinct(sign(np.frombuffer(s, np.uint64))) for s in batch.column(1).to_pylist()], batch.column(0).to_pylist())

    return in_batches(sets.select("name", "shingles"), emit, "signature long, name long")


def stars(rows: DataFrame) -> DataFrame:
    """``signature, first, other``: of the names that share a signature, the least and each of the others."""
    def first_with_others(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last_signature = last_name = first = None
        for batch in batches:
            signature, name = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            if not len(signature):
                continue
            new_group = np.empty(len(signature), bool)
            new_group[1:] = signature[1:] != signature[:-1]
            new_group[0] = last_signature is None or signature[0] != last_signature
            new_name = np.empty(len(signature), bool)
            new_name[1:] = name[1:] != name[:-1]
            new_name[0] = last_name is None or name[0] != last_name
            begins = np.maximum.accumulate(np.where(new_group, np.arange(len(signature)), -1))
            firsts = np.where(begins >= 0, name[np.maximum(begins, 0)], first if first is not None else 0)
            other = new_name & ~new_group & (name != firsts)
            if other.any():
                yield pa.RecordBatch.from_arrays([pa.array(x[other]) for x in (signature, firsts, name)], names=["signature", "first", "other"])
            last_signature, last_name, first = signature[-1], name[-1], firsts[-1]

    ordered = rows.repartition("signature").sortWithinPartitions("signature", "name")
    return staged(ordered.mapInArrow(first_with_others, "signature long, first long, other long"), "signature-stars")


def _could_link(percent: int):
    @F.pandas_udf("boolean")
    def could(n1: pd.Series, s1: pd.Series, n2: pd.Series, s2: pd.Series) -> pd.Series:
        out = []
        for a, x, b, y in zip(n1, s1, n2, s2):
            size = min(len(x), len(y))
            apart = int(np.bitwise_count(folded(x, size) ^ folded(y, size)).sum())
            out.append(100 * min(a, b) >= percent * max(a, b) and apart <= most_different(a + b, percent))
        return pd.Series(out, dtype=bool)

    return could


def _linked(percent: int):
    @F.pandas_udf("boolean")
    def linked(s1: pd.Series, s2: pd.Series) -> pd.Series:
        out = []
        for x, y in zip(s1, s2):
            a, b = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            both = len(np.intersect1d(a, b, assume_unique=True))
            out.append(100 * both >= percent * (len(a) + len(b) - both))
        return pd.Series(out, dtype=bool)

    return linked


def _with(pairs: DataFrame, table: DataFrame, column: str, suffix: str) -> DataFrame:
    renamed = table.select(*[F.col(c).alias(column if c == "name" else f"{c}{suffix}") for c in table.columns])
    return pairs.join(renamed, column)


def whole_sets(docs: DataFrame, classes: DataFrame, pairs: DataFrame, k: int, key: str, text: str) -> DataFrame:
    """``name, shingles`` of the classes in the pairs, from the text of one document each.

    A filter over the owners' text hashes keeps all other texts from the shuffle.
    """
    needed = pairs.select(F.col("first").alias("name")).union(pairs.select("other")).distinct()
    owners = staged(classes.join(needed, "name", "left_semi").select("name", "n1", "n2", F.col("owner.doc_id").alias("owner_id"), F.col("owner.text_hash").alias("owner_hash")), "set-owners")
    sent = docs.sparkSession.sparkContext.broadcast(key_filter(owners, "owner_hash").bits)

    @F.pandas_udf("boolean")
    def may_own(hashes: pd.Series) -> pd.Series:
        return pd.Series(KeyFilter(sent.value).may_have(hashes.to_numpy(np.int64).view(np.uint64)))

    bodies = docs.select(F.col(key).cast("long").alias("id"), F.xxhash64(text).alias("hash"), raw(text).alias("body"))
    found = small_batches(bodies).where(may_own("hash")).join(owners, (F.col("hash") == F.col("owner_hash")) & F.col("id").eqNullSafe(F.col("owner_id"))).select("name", "n1", "n2", "body")

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets = ShingleSets(k)
        for batch in batches:
            rows = {name: s.tobytes() for name, n1, n2, body in zip(*(c.to_pylist() for c in batch.columns)) if set_name(s := sets(body)) == (n1, n2)}
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), pa.array(rows.values(), pa.binary())], names=["name", "shingles"])

    made = in_batches(found, build, "name long, shingles binary")
    return staged(made.groupBy("name").agg(F.first("shingles").alias("shingles")), "whole-sets")


class Block:
    """Sketches of classes, by sketch length, to be compared with one class at a time."""

    def __init__(self, rows: list[tuple], percent: int):
        self.percent = percent
        self.by_size: dict[int, tuple] = {}
        for size in {len(r[4]) for r in rows}:
            mine = [r for r in rows if len(r[4]) == size]
            numbers = [np.array([r[i] for r in mine], np.int64) for i in range(4)]
            self.by_size[size] = (*numbers, {size: np.frombuffer(b"".join(r[4] for r in mine), np.uint8).reshape(len(mine), size)})

    def near(self, name: int, label: int, n: int, minor: int, data: bytes) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Distance bounds and names of the classes of other components that may be linked; of two minor classes one asks."""
        for size, (names, labels, sizes, minors, sketches) in self.by_size.items():
            at = np.flatnonzero((labels != label) & ((minors == 0) | (names > name)) & (100 * np.minimum(sizes, n) >= self.percent * np.maximum(sizes, n)))
            if not len(at):
                continue
            least = min(size, len(data))
            if least not in sketches:
                x = sketches[size]
                while x.shape[1] > least:
                    x = x[:, :x.shape[1] // 2] ^ x[:, x.shape[1] // 2:]
                sketches[least] = x
            apart = np.bitwise_count((sketches[least][at] ^ folded(data, least)).view(np.uint64)).sum(axis=1, dtype=np.int64)
            total = sizes[at] + n
            near = apart <= total - 2 * -(-self.percent * total // (100 + self.percent))
            if near.any():
                yield apart[near] / total[near], names[at[near]]


def across(groups: DataFrame, percent: int, closest: int | None) -> DataFrame:
    """``first, other, cut``: pairs of a group that lie in different components and whose sketches allow a link, and whether a class had more of them.

    ``groups``: ``signature, name, label, n_shingles, sketch``.  Only classes outside of the largest component of a group ask, so a group whose
    classes are mostly linked already costs little more than its rows.  Those that ask and all that may answer are cut into blocks of
    ``BLOCK_ROWS``, and each two blocks meet in a task of their own.  With ``closest`` a class keeps so many pairs, the nearest by their sketches.
    """
    sizes = groups.groupBy("signature", "label").agg(F.count(F.lit(1)).alias("n")).groupBy("signature").agg(
        F.sum("n").alias("rows"), F.max("n").alias("most"), F.max_by("label", F.struct("n", "label")).alias("major"))
    blocks = [F.ceil(c / F.lit(BLOCK_ROWS)).cast("int") for c in (F.col("rows"), F.col("rows") - F.col("most"))]
    cut = groups.join(sizes.select("signature", "major", blocks[0].alias("blocks"), blocks[1].alias("asking")), "signature").withColumn(
        "minor", (F.col("label") != F.col("major")).cast("long"))
    own = F.pmod(F.xxhash64("name"), F.col("blocks")).cast("int")
    turn = F.pmod(F.xxhash64("name", F.lit(1)), F.col("asking")).cast("int")

    def places(n: str, make) -> Column:
        return F.transform(F.sequence(F.lit(0), F.col(n) - 1), make)

    answers = places("asking", lambda a: F.struct(a.alias("low"), own.alias("high"), F.lit(False).alias("asks")))
    asks = F.when(F.col("minor") == 1, places("blocks", lambda b: F.struct(turn.alias("low"), b.alias("high"), F.lit(True).alias("asks"))))
    dealt = cut.select("signature", F.inline(F.concat(answers, F.coalesce(asks, F.array().cast("array<struct<low: int, high: int, asks: boolean>>")))),
                       "name", "label", "n_shingles", "minor", "sketch")

    def pairs_of(rows: list[tuple]) -> Iterator[list[tuple[int, int, bool]]]:
        """In lists of bounded length."""
        block = Block([r[4:] for r in rows if not r[3]], percent)
        out: list[tuple[int, int, bool]] = []
        for *_, asking, name, label, n, minor, data in rows:
            found = list(block.near(name, label, n, minor, data)) if asking else []
            if not found:
                continue
            names = np.concatenate([x for _, x in found])
            more = closest is not None and len(names) > closest
            if more:
                names = names[np.argsort(np.concatenate([d for d, _ in found]), kind="stable")[:closest]]
            out += [(min(name, x), max(name, x), more) for x in names.tolist()]
            if len(out) > FLUSH_PAIRS:
                yield out
                out = []
        if out:
            yield out

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def done(rows):
            for found in pairs_of(rows) if len(rows) > 1 else ():
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*found)], names=["first", "other", "cut"])

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if held and row[:3] != held[0][:3]:
                    yield from done(held)
                    held = []
                held.append(row)
        yield from done(held)

    ordered = dealt.repartition("signature", "low", "high").sortWithinPartitions("signature", "low", "high", "name")
    met = in_batches(ordered, compare, "first long, other long, cut boolean")
    return staged(met.groupBy("first", "other").agg(F.bool_or("cut").alias("cut")), "pairs-across")


def mixed_groups(named: DataFrame, split_rows: int | None = None, certain: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """``signature, name, label`` of the signatures, or pairs of a frequent signature and a second one, whose classes lie in several components.

    ``named``: ``signature, name, label`` at rest.  The second one is another frequent signature, if two linked classes surely share two.  Else ``certain``
    gives, for a table of ``name``, at rest ``signature, name`` (other names may be there) such that two linked classes surely share one.
    """
    most = SPLIT_ROWS if split_rows is None else split_rows

    def several(rows: DataFrame) -> DataFrame:
        return rows.groupBy("signature").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.count(F.lit(1)).alias("rows")).where("lo <> hi").select("signature", "rows")

    sizes = staged(several(named), "mixed-signatures")
    few = named.join(sizes.where(F.col("rows") <= most), "signature", "left_semi")
    many = named.join(sizes.where(F.col("rows") > most), "signature", "left_semi")
    if certain is None:
        second = many.select(F.col("signature").alias("second"), "name")
        met = many.join(second, "name").where(F.col("signature") < F.col("second"))
    elif sizes.where(F.col("rows") > most).isEmpty():
        return few
    else:
        owners = staged(many.select("name", "label").distinct(), "frequent-classes")
        finer = certain(owners.select("name")).join(owners, "name")
        second = finer.join(several(finer), "signature", "left_semi").select(F.col("signature").alias("second"), "name")
        met = many.join(second, "name")
    dealt = staged(met.select(F.xxhash64("signature", "second").alias("signature"), "name", "label"), "signature-pairs")
    return few.unionByName(dealt.join(several(dealt), "signature", "left_semi"))


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    met = _with(_with(pairs, sets, "other", "_o"), sets, "first", "_f")
    return staged(small_batches(met).where(_linked(percent)("shingles_o", "shingles_f")).select("first", "other"), "verified-links")


def linked_components(docs: DataFrame, sets: DataFrame, classes: DataFrame, signatures: DataFrame, k: int, percent: int, key: str, text: str,
                      signer: Callable[[], Signer] | None = None) -> DataFrame:
    """For every row the key, ``text_hash, n_shingles, component`` (a number, null for empty sets) and ``component_id``, the least id reachable by links.

    ``signer``: if linked sets share two of the ``signatures`` only with a probability, makes signatures of which they share one for certain.
    """
    made: list[DataFrame] = []

    def certain(names: DataFrame) -> DataFrame:
        """Once: as components merge, fewer signatures are mixed, so later rounds ask for some of the same names."""
        if not made:
            same = names.select(F.col("name").alias("first"), F.col("name").alias("other"))
            made.append(staged(signatures_of_sets(whole_sets(docs, classes, same, k, key, text), signer()), "certain-signatures"))
        return made[0]

    star = stars(signatures)
    narrow = classes.select("name", "n_shingles", "sketch")
    by_half = classes.select("n1", "name")
    pairs = star.select("first", "other").distinct()
    for side in ("first", "other"):
        pairs = pairs.withColumnRenamed(side, "n1").join(by_half, "n1").drop("n1").withColumnRenamed("name", side)
    near = _with(_with(pairs, narrow, "other", "_o"), narrow, "first", "_f")
    near = staged(small_batches(near).where(_could_link(percent)("n_shingles_o", "sketch_o", "n_shingles_f", "sketch_f")).select("first", "other"), "near-pairs")
    links = _verified(near, whole_sets(docs, classes, near, k, key, text), percent)
    labels = staged(components(links), "labels")
    members = star.select("signature", F.col("other").alias("n1")).union(star.select("signature", "first")).distinct()
    members = staged(members.join(by_half, "n1").select("signature", "name"), "signature-members")
    closest: int | None = CLOSEST
    while True:
        named = staged(members.join(labels, members["name"] == labels["node"], "left").select("signature", "name", F.coalesce("component", "name").alias("label")), "labelled-members")
        found = across(mixed_groups(named, certain=signer and certain).join(narrow, "name"), percent, closest)
        if found.isEmpty():
            break
        pairs = found.select("first", "other")
        new = _verified(pairs, whole_sets(docs, classes, pairs, k, key, text), percent)
        merged = not new.isEmpty()
        if merged:
            links = links.unionByName(new)
            labels = staged(components(links), "labels")
        if closest is None or found.where("cut").isEmpty():
            break  # no pair was left out
        closest = CLOSEST if merged else None  # the nearest have nothing more to link: all that may be linked are looked at
    named = classes.select("name", "n1", "n2", "least_id").join(labels, F.col("name") == F.col("node"), "left").select(
        "n1", "n2", "least_id", F.coalesce("component", "name").alias("label"))
    least = named.groupBy("label").agg(F.min("least_id").alias("component_id"))
    ids = named.join(least, "label").select("n1", "n2", F.col("label").alias("component"), "component_id")
    return sets.join(ids, ["n1", "n2"], "left").select(
        F.col("doc_id").alias(key), "text_hash", "n_shingles", "component", F.coalesce("component_id", "doc_id").alias("component_id"))


def one_row_each(docs: DataFrame, found: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` without near copies: of each component the row with the least (id, text hash), nulls last, and rows with an empty set.

    ``found`` as ``linked_components`` gives it.  Rows go by id and text hash, so rows that share an id are told apart and rows without one take
    part; of rows that agree in both, the first by their other columns stays.
    """
    own, own_hash, n, sign = free_names(docs, "id", "hash", "n", "mark")
    pairs = staged(found.where("component is not null").groupBy("component", F.col(key).alias(own), F.col("text_hash").alias(own_hash)).agg(
        F.count(F.lit(1)).alias(n)), "component-rows")
    place = F.struct(F.col(own).isNull(), own, own_hash)
    best = pairs.groupBy("component").agg(F.min(place).alias("best"))
    mark = F.when(place.eqNullSafe(F.col("best")), F.when(F.col(n) > 1, "once")).otherwise("drop")
    marks = staged(pairs.join(best, "component").select(own, own_hash, mark.alias(sign)).where(F.col(sign).isNotNull()), "copy-marks")
    same = F.col(key).eqNullSafe(F.col(own)) & (F.xxhash64(text) == F.col(own_hash))
    others = docs.join(marks, same, "left_anti")
    repeated = docs.join(marks.where(F.col(sign) == "once"), same).withColumn(
        n, F.row_number().over(Window.partitionBy(own, own_hash).orderBy(*[c for c in docs.columns if c not in (key, text)], F.lit(0))))
    return others.unionByName(repeated.where(F.col(n) == 1).select(*docs.columns))


def components_sql(k: int, percent: int, more: str = "") -> str:
    """The same for DuckDB: all pairs of different sets that share a shingle, and reachability by recursion."""
    return f"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (
  SELECT doc_id, list_sort(list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {k} THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(len(w) - {k} + 1), lambda i: array_to_string(w[i + 1:i + {k}], ' ')) END)) AS g FROM d),
c AS (SELECT min(doc_id) AS c, g, len(g) AS n FROM s WHERE len(g) > 0 GROUP BY g),
e AS (SELECT c, n, unnest(g) AS x FROM c),
l AS (SELECT a.c AS a, b.c AS b FROM e a JOIN e b ON a.x = b.x AND a.c <> b.c GROUP BY a.c, b.c, a.n, b.n HAVING 100 * count(*) >= {percent} * (a.n + b.n - count(*))),
r AS (SELECT c AS a, c AS b FROM c UNION SELECT r.a, l.b FROM r JOIN l ON l.a = r.b),
m AS (SELECT a, min(b) AS least FROM r GROUP BY a),
o AS (SELECT s.doc_id, CAST(len(s.g) AS BIGINT) AS n_shingles, coalesce(m.least, s.doc_id) AS component_id
  FROM s LEFT JOIN c ON c.g = s.g LEFT JOIN m ON m.a = c.c)
SELECT *{more} FROM o
"""
