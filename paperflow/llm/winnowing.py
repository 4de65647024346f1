"""Document fingerprints by winnowing, with DataFrame functions only.

A text's words lie between white space; in scripts written without spaces every character is a word.  Each run of ``k``
words has a 32-bit hash (a shorter text has one run).  From every ``w`` runs in a row the least hash is chosen, of equal ones the
rightmost, and kept with its place.  So two texts that share ``w + k - 1`` words in a row share a chosen hash.  Places count
modulo 2^24 words.  The fingerprint reads ``hash@place hash@place ...``; likeness is the Jaccard index of the hashes.

Texts without words have an empty fingerprint; two of them are alike (1.0), one of them and any other are not (0.0).  Null texts
count as empty.  Rows alike in id and text count as one document in the order and each gets its row.  A null id is the
smallest.  A lone document is its own next one.  An empty table gives no rows.  Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import staged

K, W = 5, 8
PLACES = (1 << 24) - 1
UNSPACED = r"([\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}])"


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def chosen(text: Column, k: int = K, w: int = W) -> Column:
    """The chosen hashes with their places, packed as hash * 2^24 + (2^24 - 1 - place), in text order."""
    none = F.array().cast("array<bigint>")

    def packed(h: Column, place: Column) -> Column:
        return F.shiftleft(F.shiftrightunsigned(h, 32), 24).bitwiseOR(F.lit(PLACES).cast("long") - place.cast("long").bitwiseAND(F.lit(PLACES).cast("long")))

    def runs(hashes: Column) -> Column:
        n = F.size(hashes)
        return F.when(n == 0, none).when(n < k, F.array(packed(F.xxhash64(hashes), F.lit(0)))).otherwise(
            F.transform(F.sequence(F.lit(0), n - k), lambda i: packed(F.xxhash64(*[F.get(hashes, i + j) for j in range(k)]), i)))

    def least(found: Column, size: int = 1) -> Column:
        """Least of every ``w`` in a row, by doubling: that of 2 in a row, of 4, and so on."""
        if size == w:
            return F.array_distinct(found)
        step = min(size, w - size)
        pairs = F.transform(F.sequence(F.lit(0), F.size(found) - 1 - step), lambda i: F.least(F.get(found, i), F.get(found, i + step)))
        return bind(pairs, lambda wider: least(wider, size + step))

    def windows(found: Column) -> Column:
        n = F.size(found)
        return F.when(n == 0, found).when(n <= w, F.array(F.array_min(found))).otherwise(least(found))

    spaced = F.when(F.rlike(text, F.lit(UNSPACED)), F.regexp_replace(text, UNSPACED, "$1 ")).otherwise(text)
    words = F.array_remove(F.split(spaced, r"\s+", -1), "")
    return bind(F.transform(words, lambda x: F.xxhash64(x)), lambda hashes: bind(runs(hashes), windows))


def hash_set(picks: Column) -> Column:
    return F.array_distinct(F.transform(picks, lambda p: (F.shiftright(p, 24) - (1 << 31)).cast("int")))


def written(picks: Column) -> Column:
    return F.array_join(F.transform(picks, lambda p: F.concat(
        F.lower(F.hex(F.shiftright(p, 24))), F.lit("@"), (F.lit(PLACES) - p.bitwiseAND(F.lit(PLACES).cast("long"))).cast("string"))), " ")


def likeness(a: Column, b: Column) -> Column:
    both, total = F.size(F.array_intersect(a, b)), F.size(a) + F.size(b)
    return F.when(total == 0, 1.0).otherwise(both / (total - both))


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = K, w: int = W) -> DataFrame:
    """``key, fingerprint, hashes`` for every row."""
    rows = docs.select(key, chosen(F.coalesce(F.col(text), F.lit("")), k, w).alias("picks"))
    return rows.select(key, written(F.col("picks")).alias("fingerprint"), hash_set(F.col("picks")).alias("hashes"))


def _followers(docs: DataFrame) -> DataFrame:
    """For each different document the id and text hash of the one before it in descending order, and that one's length.

    The order is a range partitioning: places within partitions, and the partitions' sizes summed up.
    """
    ids = docs.select("id", "h", "n_chars").distinct()
    ordered = ids.repartitionByRange(F.col("id").desc_nulls_last(), F.col("h")).sortWithinPartitions(F.col("id").desc_nulls_last(), "h")
    placed = staged(ordered.withColumn("at", F.monotonically_increasing_id()), "document-order").select(
        "id", "h", "n_chars", F.shiftright("at", 33).alias("part"), F.col("at").bitwiseAND(F.lit((1 << 33) - 1)).alias("seq"))
    parts = placed.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    starts = parts.select("part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("start"),
                          F.sum("n").over(Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("total"))
    ranked = placed.join(F.broadcast(starts), "part").select("id", "h", "n_chars", (F.col("start") + F.col("seq")).alias("rank"), "total")
    before = ranked.select(((F.col("rank") + 1) % F.col("total")).alias("rank"), F.col("id").alias("to_id"), F.col("h").alias("to_h"),
                           F.col("n_chars").alias("to_chars"))
    return ranked.select("id", "h", "rank").join(before, "rank").drop("rank")


def edited_likeness(docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = K, w: int = W) -> DataFrame:
    """Fingerprints of each text and of its edited text, whose last half is replaced by the start of the next one's.

    One shuffle of the texts; the half that the one before needs and the hashes go once more.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(key).alias("id"), body.alias("text")).withColumn("h", F.xxhash64("text"))
    follow = _followers(rows.select("id", "h", F.char_length("text").alias("n_chars")))
    same = F.col("f.id").eqNullSafe(F.col("t.id")) & (F.col("f.h") == F.col("t.h"))
    given = rows.alias("t").join(follow.alias("f"), same).select(
        F.col("to_id").alias("id"), F.col("to_h").alias("h"), F.left(F.col("t.text"), F.expr("to_chars div 2").cast("int")).alias("half"),
        hash_set(chosen(F.col("t.text"), k, w)).alias("next_hashes"))
    given = given.groupBy("id", "h").agg(F.first("half").alias("half"), F.first("next_hashes").alias("next_hashes"))
    met = rows.alias("t").join(given.alias("f"), same).select("t.id", "t.text", "half", "next_hashes")
    n = F.char_length("text")
    texts = met.select("id", n.cast("long").alias("n_chars"), "next_hashes", "text",
                       F.concat(F.left("text", (n - F.expr("char_length(text) div 2")).cast("int")), "half").alias("edited"))
    picked = texts.select("id", "n_chars", "next_hashes", F.sha2("edited", 256).alias("edited_sha256"), F.array(
        chosen(F.col("text"), k, w), chosen(F.col("edited"), k, w)).alias("p"))

    def row(p: Column) -> Column:
        own, other = F.get(p, F.lit(0)), F.get(p, F.lit(1))
        return bind(hash_set(own), lambda mine: F.struct(
            written(own).alias("fingerprint"), written(other).alias("edited_fingerprint"),
            likeness(mine, hash_set(other)).alias("near_edited"), likeness(mine, F.col("next_hashes")).alias("near_next")))

    return picked.select("id", "n_chars", "edited_sha256", bind(F.col("p"), row).alias("r")).select(
        F.col("id").alias(key), "n_chars", "edited_sha256", "r.*")
