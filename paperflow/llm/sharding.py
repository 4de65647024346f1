"""Extendible hashing: shards are hash prefixes, and only a bucket over its byte limit is split on one more bit.

The shard of a row is its shortest hash prefix whose rows together hold at most ``limit`` bytes.  The directory is built
from aggregated cells, never from rows: a first depth from the total size, then only cells still over the limit are
counted at more bits.  A bucket of one single hash value cannot be split; it is kept whole and marked ``oversized`` if it
is over the limit (one huge document, or rows that share one key).

A null key hashes like an empty one.  Null texts have 0 bytes.  Repeated rows stay together and count each.  An empty table
gives an empty directory and no rows.  Only the key and the text's size are read.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import staged

BITS = 60
LIMIT = 1 << 20
FIRST_EXTRA, STEP = 3, 4


def key_hash(key: str | Column) -> Column:
    """60 bits of the MD5 of the key as text."""
    text = F.coalesce((F.col(key) if isinstance(key, str) else key).cast("string"), F.lit(""))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def _prefix(h: str, depth: Column | int) -> Column:
    return F.expr(f"shiftright({h}, cast({BITS} - {depth} as int))") if isinstance(depth, int) else F.call_function("shiftright", F.col(h), (F.lit(BITS) - depth).cast("int"))


def _settled_cells(rows: DataFrame, limit: int, low: int, high: int) -> DataFrame:
    """For each cell at depth ``high``: the least depth from ``low`` on at which its bucket fits, or null."""
    cells = rows.groupBy(_prefix("h", high).alias("cell")).agg(
        F.sum("n_bytes").alias("b"), F.count(F.lit(1)).alias("n"), F.min("h").alias("lo"), F.max("h").alias("hi"))
    up = cells.withColumn("depth", F.explode(F.sequence(F.lit(low), F.lit(high))))
    up = up.withColumn("prefix", F.call_function("shiftright", "cell", (F.lit(high) - F.col("depth")).cast("int")))
    buckets = up.groupBy("depth", "prefix").agg(F.sum("b").alias("shard_bytes"), F.sum("n").alias("shard_docs"),
                                                F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    fitting = buckets.where((F.col("shard_bytes") <= limit) | (F.col("lo") == F.col("hi"))).drop("lo", "hi")
    best = up.select("cell", "depth", "prefix").join(fitting, ["depth", "prefix"], "left").groupBy("cell").agg(
        F.min(F.when(F.col("shard_bytes").isNotNull(), F.struct("depth", "prefix", "shard_bytes", "shard_docs"))).alias("leaf"))
    return best


def assign_shards(rows: DataFrame, key: str = "doc_id", text: str = "text", limit: int = LIMIT) -> DataFrame:
    """``key, n_bytes, shard`` (its prefix bits as text), ``depth, shard_bytes, shard_docs, oversized``."""
    narrow = staged(rows.select(F.col(key).alias("key"), F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"),
                                key_hash(key).alias("h")), "shard-keys")
    total = narrow.agg(F.sum("n_bytes")).head()[0] or 0
    low, high = 0, min(BITS, max(0, math.ceil(math.log2(max(1, total / limit)))) + FIRST_EXTRA)
    placed, left = [], narrow
    while True:
        cells = staged(_settled_cells(left, limit, low, high), "shard-cells")
        mapped = left.withColumn("cell", _prefix("h", high)).join(cells, "cell")
        placed.append(mapped.where("leaf is not null").select("key", "n_bytes", "leaf.*"))
        if cells.where("leaf is null").isEmpty():
            break
        left = staged(mapped.where("leaf is null").select("key", "n_bytes", "h"), "shard-split")
        low, high = high + 1, min(BITS, high + STEP)
    return reduce(DataFrame.unionByName, placed).select(
        F.col("key").alias(key), "n_bytes", F.expr("lpad(bin(prefix), depth, '0')").alias("shard"), "depth", "shard_bytes", "shard_docs",
        (F.col("shard_bytes") > limit).alias("oversized"))


def directory(assigned: DataFrame) -> DataFrame:
    """One row per shard."""
    return assigned.groupBy("shard").agg(F.first("depth").alias("depth"), F.first("shard_bytes").alias("shard_bytes"),
                                         F.first("shard_docs").alias("shard_docs"), F.first("oversized").alias("oversized"))


def write_shards(rows: DataFrame, assigned: DataFrame, path: str, key: str = "doc_id") -> None:
    """One folder per shard; an oversized shard is spread over several files."""
    named = rows.join(assigned.select(F.col(key).alias("shard_key"), "shard").distinct(), F.col(key).eqNullSafe(F.col("shard_key"))).drop("shard_key")
    named.hint("rebalance", "shard").write.partitionBy("shard").parquet(path)


SQL = f"""
WITH d AS (
  SELECT doc_id, coalesce(strlen(text), 0) AS n_bytes,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS h
  FROM documents),
b AS (
  SELECT k.depth, d.h >> ({BITS} - k.depth) AS prefix, sum(n_bytes) AS shard_bytes, count(*) AS shard_docs, min(h) AS lo, max(h) AS hi
  FROM d, (SELECT CAST(range AS INTEGER) AS depth FROM range(0, {BITS + 1})) k GROUP BY 1, 2),
leaf AS (
  SELECT d.doc_id, d.n_bytes, d.h, min(b.depth) AS depth
  FROM d JOIN b ON b.prefix = d.h >> ({BITS} - b.depth)
  WHERE b.shard_bytes <= {LIMIT} OR b.lo = b.hi GROUP BY 1, 2, 3)
SELECT leaf.doc_id, CAST(leaf.n_bytes AS BIGINT) AS n_bytes, lpad(bin(b.prefix), b.depth, '0') AS shard, leaf.depth,
       CAST(b.shard_bytes AS BIGINT) AS shard_bytes, b.shard_docs, b.shard_bytes > {LIMIT} AS oversized
FROM leaf JOIN b ON b.depth = leaf.depth AND b.prefix = leaf.h >> ({BITS} - leaf.depth)
"""
