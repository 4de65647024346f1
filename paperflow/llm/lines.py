"""Cross-site boilerplate: lines found on many distinct sites go, but for the first document that has them.

Each distinct line gets a HyperLogLog sketch of its sites, merged by aggregation.  Only lines whose estimate lies within the
sketch's error of the threshold have their sites counted exactly; for them and no others the distinct (line, site) pairs are
shuffled.  A line is known by two 64-bit hashes.  A line found on ``min_sites`` sites or more is removed from every document but
the one with the smallest id, so one copy of whatever repeats stays.  With ``long_chars`` a line of that many characters goes from two
sites on, which the least and the greatest site of the line tell exactly.

Blank lines are never removed and count for nothing.  Null texts stay null, null sites are not sites.  Wholly repeated rows are
treated alike.  A document may lose all lines; its text is then empty.  An empty table gives no rows.  Other columns pass
through, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import free_names, staged

MIN_SITES = 10
LONG_CHARS = 40
LG_K = 12
ERROR = 0.05
"""Three times the standard error of a sketch with 2^12 slots."""


def site_lines(docs: DataFrame, key: str, text: str, site: str, long_chars: int | None = None) -> DataFrame:
    """One narrow row per line that is not blank: hashes, document, place, site, whether it is long."""
    long = F.lit(False) if long_chars is None else F.char_length(F.trim("line")) >= long_chars
    rows = docs.select(F.col(key).alias("key"), F.xxhash64(text).alias("text_hash"), F.col(site).alias("site"),
                       F.posexplode(F.split(text, "\n", -1)).alias("pos", "line")).where(F.trim("line") != "")
    return rows.select("key", "text_hash", "site", "pos", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), "line").alias("h2"),
                       long.alias("long"))


def boilerplate(lines: DataFrame, min_sites: int = MIN_SITES, lg_k: int = LG_K, error: float = ERROR, long: bool = False) -> DataFrame:
    """Hashes of the lines on at least ``min_sites`` sites, with ``long`` those marked so on two, with the id of the document that keeps them."""
    two = F.max("long") & (F.min("site") < F.max("site")) if long else F.lit(False)
    margin = max(1.0, error * min_sites)
    sketched = lines.groupBy("h1", "h2").agg(F.hll_sketch_agg("site", lg_k).alias("sites"), F.min("key").alias("keeper"),
                                           two.alias("spread"))
    spread = staged(sketched.select("h1", "h2", "keeper", F.coalesce("spread", F.lit(False)).alias("spread"), F.hll_sketch_estimate("sites").alias("estimate"))
                    .where(F.col("spread") | (F.col("estimate") >= min_sites - margin)), "line-spread")
    near = spread.where(~F.col("spread") & (F.col("estimate") <= min_sites + margin))
    exact = (lines.select("h1", "h2", "site").where("site is not null").join(near.select("h1", "h2"), ["h1", "h2"], "left_semi").distinct()
             .groupBy("h1", "h2").count().where(F.col("count") >= min_sites))
    counted = near.join(exact.select("h1", "h2"), ["h1", "h2"], "left_semi")
    return spread.where(F.col("spread") | (F.col("estimate") > min_sites + margin)).select("h1", "h2", "keeper").unionByName(counted.select("h1", "h2", "keeper"))


def remove_boilerplate(docs: DataFrame, key: str = "doc_id", text: str = "text", site: str = "source",
                       min_sites: int = MIN_SITES, long_chars: int | None = None) -> DataFrame:
    """The documents with clean text in place of ``text``, and ``n_lines`` and ``n_removed`` appended."""
    lines = site_lines(docs, key, text, site, long_chars)
    flagged = staged(boilerplate(lines, min_sites, long=long_chars is not None), "boilerplate-lines")
    hits = lines.join(flagged, ["h1", "h2"]).where(~F.col("key").eqNullSafe(F.col("keeper")))
    own, own_hash, lost = free_names(docs, "key", "text_hash", "gone")
    gone = hits.groupBy(F.col("key").alias(own), F.col("text_hash").alias(own_hash)).agg(F.collect_set("pos").alias(lost))
    same = F.col(key).eqNullSafe(F.col(own)) & (F.xxhash64(text) == F.col(own_hash))
    joined = docs.join(gone, same, "left")
    parts = F.split(text, "\n", -1)
    kept = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), F.col(lost))
    clean = F.when(F.col(lost).isNull(), F.col(text)).otherwise(F.array_join(F.transform(kept, lambda k: F.get(parts, k)), "\n"))
    counts = {"n_lines": F.coalesce(F.size(parts), F.lit(0)), "n_removed": F.coalesce(F.size(lost), F.lit(0))}
    others = [c for c in docs.columns if c not in counts]
    return joined.select(*[clean.alias(c) if c == text else F.col(c) for c in others],
                         *[F.when(F.col(text).isNull(), F.lit(0)).otherwise(v).cast("long").alias(k) for k, v in counts.items()])


SQL = f"""
WITH l AS (
  SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos
  FROM documents WHERE text IS NOT NULL),
b AS (
  SELECT line, min(doc_id) AS keeper FROM l WHERE trim(line) <> '' GROUP BY line HAVING count(DISTINCT source) >= {MIN_SITES}),
k AS (
  SELECT l.doc_id, string_agg(l.line, chr(10) ORDER BY pos) FILTER (WHERE b.line IS NULL OR b.keeper = l.doc_id) AS text,
         count(*) AS n_lines, count(*) FILTER (WHERE b.line IS NOT NULL AND b.keeper <> l.doc_id) AS n_removed
  FROM l LEFT JOIN b USING (line) GROUP BY l.doc_id)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(k.text, '') END AS text,
       coalesce(k.n_lines, 0) AS n_lines, coalesce(k.n_removed, 0) AS n_removed
FROM documents d LEFT JOIN k ON k.doc_id = d.doc_id
"""
