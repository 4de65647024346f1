"""Keyword buckets: hit counts, best bucket, roll-ups by bucket and badge."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import fixed_values as V
from ..functions.text import once, text_or_empty

Dictionary = tuple[tuple[str, tuple[str, ...]], ...]


def paper_text(title: Column, abstract: Column, subjects: Column) -> Column:
    return F.lower(F.concat_ws(" ", text_or_empty(title), text_or_empty(abstract), text_or_empty(subjects)))


def hit_columns(text: str, buckets: Dictionary = V.BUCKETS) -> list[Column]:
    """Per bucket, how many distinct keywords occur as substrings of the lower-cased column ``text``.

    Written as SQL text: one expression per bucket instead of three calls per keyword.
    """
    def literal(word: str) -> str:
        return "'" + word.replace("\\", "\\\\").replace("'", "\\'") + "'"

    return [
        F.expr(" + ".join(f"int(contains(`{text}`, {literal(k)}))" for k in keywords))
        for _, keywords in buckets
    ]


def hits_in_batches(text: Column, buckets: Dictionary = V.BUCKETS) -> Column:
    """The array of hit counts through Arrow batches of texts and Python's substring search."""
    words = [list(keywords) for _, keywords in buckets]

    def count(texts: pd.Series) -> pd.Series:
        return pd.Series([None if t is None else [sum(k in t for k in ks) for ks in words] for t in texts])

    return F.pandas_udf(count, T.ArrayType(T.IntegerType()))(text)


def with_hits(df: DataFrame, text: Column, buckets: Dictionary = V.BUCKETS, out: str = "hits",
              batches: bool = True) -> DataFrame:
    """Adds the array of hit counts in dictionary order; narrow, no shuffle.  A null text has a null array.

    Arrow batches by default: on 24.8 M characters, 92 keywords and 8 cores they took 0.25 s, transfer
    included, and the built-in ``contains`` of ``batches=False`` 1.2 s.
    """
    if batches:
        # `once` again: a filter on the bucket would otherwise run the batches a second time
        return once(df.withColumn("_hits_raw", hits_in_batches(text, buckets)), **{out: F.col("_hits_raw")}).drop("_hits_raw")
    lowered = once(df, _text=text)
    counted = once(lowered, **{f"_h{i}": c for i, c in enumerate(hit_columns("_text", buckets))})
    parts = [f"_h{i}" for i in range(len(buckets))]
    return counted.withColumn(out, F.when(F.col("_text").isNotNull(), F.array(*parts))).drop("_text", *parts)


def best_bucket(hits: Column, buckets: Dictionary = V.BUCKETS) -> Column:
    """Most hits; a tie goes to the earlier bucket; no hit gives an empty string."""
    top = F.array_max(hits)
    names = F.array(*[F.lit(name) for name, _ in buckets])
    return F.when(top > 0, F.element_at(names, F.array_position(hits, top).cast("int"))).otherwise(F.lit(""))


def assign_bucket(df: DataFrame, text: Column, buckets: Dictionary = V.BUCKETS) -> DataFrame:
    return with_hits(df, text, buckets, "_hits").withColumn("bucket", best_bucket(F.col("_hits"), buckets)).drop("_hits")


def bucket_table(spark: SparkSession, buckets: Dictionary = V.BUCKETS) -> DataFrame:
    rows = [(i, name) for i, (name, _) in enumerate(buckets)]
    return spark.createDataFrame(rows, "bucket_rank INT, bucket STRING")


def keyword_table(spark: SparkSession, buckets: Dictionary = V.BUCKETS) -> DataFrame:
    rows = [(i, name, k) for i, (name, words) in enumerate(buckets) for k in words]
    return spark.createDataFrame(rows, "bucket_rank INT, bucket STRING, keyword STRING")


DICTIONARY_BYTES = 4 << 20


def _hits_by_automaton(text: Column, words: list[tuple[int, str]], n_buckets: int) -> Column:
    """The automaton is built once a task and used for all its batches."""
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        import ahocorasick  # here, so that the function travels by value

        found = ahocorasick.Automaton()
        buckets: dict[str, list[int]] = {}
        for bucket, word in words:
            buckets.setdefault(word, []).append(bucket)
        for word, where in buckets.items():
            found.add_word(word, (word, where))
        found.make_automaton()

        def one(t: str | None) -> list[int] | None:
            if t is None:
                return None
            hits = [0] * n_buckets
            for _, where in dict(x for _, x in found.iter(t)).items():
                for bucket in where:
                    hits[bucket] += 1
            return hits

        for texts in batches:
            yield texts.map(one)

    return F.pandas_udf(count, T.ArrayType(T.IntegerType()))(text)


def assign_bucket_large(df: DataFrame, text: Column, keywords: DataFrame, dictionary_bytes: int = DICTIONARY_BYTES) -> DataFrame:
    """The same result for a dictionary of many thousand keywords: ``keywords`` has ``bucket_rank, bucket, keyword``.

    One automaton finds all keywords in one pass over a text, so neither texts nor their parts are shuffled or joined.  The
    keywords are dealt by hash into parts of about ``dictionary_bytes`` bytes, each sent to the tasks and counted in a step
    of its own, so what is sent is bounded and a larger dictionary costs more steps.  Empty keywords do not count.
    """
    entries = keywords.select("bucket_rank", "bucket", "keyword").where(F.char_length("keyword") > 0).distinct()
    names = [r["bucket"] for r in keywords.select("bucket_rank", "bucket").distinct().orderBy("bucket_rank", "bucket").collect()]
    if not names:
        return df.withColumn("bucket", F.lit(""))
    places = {name: i for i, name in enumerate(names)}
    size = entries.agg(F.sum(F.octet_length("keyword") + 16)).head()[0] or 0
    parts = max(1, -(-size // dictionary_bytes))
    out = df.withColumn("_text", text)
    for part in range(parts):
        rows = entries.where(F.pmod(F.xxhash64("keyword"), F.lit(parts)) == part).collect()
        if rows:
            out = out.withColumn(f"_part{part}", _hits_by_automaton(F.col("_text"), sorted((places[r["bucket"]], r["keyword"]) for r in rows), len(names)))
    counted = [c for c in out.columns if c.startswith("_part")]
    hits = [sum((F.get(c, i) for c in counted[1:]), F.get(counted[0], i)) for i in range(len(names))] if counted else [F.lit(0)] * len(names)
    out = once(out.drop("_text"), _hits=F.array(*[F.coalesce(h, F.lit(0)) for h in hits]))
    return out.withColumn("bucket", best_bucket(F.col("_hits"), tuple((n, ()) for n in names))).drop("_hits", *counted)


def totals(papers: DataFrame) -> DataFrame:
    """Papers after dedup, and how many of them have a bucket."""
    return papers.agg(F.count("*").alias("total"), F.count_if(F.col("bucket") != "").alias("selected"))


def bucket_badge_counts(papers: DataFrame) -> DataFrame:
    """Non-zero counts by bucket and badge."""
    return papers.where(F.col("bucket") != "").groupBy("bucket", "badge").agg(F.count("*").alias("n"))


def document_summary(papers: DataFrame, buckets: Dictionary = V.BUCKETS) -> DataFrame:
    """One row per dictionary bucket, empty ones included: rank, total, ``badge:n`` pairs by badge,
    and the whole document's total and selected count on every row.

    Papers shrink to buckets x badges counts in the first aggregate, the unbucketed ones
    among them; everything after that is small.
    """
    counts = papers.groupBy("bucket", "badge").agg(F.count("*").alias("n"))
    pairs = F.sort_array(F.collect_list(F.struct("badge", "n")))
    per_bucket = counts.groupBy("bucket").agg(F.sum("n").alias("total"), pairs.alias("_pairs"))
    everything = W.partitionBy()
    dimension = bucket_table(papers.sparkSession, buckets)
    joined = per_bucket.join(dimension, "bucket", "full_outer")
    badge_text = F.array_join(F.transform("_pairs", lambda x: F.concat_ws(":", x["badge"], x["n"].cast("string"))), " ")
    rows = joined.select(
        "bucket_rank", "bucket", F.coalesce("total", F.lit(0)).cast("bigint").alias("total"),
        F.coalesce(badge_text, F.lit("")).alias("by_badge"))
    rows = rows.withColumn("doc_total", F.sum("total").over(everything)).withColumn(
        "doc_selected", F.sum(F.when(F.col("bucket") != "", F.col("total")).otherwise(0)).over(everything))
    return rows.where(F.col("bucket_rank").isNotNull())


def bucket_summary(papers: DataFrame, buckets: Dictionary = V.BUCKETS) -> DataFrame:
    """One row per dictionary bucket: rank, total and ``badge:n`` pairs by badge."""
    return document_summary(papers, buckets).drop("doc_total", "doc_selected")
