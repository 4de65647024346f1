"""From raw documents to packed token sequences in five stages.

Every stage takes all that its predecessor kept and, but for the last, returns the columns of ``documents``.  Documents are dropped by
the quality classifier (below an even chance of the top grade), by line dedup (nothing left but blank lines after
removal), by the near-duplicate join (all but one of each group of 5-word shingle sets of similarity 0.8 or more) and by
decontamination.  Each case of nulls, empty texts, ties and repeated rows is as the operator's module says.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperflow.llm import decontamination, jaccard, lines, packing, quality
from paperflow.llm.common import staged, table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    return quality.select_good(docs, table(spark, sf_dir, "labels"), into="__grade").select(*COLUMNS)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without cross-site boilerplate: long lines on two sites, others on ten.  A document that had only such lines goes; ``n_chars`` follows the text."""
    clean = lines.remove_boilerplate(docs, long_chars=lines.LONG_CHARS)
    changed = F.col("n_removed") > 0
    return clean.where(~changed | (F.trim(F.regexp_replace("text", "\\s", "")) != "")).withColumn(
        "n_chars", F.when(changed, F.char_length("text")).otherwise(F.col("n_chars"))).select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the row with the least id and, among rows of that id, text hash; null ids come last."""
    return jaccard.drop_near_copies(docs, k=5, percent=80).select(*COLUMNS)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any passage of a benchmark item."""
    return decontamination.drop_leaked(docs, table(spark, sf_dir, "benchmark")).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences of at most 4096 tokens."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality_classifier", classify),
    ("line_dedup", dedup_lines),
    ("ngram_jaccard_join", drop_near_copies),
    ("benchmark_decontamination", decontaminate),
    ("best_fit_packing", pack),
]

ORACLE_SQL = None
"""No SQL states the classifier; tests hold each stage against brute force."""


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
