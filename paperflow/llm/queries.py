"""The corpus operators as queries over whole tables, each with its SQL twin where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import conversations, decontamination, divergence, id_store, jaccard, licenses, lines, linking, minhash, packing, quality, sharding, suffix_tree, winnowing
from .common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign_shards(table(spark, sf_dir, "documents"))


SQL["op1_sharding"] = sharding.SQL


@query
def op2_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_tree.score_documents(table(spark, sf_dir, "documents"))


@query
def op3_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar_components(table(spark, sf_dir, "documents"), k=3, percent=90)


SQL["op3_jaccard"] = linking.components_sql(3, 90)


@query
def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


@query
def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The selected documents with their grades."""
    kept = quality.select_good(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"))
    return kept.select("doc_id", kept["grade"]["expected"].alias("expected_grade"), kept["grade"]["tail"].alias("tail_probability"))


@query
def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.remove_boilerplate(table(spark, sf_dir, "documents").select("doc_id", "text", "source")).drop("source")


SQL["op7_line_dedup"] = lines.SQL


@query
def op8_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return id_store.store_and_read(table(spark, sf_dir, "documents"))


@query
def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


@query
def op10_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnowing.edited_likeness(table(spark, sf_dir, "documents"))


@query
def op11_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


SQL["op11_minhash"] = minhash.SQL


@query
def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repaired_digests(table(spark, sf_dir, "conversations"))


@query
def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.source_divergences(table(spark, sf_dir, "documents"))


SQL["op13_divergence"] = divergence.SQL
