"""Counts by day and category kept up to date from arriving day documents, without counting again what has not changed.

A day document states a day's counts; a later generation of the day replaces an earlier one, whatever order they come in.  The store holds
mergeable partial counts: a document adds its counts, and a document that replaces another also adds that one's counts with the opposite sign.
Sums over any grouping (day, week, category) therefore need no look at versions, and a roll-up kept elsewhere only adds the new rows.
``live`` counts how many valid documents list a category, so one that is no longer listed vanishes and one listed with zero stays.
A row without a category stands for the document itself, so a day without categories is kept.

Only the stored rows of days that a batch brings are read, by the Parquet statistics of the sorted day column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .store import ATTEMPTS, LostRace, VersionedStore

PARTIALS = "day date, category string, n bigint, live bigint, generation bigint, scope string"


def open_counts(spark: SparkSession, path: str) -> VersionedStore:
    return VersionedStore(spark, path, PARTIALS)


def fold_partials(rows: DataFrame) -> DataFrame:
    """One row per day and category: what compaction keeps.  Folding is associative, in any order."""
    latest = F.when(F.col("live") > 0, F.struct("generation", "scope"))
    return rows.groupBy("day", "category").agg(
        F.sum("n").alias("n"), F.sum("live").alias("live"), F.max("generation").alias("generation"), F.max(latest).alias("_s"),
    ).select("day", "category", "n", "live", "generation", F.col("_s.scope").alias("scope")).repartitionByRange("day").sortWithinPartitions("day", "category")


def document_rows(documents: DataFrame, day: str = "day", counts: str = "by_cat", scope: str = "scope", generation: str = "generation") -> DataFrame:
    """Partial counts of day documents: ``counts`` maps categories to numbers; a null map is no document.

    Of several documents of one day and generation the one with the largest counts, as text, is taken.
    """
    rows = documents.where(F.col(counts).isNotNull()).select(
        F.col(day).alias("day"), F.sort_array(F.map_entries(counts)).alias("_e"), F.col(scope).alias("scope"), F.col(generation).cast("bigint").alias("generation"))
    last = F.max(F.struct("generation", F.struct(F.to_json(F.struct("_e")), "scope"), "_e", "scope")).alias("_d")
    picked = rows.groupBy("day").agg(last).select("day", "_d._e", "_d.scope", "_d.generation")
    entry = F.explode(F.concat(F.array(F.struct(F.lit(None).cast("string").alias("key"), F.lit(0).cast("bigint").alias("value"))),
                               F.transform("_e", lambda e: F.struct(e["key"].alias("key"), F.coalesce(e["value"].cast("bigint"), F.lit(0)).alias("value")))))
    return picked.select("day", entry.alias("_r"), "scope", "generation").select(
        "day", F.col("_r.key").alias("category"), F.col("_r.value").alias("n"), F.lit(1).cast("bigint").alias("live"), "generation", "scope")


def changes(new: DataFrame, stored: DataFrame) -> DataFrame:
    """What documents add to the stored rows: their counts, and with the opposite sign those they replace.  Older generations add nothing."""
    days = new.groupBy("day").agg(F.max("generation").alias("_new"))
    now = stored.join(days, "day", "left_semi")
    folded = now.groupBy("day", "category").agg(F.sum("n").alias("n"), F.sum("live").alias("live"), F.max("generation").alias("generation"))
    known = folded.groupBy("day").agg(F.max("generation").alias("_old"))
    valid = days.join(known, "day", "left").where(F.col("_old").isNull() | (F.col("_new") > F.col("_old")))
    added = new.join(valid.select("day"), "day", "left_semi")
    gone = folded.where("n <> 0 or live <> 0").join(valid, "day").select(
        "day", "category", (-F.col("n")).alias("n"), (-F.col("live")).alias("live"), F.col("_new").alias("generation"), F.lit(None).cast("string").alias("scope"))
    return added.unionByName(gone)


def apply_documents(store: VersionedStore, documents: DataFrame, writer: str | None = None, batch: int | None = None, **columns: str) -> DataFrame:
    """Adds a batch of day documents and returns the rows added, by which any roll-up kept elsewhere changes.

    What a batch replaces depends on what is stored, so a commit that comes between reading and writing makes the batch start again.
    """
    new = document_rows(documents, **columns)
    span = new.agg(F.min("day").alias("a"), F.max("day").alias("b")).head()
    for _ in range(ATTEMPTS):
        seen = store.manifest()
        if store.applied(writer, batch, seen):
            break
        stored = store.files(list(seen.files)).where(F.col("day").between(span["a"], span["b"]))
        names = store.stage(changes(new, stored).repartitionByRange("day").sortWithinPartitions("day", "category"))
        try:
            store.add(names, writer, batch, seen)
            return store.files(names)
        except LostRace:
            continue
    else:
        raise LostRace(f"{ATTEMPTS} other commits came first")
    return store.files([])


def stored_counts(store: VersionedStore) -> DataFrame:
    """``day, category, n``: the valid counts."""
    return fold_partials(store.read()).where("live > 0 and category is not null").select("day", "category", "n")


def stored_days(store: VersionedStore) -> DataFrame:
    """``day, by_cat, scope``: the valid documents, as ``rollup.daily_series`` reads them.  A day holds as many entries as there are categories."""
    folded = fold_partials(store.read()).where("live > 0")
    entry: Column = F.when(F.col("category").isNotNull(), F.struct(F.col("category").alias("key"), F.col("n").alias("value")))
    return folded.groupBy("day").agg(F.map_from_entries(F.sort_array(F.collect_list(entry))).alias("by_cat"), F.max(F.when(F.col("category").isNull(), F.col("scope"))).alias("scope"))
