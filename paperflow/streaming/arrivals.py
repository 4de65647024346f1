"""Arriving files drained with an available-now trigger.

Every writer is idempotent: a micro-batch is committed once under its id, or owns the folder named by its id and
overwrites it on a replay, so a lost executor or a restarted driver changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .store import VersionedStore, into


def arrivals(spark: SparkSession, path: str, schema, files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def drain(stream: DataFrame, each_batch, checkpoint: str, mode: str = "append") -> None:
    """Process what has arrived, then stop; nothing new means nothing done."""
    query = (
        stream.writeStream.outputMode(mode).foreachBatch(each_batch)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()


def running_counts(stream: DataFrame, ts: str, category: str, late: str = "7 days") -> DataFrame:
    """Counts per day and category; days older than the watermark leave the state.

    Day windows begin at midnight UTC, so the local clock time is moved there and back:
    the days are those of the data in any session time zone.
    """
    zone = F.current_timezone()
    clock = F.from_utc_timestamp(F.col(ts).cast("timestamp"), zone)
    return (
        stream.withColumn("_ts", clock).withWatermark("_ts", late)
        .groupBy(F.window("_ts", "1 day").alias("_w"), category)
        .agg(F.count("*").alias("n"))
        .select(F.to_utc_timestamp("_w.start", zone).cast("date").alias("day"), category, "n")
    )


def counts_store(spark: SparkSession, path: str, category: str) -> VersionedStore:
    return VersionedStore(spark, path, f"day date, {category} string, n bigint")


def largest_totals(category: str):
    """Per group the largest total: rows only ever arrive, so a group's totals only grow, whoever counts them and whenever."""
    def fold(rows: DataFrame) -> DataFrame:
        return rows.groupBy("day", category).agg(F.max("n").alias("n"))
    return fold


def write_counts(path: str, writer: str = "stream", compact_every: int = 0):
    """Update-mode writer: each batch adds its new totals; old ones go when the store is folded, after every ``compact_every`` batches.

    ``writer`` names the checkpoint, by which a replayed batch is known.
    """
    def each(batch: DataFrame, batch_id: int) -> None:
        category = next(c for c in batch.columns if c not in ("day", "n"))
        into(counts_store(batch.sparkSession, path, category), writer, None, largest_totals(category), compact_every)(batch, batch_id)
    return each


def read_counts(spark: SparkSession, path: str, category: str) -> DataFrame:
    return largest_totals(category)(counts_store(spark, path, category).read())


def backfill_counts(landed: DataFrame, ts: str, category: str, path: str) -> None:
    """Counts that came too late for the watermark, put right from all that has landed.

    Only groups whose stored total is smaller are written.  It may run at any time, also while polls go on and for days that are still open:
    what the stream counts later is larger and wins.  A run that dies leaves nothing that is read.
    """
    spark = landed.sparkSession
    store = counts_store(spark, path, category)
    whole = landed.groupBy(F.col(ts).cast("date").alias("day"), F.col(category).cast("string").alias(category)).agg(F.count("*").alias("n"))
    known = largest_totals(category)(store.read()).select(F.col("day").alias("_day"), F.col(category).alias("_category"), F.col("n").alias("_known"))
    same = F.col("day").eqNullSafe(F.col("_day")) & F.col(category).eqNullSafe(F.col("_category"))
    store.append(whole.join(known, same, "left").where(F.col("n") > F.coalesce("_known", F.lit(0))).select("day", category, "n"))


def distinct_arrivals(stream: DataFrame, ts: str, keys: list[str], horizon: str) -> DataFrame:
    """One row per key among rows at most ``horizon`` apart; which of them is not defined.

    The state store forgets a key after the horizon.  ``first.first_arrivals`` is the exact variant.
    """
    return (
        stream.withColumn("_ts", F.col(ts).cast("timestamp")).withWatermark("_ts", horizon)
        .dropDuplicatesWithinWatermark(keys).drop("_ts")
    )


MODE_RANK = {"journal-only": 0, "pastweek-date-section": 1, "new": 2}


def resolve_days(rows: DataFrame, keys: list[str], mode: str = "source_mode", order: str = "batch_id") -> DataFrame:
    """One row per key out of provisional and final versions.

    A final version replaces the listing part of a provisional one; the registry part
    is kept from whichever version brought the most.  The latest wins within a rank.
    """
    return fold_days(keys, mode, order)(rows).drop(order)


def fold_days(keys: list[str], mode: str = "source_mode", order: str = "batch_id"):
    """The same with the winner's ``order`` kept, so that folded rows can be folded again with later ones."""
    rank = F.element_at(F.create_map(*[F.lit(x) for kv in MODE_RANK.items() for x in kv]), F.col(mode))
    best = F.struct(rank, F.col(order))

    def fold(rows: DataFrame) -> DataFrame:
        return rows.groupBy(*keys).agg(
            F.max_by("listing_count", best).alias("listing_count"),
            F.max("journal_count").alias("journal_count"),
            F.max_by(mode, best).alias(mode),
            F.max_by(order, best).alias(order),
        )
    return fold


def append_versions(path: str):
    def each(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
    return each
