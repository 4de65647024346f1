"""Streaming twins: each drains what has landed and must equal its batch twin."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import rollup
from ..session import scratch_path
from ..sources.tables import table
from ..streaming import arrivals as A
from ..streaming import increments
from ..streaming.first import first_arrivals, rocksdb_state
from ..streaming.store import VersionedStore, into
from .calendars import _iso
from .catalog import SQL, job
from .rollups import count_text, daily_maps

POLLS = 4


def landing_polls(df: DataFrame, path: str, poll: str) -> Iterator[int]:
    """Lands a whole table poll by poll, oldest first; what has landed can be drained before the next poll comes.

    Rows of a later poll than the last come with the last one, rows of an unknown poll with the first.
    """
    known = F.coalesce(F.greatest(F.lit(0), F.least(F.lit(POLLS - 1), F.col(poll))), F.lit(0))
    for i in range(POLLS):
        df.where(known == i).drop(poll).write.mode("append").parquet(path)
        yield i


def land(df: DataFrame, path: str, poll: str) -> None:
    """Lands a whole table as the files of successive polls."""
    for _ in landing_polls(df, path, poll):
        pass


@job("stream_counts", """SELECT strftime(ts, '%Y-%m-%d') AS day, event_type, count(*) AS n FROM events GROUP BY ALL""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    landing, out = scratch_path(spark, "events-landing"), scratch_path(spark, "events-counts")
    events = table(spark, folder, "events").select("ts", "event_type", F.floor((F.dayofmonth("ts") - 1) / 8).alias("poll"))
    land(events, landing, "poll")
    stream = A.arrivals(spark, landing, events.drop("poll").schema, files_per_trigger=1)
    counts = A.running_counts(stream, "ts", "event_type")
    A.drain(counts, A.write_counts(out, compact_every=2), scratch_path(spark, "events-checkpoint"), "update")
    return A.read_counts(spark, out, "event_type").withColumn("day", F.date_format("day", "yyyy-MM-dd"))


@job("stream_dedup", """SELECT doc_id, md5(text) AS text_md5 FROM documents
QUALIFY row_number() OVER (PARTITION BY text ORDER BY coalesce(least(3, TRY_CAST(substr(source, 4) AS INT) // 5), 0), doc_id) = 1""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    """Keyed state: a text enters it as its digest, and only ids and digests cross to Python.

    Each poll is drained when it has landed, whole in one micro-batch: the state of all keys is opened once a poll, not once a file, and the
    smallest id of a poll wins whichever file holds it.
    """
    landing, out = scratch_path(spark, "docs-landing"), scratch_path(spark, "docs-first")
    docs = table(spark, folder, "documents").select(
        "doc_id", "text", F.floor(F.substring("source", 4, 10).try_cast("int") / 5).cast("int").alias("poll"))
    checkpoint = scratch_path(spark, "docs-checkpoint")
    store = VersionedStore(spark, out, "doc_id bigint, text_md5 string, dedup_key string")
    with rocksdb_state(spark):
        for _ in landing_polls(docs, landing, "poll"):
            stream = A.arrivals(spark, landing, docs.drop("poll").schema).select("doc_id", F.md5("text").alias("text_md5"))
            A.drain(first_arrivals(stream, F.col("text_md5"), ["doc_id"]), into(store, "docs"), checkpoint)
    return store.read().select("doc_id", "text_md5")


@job("stream_backfill", """SELECT strftime(ts, '%Y-%m-%d') AS day, event_type, count(*) AS n FROM events GROUP BY ALL""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    """Old days land after new ones, too late for the watermark; the batch job then counts them from what has landed."""
    landing, out = scratch_path(spark, "late-landing"), scratch_path(spark, "late-counts")
    events = table(spark, folder, "events").select("ts", "event_type", F.floor((31 - F.dayofmonth("ts")) / 8).alias("poll"))
    land(events, landing, "poll")
    schema = events.drop("poll").schema
    counts = A.running_counts(A.arrivals(spark, landing, schema, files_per_trigger=1), "ts", "event_type")
    A.drain(counts, A.write_counts(out), scratch_path(spark, "late-checkpoint"), "update")
    A.backfill_counts(spark.read.schema(schema).parquet(landing), "ts", "event_type", out)
    return A.read_counts(spark, out, "event_type").withColumn("day", F.date_format("day", "yyyy-MM-dd"))


@job("stream_rerun", """SELECT strftime(ts, '%Y-%m-%d') AS day, event_type, count(*) AS n FROM events GROUP BY ALL""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    """Drained twice from the beginning with a new checkpoint: totals counted again change nothing."""
    landing, out = scratch_path(spark, "rerun-landing"), scratch_path(spark, "rerun-counts")
    events = table(spark, folder, "events").select("ts", "event_type", F.floor((F.dayofmonth("ts") - 1) / 8).alias("poll"))
    land(events, landing, "poll")
    for _ in range(2):
        checkpoint = scratch_path(spark, "rerun-checkpoint")
        stream = A.arrivals(spark, landing, events.drop("poll").schema, files_per_trigger=1)
        A.drain(A.running_counts(stream, "ts", "event_type"), A.write_counts(out, checkpoint), checkpoint, "update")
    return A.read_counts(spark, out, "event_type").withColumn("day", F.date_format("day", "yyyy-MM-dd"))


@job("stream_upgrade", """WITH v AS (SELECT user_id, CAST(ts AS DATE) AS day, count(*) FILTER (event_type = 'purchase') AS journal_count,
  count(*) FILTER (event_type <> 'purchase') AS listing_count FROM events GROUP BY ALL)
SELECT user_id, strftime(day, '%Y-%m-%d') AS day, listing_count, journal_count,
  CASE WHEN listing_count = 0 THEN 'journal-only' WHEN listing_count >= 3 THEN 'new' ELSE 'pastweek-date-section' END AS source_mode FROM v""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    """Days land twice: first with their registry part alone, later with their listing part."""
    landing, out = scratch_path(spark, "days-landing"), scratch_path(spark, "days-versions")
    bought = F.col("event_type") == "purchase"
    full = table(spark, folder, "events").groupBy("user_id", F.col("ts").cast("date").alias("day")).agg(
        F.count_if(bought).alias("journal_count"), F.count_if(~bought).alias("listing_count"))
    mode = F.when(F.col("listing_count") >= 3, "new").otherwise("pastweek-date-section")
    versions = F.array(
        F.struct(F.lit(0).alias("poll"), F.lit(0).cast("bigint").alias("listing_count"), F.col("journal_count"), F.lit("journal-only").alias("source_mode")),
        F.struct(F.lit(1).alias("poll"), F.col("listing_count"), F.lit(0).cast("bigint").alias("journal_count"), mode.alias("source_mode")))
    rows = full.select("user_id", "day", F.col("listing_count").alias("_l"), F.explode(versions).alias("v")).select("user_id", "day", "_l", "v.*")
    rows = rows.where((F.col("poll") == 0) | (F.col("_l") > 0)).drop("_l")
    land(rows, landing, "poll")
    stream = A.arrivals(spark, landing, rows.drop("poll").schema, files_per_trigger=1)
    store = VersionedStore(spark, out, "user_id bigint, day date, listing_count bigint, journal_count bigint, source_mode string, batch_id bigint")
    fold = A.fold_days(["user_id", "day"])
    numbered = into(store, "days", lambda batch, number: batch.withColumn("batch_id", F.lit(number).cast("bigint")), fold, compact_every=2)
    A.drain(stream, numbered, scratch_path(spark, "days-checkpoint"))
    store.vacuum()
    resolved = A.resolve_days(store.read(), ["user_id", "day"])
    return resolved.withColumn("day", F.date_format("day", "yyyy-MM-dd"))


@job("stream_distinct", "SELECT DISTINCT user_id, event_type FROM events")
def _(spark: SparkSession, folder: str) -> DataFrame:
    landing, out = scratch_path(spark, "pairs-landing"), scratch_path(spark, "pairs")
    events = table(spark, folder, "events").select(
        "ts", "user_id", "event_type", F.floor((F.dayofmonth("ts") - 1) / 8).alias("poll"))
    land(events, landing, "poll")
    stream = A.arrivals(spark, landing, events.drop("poll").schema, files_per_trigger=1)
    pairs = A.distinct_arrivals(stream, "ts", ["user_id", "event_type"], "60 days")
    A.drain(pairs, A.append_versions(out), scratch_path(spark, "pairs-checkpoint"))
    return spark.read.parquet(out).select("user_id", "event_type")


def landed_documents(spark: SparkSession, folder: str) -> list[DataFrame]:
    """Day documents as three arrivals in the wrong order: second-generation documents of the days to the 20th, then first-generation ones
    of all days (late for the former, half counted), then second-generation ones of the other days."""
    whole = daily_maps(spark, folder).withColumn("scope", F.when(F.weekday("day") == 0, "all").otherwise("")).withColumn("generation", F.lit(2))
    half = whole.withColumn("by_cat", F.transform_values("by_cat", lambda k, v: F.floor(v / 2))).withColumn(
        "by_cat", F.map_concat("by_cat", F.create_map(F.lit("withdrawn"), F.lit(5).cast("bigint")))).withColumn("generation", F.lit(1))
    early = F.dayofmonth("day") <= 20
    return [whole.where(early), half, whole.where(~early)]


def incremental_store(spark: SparkSession, folder: str) -> VersionedStore:
    store = increments.open_counts(spark, scratch_path(spark, "incremental"))
    for batch, documents in enumerate(landed_documents(spark, folder)):
        increments.apply_documents(store, documents, "documents", batch)
    store.compact(increments.fold_partials)
    store.vacuum()
    return store


@job("series_incremental", SQL["daily_counts"])
def _(spark: SparkSession, folder: str) -> DataFrame:
    """The daily series from partial counts that arrivals have changed, equal to counting all events."""
    series = rollup.daily_series(increments.stored_days(incremental_store(spark, folder)))
    return series.select(_iso("day"), "total", "scope", "weekday", count_text(F.map_entries("by_cat")).alias("by_cat"))


@job("weekly_incremental", SQL["weekly_rollup"])
def _(spark: SparkSession, folder: str) -> DataFrame:
    """The weekly roll-up from the same partial counts."""
    daily = increments.stored_counts(incremental_store(spark, folder)).withColumnRenamed("category", "event_type")
    return rollup.weekly_rollup(daily, "event_type").select(_iso("week_start"), "event_type", "n", "days_covered", "week_total")
