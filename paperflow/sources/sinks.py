"""Writers.  Each one rewrites exactly what it owns, so a repeated run leaves the same files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_papers(papers: DataFrame, path: str, fmt: str = "json") -> None:
    papers.write.mode("overwrite").format(fmt).save(path)


def write_paper_arrays(papers: DataFrame, group: str, path: str) -> None:
    """One file per group with one JSON array; a group must be small enough for one row."""
    fields = [c for c in papers.columns if c != group]
    arrays = papers.groupBy(group).agg(F.to_json(F.collect_list(F.struct(*fields))).alias("value")).select("value")
    arrays.write.mode("overwrite").option("maxRecordsPerFile", 1).text(path)


def write_classified(papers: DataFrame, summary: DataFrame, path: str) -> None:
    """Summary rows as JSON and the papers as files per bucket: no bucket is gathered into one row."""
    summary.write.mode("overwrite").json(f"{path}/summary")
    papers.where(F.col("bucket") != "").write.mode("overwrite").partitionBy("bucket").json(f"{path}/papers")


def write_series(daily: DataFrame, path: str, day: str = "day") -> None:
    """Replaces only the days at hand."""
    (daily.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(day).parquet(path))


def write_feed(items: DataFrame, path: str) -> None:
    """Feed items (title, link, guid, pubDate, description) as XML; the writer escapes markup."""
    items.coalesce(1).write.mode("overwrite").option("rootTag", "channel").option("rowTag", "item").format("xml").save(path)
