"""Feeds, data sources, documents parsed once, bucketed tables and observed checks."""

import datetime
import os
import time
from xml.etree import ElementTree

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from paperflow.operators import enrich, listing
from paperflow.operators import observed as O
from paperflow.sources import feed as S
from paperflow.sources import landed

CHANNEL = S.Channel("A & B <daily>", "https://example.org", "what's \"new\"", "ko")
ITEMS = [(1, "Second <b>", "https://e.org/2", "https://e.org/2", "Tue", "d & e"), (0, "First", "https://e.org/1", "https://e.org/1", "Wed", "ü 한"), (2, "Third", "x", "x", None, "")]


def items(spark, rows=ITEMS):
    return spark.createDataFrame(rows, f"place int, {S.ITEM}")


class TestFeedDocument:
    def test_header_and_items(self, spark, tmp_path):
        document = S.feed_document(items(spark), CHANNEL, F.lit("Mon, 01 Jun 2026 09:00:00 +0900"), [F.col("place")])
        root = ElementTree.fromstring(document.first()["xml"].encode())
        channel = root.find("channel")
        assert root.tag == "rss" and root.get("version") == "2.0"
        assert [channel.findtext(t) for t in ("title", "link", "description", "language", "lastBuildDate", "ttl")] == [
            CHANNEL.title, "https://example.org/", CHANNEL.description, "ko", "Mon, 01 Jun 2026 09:00:00 +0900", "720"]
        link = channel.find(f"{{{S.ATOM}}}link")
        assert link.attrib == {"href": "https://example.org/feed.xml", "rel": "self", "type": "application/rss+xml"}
        assert [i.findtext("title") for i in channel.iterfind("item")] == ["First", "Second <b>", "Third"]
        assert channel.find("item/guid").get("isPermaLink") == "true"
        S.write_feed_document(document, str(tmp_path / "feed"))
        back = S.read_feed_items(spark, str(tmp_path / "feed"))
        assert sorted(tuple(r)[:4] for r in back.collect()) == sorted(r[1:5] for r in ITEMS)

    def test_no_items(self, spark):
        document = S.feed_document(items(spark, []), CHANNEL, F.lit("now"), [F.col("place")]).first()["xml"]
        root = ElementTree.fromstring(document.encode())
        assert root.findtext("channel/title") == CHANNEL.title and root.find("channel/item") is None


class TestDataSources:
    def test_pages_in_batches(self, spark, tmp_path):
        S.register(spark)
        for k in range(7):
            (tmp_path / f"p{k}.html").write_bytes(b"<p>%d</p>" % k + (b"\xff" if k == 3 else b""))
        (tmp_path / "_partial").write_text("not yet")
        pages = spark.read.format("landed_pages").option("filesPerTask", "2").load(str(tmp_path))
        assert pages.rdd.getNumPartitions() == 4
        assert {r["url"]: r["html"] for r in pages.collect()} == {f"p{k}.html": f"<p>{k}</p>" + ("�" if k == 3 else "") for k in range(7)}
        (tmp_path / "none").mkdir()
        assert spark.read.format("landed_pages").load(str(tmp_path / "none")).count() == 0

    def test_stream_takes_each_page_once(self, spark, tmp_path):
        S.register(spark)
        landing, seen = tmp_path / "in", []
        landing.mkdir()

        def poll():
            stream = spark.readStream.format("landed_pages").load(str(landing))
            query = stream.writeStream.foreachBatch(lambda batch, n: seen.append(sorted(r["url"] for r in batch.collect()))).option(
                "checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
            query.awaitTermination()

        for wave in (["a", "b"], ["c"], []):
            for name in wave:
                (landing / name).write_text(name)
                time.sleep(0.01)
            poll()
        assert [x for x in seen if x] == [["a", "b"], ["c"]]

    def test_feed_round_trip(self, spark, tmp_path):
        S.register(spark)
        path = str(tmp_path / "feed.xml")
        for rows in (ITEMS[:1], ITEMS):
            items(spark, rows).repartition(3).write.format("paper_feed").mode("overwrite").options(**S.channel_options(CHANNEL, "built")).save(path)
        got = spark.read.format("paper_feed").load(path).orderBy("place").collect()
        assert [(r["title"], r["description"]) for r in got] == [("First", "ü 한"), ("Second <b>", "d & e"), ("Third", "")]
        root = ElementTree.parse(path).getroot()
        assert root.findtext("channel/title") == CHANNEL.title and root.findtext("channel/language") == "ko" and root.findtext("channel/lastBuildDate") == "built"
        assert sorted(os.listdir(tmp_path)) == [".feed.xml.parts", "feed.xml"] and os.listdir(tmp_path / ".feed.xml.parts") == []

    def test_a_failed_commit_leaves_the_old_feed(self, spark, tmp_path):
        S.register(spark)
        path = str(tmp_path / "feed.xml")

        def save(rows):
            rows.write.format("paper_feed").mode("overwrite").options(**S.channel_options(CHANNEL, "b")).save(path)

        save(items(spark))
        before = open(path, encoding="utf-8").read()
        with pytest.raises(PySparkException):
            save(items(spark, [(0, "new", "l", "g", "p", "d")]).withColumn("title", F.raise_error(F.lit("lost"))))
        assert open(path, encoding="utf-8").read() == before
        writer = S.FeedWriter(path, CHANNEL, "b")
        written = [writer.write(iter(items(spark).collect()))]
        with pytest.raises(FileNotFoundError):
            writer.commit([*written, S.Written(str(tmp_path / "gone"))])
        assert open(path, encoding="utf-8").read() == before
        writer.commit(written)  # the replay
        assert len(ElementTree.parse(path).getroot().findall("channel/item")) == 3


class TestDocuments:
    DOCS = [("2026-01-01.json", '{"daily_new_counts": {"by_cat": {"a": "7.9", "b": null, "c": 3, "d": "?"}, "scope": "s"}}'),
            ("2026-01-02.json", '{"daily_new_counts": {"by_cat": [1]}}'), ("2026-01-03.json", '{"daily'), ("2026-01-04.json", "[]"),
            ("notes.json", '{"daily_new_counts": {"by_cat": {"a": 1}}}'), ("2026-01-05.json", '{"daily_new_counts": {"by_cat": {}}}'), ("2026-01-06.json", None)]

    def texts(self, spark):
        return spark.createDataFrame(self.DOCS, "file_name string, text string")

    def test_landed_once_and_read_by_path(self, spark, tmp_path):
        path = str(tmp_path / "docs")
        landed.land_documents(self.texts(spark), path)
        want = {datetime.date(2026, 1, 1): ({"a": 7, "b": 0, "c": 3, "d": 0}, "s"), datetime.date(2026, 1, 5): ({}, "")}
        for days in (landed.trends_of(spark.read.parquet(path)), landed.trends_from(self.texts(spark))):
            assert {r["day"]: (r["by_cat"], r["scope"]) for r in days.collect()} == want
        stored = spark.read.parquet(path)
        assert [r["corrupt"] for r in stored.where("corrupt is not null").collect()] == ['{"daily']
        loose = landed.landed_documents(spark, path, "STRUCT<daily_new_counts: STRUCT<scope: STRING>>")
        assert loose.count() == 6 and loose.where("doc.daily_new_counts.scope = 's'").count() == 1
        with pytest.raises(PySparkException):
            landed.landed_documents(spark, path, "STRUCT<date: STRING>", strict=True).collect()

    def test_one_parse(self, spark):
        for frame in (landed.trends_from(self.texts(spark)), landed.strict_documents(self.texts(spark), "STRUCT<date: STRING>")):
            plan = frame._jdf.queryExecution().optimizedPlan().toString()
            assert plan.count("parse_json(") + plan.count("VariantExpressionEvalUtils") <= 1 and "from_json" not in plan


class TestBuckets:
    def test_history_is_not_shuffled(self, spark, tmp_path):
        papers = spark.createDataFrame([(k, None if k % 5 == 0 else f"d{k % 7}") for k in range(100)], "pid int, doi string")
        works = spark.createDataFrame([(k, f"d{k % 6}", k * 10) for k in range(12)], "pos int, work_doi string, cited int")
        kept, known = f"test_papers_{os.getpid()}", f"test_works_{os.getpid()}"
        for day in (0, 1):
            enrich.store_by_key(papers.where(F.col("pid") % 2 == day), kept, str(tmp_path / "p"), F.col("doi"), 4, "pid", add=day > 0)
        enrich.store_works(works, known, str(tmp_path / "w"), "work_doi", ["pos"], 4)
        joined = enrich.lookup_bucketed(spark.table(kept), spark.table(known))
        plain = enrich.lookup(papers, works, F.col("doi"), "work_doi", ["pos"], "pid")
        columns = ["pid", "doi", "cited", "matched"]
        assert sorted(map(tuple, joined.select(columns).collect()), key=str) == sorted(map(tuple, plain.select(columns).collect()), key=str)
        before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        try:
            plan = enrich.lookup_bucketed(spark.table(kept), spark.table(known))._jdf.queryExecution().executedPlan().toString()
            assert "Exchange" not in plan and "SortMergeJoin" in plan
        finally:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
            for name in (kept, known):
                spark.sql(f"DROP TABLE {name}")


class TestObserved:
    def test_days_come_back_from_bitmaps(self, spark):
        days = [datetime.date(1970, 1, 1), datetime.date(2026, 2, 28), datetime.date(2026, 3, 1), datetime.date(2059, 9, 18)]
        rows = spark.createDataFrame([(d, k) for k, d in enumerate(days)] + [(None, 9)], "day date, k int").repartition(3)
        out, seen = O.watched(rows, {"odd": F.col("k") % 2 == 1, "null": F.lit(None).cast("boolean")})
        assert out.count() == 5
        assert O.days_of(seen) == {"odd": {days[1], days[3]}, "null": set(), "days": set(days)}

    def test_days_out_of_range_fail(self, spark):
        out, seen = O.watched(spark.createDataFrame([(datetime.date(1969, 12, 31),)], "day date"), {})
        out.count()
        with pytest.raises(ValueError):
            O.days_of(seen)


def test_a_missing_date_section_is_an_error(spark):
    pages = spark.createDataFrame([("p", "<h3>Mon, 1 Jun 2026</h3>x")], "url string, html string")
    day = F.lit("2026-06-01").cast("date")
    assert listing.date_section(pages, day, required=True).first()["block"].endswith("x")
    with pytest.raises(PySparkException, match="no section"):
        listing.date_section(pages, F.date_add(day, 1), required=True).collect()
