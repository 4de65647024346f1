"""Versioned store, keyed first wins and incremental counts."""

import datetime
import itertools

import pytest
from pyspark.sql import functions as F

from paperflow.operators import rollup
from paperflow.plans import jobs, streams
from paperflow.streaming import arrivals as A
from paperflow.streaming import increments as I
from paperflow.streaming.first import PROVIDER, first_arrivals, rocksdb_state
from paperflow.streaming.store import LostRace, Manifest, VersionedStore, into

ROWS = "k string, n int"


def rows_of(store, version=None):
    return sorted(tuple(r) for r in store.read(version).collect())


@pytest.fixture
def store(spark, tmp_path):
    return VersionedStore(spark, str(tmp_path / "store"), ROWS)


def frame(spark, *rows, schema=ROWS):
    return spark.createDataFrame(list(rows), schema)


class TestStore:
    def test_only_committed_files_are_read(self, spark, store):
        assert rows_of(store) == [] and store.manifest() == Manifest()
        store.append(frame(spark, ("a", 1)))
        store.stage(frame(spark, ("lost", 9)))  # a run that dies before its commit
        assert rows_of(store) == [("a", 1)] and store.manifest().version == 1
        assert store.vacuum() == 1 and rows_of(store) == [("a", 1)]

    def test_replayed_batches_change_nothing(self, spark, store):
        write = into(store, "w")
        for number, value in ((0, 1), (1, 2), (0, 1), (1, 2), (2, 3)):
            write(frame(spark, ("a", value)), number)
        store.append(frame(spark, ("b", 7)), "other", 0)
        assert rows_of(store) == [("a", 1), ("a", 2), ("a", 3), ("b", 7)]
        assert store.manifest().batches == {"w": 2, "other": 0}

    def test_folding_replaces_files_and_keeps_older_versions_readable(self, spark, store):
        for n in range(4):
            store.append(frame(spark, ("a", n), ("b", 10 - n)))
        before = store.manifest()
        after = store.compact(lambda rows: rows.groupBy("k").agg(F.max("n").alias("n")).coalesce(1))
        assert rows_of(store) == [("a", 3), ("b", 10)] and len(store.manifest(after).files) == 1
        assert len(rows_of(store, before.version)) == 8
        assert store.vacuum() == 4 + 4 and store.versions() == [after] and rows_of(store) == [("a", 3), ("b", 10)]

    def test_a_commit_that_comes_first_wins(self, spark, store):
        store.append(frame(spark, ("a", 1)))
        seen, names = store.manifest(), store.stage(frame(spark, ("a", 2)))
        store.append(frame(spark, ("b", 1)))
        with pytest.raises(LostRace):
            store.add(names, seen=seen)
        assert not store._publish(Manifest(2, ("x",), {}))
        store.add(names)
        assert rows_of(store) == [("a", 1), ("a", 2), ("b", 1)]

    def test_files_that_come_while_folding_stay(self, spark, store):
        store.append(frame(spark, ("a", 1)))

        def fold(rows):
            store.append(frame(spark, ("c", 5)))
            return rows

        store.compact(fold)
        assert rows_of(store) == [("a", 1), ("c", 5)]

        def fold_and_lose(rows):
            store.compact(lambda r: r)
            return rows

        with pytest.raises(LostRace):
            store.compact(fold_and_lose)
        assert rows_of(store) == [("a", 1), ("c", 5)]


def poll(spark, landing, schema, checkpoint, each, build=lambda s: s, mode="append", files=1):
    A.drain(build(A.arrivals(spark, landing, schema, files_per_trigger=files)), each, checkpoint, mode)


def land(df, landing):
    df.coalesce(1).write.mode("append").parquet(landing)


EVENT = "k string, pos int, v string"


class TestFirstArrivals:
    def run(self, spark, tmp_path, polls, **options):
        landing, out = str(tmp_path / "in"), VersionedStore(spark, str(tmp_path / "out"), EVENT)
        with rocksdb_state(spark):
            for rows in polls:
                land(spark.createDataFrame(rows, EVENT).repartition(3).coalesce(1), landing)
                poll(spark, landing, EVENT, str(tmp_path / "cp"), into(out, "w"), lambda s: first_arrivals(s, F.col("k"), ["pos"], **options))
        return sorted((r["k"], r["v"]) for r in out.read().collect()), out

    def test_first_row_of_the_first_poll_wins(self, spark, tmp_path):
        got, _ = self.run(spark, tmp_path, [[("a", 2, "x"), ("a", 1, "y"), ("b", 1, "z"), (None, 0, "n"), ("", 0, "e")], [("a", 0, "late"), ("c", 1, "new")], [("c", 0, "w")]])
        assert got == [("a", "y"), ("b", "z"), ("c", "new")]
        assert spark.conf.get(PROVIDER, None) != "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

    def test_ties_null_places_and_a_hot_key(self, spark, tmp_path):
        hot = [("h", 5 + i % 7, f"v{i}") for i in range(3000)]
        got, _ = self.run(spark, tmp_path, [[*hot, ("t", 1, "b"), ("t", 1, "a"), ("u", 3, "x"), ("u", None, "null first")]])
        assert got == [("h", "v0"), ("t", "a"), ("u", "null first")]

    def test_nothing_written_earlier_is_read(self, spark, tmp_path):
        """The output is removed between polls; the state alone tells what has been seen."""
        got, out = self.run(spark, tmp_path, [[("a", 1, "x")]])
        fresh = VersionedStore(spark, str(tmp_path / "elsewhere"), EVENT)
        land(spark.createDataFrame([("a", 0, "again"), ("b", 0, "first")], EVENT), str(tmp_path / "in"))
        with rocksdb_state(spark):
            poll(spark, str(tmp_path / "in"), EVENT, str(tmp_path / "cp"), into(fresh, "w"), lambda s: first_arrivals(s, F.col("k"), ["pos"]))
        assert [(r["k"], r["v"]) for r in fresh.read().collect()] == [("b", "first")]

    def test_a_poll_of_many_files_is_one_micro_batch(self, spark, tmp_path, monkeypatch):
        """The smallest id of a poll wins whichever file holds it, and files do not multiply micro-batches."""
        folder = str(tmp_path / "tables")
        rows = [(i, f"text {i % 5}", f"src{(i % 4) * 5}") for i in range(40)] + [(99, None, "src1"), (100, "only", None)]
        for part in (rows[30:], rows[20:30], rows[10:20], rows[:10]):
            spark.createDataFrame(part, "doc_id bigint, text string, source string").coalesce(1).write.mode("append").parquet(f"{folder}/documents.parquet")
        batches = []
        monkeypatch.setattr(streams, "into", lambda store, writer: lambda rows, number: (batches.append(number), into(store, writer)(rows, number)))
        got = {(r["doc_id"], r["text_md5"] is None) for r in jobs()["stream_dedup"](spark, folder).collect()}
        assert batches == list(range(streams.POLLS))
        first = {}
        for i, text, source in sorted((r for r in rows if r[1] is not None), key=lambda r: (int((r[2] or "src0")[3:]) // 5, r[0])):
            first.setdefault(text, i)
        assert got == {(i, False) for i in first.values()}

    def test_a_timer_forgets_keys(self, spark, tmp_path):
        schema = "k string, ts timestamp, v string"
        landing, out = str(tmp_path / "in"), VersionedStore(spark, str(tmp_path / "out"), schema)
        at = lambda d: datetime.datetime(2026, 1, d, tzinfo=datetime.timezone.utc)
        polls = [[("a", at(1), "first")], [("a", at(2), "seen"), ("b", at(20), "b")], [("c", at(21), "c")], [("a", at(22), "anew")]]
        with rocksdb_state(spark):
            for rows in polls:
                land(spark.createDataFrame(rows, schema), landing)
                poll(spark, landing, schema, str(tmp_path / "cp"), into(out, "w"), lambda s: first_arrivals(s, F.col("k"), ["ts"], "ts", "10 days"))
        assert sorted(r["v"] for r in out.read().collect()) == ["anew", "b", "c", "first"]


class TestBackfill:
    def events(self, spark, *days):
        return spark.createDataFrame([(datetime.datetime(2026, 1, d, 12), "a") for d in days], "ts timestamp_ntz, kind string")

    def test_backfill_between_polls_of_an_open_day(self, spark, tmp_path):
        landing, out, checkpoint = (str(tmp_path / x) for x in ("in", "out", "cp"))
        schema = "ts timestamp_ntz, kind string"

        def poll_now():
            poll(spark, landing, schema, checkpoint, A.write_counts(out, compact_every=1), lambda s: A.running_counts(s, "ts", "kind"), "update")

        def backfill():
            A.backfill_counts(spark.read.schema(schema).parquet(landing), "ts", "kind", out)

        def stored():
            return {r["day"].day: r["n"] for r in A.read_counts(spark, out, "kind").collect()}

        land(self.events(spark, 5, 5, 5), landing)
        poll_now()
        land(self.events(spark, 5, 5), landing)
        backfill()
        assert stored() == {5: 5}
        poll_now()
        land(self.events(spark, 5, 5, 5, 5), landing)
        poll_now()
        assert stored() == {5: 9}
        land(self.events(spark, 25), landing)
        poll_now()
        land(self.events(spark, 5, 25), landing)  # the fifth is too late for the watermark now
        poll_now()
        assert stored() == {5: 9, 25: 2}
        backfill()
        backfill()
        assert stored() == {5: 10, 25: 2}

    def test_folding_bounds_the_store(self, spark, tmp_path):
        out = str(tmp_path / "out")
        write = A.write_counts(out, compact_every=3)
        for number in range(9):
            write(spark.createDataFrame([(datetime.date(2026, 1, 1), "a", number + 1), (datetime.date(2026, 1, 2), None, 1)], "day date, kind string, n bigint"), number)
        store = A.counts_store(spark, out, "kind")
        assert store.read().count() == 2 and sorted(r["n"] for r in A.read_counts(spark, out, "kind").collect()) == [1, 9]


DOC = "day date, by_cat map<string,bigint>, scope string, generation int"


def day(d):
    return datetime.date(2026, 3, d)


class TestIncrements:
    docs = {
        "one": [(day(2), {"a": 3, "b": 1}, "", 1), (day(3), {"a": 5}, "all", 1), (day(4), {}, "", 1)],
        "two": [(day(3), {"b": 7, "z": 0}, "", 2), (day(4), {"a": None}, "", 3), (day(9), None, "", 1)],
        "late": [(day(2), {"a": 9}, "", 2), (day(3), {"c": 100}, "", 1), (day(4), {"q": 1}, "", 2), (day(5), {"a": 1}, "x", 1)],
    }
    counts = {(day(2), "a", 9), (day(3), "b", 7), (day(3), "z", 0), (day(4), "a", 0), (day(5), "a", 1)}

    @pytest.mark.parametrize("order", list(itertools.permutations(["one", "two", "late"])))
    def test_any_order_of_arrivals(self, spark, tmp_path, order):
        store = I.open_counts(spark, str(tmp_path))
        kept = {}
        for number, name in enumerate(order):
            for r in I.apply_documents(store, spark.createDataFrame(self.docs[name], DOC), "w", number).collect():
                key = (r["day"], r["category"])
                kept[key] = tuple(a + b for a, b in zip(kept.get(key, (0, 0)), (r["n"], r["live"])))
            if number == 1:
                store.compact(I.fold_partials)
        assert {tuple(r) for r in I.stored_counts(store).collect()} == self.counts
        assert {(*k, n) for k, (n, live) in kept.items() if live and k[1] is not None} == self.counts  # a roll-up kept elsewhere, by adding what is returned
        days = {r["day"]: (r["by_cat"], r["scope"]) for r in I.stored_days(store).collect()}
        assert days == {day(2): ({"a": 9}, ""), day(3): ({"b": 7, "z": 0}, ""), day(4): ({"a": 0}, ""), day(5): ({"a": 1}, "x")}
        series = {r["day"]: r["total"] for r in rollup.daily_series(I.stored_days(store)).collect()}
        assert series == {day(2): 9, day(3): 7, day(4): 0, day(5): 1}

    def test_replays_and_empty_batches(self, spark, tmp_path):
        store = I.open_counts(spark, str(tmp_path))
        one = spark.createDataFrame(self.docs["one"], DOC)
        I.apply_documents(store, one, "w", 0)
        assert I.apply_documents(store, one, "w", 0).count() == 0
        I.apply_documents(store, one, "w", 1)  # the same documents again: no newer generation
        I.apply_documents(store, one.limit(0), "w", 2)
        assert {tuple(r) for r in I.stored_counts(store).collect()} == {(day(2), "a", 3), (day(2), "b", 1), (day(3), "a", 5)}

    def test_two_documents_of_a_day_in_one_batch(self, spark, tmp_path):
        store = I.open_counts(spark, str(tmp_path))
        I.apply_documents(store, spark.createDataFrame([(day(2), {"a": 1}, "", 1), (day(2), {"b": 2}, "", 2), (day(2), {"b": 2}, "", 2)], DOC))
        assert {tuple(r) for r in I.stored_counts(store).collect()} == {(day(2), "b", 2)}

    def test_a_faster_writer_makes_the_batch_start_again(self, spark, tmp_path, monkeypatch):
        store = I.open_counts(spark, str(tmp_path))
        stage, other = store.stage, [spark.createDataFrame([(day(2), {"a": 1}, "", 1)], DOC)]

        def slow(rows):
            names = stage(rows)
            if other:
                I.apply_documents(I.open_counts(spark, str(tmp_path)), other.pop())
            return names

        monkeypatch.setattr(store, "stage", slow)
        I.apply_documents(store, spark.createDataFrame([(day(2), {"a": 5}, "", 2)], DOC))
        assert {tuple(r) for r in I.stored_counts(store).collect()} == {(day(2), "a", 5)}
