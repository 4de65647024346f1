import glob
import time

import numpy as np
import xxhash

from paperflow.llm import common
from paperflow.llm.filters import distinct, mixed
from paperflow.llm.linking import ShingleSets


def test_a_worker_keeps_the_tables_of_one_operator(monkeypatch):
    monkeypatch.setattr(common, "_TABLES", {})
    task = iter([1, 1, 1, 2, 2, 2, 3, 3])

    class Context:
        def taskAttemptId(self):
            return next(task)

    monkeypatch.setattr(common.TaskContext, "get", Context)
    made = []

    def ask(kind, key):
        return common.worker_table(kind, key, lambda: made.append((kind, key)) or (kind, key))

    assert ask("a", 1) == ("a", 1) and ask("b", 1) == ("b", 1) and ask("a", 1) == ("a", 1)  # two operators in a task
    assert ask("a", 1) == ("a", 1) and ask("b", 1) == ("b", 1) and len(made) == 2
    assert ask("a", 2) == ("a", 2) and set(common._TABLES) == {"a", "b"}  # one of a kind
    assert ask("c", 1) == ("c", 1) and set(common._TABLES) == {"c"}  # a later task, another operator
    assert ask("a", 2) == ("a", 2) and made[-1] == ("a", 2)


def test_staged_rows_leave_no_shuffle_files(spark):
    dirs = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    before = spark.conf.get(common.SHUFFLE_CLEANUP)

    def files():
        return {f for d in dirs for f in glob.glob(f"{d}/*/shuffle_*.data")}

    old = files()
    out = common.staged(spark.range(1000).groupBy((common.F.col("id") % 7).alias("k")).count(), "test-staged")
    until = time.time() + 20
    while files() - old and time.time() < until:
        time.sleep(0.2)
    assert not files() - old and out.count() == 7 and spark.conf.get(common.SHUFFLE_CLEANUP) == before


def test_a_task_gives_free_memory_back(spark, tmp_path):
    kept = 64 << 20

    def hold(batches):
        for batch in batches:
            held = [common.pa.allocate_buffer(1 << 16, resizable=True) for _ in range(kept >> 16)]
            for b in held:
                memoryview(b).cast("B")[::4096] = b"x" * (1 << 4)
            del held, b
            yield batch

    def measure(batches):
        for batch in batches:
            lines = open("/proc/self/smaps_rollup").read().splitlines()
            size = sum(int(x.split()[1]) for x in lines if x.startswith("Private_Dirty:")) << 10
            yield common.pa.RecordBatch.from_arrays([common.pa.array([size] * batch.num_rows)], names=["id"])

    rows = spark.range(1).coalesce(1)
    before = common.in_batches(rows, measure, "id long").head()[0]
    common.in_batches(rows, hold, "id long").collect()
    assert common.in_batches(rows, measure, "id long").head()[0] < before + kept // 2


def test_dropped_rows_leave_no_files(spark):
    kept, gone = (common.staged(spark.range(10).repartition(2), "test-dropped") for _ in range(2))
    folder = gone.inputFiles()[0].removeprefix("file:").replace("///", "/").rsplit("/", 1)[0]
    assert glob.glob(f"{folder}/*")
    common.dropped(gone)
    assert not glob.glob(folder) and kept.count() == 10


def test_shingles_are_hashed_words(monkeypatch):
    assert not hasattr(ShingleSets(3), "known")
    text = b"B a c a B a c d \x00 a"
    h = [np.array([xxhash.xxh3_64_intdigest(w)], np.uint64) for w in text.lower().split()]
    want = {int(mixed(mixed(mixed(a) + b) + c)[0]) for a, b, c in zip(h, h[1:], h[2:])}
    assert ShingleSets(3)(text).tolist() == sorted(want)
    for n in (0, 1, 2, 500):
        x = np.random.default_rng(n).integers(0, 300, n).astype(np.uint64)
        assert distinct(x).tolist() == np.unique(x).tolist()
