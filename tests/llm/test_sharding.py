import hashlib

from paperflow.llm import sharding
from paperflow.session import scratch_path

from .helpers import docs, sf_docs


def brute(rows, limit):
    items = [(k, len((t or "").encode()), int(hashlib.md5(("" if k is None else str(k)).encode()).hexdigest()[:15], 16)) for k, t in rows]
    out = []

    def split(members, depth, prefix):
        size = sum(b for _, b, _ in members)
        if size <= limit or len({h for *_, h in members}) == 1:
            out.extend((k, b, format(prefix, f"0{depth}b") if depth else "", depth, size, len(members), size > limit) for k, b, _ in members)
            return
        for bit in (0, 1):
            part = [m for m in members if m[2] >> (sharding.BITS - depth - 1) & 1 == bit]
            if part:
                split(part, depth + 1, prefix << 1 | bit)

    if items:
        split(items, 0, 0)
    return out


def same(frame, rows, limit):
    got = [tuple(r) for r in sharding.assign_shards(frame, limit=limit).collect()]
    order = lambda r: tuple(map(str, r))
    assert sorted(got, key=order) == sorted(brute(rows, limit), key=order)


def test_only_oversized_buckets_split(spark):
    rows = [(r["doc_id"], r["text"]) for r in sf_docs(spark).collect()]
    for limit in (1 << 30, 40_000, 3_000):
        same(sf_docs(spark), rows, limit)


def test_edges(spark):
    rows = [(1, None), (2, ""), (None, "abc"), (3, "x" * 500), (4, "y" * 30), (4, "y" * 30), (4, "y" * 30), (5, "é")]
    same(docs(spark, rows), rows, 50)
    assert sharding.assign_shards(docs(spark, [])).count() == 0


def test_written_shards(spark):
    frame = sf_docs(spark)
    assigned = sharding.assign_shards(frame, limit=100_000)
    path = scratch_path(spark, "shards")
    sharding.write_shards(frame, assigned, path)
    back = spark.read.option("basePath", path).parquet(path)
    assert back.count() == frame.count()
    assert sharding.directory(assigned).where("not oversized and shard_bytes > 100000").count() == 0
