"""As-of join, range join and the walk over JSON of any shape."""

import datetime
import json
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from paperflow.operators.asof import asof_join, micros, range_join
from paperflow.operators.json_walk import harvested_ids, string_leaves
from paperflow.operators.listing import harvest_ids


def brute_asof(left, right, strict):
    out = Counter()
    for k, at, v in left:
        known = [(a, w) for b, a, w in right if b == k and a is not None and at is not None and (a < at if strict else a <= at)]
        out[(k, at, v, max(known, key=lambda x: (x[0], x[1] is not None, x[1]))[1] if known else None)] += 1
    return out


class TestAsOf:
    def rows(self, seed, n=300):
        rng = random.Random(seed)
        keys = ["hot"] * 6 + ["a", "b", None]
        left = [(rng.choice(keys), rng.choice([None, *range(-50, 200)]), f"l{i}") for i in range(n)]
        right = [(rng.choice([*keys, "only right"]), rng.choice([None, *range(-50, 200)]), f"r{i:03}") for i in range(n // 3)]
        return left + left[:5], right + right[:5]

    @pytest.mark.parametrize("strict", [True, False])
    @pytest.mark.parametrize("width", [1, 7, 1000])
    def test_against_brute_force(self, spark, strict, width):
        left, right = self.rows(width)
        a, b = spark.createDataFrame(left, "k string, t bigint, v string"), spark.createDataFrame(right, "k string, t bigint, w string")
        got = asof_join(a, b, ["k"], F.col("t"), F.col("t"), ["w"], width, strict)
        assert got.columns == ["k", "t", "v", "asof_w"]
        assert Counter(map(tuple, got.collect())) == brute_asof(left, right, strict)

    def test_ties_dates_and_no_key(self, spark):
        day = lambda d: datetime.date(2026, 1, d)
        left = spark.createDataFrame([(day(3),), (day(1),), (None,)], "post date")
        right = spark.createDataFrame([(day(2), 1, "x"), (day(2), 3, "c"), (day(2), 2, "z"), (day(3), 9, "same day")], "day date, rank int, w string")
        got = asof_join(left, right, [], micros(F.col("post")), micros(F.col("day")), ["w", "day"], 86_400_000_000, ties=["rank"])
        assert {tuple(r) for r in got.collect()} == {(day(3), "c", day(2)), (day(1), None, None), (None, None, None)}
        assert asof_join(left.limit(0), right, [], micros(F.col("post")), micros(F.col("day")), ["w"], 10).count() == 0
        empty = asof_join(left, right.limit(0), [], micros(F.col("post")), micros(F.col("day")), ["w"], 10)
        assert empty.count() == 3 and empty.where("asof_w is not null").count() == 0

    def test_a_carried_null_counts(self, spark):
        left, right = spark.createDataFrame([(5,)], "t bigint"), spark.createDataFrame([(1, "a"), (3, None)], "t bigint, w string")
        assert asof_join(left, right, [], F.col("t"), F.col("t"), ["w"], 100).first()["asof_w"] is None
        assert asof_join(left, right, [], F.col("t"), F.col("t"), ["w"], 1).first()["asof_w"] is None

    def test_no_key_is_sorted_as_a_whole(self, spark):
        left, right = spark.createDataFrame([("h", 5)], "k string, t bigint"), spark.createDataFrame([("h", 1)], "k string, t bigint")
        plan = asof_join(left, right, ["k"], F.col("t"), F.col("t"), ["t"], 4)._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan and "__bucket" in plan


class TestRange:
    @pytest.mark.parametrize("width", [1, 5, 64])
    @pytest.mark.parametrize("by", [[], ["k"]])
    def test_against_brute_force(self, spark, width, by):
        rng = random.Random(width)
        points = [(rng.choice("aab"), rng.choice([None, *range(-30, 60)]), i) for i in range(200)]
        windows = [(rng.choice("abc"), s, None if s is None or rng.random() < 0.05 else s + rng.randrange(-3, 40), i) for i, s in
                   ((i, rng.choice([None, *range(-40, 70)])) for i in range(60))]
        met = range_join(spark.createDataFrame(points, "k string, t bigint, p int"), spark.createDataFrame(windows, "k string, s bigint, e bigint, w int"),
                         F.col("t"), F.col("s"), F.col("e"), width, by)
        want = Counter((p, w) for k, t, p in points for j, s, e, w in windows if None not in (t, s, e) and s <= t < e and (not by or k == j))
        assert Counter((r["p"], r["w"]) for r in met.select("point.p", "window.w").collect()) == want
        plan = met._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan


DEEP = {"a": [{"b": {"c": [[["https://arxiv.org/abs/2601.00001", {"d": {"e": {"f": "arxiv.org/abs/2601.00002v1"}}}]]]}}], "n": 5, "t": True, "z": None,
        "https://arxiv.org/abs/9999.99999": "key only", "empty": {}, "list": [], "quote": 'say "arxiv.org/abs/2601.00003" \\ end', "ü": "ä\n"}


def leaves(value):
    if isinstance(value, str):
        return [value]
    return [x for v in (value.values() if isinstance(value, dict) else value if isinstance(value, list) else []) for x in leaves(v)]


class TestJsonWalk:
    def frame(self, spark, *texts):
        return spark.createDataFrame(list(enumerate(texts)), "value int, payload string").withColumnRenamed("value", "n")

    def test_every_string_at_any_depth(self, spark):
        nested = "x"
        for k in range(30):
            nested = [nested, f"d{k}"] if k % 2 else {"k": nested, "l": f"d{k}"}
        docs = [DEEP, [], {}, "alone", 5, None, nested, [["a", ["a"]], "a"]]
        got = Counter((r["n"], r["value"]) for r in string_leaves(self.frame(spark, *map(json.dumps, docs)), "payload").collect())
        assert got == Counter((n, s) for n, d in enumerate(docs) for s in leaves(d))

    def test_escapes_are_resolved(self, spark):
        texts = [json.dumps(DEEP).replace("/", "\\u002f"), json.dumps(DEEP).replace("/", "\\/"), json.dumps(DEEP, ensure_ascii=False)]
        frame = self.frame(spark, *texts)
        want = {"2601.00001", "2601.00002", "2601.00003"}
        found = {}
        for r in harvested_ids(frame, "payload").collect():
            found.setdefault(r["n"], set()).add(r["id"])
        assert found == {k: want for k in range(3)}
        assert [set(r["ids"]) for r in frame.select(harvest_ids(F.col("payload")).alias("ids")).collect()] == [want] * 3

    def test_broken_and_missing_texts(self, spark):
        frame = self.frame(spark, '{"a": "x"', None, '"y"')
        assert [(r["n"], r["value"]) for r in string_leaves(frame, "payload", tolerant=True).collect()] == [(2, "y")]
        with pytest.raises(Exception, match="MALFORMED"):
            string_leaves(frame, "payload").collect()
        assert string_leaves(frame.limit(0), "payload").count() == 0

    def test_variant_columns_and_clashing_names(self, spark):
        frame = self.frame(spark, '{"a": ["x"]}').withColumns({"v": F.parse_json("payload"), "pos": F.lit(1), "key": F.lit("k")}).drop("payload")
        assert [tuple(r) for r in string_leaves(frame, "v").collect()] == [(0, 1, "k", "x")]
