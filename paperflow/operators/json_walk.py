"""Walks JSON of any shape: every string at any depth, found by unfolding VARIANT values level by level.

A level is one narrow pass: the values of objects and arrays of the level before, of which strings are emitted and objects and arrays go on.
The walk ends when no container is left, so its length is the depth of the deepest document; the containers of each level lie in
the scratch folder.  Escapes (``\\u002f``, ``\\/``) are resolved by the parser, keys are no values, numbers, booleans and nulls no strings.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as V
from ..session import scratch_path


def string_leaves(rows: DataFrame, payload: str, tolerant: bool = False) -> DataFrame:
    """The other columns of ``rows`` with ``value``, one row per string of the JSON text ``payload`` (a text or a VARIANT column).

    The first text that is no JSON fails the job; with ``tolerant`` it has no strings.  A null text has none.
    """
    spark = rows.sparkSession
    others = [F.col(c).alias(c) for c in rows.columns if c != payload]
    kept = [c for c in rows.columns if c != payload]
    parsed = F.col(payload)
    if rows.schema[payload].dataType.simpleString() != "variant":
        parsed = F.try_parse_json(payload) if tolerant else F.parse_json(payload)
    level = rows.select(*others, parsed.alias("__node"))
    found = []
    while True:
        kind = F.schema_of_variant("__node")
        here = level.where("__node is not null").select(
            *kept, F.when(kind.startswith("OBJECT") | kind.startswith("ARRAY"), F.col("__node")).alias("__node"),
            F.when(kind == "STRING", F.variant_get("__node", "$", "string")).alias("value")).where("__node is not null or value is not null")
        path = scratch_path(spark, "json-level")
        here.write.parquet(path)
        here = spark.read.schema(here.schema).parquet(path)
        found.append(here.where("value is not null").select(*kept, "value"))
        inner = here.where("__node is not null").drop("value")
        if inner.isEmpty():
            return reduce(DataFrame.unionByName, found)
        unfolded = inner.lateralJoin(spark.tvf.variant_explode(F.col("__node").outer()))
        level = unfolded.select(*[inner[c] for c in kept], F.col("value").alias("__node"))


def harvested_ids(rows: DataFrame, payload: str, id_pattern: str = V.ABS_ID, tolerant: bool = False) -> DataFrame:
    """The other columns of ``rows`` with ``id``: the different ids, one match per string."""
    leaves = string_leaves(rows, payload, tolerant)
    return leaves.withColumn("id", F.regexp_extract("value", id_pattern, 1)).where("id <> ''").drop("value").distinct()
