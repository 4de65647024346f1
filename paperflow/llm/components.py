"""Connected components of a graph given as links between long ids, by contraction.

Each round every node hooks onto its least neighbour, the chains so made are halved until they are flat, and the links are
mapped to the roots.  Nothing is gathered by node or component, so a node with very many links costs no more than its rows; all
steps are minima and joins over rows at rest in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged


def _flat(p: DataFrame) -> DataFrame:
    p = staged(p, "hooks")
    while True:
        step = p.alias("p").join(p.alias("n"), F.col("p.a") == F.col("n.b"), "left").select(
            "p.b", F.coalesce("n.a", "p.a").alias("a"), F.col("n.a").isNotNull().alias("moved"))
        step = staged(step, "hooks")
        if step.where("moved").isEmpty():
            return p
        p = step.drop("moved")


def _mapped(edges: DataFrame, p: DataFrame) -> DataFrame:
    for side in ("a", "b"):
        q = p.select(F.col("b").alias("__from"), F.col("a").alias("__to"))
        edges = edges.join(q, edges[side] == q["__from"], "left").withColumn(side, F.coalesce("__to", side)).drop("__from", "__to")
    return edges


def _links(edges: DataFrame) -> DataFrame:
    return edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` (the least id reachable) for every node that is not the least of its own component.

    ``edges`` has two long columns, in any direction, with repetitions and loops.
    """
    left = staged(_links(edges.toDF("a", "b")), "links")
    found = None
    while not left.isEmpty():
        hooks = _flat(left.groupBy("b").agg(F.min("a").alias("a")))
        if found is None:
            found = hooks
        else:
            later = hooks.select(F.col("b").alias("__from"), F.col("a").alias("__to"))
            found = staged(found.join(later, F.col("a") == F.col("__from"), "left").select("b", F.coalesce("__to", "a").alias("a")).unionByName(hooks), "roots")
        left = staged(_links(_mapped(left, hooks)), "links")
    if found is None:
        return left.select(F.col("b").alias("node"), F.col("a").alias("component"))
    return found.select(F.col("b").alias("node"), F.col("a").alias("component"))
