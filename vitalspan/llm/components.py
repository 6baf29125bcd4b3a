"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitalspan.llm.common import dropped, written


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``root``, the same for connected nodes, for every node that has a link.

    In each round every node of the contracted graph hooks to its least neighbour, if that is less
    than itself; links between the same trees go. Ids that are hashes make rounds few, as a
    part of all nodes that does not depend on their number hooks in each. Each round's links are
    written, so that lineage stays short; minima are combined before they are shuffled.
    """
    pairs = links.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u <> v")
    both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
    edges = written(both.distinct(), "links")
    labels = written(edges.select("u").distinct().selectExpr("u AS node", "u AS root"), "labels")
    while not edges.isEmpty():
        hooks = written(
            edges.groupBy("u").agg(F.least("u", F.min("v")).alias("p")), "hooks"
        )
        # two steps up the tree at once, which halves chains
        up = hooks.alias("x").join(hooks.alias("y"), F.col("x.p") == F.col("y.u"), "left")
        up = written(
            up.select(F.col("x.u").alias("u"), F.coalesce("y.p", "x.p").alias("p")), "hooks"
        )
        moved = labels.join(up, labels["root"] == up["u"], "left").select(
            "node", F.coalesce("p", "root").alias("root")
        )
        v_up = up.withColumnsRenamed({"u": "v", "p": "q"})
        left = edges.join(up, "u").join(v_up, "v").select(
            F.col("p").alias("u"), F.col("q").alias("v")
        )
        old = [edges, labels, hooks, up]
        labels = written(moved, "labels")
        edges = written(left.filter("u <> v").distinct(), "links")
        for table in old:
            dropped(table)
    return labels
