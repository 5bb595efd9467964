"""Connected components by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyweave.llm.workspace import Workspace


def components(edges: DataFrame, workspace: Workspace, name: str = "cc") -> DataFrame:
    """``node``, ``root`` for every node of ``edges`` (``a``, ``b``, not null); the root is the smallest node.

    In each round every group of nodes takes the smallest neighbouring group as its parent, chains of parents are
    followed by doubling, and edges are rewritten to the roots. Rounds at least halve the groups that still have
    edges. Minima are aggregated before the shuffle, and both sides of each join are written tables, so that Spark can
    split the rows of a node with very many edges.
    """
    links = workspace.keep(
        edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(),
        f"{name}-0",
    )
    labels = None
    step = 0
    while not links.isEmpty():
        step += 1
        both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parents = workspace.keep(
            both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("root")),
            f"{name}-parent-{step}-0",
        )
        hop = 0
        while True:
            upper = parents.select(F.col("node").alias("root"), F.col("root").alias("top"))
            ahead = parents.join(upper, "root").select("node", "top", (F.col("top") != F.col("root")).alias("moved"))
            ahead = workspace.keep(ahead, f"{name}-parent-{step}-{hop + 1}")
            workspace.drop(f"{name}-parent-{step}-{hop}")
            hop += 1
            parents = ahead.select("node", F.col("top").alias("root"))
            if ahead.where("moved").isEmpty():
                break
        if labels is None:
            labels = parents
        else:
            renamed = parents.select(F.col("node").alias("root"), F.col("root").alias("top"))
            labels = workspace.keep(
                labels.join(renamed, "root", "left").select("node", F.coalesce("top", "root").alias("root")),
                f"{name}-label-{step}",
            )
        x = parents.select(F.col("node").alias("a"), F.col("root").alias("x"))
        y = parents.select(F.col("node").alias("b"), F.col("root").alias("y"))
        links = workspace.keep(
            links.join(x, "a").join(y, "b").where("x <> y")
            .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(),
            f"{name}-{step}",
        )
        workspace.drop(f"{name}-{step - 1}")
    if labels is None:
        return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return labels
