"""Connected components of links that never leave the executors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindred.session import materialise


def components(links: DataFrame) -> DataFrame | None:
    """node, root (the smallest node reachable) of every node of ``links`` (a, b long).

    Each round hangs every node below its smallest neighbour, shortens the chains
    until all point at their tree's root, and goes on with the links between trees.
    Trees at least halve in number, chains halve in length with every step, so both
    loops are logarithmic. None if there is no link.
    """
    edges = materialise(links.filter("a <> b").select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    mapping = None
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parents = materialise(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("other"))
                              .select("node", F.least("node", "other").alias("root")), "parents")
        while True:
            up = parents.select(F.col("node").alias("root"), F.col("root").alias("above"))
            risen = materialise(parents.join(up, "root").select(
                "node", F.col("above").alias("root"), (F.col("above") != F.col("root")).alias("moved")), "parents")
            parents = risen.drop("moved")
            if risen.filter("moved").isEmpty():
                break
        above = parents.select(F.col("node").alias("root"), F.col("root").alias("above"))
        mapping = parents if mapping is None else materialise(
            mapping.join(above, "root", "left").select("node", F.coalesce("above", "root").alias("root"))
            .unionByName(parents.join(mapping.select("node"), "node", "left_anti")), "roots")
        ends = {x: parents.select(F.col("node").alias(x), F.col("root").alias(f"root_{x}")) for x in "ab"}
        edges = materialise(
            edges.join(ends["a"], "a").join(ends["b"], "b").filter("root_a <> root_b")
            .select(F.least("root_a", "root_b").alias("a"), F.greatest("root_a", "root_b").alias("b")).distinct(),
            "edges")
    return mapping
