"""Totals of every subtree by parallel tree contraction (Miller and Reif, 1985).

Each round first *rakes*: leaves give what they have gathered to their parents and
go. Then it *compresses*: of each chain of nodes with one child, an independent part
is cut out, and the only child moves up to the parent of the cut node, with what the cut
node had gathered as the load of its new edge: it hands the load on when it is raked.
Cut nodes get their totals when the rounds are unwound: what they had gathered when
they were cut, plus the load of the edge and the total of the child they had then.

A tree loses all its leaves in a round. A chain of consecutive depths loses every
second node, because round r cuts where bit r of the depth is set: at any time its
nodes stand 2^r apart. Other chains lose a share of their nodes by hash. So rounds
are logarithmic in the number of nodes also for trees that are one long path, and
the rows of all rounds together are a small multiple of the tree.

A node with any number of children costs no more than its children's partial sums:
children are aggregated by parent, and joins go from a node to its only child, so
both sides have one row per key.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindred.session import materialise


def with_children(tree: DataFrame) -> DataFrame:
    """``tree`` (node, parent, …) with ``kids``, the number of each node's children."""
    counts = tree.filter("parent IS NOT NULL").groupBy(F.col("parent").alias("node")).agg(
        F.count(F.lit(1)).alias("kids"))
    return tree.join(counts, "node", "left").withColumn("kids", F.coalesce("kids", F.lit(0)))


def subtree_totals(tree: DataFrame, values: list[str]) -> DataFrame:
    """node and the sums of ``values`` (long) over its subtree, itself included.

    ``tree``: node, parent (null for roots; several roots are several trees), depth
    (long; any numbers give right totals, depths give few rounds), kids, and the values.
    """
    state = materialise(tree.select("node", "parent", "depth", "kids", *values, *(
        F.lit(0).cast("long").alias(f"load_{v}") for v in values)), "tree")
    deepest = state.agg(F.max("depth")).first()[0] or 0
    rounds: list[tuple[DataFrame, DataFrame]] = []
    while not state.isEmpty():
        step = _round(state, len(rounds), deepest, values)
        rounds.append((state, step))
        state = step.filter("NOT cut").select(state.columns)
    if not rounds:
        return tree.select("node", *values)
    done: DataFrame | None = None
    for number in range(len(rounds) - 1, -1, -1):
        before, after = rounds[number]
        parts = [before.filter("kids = 0").select("node", *values)]
        if done is not None:
            totals = done.select(F.col("node").alias("kid"), *(F.col(v).alias(f"below_{v}") for v in values))
            parts += [done, after.filter("cut").join(totals, "kid").select(
                "node", *((F.col(v) + F.col(f"edge_{v}") + F.col(f"below_{v}")).alias(v) for v in values))]
        done = functools.reduce(DataFrame.unionByName, parts)
        if number:  # so that every plan reads three tables, however many rounds there were
            done = materialise(done, "expanded")
    return done


def _round(state: DataFrame, number: int, deepest: int, values: list[str]) -> DataFrame:
    """The nodes that are no leaves, after raking: ``cut`` marks those compressed away
    into their only child ``kid``; the others have their new parent."""
    leaf = F.col("kids") == 0
    gathered = state.filter("parent IS NOT NULL").groupBy(F.col("parent").alias("node")).agg(
        F.count_if(leaf).alias("raked"), F.max(F.when(~leaf, F.col("node"))).alias("kid"),
        *(F.sum(F.when(leaf, F.col(v) + F.col(f"load_{v}")).otherwise(0)).alias(f"from_{v}") for v in values),
        *(F.sum(F.when(leaf, 0).otherwise(F.col(f"load_{v}"))).alias(f"edge_{v}") for v in values))
    coin = (F.shiftright("depth", number).bitwiseAND(1) == 1) if deepest >> number else (
        F.xxhash64("node", F.lit(number)).bitwiseAND(1) == 1)
    inner = state.filter(~leaf).join(gathered, "node").select(
        "node", "parent", "depth", (F.col("kids") - F.col("raked")).alias("kids"),
        *((F.col(v) + F.col(f"from_{v}")).alias(v) for v in values), *(f"load_{v}" for v in values),
        *(f"edge_{v}" for v in values), "kid",
        ((F.col("kids") - F.col("raked") == 1) & F.col("parent").isNotNull() & coin).alias("ready"))
    # A node whose parent is ready too waits, so no two neighbours are cut at once.
    above = inner.filter("ready").select(F.col("kid").alias("node"), F.lit(True).alias("waits"))
    chosen = inner.join(above, "node", "left").withColumn(
        "cut", F.col("ready") & F.col("waits").isNull()).drop("ready", "waits")
    moved = chosen.filter("cut").select(
        F.col("kid").alias("node"), F.col("parent").alias("higher"),
        *((F.col(v) + F.col(f"load_{v}")).alias(f"more_{v}") for v in values))
    return materialise(chosen.join(moved, "node", "left").withColumns({
        "parent": F.coalesce("higher", "parent"),
        **{f"load_{v}": F.col(f"load_{v}") + F.coalesce(f"more_{v}", F.lit(0)) for v in values},
    }).drop("higher", *(f"more_{v}" for v in values)), "contracted")
