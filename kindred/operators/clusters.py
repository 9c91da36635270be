"""Clusters of nearly equal unit vectors, and which cluster pairs need no comparison.

Vectors whose heavy weights fall in the same cells of a grid make a bucket. The mean of
a bucket on its *core*, the ingredients that half of it has, is a *centre*. Vectors that
a cell border cut off from the rest meet it again on shifted and finer grids. Nothing
depends on what the grids miss: whatever is in no cluster is compared as before.

Weights are positive, so the product of two vectors is at least that of their core
parts: m·n·cos(α + β), where m and n are the lengths of the parts and α and β their
angles to the centre. As -ln cos(α + β) <= 1.01 (α² + β²) for angles up to 0.05, it is at or
above the ceiling if the *costs* -ln m + 1.01 α² of both add up to at most -ln(ceiling). Members of
a cluster cost at most half of that, so no two of them need to be compared.

Two clusters of one core are bounded in the same way, with the angle between their
centres; any two by the triangle inequality on the angles of whole vectors, from both
sides. A pair of clusters whose members are all at or above the ceiling, or all below
the floor of every query in it, is settled by one comparison, whatever their numbers.
"""

from __future__ import annotations

import functools
import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kindred.session import materialise

#: Cell width and offset of the grids, in the order they are tried.
GRIDS = ((0.15, 0.5), (0.15, 0.83), (0.15, 0.17), (0.05, 0.5), (0.05, 0.83), (0.05, 0.17))
#: Members that a bucket needs to become a cluster.
MIN_MEMBERS = 16
#: Slack for rounding in angles and in costs.
SLACK = 1e-6
COST_SLACK = 1e-8
#: Angles up to here obey the bound on their cosine.
LARGEST_TURN = 0.05


@dataclass(frozen=True)
class Clusters:
    """``members``: side, profile, cluster. ``centres``: cluster, ingredient, u (of length 1).
    ``radii``: cluster, core (a hash of the ingredients), and over the members the least
    length m in the core, the largest angle there, and the largest angle of the whole vector."""

    members: DataFrame
    centres: DataFrame
    radii: DataFrame


def _signature(number: int) -> Column:
    width, offset = GRIDS[number]
    cell = F.floor(F.col("u") / width + offset)
    return F.bit_xor(F.when(cell >= 1, F.xxhash64("ingredient", cell))).alias(f"s{number}")


def _angle(cosine: Column) -> Column:
    return F.acos(F.least(F.lit(1.0), F.greatest(F.lit(-1.0), cosine)))


def largest_angle(ceiling: float) -> float:
    return math.acos(ceiling) - SLACK


def largest_cost(ceiling: float) -> float:
    return -math.log(ceiling) - COST_SLACK


def find_clusters(rows: DataFrame, ceiling: float) -> Clusters | None:
    """``rows``: side, profile, ingredient, u, of unit vectors all ingredients that count in a product."""
    vector = ["side", "profile"]
    signed = materialise(rows.groupBy(*vector).agg(*map(_signature, range(len(GRIDS)))), "signatures")
    cells = F.explode(F.array(*[F.struct(F.lit(i).alias("grid"), F.col(f"s{i}").alias("sign")) for i in range(len(GRIDS))]))
    filled = signed.select(cells.alias("c")).filter("c.sign IS NOT NULL").groupBy("c.grid", "c.sign").agg(
        F.count(F.lit(1)).alias("n")).filter(F.col("n") >= MIN_MEMBERS)
    tried = sorted(r.grid for r in filled.select("grid").distinct().collect())
    found: list[tuple[DataFrame, DataFrame]] = []
    for number in tried:
        sign = F.col(f"s{number}")
        members = functools.reduce(DataFrame.unionByName, [m for m, _ in found]) if found else None
        free = signed.filter(sign.isNotNull())
        if found:
            free = free.join(members, vector, "left_anti")
            near = signed.join(members, vector).groupBy(sign.alias("sign")).agg(F.min("cluster").alias("cluster"))
            centres = functools.reduce(DataFrame.unionByName, [c for _, c in found])
            joining = free.withColumn("sign", sign).join(near, "sign").select(*vector, "cluster")
            joined = materialise(_close(joining, rows, centres, ceiling), "joined")
            if not joined.isEmpty():
                found.append((joined, centres.limit(0)))
                free = free.join(joined, vector, "left_anti")
        large = free.groupBy(sign.alias("sign")).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= MIN_MEMBERS)
        buckets = materialise(free.withColumn("sign", sign).join(large, "sign").select(
            *vector, F.xxhash64("sign", F.lit(number)).alias("cluster")), "buckets")
        if buckets.isEmpty():
            continue
        sizes = buckets.groupBy("cluster").agg(F.count(F.lit(1)).alias("size"))
        core = buckets.join(rows, vector).groupBy("cluster", "ingredient").agg(
            F.sum("u").alias("s"), F.count(F.lit(1)).alias("n")).join(sizes, "cluster").filter("2 * n >= size")
        norms = core.groupBy("cluster").agg(F.sqrt(F.sum(F.col("s") * F.col("s"))).alias("norm"))
        centres = materialise(core.join(norms, "cluster").select(
            "cluster", "ingredient", (F.col("s") / F.col("norm")).alias("u")), "centres")
        close = materialise(_close(buckets, rows, centres, ceiling), "close")
        if not close.isEmpty():
            found.append((close, centres))
    if not found:
        return None
    everyone = materialise(functools.reduce(DataFrame.unionByName, [m for m, _ in found]), "clustered")
    centres = functools.reduce(DataFrame.unionByName, [c for _, c in found])
    cores = centres.groupBy("cluster").agg(F.bit_xor(F.xxhash64("ingredient")).alias("core"))
    radii = materialise(everyone.groupBy("cluster").agg(
        F.min("m").alias("m"), F.max("angle").alias("angle"), F.max("whole").alias("whole"),
        F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n").join(cores, "cluster"), "radii")
    return Clusters(everyone.join(radii, "cluster", "left_semi").select(*vector, "cluster"),
                    materialise(centres.join(radii, "cluster", "left_semi"), "centres"), radii)


def _close(asked: DataFrame, rows: DataFrame, centres: DataFrame, ceiling: float) -> DataFrame:
    """side, profile, cluster, m, angle, whole of those asked that cost at most half of what the ceiling allows."""
    in_core = asked.join(rows, ["side", "profile"]).join(
        centres.withColumnRenamed("u", "c"), ["cluster", "ingredient"]).groupBy("side", "profile", "cluster").agg(
        F.sum(F.col("u") * F.col("c")).alias("cosine"), F.sqrt(F.sum(F.col("u") * F.col("u"))).alias("m"))
    return in_core.select(
        "side", "profile", "cluster", "m", _angle(F.col("cosine") / F.col("m")).alias("angle"),
        _angle(F.col("cosine")).alias("whole"),
    ).filter((F.col("angle") <= LARGEST_TURN)
             & (-F.log("m") + 1.01 * F.col("angle") * F.col("angle") <= largest_cost(ceiling) / 2))


def compare(probes: DataFrame, postings: DataFrame, clusters: Clusters, ceiling: float) -> DataFrame:
    """ca, cb, state of cluster pairs that share an ingredient: ``above`` (every pair of
    members is at or above the ceiling), ``below`` (every one below the least floor of
    the queries) or ``open``.

    ``probes``: cluster_a, ingredient, floor. ``postings``: cluster_b, ingredient.
    """
    asked = probes.filter("cluster_a IS NOT NULL").groupBy(F.col("cluster_a").alias("ca"), "ingredient").agg(
        F.min("floor").alias("floor"))
    held = postings.filter("cluster_b IS NOT NULL").select(F.col("cluster_b").alias("cb"), "ingredient").distinct()
    touching = materialise(asked.join(held, "ingredient").groupBy("ca", "cb").agg(F.min("floor").alias("floor")),
                           "touching")
    centre = {x: clusters.centres.select(F.col("cluster").alias(f"c{x}"), "ingredient", F.col("u").alias(f"u{x}"))
              for x in "ab"}
    radius = {x: clusters.radii.select(F.col("cluster").alias(f"c{x}"), F.struct("core", "m", "angle", "whole").alias(x))
              for x in "ab"}
    cosine = touching.join(centre["a"], "ca").join(centre["b"], ["cb", "ingredient"]).groupBy("ca", "cb").agg(
        F.sum(F.col("ua") * F.col("ub")).alias("cosine"))
    angle = _angle(F.coalesce("cosine", F.lit(0.0)))
    a, b = F.col("a"), F.col("b")
    spread = a["whole"] + b["whole"] + SLACK
    turned = F.when(F.col("ca") == F.col("cb"), 0.0).otherwise(angle) + a["angle"] + b["angle"] + SLACK
    cost = -F.log(a["m"] * b["m"] * F.cos(F.least(turned, F.lit(1.5))))
    above = (F.col("ca") == F.col("cb")) | (angle + spread <= largest_angle(ceiling)) | (
        (a["core"] == b["core"]) & (cost <= largest_cost(ceiling)))
    below = F.cos(F.greatest(F.lit(0.0), angle - spread)) < F.col("floor")
    return materialise(
        touching.join(cosine, ["ca", "cb"], "left").join(radius["a"], "ca").join(radius["b"], "cb").select(
            "ca", "cb", F.when(above, "above").when(below, "below").otherwise("open").alias("state")), "compared")
