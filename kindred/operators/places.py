"""Ranks over a whole table and inside groups of any size, without a window over them.

Rows are dealt by ranges of the order. Each range numbers its own rows, and the counts
of the ranges before it are added, so neither a table nor a hot group passes through
one task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from kindred.session import materialise


def add_places(rows: DataFrame, order: Sequence[str], within: Mapping[str, Sequence[str]], label: str) -> DataFrame:
    """``rows`` with, for every item of ``within``, a column of that name: the place by
    ``order`` (from 1, no ties) among the rows that agree in the columns given for it.
    Those columns must not be null."""
    placed = materialise(rows.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), label)
    for name, columns in within.items():
        inside = W.partitionBy("_range", *columns).orderBy(*order)
        earlier = W.partitionBy(*columns).orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
        before = placed.groupBy("_range", *columns).agg(F.count(F.lit(1)).alias("_n")).withColumn(
            "_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0))).drop("_n")
        placed = placed.withColumn(name, F.row_number().over(inside)).join(before, ["_range", *columns]).withColumn(
            name, F.col(name) + F.col("_before")).drop("_before")
    return placed.drop("_range")


def free_places(blocked: DataFrame, wanted: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``wanted`` (keys, nth) with ``place``: the nth place, from 1, that is not among the
    key's ``blocked`` (keys, place, distinct).

    The i-th blocked place p leaves p - i free ones before it, so the nth free place is n
    plus the number of blocked places with p - i < n: one running sum over both.
    """
    by_place = W.partitionBy(*keys).orderBy("place")
    gaps = blocked.withColumn("_at", F.col("place") - F.row_number().over(by_place)).groupBy(*keys, "_at").agg(
        F.count(F.lit(1)).alias("_n"))
    # A wanted number stands before a gap of the same size, which does not count for it.
    both = wanted.select(*keys, F.col("nth").cast("long").alias("_at"), F.lit(0).cast("long").alias("_n"),
                         F.lit(0).alias("_kind")).unionByName(
        gaps.select(*keys, F.col("_at").cast("long").alias("_at"), "_n", F.lit(1).alias("_kind")))
    so_far = W.partitionBy(*keys).orderBy("_at", "_kind").rowsBetween(W.unboundedPreceding, W.currentRow)
    return both.withColumn("place", F.col("_at") + F.sum("_n").over(so_far)).filter("_kind = 0").select(
        *keys, F.col("_at").alias("nth"), "place")
