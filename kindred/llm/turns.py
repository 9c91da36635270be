"""Positions of rows inside their groups, also of groups that one task could not hold.

Rows are dealt by ranges of the key and the order, so a group of any size is cut
into chunks of neighbouring ranges. Each chunk numbers its own rows; the sizes of the
chunks before it are added. Rows that agree in the key and in the whole order are
told apart by a hash of their place, so that even they can be split.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kindred.session import materialise


def run_starts(keys: pa.Array) -> np.ndarray:
    """Where a run of equal keys begins; keys are sorted and not null."""
    values = keys.to_numpy(zero_copy_only=False)
    return np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]]))


def ranked(rows: DataFrame, key: str, order: list[Column], label: str) -> DataFrame:
    """``rows`` with ``pos``, from 1 in each group of ``key`` (long, not null) by ``order``.

    Rows equal in all of ``order`` follow each other in any order. Columns that begin
    with an underscore are dropped.
    """
    kept = [c for c in rows.columns if not c.startswith("_")]
    spread = F.xxhash64(F.monotonically_increasing_id())
    by = [f"_order_{i}" for i in range(len(order))]
    ranges = (
        rows.select(*kept, *(c.alias(n) for c, n in zip(order, by, strict=True)), spread.alias("_tie"))
        .repartitionByRange(key, *by, "_tie").sortWithinPartitions(key, *by, "_tie")
        .select(*kept, F.spark_partition_id().alias("_chunk")))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, seen = None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column(key)
            starts = run_starts(keys)
            local = np.arange(1, batch.num_rows + 1) - np.repeat(starts, np.diff(np.append(starts, batch.num_rows)))
            if keys[0].as_py() == last:
                local[:starts[1] if len(starts) > 1 else batch.num_rows] += seen
            last, seen = keys[-1].as_py(), int(local[-1])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(local, pa.int64())],
                                             names=[*batch.schema.names, "_local"])

    numbered = materialise(ranges.mapInArrow(
        count, T.StructType([*ranges.schema.fields, T.StructField("_local", T.LongType())])), label)
    earlier = W.partitionBy(key).orderBy("_chunk").rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        numbered.groupBy(key, "_chunk").agg(F.max("_local").alias("_size"))
        .withColumn("_offset", F.sum("_size").over(earlier))
        .filter("_offset IS NOT NULL").select(key, "_chunk", "_offset"))
    return numbered.join(offsets, [key, "_chunk"], "left").select(
        *kept, (F.col("_local") + F.coalesce("_offset", F.lit(0))).alias("pos"))


def rows_of(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text without nulls in the last two; rows without a conversation go."""
    return conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn",
        *(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")))
