"""Sharding by jump consistent hashing, with gapless slots inside each shard.

The shard of a row follows from its key and the number of shards alone (Lamping and
Veach, 2014): no ring table, and one more shard takes rows only into itself, about
1/(n+1) of them. Slots number the rows of a shard by key. They come from ranges of
the keys, not from one task per shard: each range counts its rows per shard, and the
counts of the ranges before it are added.

Defined results: a key that is no whole number counts as its hash, a null key as -1; a null text has no bytes and the checksum
of an empty one; repeated rows each get a slot of their own; an empty table gives no
rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from kindred.llm.labelled import long_id
from kindred.session import materialise

#: Fixed values of the method.
MULTIPLIER = 2862933555777941757
OVERHEAD_BYTES = 16


def jump(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each 64-bit key."""
    state = keys.astype(np.int64).view(np.uint64).copy()
    shard = np.zeros(len(state), np.int64)
    ahead = np.zeros(len(state), np.int64)
    live = np.arange(len(state))
    while len(live):
        shard[live] = ahead[live]
        state[live] = state[live] * np.uint64(MULTIPLIER) + np.uint64(1)
        draw = (state[live] >> np.uint64(33)).astype(np.float64) + 1.0
        ahead[live] = ((shard[live] + 1) * (float(1 << 31) / draw)).astype(np.int64)
        live = live[ahead[live] < shards]
    return shard


def assign(docs: DataFrame, shards: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, size, text_crc32, law, shard, slot, grown_shard.

    Only these few bytes a row are shuffled; texts are read once and stay behind.
    """
    rows = docs.select(
        long_id(docs, key).alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + OVERHEAD_BYTES).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("text_crc32"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("doc_id").fill_null(-1).to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(jump(keys, shards), pa.int32()),
                 pa.array(jump(keys, shards + 1), pa.int32())],
                names=[*batch.schema.names, "shard", "grown_shard"])

    placed = materialise(rows.mapInArrow(
        place, "doc_id long, size long, text_crc32 long, shard int, grown_shard int"), "placed")
    # Equal keys may be many: the last column lets the ranges split them.
    spread = F.xxhash64(F.monotonically_increasing_id())
    ranges = (
        placed.withColumn("_tie", spread)
        .repartitionByRange("doc_id", "text_crc32", "size", "_tie")
        .sortWithinPartitions("doc_id", "text_crc32", "size", "_tie").drop("_tie")
        .withColumn("_range", F.spark_partition_id())
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(shards, np.int64)
        for batch in batches:
            shard = batch.column("shard").to_numpy()
            order = np.argsort(shard, kind="stable")
            counts = np.bincount(shard, minlength=shards)
            before = np.concatenate([[0], np.cumsum(counts)[:-1]])
            local = np.empty(len(shard), np.int64)
            local[order] = np.arange(len(shard)) - before[shard[order]] + seen[shard[order]]
            seen += counts
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(local)],
                                             names=[*batch.schema.names, "_local"])

    numbered = materialise(ranges.mapInArrow(
        count, "doc_id long, size long, text_crc32 long, shard int, grown_shard int, _range int, _local long"),
        "numbered")
    earlier = W.partitionBy("shard").orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        numbered.groupBy("shard", "_range").agg(F.count(F.lit(1)).alias("n"))
        .select("shard", "_range", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_offset"))
    )
    return numbered.join(offsets, ["shard", "_range"]).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
        (F.col("_offset") + F.col("_local")).alias("slot"), "grown_shard")
