"""Rows dealt to tasks by the bytes of their texts, for work that costs by the byte.

A file of few row groups is few tasks, and rows of very different lengths make uneven
ones even if their numbers agree. Here the running sum of bytes over the table is cut
into slices of one size, and each slice is a task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from kindred.session import materialise

#: Bytes of text in a slice at most, and slices for each core at least.
SLICE_BYTES = 128 << 20
SLICES_PER_CORE = 2
#: Bytes that a row counts besides its text.
ROW_BYTES = 64
#: A table whose largest task holds no more than this many slices, or no more than so many
#: bytes, stays as it is; also one of so many partitions that there is enough to deal out.
TOLERANCE, LEAST_BYTES, MOST_PARTS = 1.5, 6 << 20, 1000

#: Bits of a running row number below its partition, as Spark makes them.
_ROW_BITS = 33


def balance(df: DataFrame, text: str) -> DataFrame:
    """``df``, shuffled if need be so that every task holds about the same bytes of ``text``.

    Sizes alone are read first and written: a row number and a length for each row, summed
    up per partition and cut. One row per slice and partition comes to the driver. Rows whose
    numbers differ at the second reading (of a source without fixed order) are dealt
    less evenly, but each once.
    """
    spark = df.sparkSession
    marked = df.withColumn("_row", F.monotonically_increasing_id())
    sizes = materialise(marked.select(
        F.shiftright("_row", _ROW_BITS).alias("_part"), "_row",
        (F.coalesce(F.octet_length(text), F.lit(0)) + ROW_BYTES).cast("long").alias("_bytes")), "sizes")
    totals = {r[0]: r[1] for r in sizes.groupBy("_part").agg(F.sum("_bytes")).collect()}
    total = sum(totals.values())
    slices = max(SLICES_PER_CORE * spark.sparkContext.defaultParallelism, -(-total // SLICE_BYTES))
    width = max(1, -(-total // slices))
    if not totals or len(totals) > MOST_PARTS or max(totals.values()) <= max(TOLERANCE * width, LEAST_BYTES):
        return df
    before, offsets = 0, []
    for part in sorted(totals):
        offsets += [F.lit(part), F.lit(before)]
        before += totals[part]
    inside = W.partitionBy("_part").orderBy("_row").rowsBetween(W.unboundedPreceding, -1)
    begin = F.coalesce(F.sum("_bytes").over(inside), F.lit(0)) + F.create_map(*offsets)[F.col("_part")]
    cuts: dict[int, list[tuple[int, int]]] = {}
    numbered = sizes.withColumn("_slice", F.floor(begin / width))
    for part, number, row in numbered.groupBy("_part", "_slice").agg(F.min("_row")).collect():
        cuts.setdefault(part, []).append((number, row))
    # The slice of a row: the first of its partition, and one more for every cut at or before it.
    firsts, rows = [], []
    for part, found in cuts.items():
        found.sort()
        firsts += [F.lit(part), F.lit(found[0][0])]
        rows += [F.lit(part), F.array(*(F.lit(row) for _, row in found[1:])).cast("array<bigint>")]
    part = F.shiftright("_row", _ROW_BITS)
    passed = F.size(F.filter(F.create_map(*rows)[part], lambda cut: cut <= F.col("_row")))
    number = F.coalesce(F.create_map(*firsts)[part] + passed, F.lit(0))
    return marked.repartitionById(slices, F.pmod(number, F.lit(slices)).cast("int")).drop("_row")
