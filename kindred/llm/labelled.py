"""Labelled rows to learn from, and the split that is held out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

FOLDS = 5


def held_out(doc_id: Column) -> Column:
    """Every row whose id, as text, has a checksum divisible by five. A null id is learned from by nobody."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, label: str, most: int) -> DataFrame:
    """text, label of labelled rows that are not held out, about ``most`` at the most.

    Both sides are cut by the same hash of the id before they meet, so only the sample
    is shuffled. A document with several labels counts with each.
    """
    usable = labels.filter(F.col(label).isin(0, 1) & ~held_out(F.col("doc_id")) & F.col("doc_id").isNotNull())
    count = usable.count()
    share = F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 20)) < F.lit(
        (1 << 20) if count <= most else int((1 << 20) * most / count))
    chosen = usable.filter(share).select("doc_id", F.col(label).cast("int").alias("label"))
    return docs.select("doc_id", "text").filter(share).join(chosen, "doc_id").select("text", "label")


def long_id(docs: DataFrame, column: str) -> Column:
    """The ids of ``docs`` as longs: whole numbers as they are, any other text as its 64-bit hash."""
    given = F.col(column)
    if isinstance(docs.schema[column].dataType, T.IntegralType):
        return given.cast("long")
    return F.when(given.isNotNull(), F.coalesce(given.try_cast("long"), F.xxhash64(given)))
