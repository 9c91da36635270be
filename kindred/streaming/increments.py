"""Silver and document frequencies of arriving files, one part for each batch.

A part is made from its batch alone: the silver rows of its listings (their texts are
cleaned here and never again), how many products hold each ingredient, how many
products there are, and how often each content occurs, so that later copies of a record
go on with their numbers. Products of different parts are different, so frequencies and
counts of the catalogue are sums over the parts. A batch that is tried again overwrites
its own part and reads only those before it, so it changes nothing.

Gold depends on all products, since each new one changes every weight. It is made once
for all batches of a trigger, from the parts.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kindred import schemas
from kindred.operators import bronze, weigh
from kindred.session import matching, scratch

#: Number of the part that holds what does not arrive as a stream.
STANDING = -1

_COPIES = T.StructType([T.StructField(n, T.LongType()) for n in ("_k1", "_k2", "copies", "batch_id")])
_FREQUENCY = T.StructType([T.StructField("ingredient", T.StringType()), T.StructField("doc_freq", T.LongType()),
                           T.StructField("batch_id", T.LongType())])
_PRODUCTS = T.StructType([T.StructField("products", T.LongType()), T.StructField("batch_id", T.LongType())])


@dataclass(frozen=True)
class Parts:
    """The parts below a folder, which every executor can reach."""

    spark: SparkSession
    path: str

    def _read(self, kind: str, schema: T.StructType) -> DataFrame:
        if not matching(self.spark, f"{self.path}/{kind}/batch_id=*"):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.path}/{kind}")

    def has(self, batch_id: int) -> bool:
        """Whether a part is there as a whole: its products are counted last."""
        return bool(matching(self.spark, f"{self.path}/products/batch_id={batch_id}/_SUCCESS"))

    def add(self, listings: DataFrame, source: str, batch_id: int) -> None:
        """``listings`` (url, brand, product_name, price_eur, ingredients_raw) as the part
        ``batch_id``; only a part of the same number is replaced."""
        kept = bronze.with_text(bronze.with_key(listings)).select(
            "url", "brand", "product_name", "price_eur", "ingredients_raw")
        self._write(bronze.copy_counts(kept), f"copies/source={source}", batch_id)
        earlier = self.spark.read.schema(T.StructType([*_COPIES.fields, T.StructField("source", T.StringType())])).parquet(
            f"{self.path}/copies").filter((F.col("source") == source) & (F.col("batch_id") < batch_id))
        with scratch(self.spark):
            self._write(bronze.to_silver(kept, source, earlier=earlier), "silver", batch_id)
        part = self.silver().filter(F.col("batch_id") == batch_id)
        self._write(weigh.document_frequency(weigh.cells(part)), "frequency", batch_id)
        self._write(weigh.product_count(part), "products", batch_id)

    def _write(self, rows: DataFrame, kind: str, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(f"{self.path}/{kind}/batch_id={batch_id}")

    def silver(self) -> DataFrame:
        """Silver of all parts, with batch_id."""
        return self._read("silver", T.StructType([*schemas.SILVER.fields, T.StructField("batch_id", T.LongType())]))

    def weights(self) -> DataFrame:
        """As ``weigh.weigh`` of all silver rows, with the frequencies and counts of the parts."""
        total = self._read("products", _PRODUCTS).agg(F.sum("products").alias("products"))
        return weigh.weigh(self.silver().drop("batch_id"), self.frequency(), total.scalar())

    def frequency(self) -> DataFrame:
        """ingredient, doc_freq over all parts."""
        return weigh.merged_frequency(self._read("frequency", _FREQUENCY))
