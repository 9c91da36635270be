"""File arrival as a stream: new bronze files start a refresh.

A structured stream over the landing folder replaces the storage event. Every
micro-batch is stored under its batch id, so a batch that is tried again after a
failure overwrites itself. After the batch the caller's ``each`` gets its rows alone, for
work that adds up (``increments``), and ``refresh`` all rows so far. There is no event
time and hence no watermark.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def watch(spark: SparkSession, landing: str, schema: T.StructType, fmt: str = "csv",
          files_per_batch: int | None = None, **options) -> DataFrame:
    reader = spark.readStream.schema(schema).format(fmt).options(**options)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(landing)


def store_arrivals(arrivals: DataFrame, bronze: str, checkpoint: str,
                   refresh: Callable[[DataFrame, int], None] | None = None,
                   each: Callable[[DataFrame, int], None] | None = None):
    """Start a query that takes all files that have arrived and then stops."""
    schema = arrivals.schema

    def store(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{bronze}/batch_id={batch_id}")
        if each is not None:
            each(batch.sparkSession.read.schema(schema).parquet(f"{bronze}/batch_id={batch_id}"), batch_id)
        if refresh is not None:
            refresh(read_arrivals(batch.sparkSession, bronze, schema), batch_id)

    return (arrivals.writeStream.foreachBatch(store)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def read_arrivals(spark: SparkSession, bronze: str, schema: T.StructType) -> DataFrame:
    """Everything stored so far with the batch it came in."""
    with_batch = T.StructType([*schema.fields, T.StructField("batch_id", T.LongType())])
    return spark.read.schema(with_batch).parquet(bronze)


def count_arrivals(stored: DataFrame) -> DataFrame:
    return stored.groupBy("batch_id").agg(F.count(F.lit(1)).alias("rows"))
