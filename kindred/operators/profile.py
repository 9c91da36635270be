"""Counts and shape of a stage.

Several exact distinct counts in one aggregate would copy every row once per counted
column. Here each column is counted on its own, as a subquery that reads that column
alone and shuffles its distinct values, one partial row per value and task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindred.operators.places import add_places


def distinct_count(df: DataFrame, column: str) -> DataFrame:
    """One row, ``n``: the exact number of distinct values, null not counted."""
    return df.select(F.col(column).alias("value")).groupBy("value").agg(F.lit(1).alias("one")).agg(F.count("value").alias("n"))


def profile(df: DataFrame, distinct: Sequence[str]) -> DataFrame:
    """Rows and exact distinct values (null not counted) of the given columns."""
    return df.agg(F.count(F.lit(1)).alias("rows")).select(
        "rows", *[distinct_count(df, c).scalar().alias(f"distinct_{c}") for c in distinct])


def count_by(df: DataFrame, *columns: str) -> DataFrame:
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("rows")).orderBy(*columns)


def sparsity(weighted: DataFrame) -> DataFrame:
    """Percent of zeros in the product × ingredient matrix, without building it.
    ``weighted`` has one row per (product, ingredient)."""
    by_ingredient = weighted.groupBy("ingredient").agg(F.count_if(F.col("tfidf") != 0).alias("filled"))
    counts = by_ingredient.agg(F.count("ingredient").alias("ingredients"), F.sum("filled").alias("filled"))
    cells = F.col("products").cast("double") * F.col("ingredients")
    return counts.withColumn("products", distinct_count(weighted, "product_id").scalar()).select(
        "products", "ingredients",
        (F.try_divide(cells - F.coalesce("filled", F.lit(0)), cells) * 100).alias("sparsity"))


def pivot_export(weighted: DataFrame, ingredients: Sequence[str]) -> DataFrame:
    """A dense block for chosen ingredients (0 where absent); the long form is the
    working representation, this one is for export."""
    return (weighted.filter(F.col("ingredient").isin(*ingredients))
            .groupBy("product_id").pivot("ingredient", list(ingredients))
            .agg(F.first("tfidf")).na.fill(0.0))


#: Ingredients that stand side by side in a block of the export.
BLOCK_WIDTH = 64


def pivot_columns(weighted: DataFrame, width: int = BLOCK_WIDTH) -> DataFrame:
    """ingredient, block, place: the column of each ingredient, by name, in blocks of ``width`` columns."""
    names = weighted.filter(F.col("ingredient").isNotNull()).select("ingredient").distinct()
    numbered = add_places(names, ["ingredient"], {"number": []}, "columns")
    return numbered.select(
        "ingredient", F.expr(f"(number - 1) div {width}").alias("block"), ((F.col("number") - 1) % width).cast("int").alias("place"))


def pivot_blocks(weighted: DataFrame, columns: DataFrame, width: int = BLOCK_WIDTH) -> DataFrame:
    """product_id, block, values: the product × ingredient matrix for export, in rows of ``width`` columns.

    ``columns`` is what ``pivot_columns`` gives. A row is made from the cells of one
    product in one block, at most ``width`` of them; absent ingredients are 0. Blocks
    in which a product has no cell are all 0 and have no row, so the export grows with
    the cells and not with products times ingredients.
    """
    cells = weighted.join(columns, "ingredient").groupBy("product_id", "block").agg(
        F.map_from_entries(F.collect_list(F.struct("place", "tfidf"))).alias("filled"))
    return cells.select("product_id", "block", F.transform(
        F.sequence(F.lit(0), F.lit(width - 1)), lambda i: F.coalesce(F.try_element_at("filled", i), F.lit(0.0))).alias("values"))
