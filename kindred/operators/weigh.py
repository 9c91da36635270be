"""Position-weighted TF-IDF in long form: one row per (product, ingredient)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kindred.operators.match import brand_lines, counted_lists, with_list_lengths

#: Fixed value: position given to a row whose position is missing or unreadable.
MISSING_POSITION = 999


def tolerant_position(position: Column | str) -> Column:
    return F.coalesce(_try_cast(position, "double"), F.lit(float(MISSING_POSITION)))


def _try_cast(col: Column | str, to: str) -> Column:
    col = F.col(col) if isinstance(col, str) else col
    return col.try_cast(to)


def term_frequency(position: Column | str) -> Column:
    """1 / position. Position 0 gives null rather than an error."""
    return F.try_divide(F.lit(1.0), tolerant_position(position))


def cells(silver: DataFrame) -> DataFrame:
    """The first value of every (product, ingredient), as a pivot would keep it.

    This grouping is the only wide shuffle of the raw rows in the weighting;
    repeats are collapsed before it by partial aggregation.
    """
    return (
        silver.filter(F.col("ingredient").isNotNull() & F.col("product_id").isNotNull())
        .groupBy("product_id", "ingredient")
        .agg(F.min(tolerant_position("position")).alias("position"))
    )


def product_count(silver: DataFrame) -> DataFrame:
    return silver.agg(F.count_distinct("product_id").alias("products"))


def document_frequency(cell_rows: DataFrame) -> DataFrame:
    """Distinct products per ingredient. ``cell_rows`` is distinct already, so a
    plain count (one partial row per ingredient and map task) is exact. It counts the
    position, never null, because a pruned column would keep the plan from reusing
    the shuffle of the cells."""
    return cell_rows.groupBy("ingredient").agg(F.count("position").alias("doc_freq"))


def merged_frequency(parts: DataFrame) -> DataFrame:
    """Document frequencies of a catalogue from those of parts that share no product."""
    return parts.groupBy("ingredient").agg(F.sum("doc_freq").alias("doc_freq"))


def weigh(silver: DataFrame, frequency: DataFrame | None = None, total: Column | None = None,
          products: DataFrame | None = None) -> DataFrame:
    """product_id, ingredient, position, doc_freq, tf, idf, tfidf.

    The number of products is a one-value scalar subquery. The frequency table is
    joined unhinted: it is broadcast only while its measured size allows it, and
    a hot ingredient otherwise has its product side split by the skew-join rule.
    ``frequency`` and ``total`` are counted from ``silver`` unless they are known. With
    ``products`` (see ``match.with_list_lengths``), the lengths of their lists are counted in the
    same pass and are added; the cells are then dealt by product, and once by ingredient.
    """
    rows = cells(silver if products is None else silver.repartition("product_id"))
    total = product_count(silver).scalar() if total is None else total
    if products is not None:
        rows = with_list_lengths(rows, products)
        rows = rows if frequency is None else rows.drop("doc_freq").join(frequency, "ingredient", "left")
    else:
        rows = rows.join(document_frequency(rows) if frequency is None else frequency, "ingredient", "left")
    return _weighted(rows, total)


def _weighted(rows: DataFrame, total: Column) -> DataFrame:
    return (
        rows.withColumn("tf", F.try_divide(F.lit(1.0), F.col("position")))
        .withColumn("idf", F.log(total / F.col("doc_freq")))
        .withColumn("tfidf", F.col("tf") * F.col("idf"))
        .select("product_id", "ingredient", "position", "doc_freq", "tf", "idf", "tfidf",
                *(c for c in ("postings", "match_line", "query_line") if c in rows.columns))
    )


def weigh_numbered(silver: DataFrame, numbers: DataFrame, products: DataFrame) -> DataFrame:
    """``weigh`` with ``products``, whose ids are numbers already: ``numbers`` (product_id, number) has that of every
    product in ``silver``. Ingredients are hashes.

    Texts and long ids are most of what a cell weighs. Two hashes (equal for others but by chance, 2^-128) stand for
    the ingredient before anything is shuffled, and the number for the product from where its cells lie together.
    """
    lines = brand_lines(products).withColumnRenamed("product_id", "number")
    of_product = numbers.select("product_id", "number").join(lines, "number", "left")
    rows = silver.filter(F.col("ingredient").isNotNull() & F.col("product_id").isNotNull()).select(
        "product_id", F.xxhash64("ingredient").alias("_ingredient"), F.xxhash64(F.lit("second"), "ingredient").alias("second"),
        tolerant_position("position").alias("position"))
    keys = ["number", "held_by", "asked_by", "_ingredient", "second"]
    found = rows.repartition("product_id").join(of_product, "product_id").groupBy("product_id", *keys).agg(
        F.min("position").alias("position")).select(*keys, "position").withColumnsRenamed(
        {"number": "product_id", "_ingredient": "ingredient"})
    return _weighted(counted_lists(found, "second"), numbers.agg(F.count(F.lit(1)).alias("products")).scalar())
