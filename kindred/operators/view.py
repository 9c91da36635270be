"""Queries over the serving items: search, filters, order, savings, statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kindred.functions.fields import match_percent, price_label

ALL_BRANDS = "All brands"


def best_similarity() -> Column:
    """Similarity of the first match, null for an item without matches."""
    return F.get("top_matches", F.lit(0))["cosine_similarity"].cast("double")


def search(items: DataFrame, text: str | None) -> DataFrame:
    """Literal, case-insensitive part of the name or of the brand; empty = all."""
    if not text:
        return items
    wanted = F.lit(text.lower())
    return items.filter(F.contains(F.lower("product_name"), wanted)
                        | F.contains(F.lower("brand"), wanted))


def of_brand(items: DataFrame, brand: str = ALL_BRANDS) -> DataFrame:
    return items if brand == ALL_BRANDS else items.filter(F.col("brand") == brand)


def at_least(items: DataFrame, similarity: float) -> DataFrame:
    """Items whose best match reaches ``similarity``; 0 = no filter."""
    return items.filter(best_similarity() >= similarity) if similarity > 0 else items


def by_similarity(items: DataFrame) -> DataFrame:
    return items.orderBy(F.coalesce(best_similarity(), F.lit(0.0)).desc(), "item_key")


def browse(items: DataFrame, text: str | None = None, brand: str = ALL_BRANDS,
           similarity: float = 0.0) -> DataFrame:
    """All filters, then best match first: the list the view shows."""
    return by_similarity(at_least(of_brand(search(items, text), brand), similarity))


def brands(items: DataFrame) -> DataFrame:
    """Brands in order with the number of their items. The items of one brand are
    ``of_brand``: they are never gathered into one row."""
    return items.groupBy("brand").agg(F.count(F.lit(1)).alias("items")).orderBy("brand")


def known(price: Column) -> Column:
    """A price that is null or 0 counts as unavailable."""
    return F.coalesce(price, F.lit(0)) != 0


def savings(items: DataFrame) -> DataFrame:
    """Per match: price difference where both are known, and its label."""
    rows = items.select(
        "item_key", "product_name", F.col("price_eur").alias("query_price_eur"),
        F.inline("top_matches").alias("rank", "match_product_name", "match_brand",
                                      "match_price_eur", "match_url", "cosine_similarity"))
    gain = F.when(known(F.col("query_price_eur")) & known(F.col("match_price_eur")),
                  F.col("query_price_eur") - F.col("match_price_eur"))
    amount = F.format_string("%.2f", F.abs("savings").cast("double"))
    return rows.withColumn("savings", gain).select(
        "item_key", "rank", "match_product_name", F.col("savings").cast("double").alias("savings"),
        F.when(F.col("savings") > 0, F.concat(F.lit("Save €"), amount))
        .when(F.col("savings").isNotNull(), F.concat(F.lit("+€"), amount)).alias("savings_label"))


def labels(items: DataFrame) -> DataFrame:
    """Texts of each match: percent, its price and the product's own price."""
    return items.select(
        "item_key", F.col("price_eur").alias("own"),
        F.inline("top_matches").alias("rank", "match_product_name", "match_brand",
                                      "price", "match_url", "similarity"),
    ).select(
        "item_key", "rank", match_percent(F.col("similarity")).alias("match_percent"),
        price_label(F.col("own"), "Price unavailable").alias("product_price"),
        price_label(F.col("price"), "—").alias("match_price"))


def statistics(items: DataFrame) -> DataFrame:
    """Products, brands, mean best similarity over all items, mean positive saving of
    the best match; one pass, one row."""
    own, best = F.col("price_eur").cast("double"), F.get("top_matches", F.lit(0))
    price = best["price_eur"].cast("double")
    gain = F.when(known(own) & known(price) & (own > price), own - price)
    return items.agg(
        F.count(F.lit(1)).alias("products"),
        F.count_distinct("brand").alias("brands"),
        (F.coalesce(F.sum(best_similarity()), F.lit(0.0))
         / F.greatest(F.count(F.lit(1)), F.lit(1))).alias("avg_similarity"),
        (F.coalesce(F.sum(gain), F.lit(0.0))
         / F.greatest(F.count(gain), F.lit(1))).alias("avg_saving"))
