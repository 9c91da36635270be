"""The catalogue job: bronze listings → silver → gold → serving items.

Each step is a function from DataFrames to a DataFrame. Only silver, gold and the
serving table are written; counts and checks ride on those writes.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from kindred.operators import bronze, match, nest, quality, weigh
from kindred.session import scratch
from kindred.sources import tables
from kindred.streaming import arrivals
from kindred.streaming.increments import STANDING, Parts

SOURCE_A, SOURCE_B = "a", "b"


@dataclass(frozen=True)
class Layout:
    """Where the stages live; every path must be reachable by all executors."""

    listing_a: str
    ingredients_a: str
    merged_b: str
    silver: str
    gold: str
    serving: str


def silver_rows(spark: SparkSession, at: Layout, stable_ids: bool = True, **given: DataFrame) -> DataFrame:
    """Silver of the three inputs: the CSV tables of the layout, or what is ``given`` for
    ``listing_a``, ``ingredients_a`` or ``merged_b`` (stored arrivals)."""
    return bronze.union_sources(*(bronze.to_silver(rows, source, stable_ids)
                                  for source, rows in _listings(spark, at, given).items()))


def _listings(spark: SparkSession, at: Layout, given: dict[str, DataFrame]) -> dict[str, DataFrame]:
    def read(name: str, columns: tuple[str, ...], sep: str = ",") -> DataFrame:
        if name in given:
            return tables.require_columns(given[name], columns)
        return tables.read_bronze(spark, getattr(at, name), sep=sep, columns=columns)

    listing = read("listing_a", ("url", "brand", "series", "price"), ";")
    texts = read("ingredients_a", ("url", "ingredients"))
    merged = read("merged_b", ("product_url", "brand", "product_name", "price", "ingredients"))
    return {SOURCE_A: bronze.listings_a(listing, texts), SOURCE_B: bronze.listings_b(merged)}


def gold_rows(silver: DataFrame, query_source: str = SOURCE_A, match_source: str = SOURCE_B,
              n: int = match.TOP_N, ceiling: float = match.SAME_PRODUCT,
              pad_zero: bool = True, weights: DataFrame | None = None) -> DataFrame:
    """Gold of silver rows; ``weights`` are those of ``weigh.weigh``, if they are known. If not, numbers stand for the
    products and hashes for the ingredients until the answers are ranked."""
    products = nest.first_per_product(silver)
    options = {"n": n, "ceiling": ceiling, "pad_zero": pad_zero}
    if weights is not None:
        ranked = match.rank_matches(weights, nest.sides(products, query_source, match_source), **options)
        return nest.attach_attributes(ranked, products)
    products = nest.with_numbers(products)
    numbers = products.drop("product_id").withColumnRenamed("number", "product_id")
    ranked = match.rank_matches(lambda listed: weigh.weigh_numbered(silver, products, listed),
                                nest.sides(numbers, query_source, match_source), **options)
    return nest.attach_attributes(ranked, products, "number")


def refresh_gold(spark: SparkSession, at: Layout, **options) -> DataFrame:
    """Gold from the silver table; an empty result fails before anything is replaced.
    The matching's intermediate tables go when gold is stored."""
    return _store_gold(spark, at, lambda: gold_rows(tables.read_silver(spark, at.silver), **options))


def _store_gold(spark: SparkSession, at: Layout, make: Callable[[], DataFrame]) -> DataFrame:
    with scratch(spark):
        tables.write_gold(make(), at.gold, check=lambda rows: quality.require_rows(rows, "gold"))
    return tables.read_gold(spark, at.gold)


def refresh_serving(spark: SparkSession, at: Layout) -> int:
    gold = quality.require_rows(tables.read_gold(spark, at.gold), "gold")
    items, seen = quality.counted(nest.nest_matches(gold))
    tables.write_serving(items, at.serving)
    return quality.verify_count(tables.read_serving(spark, at.serving), seen.get["rows"])


def run(spark: SparkSession, at: Layout, given: dict[str, DataFrame] | None = None, **options) -> int:
    """All stages; returns the number of serving items."""
    with scratch(spark):
        tables.write_silver(silver_rows(spark, at, **(given or {})), at.silver)
    refresh_gold(spark, at, **options)
    return refresh_serving(spark, at)


def on_arrival(at: Layout, name: str, **options) -> Callable[[DataFrame, int], None]:
    """What ``arrivals.store_arrivals`` calls after each batch of the input ``name``: the
    whole job over everything that has arrived. ``take_arrivals`` works on each batch once."""
    def refresh(rows: DataFrame, batch_id: int) -> None:
        run(rows.sparkSession, at, {name: rows.drop("batch_id")}, **options)
    return refresh


def take_arrivals(spark: SparkSession, at: Layout, name: str, arriving: DataFrame, stored: str, progress: str,
                  **options) -> int | None:
    """Take the files of the stream ``arriving`` (input ``name``, see ``arrivals.watch``) that
    are there, in as many batches as it makes, and refresh gold and serving once.

    The other inputs are those of the layout, whose listings are cleaned once. A listing
    that arrives is joined with all ingredient texts of the layout, and the other way
    round. Returns the number of serving items, or None if nothing was new.
    """
    source = SOURCE_B if name == "merged_b" else SOURCE_A
    parts = Parts(spark, f"{at.silver}-parts")
    taken: list[int] = []

    def add(rows: DataFrame, batch_id: int) -> None:
        parts.add(_listings(spark, at, {name: rows})[source], source, batch_id)
        taken.append(batch_id)

    arrivals.store_arrivals(arriving, stored, progress, each=add).awaitTermination()
    if not taken:
        return None
    if not parts.has(STANDING):
        other = SOURCE_A if source == SOURCE_B else SOURCE_B
        parts.add(_listings(spark, at, {})[other], other, STANDING)
    _store_gold(spark, at, lambda: gold_rows(parts.silver().drop("batch_id"), weights=parts.weights(), **options))
    return refresh_serving(spark, at)
